"""Landed feeds and reference files, batch and streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StringType, StructType

CELL_ROWS = ArrayType(ArrayType(StringType()))

#: Offsets of a topic's partition that one task puts in order.
RANGE = 1 << 14

# Order of files by landing time, and of the splits of a file.
_FILE = ("_metadata.file_modification_time", "_metadata.file_path", "_metadata.file_block_start")


def read_feed(spark: SparkSession, path: str, schema: StructType | str, format: str = "json", **options) -> DataFrame:
    """Landed feed records with ``_arrival``, their position in the feed."""
    feed = spark.read.schema(schema).options(**options).format(format).load(path)
    return feed.select("*", F.struct(*_FILE, F.monotonically_increasing_id().alias("row")).alias("_arrival"))


def read_reference(spark: SparkSession, path: str, value: StructType | ArrayType | str) -> DataFrame:
    """A keyed reference table stored as JSON lines ``{"key": ..., "value": ...}``: splittable."""
    kind = value if isinstance(value, str) else value.simpleString()
    return spark.read.schema(f"key string, value {kind}").json(path)


def read_reference_object(spark: SparkSession, path: str, value: StructType | ArrayType | str) -> DataFrame:
    """The same table out of files that each hold one JSON object, a member per key.

    Each file is one record here, read by one task (``sources.objects.read_large_object`` splits it); write it back with
    ``write_reference`` and read the lines from then on.  Members are parsed one by one, so one of another shape (a text
    in place of rows) gives a NULL value instead of losing the file.
    """
    members = spark.read.text(path, wholetext=True).select(
        F.explode(F.from_json("value", MapType(StringType(), StringType()))).alias("key", "text")
    )
    return members.select("key", F.from_json("text", value).alias("value"))


def write_reference(df: DataFrame, path: str, key: str, value: str) -> None:
    """JSON lines, one per key."""
    df.select(F.col(key).cast("string").alias("key"), F.col(value).alias("value")).write.mode("overwrite").option(
        "ignoreNullFields", "false"
    ).json(path)


def kafka_messages(spark: SparkSession, servers: str, topic: str, **options) -> DataFrame:
    """A topic from its first offset, as (value, arrival).

    Lost offsets stop the query.  Within a partition the offsets decide, whatever a producer's clock
    says: ``arrival`` goes by the greatest time up to the message's own offset.  Messages carry no
    key, so across partitions only these times order them; let the broker stamp them
    (``message.timestamp.type=LogAppendTime``).
    """
    raw = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .option("failOnDataLoss", "true")
        .options(**options)
        .load()
    )
    return topic_arrival(raw)


def topic_arrival(raw: DataFrame) -> DataFrame:
    """(value, arrival) of a topic's rows; ``in_batch`` turns this arrival into a sortable one."""
    return raw.select("value", F.struct("timestamp", "partition", "offset").alias("arrival"))


def in_batch(messages: DataFrame) -> DataFrame:
    """The rows of one batch with an ``arrival`` that never goes back within a partition of the topic.

    Each time is raised to the greatest one before it in its partition: the greatest before it in its range of
    offsets, and that of the ranges before, of which there is one row each.  So a partition's messages are shared by as
    many tasks as it has ranges.
    """
    fields = messages.schema["arrival"].dataType
    if "offset" not in getattr(fields, "names", ()):
        return messages
    places = messages.select(
        F.col("arrival.partition").alias("_part"), F.floor(F.col("arrival.offset") / RANGE).alias("_range"), "arrival.timestamp"
    )
    greatest = places.groupBy("_part", "_range").agg(F.max("timestamp").alias("_greatest"))
    before = Window.partitionBy("_part").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    greatest = greatest.select("_part", "_range", F.max("_greatest").over(before).alias("_before"))
    ranges = messages.withColumn("_p", F.col("arrival.partition")).withColumn("_r", F.floor(F.col("arrival.offset") / RANGE))
    so_far = Window.partitionBy("_p", "_r").orderBy("arrival.offset").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranges = ranges.withColumn("_within", F.max("arrival.timestamp").over(so_far))
    same = F.col("_p").eqNullSafe(F.col("_part")) & F.col("_r").eqNullSafe(F.col("_range"))
    # One row for a range: few enough to be sent to all tasks.
    met = ranges.join(F.broadcast(greatest), same, "left")
    return met.withColumn("_time", F.greatest("_before", "_within")).select(
        *[c for c in messages.columns if c != "arrival"],
        F.struct(F.col("_time").alias("timestamp"), "arrival.partition", "arrival.offset").alias("arrival"),
    )


def landed_messages(spark: SparkSession, path: str, **options) -> DataFrame:
    """The same stream out of text files with one message per line, ordered by landing time."""
    raw = spark.readStream.format("text").options(**options).load(path)
    return raw.select(F.col("value").cast("binary").alias("value"), F.struct(*_FILE).alias("arrival"))


def landed_observations(spark: SparkSession, path: str, schema: StructType, format: str = "json", **options) -> DataFrame:
    """A stream of landed flight records."""
    return spark.readStream.format(format).schema(schema).options(**options).load(path)


def topic_table(topic: str) -> str:
    """``raw_flight_data`` feeds the table ``flight``."""
    return topic.split("_")[1]
