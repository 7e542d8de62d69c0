"""Message stream to current-state table; J14: observations to message stream."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from skytally.operators.records import public_columns
from skytally.operators.tables import KeyedTable
from skytally.sources.feeds import in_batch
from skytally.streaming.messages import decode, to_messages

#: Messages that one task decodes, where a batch is spread.
PER_TASK = 250_000


def ingest_batch(
    messages: DataFrame,
    table: KeyedTable,
    batch_id: int,
    quarantine: str | None,
    on_bad: str = "quarantine",
    writer: str = "",
) -> None:
    """Upsert one micro-batch of (value, arrival).

    Refused messages go to ``quarantine/writer=.../batch_id=...`` with the reason, or raise with
    ``on_bad="fail"``.  Both writes replace what an earlier try of the same writer's batch left.
    """
    if on_bad not in ("quarantine", "fail"):
        raise ValueError(f"unknown policy {on_bad!r}")
    decoded = decode(messages, table.spec.schema)
    if on_bad == "fail":
        good = decoded.withColumn(
            table.spec.key,
            F.when(F.col("_reason").isNotNull(), F.raise_error(F.col("_reason")).cast("string")).otherwise(
                F.col(table.spec.key)
            ),
        )
        table.upsert(good, batch_id, "arrival", writer)
        return
    decoded = decoded.persist()
    try:
        bad = decoded.filter(F.col("_reason").isNotNull()).select("value", "arrival", F.col("_reason").alias("reason"))
        bad.write.mode("overwrite").parquet(f"{quarantine}/writer=s{writer}/batch_id={batch_id}")
        table.upsert(decoded.filter(F.col("_reason").isNull()), batch_id, "arrival", writer)
    finally:
        decoded.unpersist()


def ingest(
    messages: DataFrame,
    table: KeyedTable,
    checkpoint: str,
    quarantine: str | None = None,
    on_bad: str = "quarantine",
    trigger: dict | None = None,
    partitions: int | None = None,
    compact_every: int | None = 100,
    keep: int = 10,
    after_batch: Callable[[KeyedTable, int], None] | None = None,
) -> StreamingQuery:
    """Run the stream of (value, arrival) into the table.

    The checkpoint holds the position, so a restart goes on where the last finished batch ended.
    ``partitions`` spreads a batch's messages over so many tasks where the source has few splits, and over more where
    these would have more than ``PER_TASK`` messages each; for that the batch is counted first.
    ``compact_every`` folds the deltas after so many batches and removes folders that none of the last ``keep`` lists
    names: as many lists as the longest reader may take (a batch makes one, a compaction another).
    ``after_batch`` may run queries over the new state.

    Batches are known by the stream's id, which lies in the checkpoint: a new checkpoint is a new
    writer, whose batches count whatever their numbers.  A topic's first batch takes all there is; bound
    it with the source's own option (``maxOffsetsPerTrigger``, ``maxFilesPerTrigger``).
    """
    quarantine = quarantine or f"{table.path}_quarantine"

    def run(batch: DataFrame, batch_id: int) -> None:
        # Where arrivals are equal (lines of one file), the order of reading decides.
        numbered = in_batch(batch).withColumn("arrival", F.struct("arrival", F.monotonically_increasing_id().alias("row")))
        spread = numbered.repartition(max(partitions, math.ceil(batch.count() / PER_TASK))) if partitions else numbered
        writer = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        ingest_batch(spread, table, batch_id, quarantine, on_bad, writer)
        if compact_every and (batch_id + 1) % compact_every == 0:
            table.compact()
            table.retire(keep)
        if after_batch:
            after_batch(table, batch_id)

    return (
        messages.writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .queryName(f"ingest_{table.spec.name}")
        .trigger(**(trigger or {"processingTime": "10 seconds"}))
        .start()
    )


def publish(
    observations: DataFrame, checkpoint: str, format: str = "kafka", trigger: dict | None = None, **options
) -> StreamingQuery:
    """Send each observation's public columns as one JSON message.

    ``options`` go to the sink: ``topic`` and ``kafka.bootstrap.servers``, or ``path`` for text files.
    """
    return (
        to_messages(public_columns(observations))
        .writeStream.format(format)
        .options(**options)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "300 seconds"}))
        .start()
    )
