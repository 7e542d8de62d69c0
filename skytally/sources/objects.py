"""The members of one huge JSON object, read by many tasks.

The file is cut at commas, which Spark does in parallel by byte ranges.  Whether a comma parts two members of the object
depends on all before it: whether it stands in a text, and how deep.  Each range of the file is summed up for
both cases, beginning in a text or not, as a change of that state and of the depth; a scan over these sums,
one row per range, gives the state each range begins in.  Then ranges are read again, now knowing it, and the pieces of
a member, also one that crosses ranges, meet by its number.  A member is held whole by one task, the file by none.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StringType, StructType

from skytally.session import shared_dir

# Workers get the functions themselves, so the package need not be installed on the executors.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_MARKS = re.compile(r'\\.|["{}\[\]]', re.S)


def _scan(text: str, inside: bool) -> tuple[bool, int]:
    """Whether the text ends in a JSON text, and the change of depth, given whether it begins in one."""
    depth = 0
    for mark in _MARKS.findall(text):
        if mark == '"':
            inside = not inside
        elif not inside and mark in "{[":
            depth += 1
        elif not inside and mark in "}]":
            depth -= 1
    return inside, depth


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per range: whether the state changes over it, and the depth's change if it begins outside a text, or inside."""
    found: dict[tuple[str, int], list] = {}
    for batch in batches:
        for value, file, block in zip(*(c.to_pylist() for c in batch.columns)):
            state = found.setdefault((file, block), [[False, 0], [True, 0]])
            for begin in state:
                begin[0], change = _scan(value, begin[0])
                begin[1] += change
    rows = [(f, b, s[0][0], s[0][1], s[1][1]) for (f, b), s in found.items()]
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], ["file", "block", "flips", "outside", "inside"])


def _begins(ranges: pd.DataFrame) -> pd.DataFrame:
    """State and depth at the begin of each range of a file, out of its sums."""
    inside, depth, out = False, 0, []
    for row in ranges.sort_values("block").itertuples(index=False):
        out.append((row.file, row.block, inside, depth))
        depth += row.inside if inside else row.outside
        inside ^= row.flips
    return pd.DataFrame(out, columns=["file", "block", "in_text", "depth"])


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each piece with the number of members that have begun in its range so far; first and last brace are cut off."""
    state: dict[tuple[str, int], list] = {}
    for batch in batches:
        values, files, blocks, at, in_text, depths = (c.to_pylist() for c in batch.columns)
        rows = []
        for value, file, block, place, inside, depth in zip(values, files, blocks, at, in_text, depths):
            now = state.setdefault((file, block), [inside, depth, 0])
            # A comma at depth 1 outside of texts has come before this piece; the first piece begins at depth 0.
            now[2] += not now[0] and now[1] <= 1
            begins_object = now[1] == 0 and not now[0]
            now[0], change = _scan(value, now[0])
            now[1] += change
            if begins_object:
                value = value.lstrip("\ufeff \t\r\n")[1:]
            if now[1] == 0 and not now[0]:
                value = value.rstrip()[:-1]
            rows.append((file, block, place, now[2], value))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], ["file", "block", "at", "begun", "value"])


def read_large_object(spark: SparkSession, path: str, value: StructType | ArrayType | str) -> DataFrame:
    """(key, value) of the members of the JSON objects in the files, one object a file.

    As in ``read_reference_object``, a member of another shape gives a NULL value; members without text are skipped.
    """
    text = spark.read.option("lineSep", ",").text(path)
    file, block = F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")
    text = text.select("value", file, block, F.monotonically_increasing_id().alias("at"))
    sums = text.select("value", "file", "block").mapInArrow(_sums, "file string, block long, flips boolean, outside long, inside long")
    begins = sums.groupBy("file").applyInPandas(_begins, "file string, block long, in_text boolean, depth long")
    begins = _stored(begins)
    # One row per range: the pieces stay where they are, and in order.
    known = text.join(F.broadcast(begins), ["file", "block"]).select("value", "file", "block", "at", "in_text", "depth")
    pieces = _stored(known.mapInArrow(_pieces, "file string, block long, at long, begun long, value string"))
    ranges = pieces.groupBy("file", "block").agg(F.max("begun").alias("n"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select("file", "block", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    numbered = pieces.join(ranges, ["file", "block"]).withColumn("member", F.col("before") + F.col("begun"))
    ordered = F.array_sort(F.collect_list(F.struct("block", "at", "value")))
    members = numbered.groupBy("file", "member").agg(F.array_join(F.transform(ordered, lambda p: p["value"]), ",").alias("text"))
    pairs = F.from_json(F.concat(F.lit("{"), "text", F.lit("}")), MapType(StringType(), StringType()))
    found = members.filter(F.trim("text") != "").select(F.explode(pairs).alias("key", "text"))
    return found.select("key", F.from_json("text", value).alias("value"))


def _stored(rows: DataFrame) -> DataFrame:
    path = shared_dir(rows.sparkSession, "object")
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)
