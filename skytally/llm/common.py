"""Small helpers that the operators share."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skytally.session import shared_dir

# Words are runs of anything but ASCII white space, in Java's, Python's and SQL engines' patterns alike.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write the rows to a new shared folder and read them back: cuts the plan, survives lost executors,
    and gives Spark the real size of the rows for its choice of joins."""
    path = shared_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored_by(df: DataFrame, key: str, purpose: str) -> DataFrame:
    """Like ``stored``, bucketed by a column: joins and groups by it leave these rows where they are.

    Spark knows buckets of catalog tables only.  The table's name is given up again once it is read; its
    files stay in the shared folder.
    """
    spark = df.sparkSession
    path = shared_dir(spark, purpose)
    name = path.rsplit("/", 1)[1].replace("-", "_")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.format("parquet").option("path", path).bucketBy(n, key).sortBy(key).saveAsTable(name)
    rows = spark.table(name)
    rows.schema  # resolved now, while the name is known
    spark.sql(f"DROP TABLE {name}")
    return rows


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names like the given ones that the frame doesn't have."""
    taken = {c.lower() for c in df.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found


def word_count(text: Column) -> Column:
    """Number of words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


_kept: dict[str, Callable[[], None]] = {}
_last = [""]


def keeps(operator: str, clear: Callable[[], None]) -> None:
    """Say that an operator's tasks leave something in this worker for those after them."""
    _kept[operator] = clear


def begin(operator: str) -> None:
    """A task of an operator begins: what other operators keep in this worker goes, its memory back to the system."""
    if _last[0] == operator:
        return
    before, _last[0] = _last[0], operator
    for name in [name for name in _kept if name != operator]:
        _kept.pop(name)()
    if before:
        gc.collect()
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim:
            trim(0)


@contextmanager
def arrow_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Arrow batches of so many rows for what is run inside: for rows of several whole texts."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)
