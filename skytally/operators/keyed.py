"""One row per key, and the best k rows per group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANKINGS = {"row_number": F.row_number, "rank": F.rank, "dense_rank": F.dense_rank}


def latest_per_key(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The row with the greatest ``order`` per key (last one wins).

    Each task first keeps one row per key of its own input, so a key held by a large part of the
    rows costs no more than any other; columns nobody asks for are not read.
    """
    newest = Window.partitionBy(key).orderBy(*[F.desc_nulls_last(c) for c in order])
    return df.withColumn("_n", F.row_number().over(newest)).filter(F.col("_n") == 1).drop("_n")


def distinct_on(df: DataFrame, key: str, newest: str) -> DataFrame:
    """One row per key: the newest, and among equally new ones the greatest by the other columns."""
    others = [c for c in df.columns if c not in (key, newest)]
    top = df.groupBy(key).agg(F.max(F.struct(newest, *others)).alias("_row"))
    return top.select(*[F.col(key) if c == key else F.col("_row")[c].alias(c) for c in df.columns])


def top_k_per_group(
    df: DataFrame, group: str, order: list[Column], k: int, ties: str = "row_number", rank_column: str = "rank"
) -> DataFrame:
    """The first k rows of each group.  Tasks keep k rows per group before the shuffle."""
    ranking = _RANKINGS[ties]().over(Window.partitionBy(group).orderBy(*order))
    return df.withColumn(rank_column, ranking).filter(F.col(rank_column) <= k)


def top_rows(df: DataFrame, order: list[Column], k: int = 1) -> DataFrame:
    """The first k rows overall."""
    return df.orderBy(*order).limit(k)


def descending(column: str, nulls: str = "first") -> Column:
    """Descending order; NULLs come first unless asked otherwise."""
    return F.desc_nulls_first(column) if nulls == "first" else F.desc_nulls_last(column)
