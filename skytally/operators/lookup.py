"""Joins against dimensions.

No side carries a broadcast hint: Spark broadcasts a dimension while its measured size is below
``autoBroadcastJoinThreshold`` and otherwise shuffles, splitting hot partitions.  Where the job is
an aggregate it is computed before the join (see ``skytally.plans.jobs``), so that a key held by a
third of the rows meets the join as one row.  Where both sides of a join hold a code many times, its rows are dealt in
tiles (``hot_codes``, ``tiled``, ``for_each_tile``), so that no task makes all pairs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fan_out(df: DataFrame, dimension: DataFrame, left: str, right: str, how: str = "inner") -> DataFrame:
    """Equi-join that keeps every matching dimension row; the dimension's key column is dropped."""
    return df.join(dimension, F.col(left) == F.col(right), how).drop(right)


def hot_codes(dimension: DataFrame, code: str, tile: int) -> DataFrame:
    """(_code, _tiles) of the codes that more than ``tile`` rows of a dimension share, cut in tiles of about that many."""
    counts = dimension.groupBy(F.col(code).alias("_code")).agg(F.count("*").alias("_n")).filter(F.col("_n") > tile)
    return counts.filter("_code IS NOT NULL").select("_code", F.ceil(F.col("_n") / tile).cast("int").alias("_tiles"))


def at_most_tiles(hot: DataFrame, most: int) -> DataFrame:
    """Hot codes with ``most`` tiles at the most: more of them would only repeat rows that meet each tile more often."""
    return hot.withColumn("_tiles", F.least("_tiles", F.lit(most)))


def tiled(dimension: DataFrame, code: str, hot: DataFrame, by: str, name: str) -> DataFrame:
    """Add the tile that a row of a dimension is in; rows of codes that aren't hot are all in tile 0."""
    rows = dimension.join(hot, F.col(code) == hot["_code"], "left")
    tile = F.pmod(F.xxhash64(by), F.coalesce("_tiles", F.lit(1))).cast("int")
    return rows.select(*dimension.columns, tile.alias(name))


def for_each_tile(rows: DataFrame, code: str, hot: DataFrame, name: str) -> DataFrame:
    """Rows once for each tile of their code, to meet its rows in equal parts: the parts' tasks share a hot fan-out."""
    found = rows.join(hot, F.col(code) == hot["_code"], "left")
    last = F.coalesce("_tiles", F.lit(1)) - 1
    return found.select(*rows.columns, F.explode(F.sequence(F.lit(0), last)).alias(name))


def with_default(df: DataFrame, reference: DataFrame, key: str, value: str, default: str) -> DataFrame:
    """Add ``value`` from ``reference``; the default stands in for a missing key only.

    ``reference`` is (key, value), one row per key.  A key that is present keeps its value even if
    that is '' or NULL.
    """
    found = reference.select(key, value, F.lit(True).alias("_found"))
    filled = F.when(F.col("_found").isNull(), F.lit(default)).otherwise(F.col(value))
    return df.join(found, key, "left").withColumn(value, filled).drop("_found")


def first_of(
    df: DataFrame, tables: list[DataFrame], key: str, value: str, on_unknown: str = "fail"
) -> DataFrame:
    """Add ``value`` from the first table that knows the key.

    A key known to no table raises when the row is computed, or gives NULL with
    ``on_unknown="null"``.
    """
    if on_unknown not in ("fail", "null"):
        raise ValueError(f"unknown policy {on_unknown!r}")
    out: Column = F.lit(None).cast("string")
    if on_unknown == "fail":
        out = F.raise_error(F.concat(F.lit(f"no {value} for {key} "), F.coalesce(F.col(key), F.lit("NULL")))).cast("string")
    joined = df
    for i in reversed(range(len(tables))):
        side = tables[i].select(F.col(key), F.col(value).alias(f"_value{i}"), F.lit(True).alias(f"_found{i}"))
        joined = joined.join(side, key, "left")
        out = F.when(F.col(f"_found{i}"), F.col(f"_value{i}")).otherwise(out)
    return joined.select(*df.columns, out.alias(value))
