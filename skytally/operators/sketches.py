"""Distinct counts over any span of batches, from sketches that are stored once per batch.

A sketch of a group's values has a fixed size however many they are, and sketches of batches unite to that
of all their rows.  A count from one is off by a known share: ``relative_error`` for one standard deviation.  Exact
counts stay the default of the jobs; these are for spans whose rows are not read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Binary logarithm of a sketch's number of registers.
PRECISION = 14


def relative_error(precision: int = PRECISION) -> float:
    return 1.04 / 2 ** (precision / 2)


def sketched(rows: DataFrame, by: list[str], value: str, precision: int = PRECISION) -> DataFrame:
    """(by, sketch): one sketch of the values of each group; NULL values don't count."""
    return rows.groupBy(*by).agg(F.hll_sketch_agg(value, precision).alias("sketch"))


def united(sketches: DataFrame, by: list[str], name: str = "n") -> DataFrame:
    """(by, name): about how many distinct values the groups' sketches have seen together."""
    return sketches.groupBy(*by).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias(name))
