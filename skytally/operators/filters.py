"""Row predicates of the flight jobs.  All are plain Column filters, so they reach the scan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skytally.functions.clock import Instant, window_start


def recent(df: DataFrame, as_of: Instant, seconds: int, column: str = "time", replay: bool = False) -> DataFrame:
    """Rows observed less than ``seconds`` before ``as_of`` (a row exactly that old is out).

    ``replay`` also drops rows observed after ``as_of``, to run an old clock over a finished table.
    """
    kept = df.filter(F.col(column) > window_start(as_of, seconds))
    return kept.filter(F.col(column) <= window_start(as_of, 0)) if replay else kept


def in_the_air(df: DataFrame) -> DataFrame:
    return df.filter(F.col("on_ground") == 0)


def non_empty(df: DataFrame, column: str) -> DataFrame:
    """Rows whose text is neither '' nor NULL."""
    return df.filter(F.col(column) != "")


def equal_columns(df: DataFrame, left: str, right: str) -> DataFrame:
    """Rows where both columns hold the same value; NULL equals nothing."""
    return df.filter(F.col(left) == F.col(right))
