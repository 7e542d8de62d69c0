"""Shape of a record: names and choice of columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lower_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def public_columns(df: DataFrame) -> DataFrame:
    """Columns whose name does not start with an underscore."""
    return df.select([F.col(f"`{c}`") for c in df.columns if not c.startswith("_")])


def project(df: DataFrame, columns: list[str]) -> DataFrame:
    """Exactly these columns, extras dropped; a column the input lacks is an error."""
    absent = [c for c in columns if c not in df.columns]
    if absent:
        raise KeyError(f"missing columns: {absent}")
    return df.select(*columns)
