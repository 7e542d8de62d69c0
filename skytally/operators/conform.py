"""Assignment of computed rows to a table's column types, and null policies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    CharType,
    DataType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    VarcharType,
)

_NUMBERS = (LongType, FloatType, DoubleType, DecimalType)


def _assign(field: StructField, source: DataType) -> str:
    """SQL text that assigns the column of the field's name to the field."""
    name, column, target = field.name, f"`{field.name}`", field.dataType
    if isinstance(target, (VarcharType, CharType)):
        limit = target.length
        value = f"string({column})"
        value = f"CASE WHEN length({value}) > {limit} THEN raise_error('{name}: text longer than {limit}') ELSE {value} END"
    elif isinstance(target, IntegerType) and isinstance(source, _NUMBERS):
        # Floating numbers go to the even neighbour, decimal ones away from zero.
        whole = column
        if isinstance(source, (FloatType, DoubleType)):
            whole = f"bround(double({column}), 0)"
        elif isinstance(source, DecimalType):
            whole = f"round({column})"
        value = (
            f"CASE WHEN {whole} NOT BETWEEN -2147483648 AND 2147483647 "
            f"THEN raise_error('{name}: integer out of range') ELSE int({whole}) END"
        )
    else:
        value = f"CAST({column} AS {target.simpleString()})"
    if not field.nullable:
        value = f"coalesce({value}, raise_error('{name}: NULL in a required column'))"
    return f"{value} AS {column}"


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Cast to the table's columns as an INSERT would.

    Too long a text, too large a number or a NULL in a required column raises when the row is
    computed, so the whole batch fails and nothing of it is stored.
    """
    sources = {f.name: f.dataType for f in df.schema.fields}
    return df.selectExpr(*[_assign(f, sources[f.name]) for f in schema.fields])


def split_nulls(df: DataFrame, required: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows complete in the required columns, the other rows)."""
    incomplete = F.lit(False)
    for name in required:
        incomplete = incomplete | F.col(name).isNull()
    return df.filter(~incomplete), df.filter(incomplete)


def storage_schema(schema: StructType) -> StructType:
    """The schema as Parquet readers see it: length limits are checked on write only."""
    out = StructType()
    for field in schema.fields:
        text = isinstance(field.dataType, (VarcharType, CharType))
        out = out.add(field.name, StringType() if text else field.dataType, True)
    return out
