"""JSON messages to typed rows and back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType


def to_messages(df: DataFrame) -> DataFrame:
    """One JSON object per row, NULLs kept, no message key."""
    return df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"))


def decode(messages: DataFrame, schema: StructType, value: str = "value") -> DataFrame:
    """Add the schema's columns and ``_reason``, which is NULL for a good message.

    Members the schema does not name are ignored.  A member that is null is a NULL; a member that
    is absent, or whose text does not fit the column's type, is a reason to refuse the message.
    """
    kept = [f"`{c}`" for c in messages.columns]
    fields = schema.fields
    text = f"string({value})"
    # The message is parsed once, to its members as text; then members become values.
    parsed = messages.selectExpr(
        *kept, f"is_valid_utf8({text}) AS _valid", f"from_json({text}, 'MAP<STRING, STRING>') AS _members"
    )
    parsed = parsed.selectExpr(
        *kept,
        "CASE WHEN NOT _valid THEN 'not UTF-8' WHEN _members IS NULL THEN 'not a JSON object' END AS _flaw",
        "_members",
        f"named_struct({', '.join(f"""'{f.name}', try_element_at(_members, '{f.name}')""" for f in fields)}) AS _text",
    )
    # Only a member without text can be absent.
    absent = _names_where({f.name: f"_text.`{f.name}` IS NULL AND NOT map_contains_key(_members, '{f.name}')" for f in fields})
    parsed = parsed.selectExpr(*kept, "_flaw", f"{absent} AS _absent", "_text")
    typed = parsed.selectExpr("*", *[f"{_typed(f)} AS `{f.name}`" for f in fields])
    checked = [f for f in fields if not isinstance(f.dataType, StringType)]
    unfit = _names_where({f.name: f"_text.`{f.name}` IS NOT NULL AND `{f.name}` IS NULL" for f in checked})
    empty = _names_where({f.name: f"`{f.name}` IS NULL" for f in fields if not f.nullable})
    reason = f"""CASE WHEN _flaw IS NOT NULL THEN _flaw
        WHEN _absent != '' THEN concat('absent: ', _absent)
        WHEN {unfit} != '' THEN concat('wrong type: ', {unfit})
        WHEN {empty} != '' THEN concat('NULL key: ', {empty}) END AS _reason"""
    return typed.selectExpr(*kept, *[f"`{f.name}`" for f in fields], reason)


def _names_where(conditions: dict[str, str]) -> str:
    """SQL text for the names whose condition holds, as one text."""
    found = [f"CASE WHEN {condition} THEN '{name}' END" for name, condition in conditions.items()]
    return f"concat_ws(', ', {', '.join(found)})" if found else "''"


def _typed(field: StructField) -> str:
    text = f"_text.`{field.name}`"
    if isinstance(field.dataType, IntegerType):
        # A number with a fraction is rounded on assignment, halves away from zero.
        return f"try_cast(round(try_cast({text} AS DOUBLE)) AS INT)"
    return f"try_cast({text} AS {field.dataType.simpleString()})"
