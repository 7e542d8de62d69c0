"""String and cell functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _column(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def first_word(c) -> Column:
    """Text before the first space; the whole text if there is none; '' for ''; NULL for NULL."""
    return F.split_part(_column(c), F.lit(" "), F.lit(1))


def field_after(c, delimiter: str = ":") -> Column:
    """Text between the first delimiter and the next; NULL if there is no delimiter."""
    return F.get(F.split(_column(c), rf"\Q{delimiter}\E"), F.lit(1))


def strip(c) -> Column:
    """Remove white space of any kind, Unicode spaces included, from both ends."""
    return F.regexp_replace(_column(c), r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")


def non_empty_cells(rows) -> Column:
    """Cells of all rows in order, without the empty ones."""
    return F.filter(F.flatten(_column(rows)), lambda cell: F.length(cell) > 0)
