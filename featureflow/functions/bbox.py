"""Bounding-box text -> four integers, as native expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# an integer field as int() reads it: optional spaces, optional sign, digits
_INT_FIELD = r"^ *[+-]?[0-9]+ *$"


def bbox_parts(text: Column) -> Column:
    """``array<int>`` of the comma-separated fields; a field that is not an
    integer (or does not fit an int) is NULL inside the array."""
    return F.transform(
        F.split(text, ","),
        lambda x: F.when(x.rlike(_INT_FIELD), F.trim(x).try_cast("int")),
    )


def bbox_ok(parts: Column) -> Column:
    """Exactly four fields, all integers."""
    return (
        parts.isNotNull()
        & (F.size(parts) == 4)
        & ~F.exists(parts, lambda x: x.isNull())
    )
