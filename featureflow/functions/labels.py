"""Class-name <-> code columns."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# The seven emotion classes and their codes, as the training
# data of the original pipeline uses them.
EMOTION_CODES = {
    "angry": 0,
    "fear": 1,
    "neutral": 2,
    "sad": 3,
    "disgust": 4,
    "happy": 5,
    "surprise": 6,
}

UNKNOWN_CODE = -1


def mapping_literal(mapping: Mapping[str, int]) -> Column:
    """A literal MAP<STRING, INT> column (folded into the plan; no join, no UDF)."""
    if not mapping:
        raise ValueError("label mapping is empty")
    pairs = []
    for name, code in sorted(mapping.items(), key=lambda kv: kv[1]):
        pairs += [F.lit(str(name)), F.lit(int(code))]
    return F.create_map(*pairs)


def label_code(label: Column, mapping: Mapping[str, int]) -> Column:
    """Code of ``label``; NULL or unmapped names give -1."""
    return F.coalesce(F.try_element_at(mapping_literal(mapping), label), F.lit(UNKNOWN_CODE))
