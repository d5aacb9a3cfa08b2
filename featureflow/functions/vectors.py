"""Array/vector columns: argmax, probability lookup, log-loss term."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LOG_EPS = 1e-15


def argmax(values: Column) -> Column:
    """0-based position of the first maximum (ties -> lowest position)."""
    return (F.array_position(values, F.array_max(values)) - 1).cast("int")


def prob_at(prob: Column, index: Column) -> Column:
    """``prob[index]`` (0-based); out of range or NULL -> NULL (never raises)."""
    return F.when(index >= 0, F.try_element_at(prob, index.cast("int") + 1))


def log_loss_term(p: Column, on_zero: str = "clip", eps: float = LOG_EPS) -> Column:
    """``-ln p`` of the true class.

    ``clip``: p is raised to ``eps`` first, so p = 0 (or a class outside the
    vector, p NULL) costs ``-ln eps``. ``zero``: such rows cost 0.0, the rule
    of the original trainer.
    """
    if on_zero == "clip":
        return -F.ln(F.greatest(F.coalesce(p, F.lit(0.0)), F.lit(eps)))
    if on_zero == "zero":
        return F.when(p.isNull() | (p <= 0), F.lit(0.0)).otherwise(-F.ln(p))
    raise ValueError(f"on_zero must be 'clip' or 'zero', not {on_zero!r}")


def rounded(values: Column, digits: int) -> Column:
    return F.transform(values, lambda x: F.round(x, digits))
