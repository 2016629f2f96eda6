"""Ratios, cut points and flags."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from riskloom import constants as K
from riskloom.functions.text import _col


def nan_to_null(x) -> Column:
    value = _col(x)
    return F.when(~F.isnan(value), value)


def share(a, b) -> Column:
    """a / b within [0, 1]; NULL when b is 0."""
    ratio = _col(a) / F.nullif(_col(b), F.lit(0))
    return F.when(ratio.isNotNull(), F.least(F.lit(1.0), F.greatest(F.lit(0.0), ratio)))


def ratio_or_zero(a, b) -> Column:
    """a / b; 0 when b is 0 or either side is missing."""
    return F.coalesce(_col(a) / F.nullif(_col(b), F.lit(0)), F.lit(0.0))


def alert_flag(score, threshold) -> Column:
    limit = threshold if isinstance(threshold, Column) else F.lit(threshold)
    return (_col(score) >= limit).cast("int")


def trend(first, last, delta: float = K.TREND_DELTA) -> Column:
    change = _col(last) - _col(first)
    return (
        F.when(change > delta, "worse").when(change < -delta, "better").otherwise("stable")
    )


def cut_index(column: str, edges: Sequence[float]) -> Column:
    """How many of the sorted ``edges`` are <= the column, as a balanced tree of comparisons.

    A decision tree of depth log2(len(edges)) compiles to a few branches per row and
    compares with the very literals given, so float edges match to the last bit.
    """
    name = f"`{column}`"

    def tree(lo: int, hi: int) -> str:
        if lo == hi:
            return str(lo)
        mid = (lo + hi) // 2
        return f"IF({name} >= {float(edges[mid])!r}D, {tree(mid + 1, hi)}, {tree(lo, mid)})"

    return F.expr(f"IF({name} IS NULL, NULL, {tree(0, len(edges))})")


def expires_at(created, days: int = K.RETENTION_DAYS) -> Column:
    return _col(created) + F.make_dt_interval(F.lit(days))


def days_left(expires, now) -> Column:
    """Whole days until ``expires``, rounded down also when already past."""
    seconds = _col(expires).cast("timestamp").cast("double") - _col(now).cast("timestamp").cast(
        "double"
    )
    return F.floor(seconds / 86400.0).cast("long")
