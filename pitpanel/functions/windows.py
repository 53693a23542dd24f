"""The single home of strictly-prior window frames.

``shift(1)`` followed by ``rolling(n)`` / ``expanding()`` in a per-entity
time series is exactly a rows frame ``[-n, -1]`` / ``[unbounded, -1]``.
Every prior-only feature in this package builds its frame here, so the
leakage contract ("row t never sees t or later") is provable in one place.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F


def ordered(keys: Sequence[str], order: Sequence[str | Column]) -> WindowSpec:
    return Window.partitionBy(*keys).orderBy(*order)


def prior(keys: Sequence[str], order: Sequence[str | Column], n: int | None = None) -> WindowSpec:
    """Rows strictly before the current row: ``[-n, -1]`` or ``[unbounded, -1]``."""
    start = Window.unboundedPreceding if n is None else -int(n)
    return ordered(keys, order).rowsBetween(start, -1)


def prior_range(keys: Sequence[str], order_col: str, span: int | None = None) -> WindowSpec:
    """Strictly earlier *values* of ``order_col`` (e.g. ``year < t``).

    A range frame ending at -1 excludes every row sharing the current order
    value, so duplicates of the current period never leak into its history.
    """
    start = Window.unboundedPreceding if span is None else -int(span)
    return Window.partitionBy(*keys).orderBy(F.col(order_col)).rangeBetween(start, -1)


def running(keys: Sequence[str], order: Sequence[str | Column]) -> WindowSpec:
    """Prefix frame including the current row (for run lengths)."""
    return ordered(keys, order).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def gated_avg(c: str, w: WindowSpec, min_periods: int = 1) -> Column:
    """Mean over the frame, NULL unless at least ``min_periods`` non-NULL values."""
    return F.when(F.count(F.col(c)).over(w) >= min_periods, F.avg(F.col(c)).over(w))


def gated_std(c: str, w: WindowSpec, min_periods: int = 2) -> Column:
    """Sample std over the frame, NULL unless ``min_periods`` non-NULL values."""
    return F.when(F.count(F.col(c)).over(w) >= min_periods, F.stddev_samp(F.col(c)).over(w))
