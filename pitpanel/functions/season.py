"""Season calendar: growing-season predicates and checkpoint cutoffs."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Growing season and thresholds of the reference feature set.
SEASON_START_MONTH = 4          # April
SEASON_END_MONTH = 8            # August
FULL_SEASON_DAYS = 153          # Apr 30 + May 31 + Jun 30 + Jul 31 + Aug 31
GDD_BASE_TEMP_C = 10.0
EXTREME_HEAT_C = 35.0
DRY_DAY_MM = 1.0
STRESS_LAST_N_DAYS = 30

# Checkpoint name -> "MM-DD" cutoff (None = whole season) and
# the number of season days through that cutoff.
CHECKPOINTS: dict[str, str | None] = {
    "may_31": "05-31",
    "june_30": "06-30",
    "july_31": "07-31",
    "august_31": "08-31",
    "full_season": None,
}
CHECKPOINT_DAYS: dict[str, int] = {
    "may_31": 61,
    "june_30": 91,
    "july_31": 122,
    "august_31": 153,
    "full_season": 153,
}
# Checkpoints whose window contains July (heat-after-July-1 is defined).
JULY_CHECKPOINTS = ("july_31", "august_31", "full_season")


def _d(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def in_season(date_col="date", start_month: int = SEASON_START_MONTH,
              end_month: int = SEASON_END_MONTH) -> Column:
    """start_month <= month(date) <= end_month."""
    m = F.month(_d(date_col))
    return (m >= start_month) & (m <= end_month)


def parse_month_day(md: str) -> tuple[int, int]:
    mm, dd = md.split("-")
    return int(mm), int(dd)


def month_day_key(date_col="date") -> Column:
    """Year-agnostic ordinal ``month * 100 + day`` for cutoff comparisons."""
    d = _d(date_col)
    return F.month(d) * 100 + F.dayofmonth(d)


def within_month_day(date_col, md: str) -> Column:
    """inclusive year-agnostic cutoff ``MM-DD``."""
    mm, dd = parse_month_day(md)
    return month_day_key(date_col) <= mm * 100 + dd


def on_or_before(date_col, cutoff) -> Column:
    """inclusive absolute cutoff date."""
    if isinstance(cutoff, str):
        cutoff = _dt.date.fromisoformat(cutoff[:10])
    return _d(date_col) <= F.lit(cutoff)


def season_filter(date_col="date", cutoff_date=None, cutoff_month_day: str | None = None) -> Column:
    """F1 + F2/F3; the month-day cutoff wins when both are given."""
    cond = in_season(date_col)
    if cutoff_month_day is not None:
        cond = cond & within_month_day(date_col, cutoff_month_day)
    elif cutoff_date is not None:
        cond = cond & on_or_before(date_col, cutoff_date)
    return cond


def checkpoint_end_md(name: str) -> str:
    md = CHECKPOINTS[name]
    return md if md is not None else f"{SEASON_END_MONTH:02d}-31"


def validate_checkpoints(names) -> list[str]:
    names = list(names) if names else list(CHECKPOINTS)
    for n in names:
        if n not in CHECKPOINTS:
            raise ValueError(f"Unknown checkpoint {n!r}. Choose from: {list(CHECKPOINTS)}")
    return names
