"""Validation splits.

Only bounded scalars reach the driver: the ``n + 1`` largest distinct years
for a temporal cutoff, or the distinct year list for fold generation (one
value per period).  Rows are never collected.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitpanel.schema import require_columns


def temporal_cutoff(df: DataFrame, n_test_years: int = 3, year_col: str = "year") -> int:
    top = [r[0] for r in df.select(year_col).where(F.col(year_col).isNotNull()).distinct()
           .orderBy(F.col(year_col).desc()).limit(n_test_years + 1).collect()]
    if len(top) <= n_test_years:
        raise ValueError(f"{n_test_years} test years leave no training year: the data has {len(top)}")
    return int(top[n_test_years - 1])


def temporal_split(df: DataFrame, n_test_years: int = 3, year_col: str = "year"):
    """T5: the latest ``n_test_years`` distinct years are test."""
    cutoff = temporal_cutoff(df, n_test_years, year_col)
    return df.filter(F.col(year_col) < cutoff), df.filter(F.col(year_col) >= cutoff)


def tag_temporal_split(df: DataFrame, n_test_years: int = 3, year_col: str = "year",
                       split_col: str = "split") -> DataFrame:
    """T5 as one tagged DataFrame (``train`` / ``test``)."""
    cutoff = temporal_cutoff(df, n_test_years, year_col)
    return df.filter(F.col(year_col).isNotNull()).withColumn(
        split_col, F.when(F.col(year_col) < cutoff, "train").otherwise("test"))


def spatial_split(df: DataFrame, holdout: str, state_col: str = "state", check: bool = True):
    """Hold one state out; error when it has no rows."""
    test = df.filter(F.col(state_col) == holdout)
    if check and not test.limit(1).count():
        raise ValueError(f"the held-out state {holdout!r} has no rows")
    return df.filter(~(F.col(state_col) == holdout) | F.col(state_col).isNull()), test


def expanding_folds(df: DataFrame, min_train_years: int = 5, year_col: str = "year") -> DataFrame:
    """For each year after the first ``min_train_years``: train = earlier
    years, test = that year.  Long output (fold_year, role, row...), made by a
    generator over the bounded list of fold years -- no join."""
    years = sorted(r[0] for r in df.select(year_col).where(F.col(year_col).isNotNull()).distinct().collect())
    folds = years[min_train_years:]
    if not folds:
        return df.withColumn("fold_year", F.lit(None).cast("int")).withColumn("role", F.lit(None).cast("string")).limit(0)
    arr = F.array(*[F.lit(int(y)) for y in folds])
    y = F.col(year_col)
    g = F.explode(F.filter(arr, lambda f: f >= y)).alias("fold_year")
    out = df.select("*", g)
    return out.withColumn("role", F.when(F.col(year_col) < F.col("fold_year"), "train").otherwise("test"))


def assert_no_year_overlap(train: DataFrame, test: DataFrame, year_col: str = "year") -> None:
    """The two splits share no year (U2 intersect)."""
    both = train.select(year_col).distinct().intersect(test.select(year_col).distinct())
    shared = sorted(r[0] for r in both.collect())  # years: a handful
    if shared:
        raise AssertionError(f"years on both sides of the split: {shared}")


def panel_sanity_check(df: DataFrame, required: Sequence[str] = (
        "county_fips", "state", "county", "crop", "year", "actual_yield", "expected_yield", "yield_anomaly"),
        keys: Sequence[str] = ("county_fips", "crop", "year", "checkpoint")) -> None:
    """Required columns and a unique key among rows with a checkpoint."""
    require_columns(df, required, "panel")
    dup = df.dropna(subset=["checkpoint"]).groupBy(*keys).count().filter(F.col("count") > 1)
    n = dup.limit(1).count()
    if n:
        raise ValueError(f"Panel has duplicate rows on {list(keys)}")
