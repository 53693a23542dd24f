"""Lagged yield history (W4-W8): prior-only lags and rolling statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, VariantType

from pitpanel.functions.windows import gated_avg, gated_std, ordered, prior

# Keys and window of the lag table.
LAG_KEYS = ["county_fips", "crop"]
LAG_ROLLING_WINDOW = 3
LAG_COLUMNS = [
    "prior_year_yield_anomaly", "prior_year_yield",
    "rolling_3yr_mean_yield_anomaly", "rolling_3yr_std_yield_anomaly",
    "rolling_3yr_mean_yield", "rolling_3yr_std_yield",
]


def add_lag_features(df: DataFrame, keys: Sequence[str] = LAG_KEYS, year_col: str = "year",
                     anomaly_col: str = "yield_anomaly", yield_col: str = "actual_yield",
                     tiebreak: Sequence[str] = ()) -> DataFrame:
    """Lag 1, prior 3-row mean (min 1) and sample std (min 2).
    All six share one partitioning and ordering -> one exchange, one sort."""
    order = [F.col(c) for c in dict.fromkeys([year_col, *tiebreak, yield_col, anomaly_col])]
    w_lag = ordered(keys, order)
    w3 = prior(keys, order, LAG_ROLLING_WINDOW)
    return df.select(
        "*",
        F.lag(anomaly_col, 1).over(w_lag).alias("prior_year_yield_anomaly"),
        F.lag(yield_col, 1).over(w_lag).alias("prior_year_yield"),
        gated_avg(anomaly_col, w3, 1).alias("rolling_3yr_mean_yield_anomaly"),
        gated_std(anomaly_col, w3, 2).alias("rolling_3yr_std_yield_anomaly"),
        gated_avg(yield_col, w3, 1).alias("rolling_3yr_mean_yield"),
        gated_std(yield_col, w3, 2).alias("rolling_3yr_std_yield"),
    )


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence) -> DataFrame:
    """One row per key, the least under ``order`` (values, ascending, null
    first) and then under all other columns: a total order, so the survivor
    does not depend on the partitioning (as ``dropDuplicates``'s does).  One
    ``min_by``, combined on the map side before the shuffle."""
    others = [F.col(f"`{f.name}`") for f in df.schema.fields
              if f.name not in keys and not isinstance(f.dataType, (MapType, VariantType))]
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    return df.groupBy(*keys).agg(F.min_by(row, F.struct(*order, *others)).alias("_row")).select("_row.*")


def lag_table(df: DataFrame, keys: Sequence[str] = ("county_fips", "crop", "year"),
              tiebreak: Sequence[str] = ("state", "actual_yield")) -> DataFrame:
    """Merge-ready keys + six lag columns, unique by ``keys``."""
    tb = [c for c in tiebreak if c in df.columns]
    with_lags = add_lag_features(df, tiebreak=tb)
    return keep_first(with_lags.select(*keys, *[c for c in tb if c not in keys], *LAG_COLUMNS), list(keys),
                      [F.col(c) for c in tb]).select(*keys, *LAG_COLUMNS)


def add_yield_lags(df: DataFrame, n_lags: int = 1, keys: Sequence[str] = LAG_KEYS,
                   year_col: str = "year", y_col: str = "actual_yield") -> DataFrame:
    """``yield_lag_1 .. yield_lag_n``."""
    w = ordered(keys, [F.col(year_col)])
    return df.select("*", *[F.lag(y_col, i).over(w).alias(f"yield_lag_{i}") for i in range(1, n_lags + 1)])


def add_lag_columns(df: DataFrame, keys: Sequence[str] = ("county_fips", "crop", "year"),
                    tiebreak: Sequence[str] = ("state", "actual_yield")) -> DataFrame:
    """J2 without the join: the six lag columns added in place.

    Equal to ``df LEFT JOIN lag_table(df) USING keys``: every row of a key
    gets the values of that key's first row (keep-first under the same
    total order), and the row count cannot change.  The per-key window is
    partitioned by a superset of the lag window's keys, so it reuses that
    exchange instead of shuffling both sides of a join."""
    cols = set(df.columns)
    tb = [c for c in tiebreak if c in cols]
    with_lags = add_lag_features(df, tiebreak=tb)
    order = [F.col(c) for c in [*tb, *LAG_COLUMNS]]  # rows equal in all of these give the same values
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return with_lags.withColumns({c: F.first(F.col(c)).over(w) for c in LAG_COLUMNS})
