"""Yield targets: expected yield, anomalies and risk labels (C10, W2, W3,
T1-T4, A7, W11).

Entity windows are partitioned by the entity keys; an entity holds one row
per period, so window partitions stay small however large the table is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitpanel.functions.windows import gated_avg, prior
from pitpanel.schema import require_columns

# Default keys and parameters of the target definition.
TARGET_KEYS = ["state", "county_fips", "crop"]
ROLLING_WINDOW = 5
ROLLING_MIN_PERIODS = 3
TREND_MIN_YEARS = 5
RISK_QUANTILE = 0.20


def clean_yields(df: DataFrame, value_col: str = "value", year_col: str = "year",
                 keys: Sequence[str] = TARGET_KEYS) -> DataFrame:
    """Required columns, ``value`` -> ``actual_yield`` (numeric), year as
    INT, rows without a yield dropped."""
    require_columns(df, [*keys, year_col, value_col], "clean_yields")
    out = df.withColumn(value_col, F.col(value_col).cast("string").try_cast("double")) \
        .withColumnRenamed(value_col, "actual_yield") \
        .withColumn(year_col, F.col(year_col).cast("string").try_cast("int"))
    return out.filter(F.col("actual_yield").isNotNull() & ~F.isnan("actual_yield"))


def _order(year_col: str, tiebreak: Sequence[str]) -> list:
    return [F.col(year_col), *[F.col(c) for c in tiebreak]]


def add_expected_rolling(df: DataFrame, window: int = ROLLING_WINDOW,
                         min_periods: int = ROLLING_MIN_PERIODS,
                         keys: Sequence[str] = TARGET_KEYS, year_col: str = "year",
                         y_col: str = "actual_yield", out_col: str = "expected_yield",
                         tiebreak: Sequence[str] = ()) -> DataFrame:
    """Mean of the previous ``window`` rows with >= ``min_periods`` values."""
    w = prior(keys, _order(year_col, tiebreak), window)
    return df.withColumn(out_col, gated_avg(y_col, w, min_periods))


def add_expected_trend(df: DataFrame, min_years: int = TREND_MIN_YEARS,
                       keys: Sequence[str] = TARGET_KEYS, year_col: str = "year",
                       y_col: str = "actual_yield", out_col: str = "expected_yield",
                       base_year: int = 2000, tiebreak: Sequence[str] = ()) -> DataFrame:
    """OLS line through all prior (year, yield) points evaluated at the
    current year; needs ``min_years`` prior points.  Years are centred on
    ``base_year`` for conditioning (the fitted line is the same)."""
    w = prior(keys, _order(year_col, tiebreak))
    x = (F.col(year_col) - F.lit(base_year)).cast("double")
    y = F.col(y_col)
    n = F.count(F.when(y.isNotNull() & x.isNotNull(), F.lit(1))).over(w)
    slope = F.regr_slope(y, x).over(w)
    icpt = F.regr_intercept(y, x).over(w)
    return df.withColumn(out_col, F.when(n >= min_years, icpt + slope * x))


def add_trend_slope(df: DataFrame, min_years: int = TREND_MIN_YEARS,
                    keys: Sequence[str] = TARGET_KEYS, year_col: str = "year",
                    y_col: str = "actual_yield", out_col: str = "yield_trend_slope") -> DataFrame:
    """Slope of the prior-only trend line."""
    w = prior(keys, [F.col(year_col)])
    y = F.col(y_col)
    x = F.col(year_col).cast("double")
    n = F.count(F.when(y.isNotNull() & x.isNotNull(), F.lit(1))).over(w)
    return df.withColumn(out_col, F.when(n >= min_years, F.regr_slope(y, x).over(w)))


def add_anomaly(df: DataFrame, actual: str = "actual_yield",
                expected: str = "expected_yield") -> DataFrame:
    """Anomaly and % anomaly (NULL when expected is NULL or 0)."""
    require_columns(df, [actual, expected], "add_anomaly")
    anom = F.col(actual) - F.col(expected)
    pct = F.when(F.col(expected).isNotNull() & (F.col(expected) != 0),
                 (anom / F.col(expected)) * 100.0)
    return df.withColumn("yield_anomaly", anom).withColumn("yield_anomaly_pct", pct)


def add_descriptive_risk(df: DataFrame, quantile: float = RISK_QUANTILE,
                         keys: Sequence[str] = TARGET_KEYS, pct_col: str = "yield_anomaly_pct",
                         label_col: str = "severe_risk_descriptive") -> DataFrame:
    """W11 (EDA only -- uses every row of the entity): pct <= entity quantile.
    The quantile comes from the distributed exact quantile (no per-entity
    window buffer) and is joined back on the entity keys."""
    thr = risk_thresholds(df, quantile, keys, pct_col)
    j = df.join(thr, list(keys), "left")
    return j.withColumn(label_col, F.when(F.col(pct_col).isNotNull(),
                                          (F.col(pct_col) <= F.col("risk_threshold")).cast("int"))) \
        .drop("risk_threshold")


def risk_thresholds(train: DataFrame, quantile: float = RISK_QUANTILE,
                    keys: Sequence[str] = TARGET_KEYS, pct_col: str = "yield_anomaly_pct") -> DataFrame:
    """Per-entity linear-interpolated quantile from training rows only.

    Computed with :func:`exact_quantiles` (range-partitioned ranks), so even
    an entity holding a large share of the rows is split across tasks
    instead of being buffered in one.  Entities whose values are all NULL
    get no row, i.e. a NULL threshold after the left join (as pandas)."""
    from pitpanel.operators.metrics import exact_quantiles
    q = exact_quantiles(train.dropna(subset=list(keys)), list(keys), pct_col, {"risk_threshold": quantile})
    return q.select(*keys, F.col("risk_threshold").cast("double").alias("risk_threshold"))


def apply_thresholds(df: DataFrame, thresholds: DataFrame, keys: Sequence[str] = TARGET_KEYS,
                     pct_col: str = "yield_anomaly_pct", label_col: str = "severe_risk") -> DataFrame:
    """Left-join thresholds; label NULL for unseen entities."""
    j = df.join(thresholds, list(keys), "left")
    lab = F.when(F.col(pct_col).isNotNull() & F.col("risk_threshold").isNotNull(),
                 (F.col(pct_col) <= F.col("risk_threshold")).cast("int"))
    return j.withColumn(label_col, lab).drop("risk_threshold")


def assign_risk_labels(train: DataFrame, *others: DataFrame, quantile: float = RISK_QUANTILE,
                       keys: Sequence[str] = TARGET_KEYS, label_col: str = "severe_risk"):
    """Thresholds learnt on ``train`` applied to train and every other split."""
    thr = risk_thresholds(train, quantile, keys)
    return tuple(apply_thresholds(d, thr, keys, label_col=label_col) for d in (train, *others))


def build_targets(yields: DataFrame, method: str = "rolling", window: int = ROLLING_WINDOW,
                  min_periods: int = ROLLING_MIN_PERIODS, min_years: int = TREND_MIN_YEARS,
                  risk_quantile: float = RISK_QUANTILE, add_descriptive: bool = False,
                  keys: Sequence[str] = TARGET_KEYS, value_col: str = "value") -> DataFrame:
    """T4: C10 -> W2 | W3 -> T1 [-> W11]."""
    df = clean_yields(yields, value_col=value_col, keys=keys)
    # One shuffle on (county_fips, crop) serves this entity window (its keys
    # are a superset) and the later lag windows keyed by (county_fips, crop).
    shared = [k for k in ("county_fips", "crop") if k in keys]
    if shared:
        df = df.repartition(*shared)
    if method == "rolling":
        df = add_expected_rolling(df, window, min_periods, keys)
    elif method == "trend":
        df = add_expected_trend(df, min_years, keys)
    else:
        raise ValueError(f"Unknown method {method!r}. Use 'rolling' or 'trend'.")
    df = add_anomaly(df)
    if add_descriptive:
        df = add_descriptive_risk(df, risk_quantile, keys)
    return df
