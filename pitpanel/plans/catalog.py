"""Registered queries: one Spark job per operator family over the adapter
views, each paired with an independent DuckDB oracle (``oracle.py``).

Every query reads the whole tables under ``sf_dir``; doubles are rounded to
a fixed number of decimals on both sides so that floating-point summation
order (which differs between engines) does not affect the comparison.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from pitpanel.plans import oracle as O
from pitpanel.sources import adapters as A
from pitpanel.operators import panel as P
from pitpanel.operators import season as S
from pitpanel.operators import splits as SP
from pitpanel.operators import targets as T
from pitpanel.operators import weekly as WK


@dataclass
class Query:
    fn: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    doubles: list[str] = field(default_factory=list)
    digits: dict[str, int] = field(default_factory=dict)


REGISTRY: dict[str, Query] = {}


def register(name: str, sql: str | None, doubles: list[str] | None = None,
             digits: dict[str, int] | None = None):
    """``doubles`` lists the floating output columns, rounded in the oracle
    exactly as :func:`finish` rounds them on the Spark side."""
    def deco(fn):
        REGISTRY[name] = Query(fn, sql, list(doubles or []), digits or {})
        return fn
    return deco


# Floating output columns per operator family (for the oracle rounding).
TARGET_DOUBLES = ["actual_yield", "expected_yield", "yield_anomaly", "yield_anomaly_pct"]
LAG_DOUBLES = ["prior_year_yield_anomaly", "prior_year_yield", "rolling_3yr_mean_yield_anomaly",
               "rolling_3yr_std_yield_anomaly", "rolling_3yr_mean_yield", "rolling_3yr_std_yield"]
SEASON_DOUBLES = ["cumulative_precip", "mean_temp", "max_temp", "growing_degree_days", "precip_anomaly"]
STRESS_DOUBLES = ["extreme_heat_days_after_july_1", "precip_last_30_days_before_checkpoint",
                  "heat_days_last_30_days_before_checkpoint", "gdd_last_30_days_before_checkpoint"]
ANOMALY_DOUBLES = ["precip_anomaly_from_county_checkpoint_mean", "gdd_anomaly_from_county_checkpoint_mean",
                   "heat_days_anomaly_from_county_checkpoint_mean", "dry_days_anomaly_from_county_checkpoint_mean",
                   "temp_mean_anomaly_from_county_checkpoint_mean", "precip_pct_of_county_checkpoint_mean"]
WEATHER_DOUBLES = SEASON_DOUBLES + STRESS_DOUBLES + ANOMALY_DOUBLES
DROUGHT_DOUBLES = ["mean_drought_severity"]
PANEL_DOUBLES = TARGET_DOUBLES + LAG_DOUBLES + WEATHER_DOUBLES + DROUGHT_DOUBLES


SIG_DIGITS = 8


def sig_round(c, sig: int = SIG_DIGITS):
    """Round to ``sig`` significant digits with engine-independent arithmetic:
    d = sig - 1 - floor(log10|x|) (clamped to [-12, 22]), scale = 10^|d|
    (an exact double for these integer powers), then half-up as
    floor(x * scale + 0.5) / scale (or the mirror for d < 0).  Identical
    doubles round identically in Spark and in the SQL oracle; ``+ 0.0``
    folds -0.0 into 0.0; zero, NaN and |x| >= 1e13 pass through."""
    a = F.abs(c)
    d = F.least(F.greatest(F.lit(sig - 1) - F.floor(F.log10(F.greatest(a, F.lit(1e-300)))), F.lit(-12)), F.lit(22))
    scale = F.pow(F.lit(10.0), F.abs(d))
    rounded = F.when(d >= 0, F.floor(c * scale + F.lit(0.5)) / scale) \
        .otherwise(F.floor(c / scale + F.lit(0.5)) * scale)
    keep = F.isnan(c) | (a == 0) | (a >= F.lit(1e13))
    return F.when(keep, c).otherwise(rounded) + F.lit(0.0)


def finish(df: DataFrame, digits: dict[str, int] | None = None, default: int = SIG_DIGITS) -> DataFrame:
    """Round every floating column to significant digits (per-column override).
    Columns of equal digits are rounded as one array, so the generated code
    does not grow with their number."""
    digits = digits or {}
    alike: dict[int, list[str]] = {}
    for f in df.schema.fields:
        if isinstance(f.dataType, (DoubleType, FloatType)):
            alike.setdefault(digits.get(f.name, default), []).append(f.name)
    places = {c: F.col(f"_rounded_{d}")[i].alias(c) for d, names in alike.items() for i, c in enumerate(names)}

    def rounded(d: int):
        values = F.array(*[F.col(f"`{c}`").cast("double") for c in alike[d]])
        return F.transform(values, lambda x: sig_round(x, d)).alias(f"_rounded_{d}")
    arrays = [rounded(d) for d in alike]
    kept = [F.col(f"`{c}`") for c in df.columns if c not in places]
    return df.select(*kept, *arrays).select(*[places.get(c, F.col(f"`{c}`")) for c in df.columns])


def double_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, (DoubleType, FloatType))]


# ------------------------------------------------------------------ shared
def targets_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.build_targets(A.annual(spark, sf_dir))


def weather_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = S.checkpoint_weather(A.daily(spark, sf_dir), group_cols=["county_fips", "year"])
    return S.add_weather_anomalies(w)


def drought_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    return WK.weekly_features(A.weekly(spark, sf_dir)).drop("checkpoint")


def panel_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The modeling panel over the adapter views (flagship, entry 1)."""
    return P.build_panel(targets_df(spark, sf_dir), weather_df(spark, sf_dir), drought_df(spark, sf_dir))


_STORED: dict[tuple[int, str, str], tuple[object, DataFrame]] = {}


def stored(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """Materialise a shared stage once per session and input (reliable
    checkpoint into the shared ``spark.checkpoint.dir``; lineage cut)."""
    from pitpanel.session import cut_lineage
    js = spark._jsparkSession
    key = (id(js), sf_dir, name)
    if key not in _STORED or _STORED[key][0] is not js:
        _STORED[key] = (js, cut_lineage(build()))
    return _STORED[key][1]


def stored_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The panel as a materialised stage: built once per session and input,
    written by a reliable checkpoint into ``spark.checkpoint.dir`` (lineage
    cut; survives executor loss) and read by every downstream job -- the
    baselines, metrics and model fits -- as the saved panel is in a batch
    workflow."""
    return stored(spark, sf_dir, "panel", lambda: panel_df(spark, sf_dir))


TARGET_COLS = ["state", "county", "county_fips", "crop", "year", "actual_yield", "expected_yield",
               "yield_anomaly", "yield_anomaly_pct"]


# ------------------------------------------------------------------ queries
@register("w2_expected_rolling", O.with_ctes(["targets"], "SELECT * FROM targets"), TARGET_DOUBLES)
def q_w2(spark, sf_dir):
    return targets_df(spark, sf_dir).select(*TARGET_COLS)


T2_SQL = O.with_ctes(["targets"], """
SELECT t.state, t.county_fips, t.crop, t.year, t.split, t.yield_anomaly_pct,
  CASE WHEN t.yield_anomaly_pct IS NOT NULL AND r.risk_threshold IS NOT NULL
       THEN cast(t.yield_anomaly_pct <= r.risk_threshold AS int) END AS severe_risk
FROM tagged t LEFT JOIN thr r ON t.state = r.state AND t.county_fips = r.county_fips AND t.crop = r.crop""",
    extra="""base AS (SELECT * FROM targets WHERE yield_anomaly IS NOT NULL),
cut AS (SELECT min(year) AS cutoff FROM (SELECT DISTINCT year FROM base ORDER BY year DESC LIMIT 2)),
tagged AS (SELECT b.*, CASE WHEN b.year < cut.cutoff THEN 'train' ELSE 'test' END AS split FROM base b, cut),
thr AS (SELECT state, county_fips, crop, quantile_cont(yield_anomaly_pct, 0.2) AS risk_threshold
        FROM tagged WHERE split = 'train' GROUP BY state, county_fips, crop)""")


@register("t2_severe_risk", T2_SQL, ["yield_anomaly_pct"])
def q_t2(spark, sf_dir):
    """Minimum slice: which entities are in severe shortfall in the held-out
    years, by thresholds learnt on training years only (W2 -> T1 -> T5 -> A7 -> T2)."""
    base = targets_df(spark, sf_dir).filter(F.col("yield_anomaly").isNotNull())
    tagged = SP.tag_temporal_split(base, n_test_years=2)
    thr = T.risk_thresholds(tagged.filter(F.col("split") == "train"))
    out = T.apply_thresholds(tagged, thr)
    return out.select("state", "county_fips", "crop", "year", "split", "yield_anomaly_pct", "severe_risk")


@register("a5_checkpoint_weather", O.with_ctes(["ckw"], "SELECT * FROM ckw"), WEATHER_DOUBLES)
def q_a5(spark, sf_dir):
    return weather_df(spark, sf_dir)


@register("j1_modeling_panel", O.with_ctes(["panel"], "SELECT * FROM panel"), PANEL_DOUBLES)
def q_j1(spark, sf_dir):
    return panel_df(spark, sf_dir)


# ------------------------------------------------------------------ targets
TREND_SQL = O.with_ctes(["annual"], """
SELECT state, county, county_fips, crop, year, value AS actual_yield, expected_yield,
  value - expected_yield AS yield_anomaly,
  CASE WHEN expected_yield IS NOT NULL AND expected_yield <> 0
       THEN ((value - expected_yield) / expected_yield) * 100.0 END AS yield_anomaly_pct
FROM (SELECT *, CASE WHEN count(value) OVER w >= 5
             THEN regr_intercept(value, cast(year - 2000 AS double)) OVER w
                  + regr_slope(value, cast(year - 2000 AS double)) OVER w * cast(year - 2000 AS double) END AS expected_yield
      FROM annual WINDOW w AS (PARTITION BY state, county_fips, crop ORDER BY year
                               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))""")


@register("w3_expected_trend", TREND_SQL, TARGET_DOUBLES,
          {"expected_yield": 7, "yield_anomaly": 7, "yield_anomaly_pct": 7})
def q_w3(spark, sf_dir):
    """W3 + T1: prior-only OLS trend expectation (rounded to 4 decimals)."""
    return T.build_targets(A.annual(spark, sf_dir), method="trend").select(*TARGET_COLS)


@register("w13_trend_slope", O.with_ctes(["annual"], """
SELECT state, county_fips, crop, year,
  CASE WHEN count(value) OVER w >= 5 THEN regr_slope(value, cast(year AS double)) OVER w END AS yield_trend_slope
FROM annual WINDOW w AS (PARTITION BY state, county_fips, crop ORDER BY year
                         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"""), ["yield_trend_slope"],
          {"yield_trend_slope": 7})
def q_w13(spark, sf_dir):
    """Prior-only trend slope feature."""
    y = T.clean_yields(A.annual(spark, sf_dir))
    return T.add_trend_slope(y).select("state", "county_fips", "crop", "year", "yield_trend_slope")


@register("w11_descriptive_risk", O.with_ctes(["targets"], """
SELECT state, county_fips, crop, year, yield_anomaly_pct,
  CASE WHEN yield_anomaly_pct IS NOT NULL
       THEN cast(yield_anomaly_pct <= quantile_cont(yield_anomaly_pct, 0.2) OVER (PARTITION BY state, county_fips, crop) AS int)
  END AS severe_risk_descriptive
FROM targets"""), ["yield_anomaly_pct"])
def q_w11(spark, sf_dir):
    """EDA-only label from the entity's whole history."""
    t = T.add_descriptive_risk(targets_df(spark, sf_dir))
    return t.select("state", "county_fips", "crop", "year", "yield_anomaly_pct", "severe_risk_descriptive")


@register("w7_lag_table", O.with_ctes(["lagt"], "SELECT * FROM lagt"), LAG_DOUBLES)
def q_w7(spark, sf_dir):
    """Merge-ready lag table, unique by (county_fips, crop, year)."""
    from pitpanel.operators.lags import lag_table
    return lag_table(targets_df(spark, sf_dir))


@register("w8_yield_lags", O.with_ctes(["targets"], """
SELECT county_fips, crop, year, actual_yield,
  lag(actual_yield, 1) OVER w AS yield_lag_1, lag(actual_yield, 2) OVER w AS yield_lag_2,
  lag(actual_yield, 3) OVER w AS yield_lag_3
FROM targets WINDOW w AS (PARTITION BY county_fips, crop ORDER BY year)"""),
          ["actual_yield", "yield_lag_1", "yield_lag_2", "yield_lag_3"])
def q_w8(spark, sf_dir):
    """N autoregressive yield lags."""
    from pitpanel.operators.lags import add_yield_lags
    t = targets_df(spark, sf_dir).select("county_fips", "crop", "year", "actual_yield")
    return add_yield_lags(t, 3)


# ------------------------------------------------------------------ splits
SPLIT_EXTRA = """base AS (SELECT * FROM targets WHERE yield_anomaly IS NOT NULL),
cut AS (SELECT min(year) AS cutoff FROM (SELECT DISTINCT year FROM base ORDER BY year DESC LIMIT 2))"""


@register("t5_temporal_split", O.with_ctes(["targets"], """
SELECT b.state, b.county_fips, b.crop, b.year, CASE WHEN b.year < cut.cutoff THEN 'train' ELSE 'test' END AS split
FROM base b, cut""", extra=SPLIT_EXTRA))
def q_t5(spark, sf_dir):
    """T5: the latest 2 distinct years are test."""
    base = targets_df(spark, sf_dir).filter(F.col("yield_anomaly").isNotNull())
    return SP.tag_temporal_split(base, 2).select("state", "county_fips", "crop", "year", "split")


@register("t6_spatial_split", O.with_ctes(["targets"], """
SELECT state, county_fips, crop, year, CASE WHEN state = 'ASIA' THEN 'test' ELSE 'train' END AS split
FROM targets"""))
def q_t6(spark, sf_dir):
    """Hold one state (region) out."""
    t = targets_df(spark, sf_dir)
    train, test = SP.spatial_split(t, "ASIA")
    cols = ["state", "county_fips", "crop", "year"]
    return train.select(*cols, F.lit("train").alias("split")).unionByName(
        test.select(*cols, F.lit("test").alias("split")))


@register("t7_expanding_folds", O.with_ctes(["targets"], """
SELECT t.state, t.county_fips, t.crop, t.year, f.fold_year,
       CASE WHEN t.year < f.fold_year THEN 'train' ELSE 'test' END AS role
FROM targets t JOIN (SELECT year AS fold_year FROM (SELECT DISTINCT year FROM targets)
                     QUALIFY row_number() OVER (ORDER BY year) > 3) f ON t.year <= f.fold_year"""))
def q_t7(spark, sf_dir):
    """Expanding-window folds after 3 training years, long form."""
    t = targets_df(spark, sf_dir).select("state", "county_fips", "crop", "year")
    return SP.expanding_folds(t, 3)


# ------------------------------------------------------------------ season
@register("f2_season_cutoff", O.with_ctes(["daily"], """
SELECT * FROM daily WHERE month(date) BETWEEN 4 AND 8 AND month(date) * 100 + day(date) <= 630"""),
          ["PRECTOTCORR", "T2M", "T2M_MAX"])
def q_f2(spark, sf_dir):
    """F1 + F2: season days up to a year-agnostic 06-30 cutoff."""
    return S.filter_season(A.daily(spark, sf_dir), cutoff_month_day="06-30")


@register("f3_season_date_cutoff", O.with_ctes(["daily"], """
SELECT * FROM daily WHERE month(date) BETWEEN 4 AND 8 AND date <= DATE '1997-07-15'"""),
          ["PRECTOTCORR", "T2M", "T2M_MAX"])
def q_f3(spark, sf_dir):
    """F1 + F3: season days up to an absolute inclusive cutoff."""
    return S.filter_season(A.daily(spark, sf_dir), cutoff_date="1997-07-15")


A1_SQL = O.with_ctes(["runs"], """
SELECT *, obs_days < 153 AS is_partial_year,
  cumulative_precip - avg(cumulative_precip) OVER (PARTITION BY county_fips ORDER BY year
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS precip_anomaly
FROM (SELECT county_fips, year, coalesce(sum(PRECTOTCORR), 0.0) AS cumulative_precip, avg(T2M) AS mean_temp,
        max(T2M_MAX) AS max_temp, count_if(T2M_MAX >= 35.0) AS extreme_heat_days,
        count_if(PRECTOTCORR <= 1.0) AS dry_days, cast(coalesce(max(run_bridge), 0) AS bigint) AS longest_dry_spell,
        coalesce(sum(CASE WHEN T2M - 10.0 > 0.0 THEN T2M - 10.0 ELSE 0.0 END), 0.0) AS growing_degree_days,
        count(*) AS obs_days
      FROM runs GROUP BY county_fips, year)""")


@register("a1_season_features", A1_SQL, SEASON_DOUBLES)
def q_a1(spark, sf_dir):
    """A1 + A2 + A3 + W1 for the whole season, one row per entity-year."""
    return S.season_features(A.daily(spark, sf_dir), group_cols=["county_fips", "year"])


STRESS_COLS = ["county_fips", "year", "checkpoint", "max_consecutive_dry_days", "extreme_heat_days_after_july_1",
               "precip_last_30_days_before_checkpoint", "heat_days_last_30_days_before_checkpoint",
               "gdd_last_30_days_before_checkpoint"]


@register("a6_stress_features", O.with_ctes(["ckw"], "SELECT " + ", ".join(STRESS_COLS) + " FROM ckw0"),
          STRESS_DOUBLES)
def q_a6(spark, sf_dir):
    """Stress-timing features per checkpoint."""
    return S.stress_features(A.daily(spark, sf_dir), group_cols=["county_fips", "year"]).select(*STRESS_COLS)


@register("f5_drop_partial_current_year", O.with_ctes(["ckw"], """
SELECT * FROM ckw WHERE NOT (year = 2001 AND coalesce(is_partial_year, false))"""), WEATHER_DOUBLES)
def q_f5(spark, sf_dir):
    """current-year (2001, explicit) partial-season rows are dropped;
    anomaly baselines are computed before the drop (N14)."""
    return S.drop_incomplete_current_year(weather_df(spark, sf_dir), current_year=2001)


# ------------------------------------------------------------------ weekly
A4_COLS = ["county_fips", "year", "weeks_d0", "weeks_d1", "weeks_d2", "weeks_d3", "weeks_d4", "weeks_d2_plus",
           "max_drought_category", "mean_drought_severity", "d0_max_pct", "d1_max_pct", "d2_max_pct",
           "d3_max_pct", "d4_max_pct", "d2_plus_max_pct"]


@register("a4_drought_features", O.with_ctes(["drought"], "SELECT *, 'full_season' AS checkpoint FROM drought"),
          ["mean_drought_severity", "d0_max_pct", "d1_max_pct", "d2_max_pct", "d3_max_pct", "d4_max_pct",
           "d2_plus_max_pct"])
def q_a4(spark, sf_dir):
    """A4 + A18: weekly severity features per entity-year (full season)."""
    return WK.weekly_features(A.weekly(spark, sf_dir), with_max_pct=True)


@register("f4_weekly_cutoff", O.with_ctes(["weekly"], """
SELECT county_fips, cast(year(date) AS int) AS year, count_if(D0 > 0) AS weeks_d0, count_if(D1 > 0) AS weeks_d1,
  count_if(D2 > 0) AS weeks_d2, count_if(D3 > 0) AS weeks_d3, count_if(D4 > 0) AS weeks_d4,
  count_if(D2 + D3 + D4 > 0) AS weeks_d2_plus,
  max(CASE WHEN D4 > 0 THEN 4 WHEN D3 > 0 THEN 3 WHEN D2 > 0 THEN 2 WHEN D1 > 0 THEN 1 ELSE 0 END) AS max_drought_category,
  avg(CASE WHEN D4 > 0 THEN 4 WHEN D3 > 0 THEN 3 WHEN D2 > 0 THEN 2 WHEN D1 > 0 THEN 1 ELSE 0 END) AS mean_drought_severity,
  '1996-07-01' AS checkpoint
FROM weekly WHERE month(date) BETWEEN 4 AND 8 AND date <= DATE '1996-07-01' GROUP BY county_fips, year(date)"""),
          ["mean_drought_severity"])
def q_f4(spark, sf_dir):
    """weekly severity features up to a cutoff date (a Monday, so its own
    week counts)."""
    return WK.weekly_features(A.weekly(spark, sf_dir), cutoff_date="1996-07-01")


@register("a4_drought_by_checkpoint", O.with_ctes(["weekly", "ck"], """
SELECT county_fips, year, checkpoint, count_if(D0 > 0) AS weeks_d0, count_if(D1 > 0) AS weeks_d1,
  count_if(D2 > 0) AS weeks_d2, count_if(D3 > 0) AS weeks_d3, count_if(D4 > 0) AS weeks_d4,
  count_if(D2 + D3 + D4 > 0) AS weeks_d2_plus, max(dom) AS max_drought_category, avg(dom) AS mean_drought_severity
FROM (SELECT w.*, cast(year(w.date) AS int) AS year, ck.checkpoint,
        CASE WHEN D4 > 0 THEN 4 WHEN D3 > 0 THEN 3 WHEN D2 > 0 THEN 2 WHEN D1 > 0 THEN 1 ELSE 0 END AS dom
      FROM weekly w JOIN ck ON month(w.date) * 100 + day(w.date) <= ck.end_key
      WHERE month(w.date) BETWEEN 4 AND 8)
GROUP BY county_fips, year, checkpoint"""), ["mean_drought_severity"])
def q_a4c(spark, sf_dir):
    """A4 per checkpoint cutoff (closes the early-checkpoint drought leak, N11)."""
    return WK.weekly_features_by_checkpoint(A.weekly(spark, sf_dir))


@register("c9_clean_weekly", O.with_ctes(["weekly"], """
SELECT date, county_fips, cast(year(date) AS int) AS year,
  greatest(least(coalesce(D0, 0.0), 100.0), 0.0) AS D0, greatest(least(coalesce(D1, 0.0), 100.0), 0.0) AS D1,
  greatest(least(coalesce(D2, 0.0), 100.0), 0.0) AS D2, greatest(least(coalesce(D3, 0.0), 100.0), 0.0) AS D3,
  greatest(least(coalesce(D4, 0.0), 100.0), 0.0) AS D4
FROM weekly WHERE date IS NOT NULL"""), ["D0", "D1", "D2", "D3", "D4"])
def q_c9(spark, sf_dir):
    """Weekly table cleaning with source column-name variants."""
    w = A.weekly(spark, sf_dir).withColumnRenamed("date", "MapDate").withColumnRenamed("county_fips", "FIPS")
    w = w.withColumn("MapDate", F.date_format("MapDate", "yyyyMMdd"))
    return WK.clean_weekly(w)


# ------------------------------------------------------------------ audits
@register("a14_target_by_crop", O.with_ctes(["panel"], """
SELECT crop, count(yield_anomaly) AS n, avg(yield_anomaly) AS mean, stddev_samp(yield_anomaly) AS std
FROM panel WHERE crop IS NOT NULL GROUP BY crop"""), ["mean", "std"])
def q_a14c(spark, sf_dir):
    """Target count / mean / std by crop."""
    return P.panel_summary_by(stored_panel(spark, sf_dir), "crop")


@register("a14_target_by_checkpoint", O.with_ctes(["panel"], """
SELECT checkpoint, count(yield_anomaly) AS n, avg(yield_anomaly) AS mean, stddev_samp(yield_anomaly) AS std
FROM panel WHERE checkpoint IS NOT NULL GROUP BY checkpoint"""), ["mean", "std"])
def q_a14k(spark, sf_dir):
    """Target count / mean / std by checkpoint."""
    return P.panel_summary_by(stored_panel(spark, sf_dir), "checkpoint")


@register("a14_panel_audit", O.with_ctes(["panel"], """
SELECT count(*) AS row_count, count(DISTINCT county_fips) AS n_counties, count(DISTINCT state) AS n_states,
  string_agg(DISTINCT state, ',' ORDER BY state) AS states, string_agg(DISTINCT crop, ',' ORDER BY crop) AS crops,
  string_agg(DISTINCT cast(year AS varchar), ',' ORDER BY cast(year AS varchar)) AS years,
  string_agg(DISTINCT checkpoint, ',' ORDER BY checkpoint) AS checkpoints,
  count(*) - count(DISTINCT (county_fips, crop, year, checkpoint)) AS duplicate_rows
FROM panel"""))
def q_a14(spark, sf_dir):
    """Headline audit (distinct lists joined as sorted text)."""
    a = P.panel_audit(stored_panel(spark, sf_dir))
    return a.select("row_count", "n_counties", "n_states",
                    *[F.array_join(F.col(c).cast("array<string>"), ",").alias(c)
                      for c in ("states", "crops", "years", "checkpoints")], "duplicate_rows")


# ------------------------------------------------------------------ baselines + metrics
from pitpanel.operators import baselines as B  # noqa: E402
from pitpanel.operators import metrics as M  # noqa: E402

META = ["year", "state", "county_fips", "crop", "checkpoint"]


def labelled_panel(spark: SparkSession, sf_dir: str, n_test_years: int = 2) -> DataFrame:
    """Panel rows with a checkpoint -> T5 (latest 2 years test) -> T3 labels,
    as one ``split``-tagged table materialised once (the labelled split is
    shared by every baseline, metric and model job)."""
    def build():
        panel = stored_panel(spark, sf_dir).filter(F.col("checkpoint").isNotNull())
        tagged = SP.tag_temporal_split(panel, n_test_years)
        thr = T.risk_thresholds(tagged.filter(F.col("split") == "train"))
        return T.apply_thresholds(tagged, thr)
    return stored(spark, sf_dir, f"labelled{n_test_years}", build)


def labelled_split(spark: SparkSession, sf_dir: str, n_test_years: int = 2):
    lab = labelled_panel(spark, sf_dir, n_test_years)
    return (lab.filter(F.col("split") == "train").drop("split"),
            lab.filter(F.col("split") == "test").drop("split"))


def reg_preds(spark, sf_dir):
    """Regression baseline predictions (a saved output, read by the metric jobs)."""
    def build():
        train, test = labelled_split(spark, sf_dir)
        return B.regression_predictions(train, test)
    return stored(spark, sf_dir, "reg_preds", build)


def cls_preds(spark, sf_dir):
    def build():
        train, test = labelled_split(spark, sf_dir)
        return B.classification_predictions(train, test)
    return stored(spark, sf_dir, "cls_preds", build)


PRED_COLS = [*META, "model", "task", "y_true", "y_pred"]


@register("t3_panel_labels", O.with_ctes(["lab"], """
SELECT county_fips, crop, year, checkpoint, split, yield_anomaly_pct, severe_risk FROM lab"""),
          ["yield_anomaly_pct"])
def q_t3(spark, sf_dir):
    """Training-only thresholds applied to train and test panel rows."""
    train, test = labelled_split(spark, sf_dir)
    cols = ["county_fips", "crop", "year", "checkpoint", "yield_anomaly_pct", "severe_risk"]
    return train.select(*cols, F.lit("train").alias("split")).unionByName(
        test.select(*cols, F.lit("test").alias("split")))


@register("b7_regression_baselines", O.with_ctes(["reg_preds"], "SELECT * FROM reg_preds"), ["y_true", "y_pred"])
def q_b7r(spark, sf_dir):
    """B1-B4 (+J6, J7/W12): regression baseline predictions, long form."""
    return reg_preds(spark, sf_dir).select(*PRED_COLS)


@register("b7_classification_baselines", O.with_ctes(["cls_preds"], "SELECT * FROM cls_preds"))
def q_b7c(spark, sf_dir):
    """Classification baseline predictions, long form."""
    return cls_preds(spark, sf_dir).select(*PRED_COLS)


REG_METRICS_SQL = O.with_ctes(["reg_preds"], """
SELECT model, "group", group_value,
  sqrt(avg((y_true - y_pred) * (y_true - y_pred))) AS rmse, avg(abs(y_true - y_pred)) AS mae,
  CASE WHEN count(y_true) * var_pop(y_true) = 0
       THEN CASE WHEN sum((y_true - y_pred) * (y_true - y_pred)) = 0 THEN 1.0 ELSE 0.0 END
       ELSE 1 - sum((y_true - y_pred) * (y_true - y_pred)) / (count(y_true) * var_pop(y_true)) END AS r2,
  count(*) AS n, 'regression' AS task
FROM g WHERE group_value IS NOT NULL
GROUP BY model, "group", group_value
HAVING "group" = 'overall' OR count(*) >= 2""", extra="""g AS (
  SELECT model, y_true, y_pred, 'overall' AS "group", 'all' AS group_value FROM reg_preds
  UNION ALL SELECT model, y_true, y_pred, 'crop', crop FROM reg_preds
  UNION ALL SELECT model, y_true, y_pred, 'checkpoint', checkpoint FROM reg_preds
  UNION ALL SELECT model, y_true, y_pred, 'year', cast(year AS varchar) FROM reg_preds
  UNION ALL SELECT model, y_true, y_pred, 'crop_checkpoint', crop || '/' || checkpoint FROM reg_preds)""")


@register("a12_regression_metrics", REG_METRICS_SQL, ["rmse", "mae", "r2"])
def q_a12r(spark, sf_dir):
    """A10 + A12: grouped regression metrics (overall, crop, checkpoint, year, crop x checkpoint)."""
    return M.grouped_metrics(reg_preds(spark, sf_dir), "regression", crop_checkpoint=True)


CLS_METRICS_SQL = O.with_ctes(["cls_preds"], """
SELECT model, "group", group_value,
  CASE WHEN n > 0 THEN (tp + tn) / n ELSE 0.0 END AS accuracy,
  CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS precision,
  CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END AS recall,
  CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0.0 END AS f1,
  tn, fp, fn, tp, n, 'classification' AS task
FROM (SELECT model, "group", group_value,
        count_if(y_true = 1 AND y_pred = 1) AS tp, count_if(y_true <> 1 AND y_pred = 1) AS fp,
        count_if(y_true = 1 AND y_pred <> 1) AS fn, count_if(y_true <> 1 AND y_pred <> 1) AS tn,
        count(*) AS n, min(y_true) AS ymin, max(y_true) AS ymax
      FROM g WHERE group_value IS NOT NULL GROUP BY model, "group", group_value)
WHERE "group" = 'overall' OR (n >= 2 AND ymin <> ymax)""", extra="""g AS (
  SELECT model, y_true, y_pred, 'overall' AS "group", 'all' AS group_value FROM cls_preds
  UNION ALL SELECT model, y_true, y_pred, 'crop', crop FROM cls_preds
  UNION ALL SELECT model, y_true, y_pred, 'checkpoint', checkpoint FROM cls_preds
  UNION ALL SELECT model, y_true, y_pred, 'year', cast(year AS varchar) FROM cls_preds)""")


@register("a12_classification_metrics", CLS_METRICS_SQL, ["accuracy", "precision", "recall", "f1"])
def q_a12c(spark, sf_dir):
    """A11 + A12: grouped classification metrics (baseline layout, no crop x checkpoint)."""
    m = M.grouped_metrics(cls_preds(spark, sf_dir), "classification", crop_checkpoint=False)
    return m.select("model", "group", "group_value", "accuracy", "precision", "recall", "f1",
                    "tn", "fp", "fn", "tp", "n", "task")


@register("a8_group_means", O.with_ctes(["lab"], """
SELECT county_fips, crop, checkpoint, avg(yield_anomaly) AS mean_target, count(yield_anomaly) AS n,
  CASE grouping(county_fips, crop, checkpoint) WHEN 1 THEN 'county_crop' WHEN 5 THEN 'crop'
       WHEN 4 THEN 'crop_checkpoint' ELSE 'global' END AS level
FROM train GROUP BY GROUPING SETS ((county_fips, crop), (crop), (crop, checkpoint), ())"""), ["mean_target"])
def q_a8(spark, sf_dir):
    """All baseline group means in one GROUPING SETS aggregate."""
    train, _ = labelled_split(spark, sf_dir)
    return B.group_means(train)


@register("b8_entity_mean", O.with_ctes(["lab"], """
SELECT t.county_fips, t.crop, t.year, t.checkpoint,
  cast(CASE WHEN e.county_fips IS NOT NULL THEN e.v ELSE gm.g END AS double) AS y_pred
FROM test t LEFT JOIN (SELECT county_fips, avg(yield_anomaly) AS v FROM train WHERE county_fips IS NOT NULL
                       GROUP BY county_fips) e ON t.county_fips = e.county_fips
CROSS JOIN (SELECT CASE WHEN avg(yield_anomaly) IS NULL OR avg(yield_anomaly) = 0 THEN 0.0
                        ELSE avg(yield_anomaly) END AS g FROM train) gm"""), ["y_pred"])
def q_b8(spark, sf_dir):
    """Single-key entity mean with a global fallback."""
    train, test = labelled_split(spark, sf_dir)
    return B.entity_mean(train, test).select("county_fips", "crop", "year", "checkpoint", "y_pred")


@register("a16_residual_summary", O.with_ctes(["reg_preds"], """
SELECT model, year, avg(y_true - y_pred) AS mean_residual, stddev_samp(y_true - y_pred) AS std_residual,
  avg(abs(y_true - y_pred)) AS mae, count(y_true - y_pred) AS count
FROM reg_preds GROUP BY model, year"""), ["mean_residual", "std_residual", "mae"])
def q_a16(spark, sf_dir):
    """C17 + A16: residual mean / std / MAE / count by model and year."""
    return M.residual_summary(M.add_residuals(reg_preds(spark, sf_dir)), ["model", "year"])


@register("a17_residual_box", O.with_ctes(["reg_preds"], """
SELECT model, year, quantile_cont(r, 0.0) AS q0, quantile_cont(r, 0.25) AS q1, quantile_cont(r, 0.5) AS median,
  quantile_cont(r, 0.75) AS q3, quantile_cont(r, 1.0) AS q100
FROM (SELECT *, y_true - y_pred AS r FROM reg_preds) WHERE r IS NOT NULL GROUP BY model, year"""),
          ["q0", "q1", "median", "q3", "q100"])
def q_a17(spark, sf_dir):
    """Exact residual box statistics by model and year (distributed ranks)."""
    return M.residual_box_stats(M.add_residuals(reg_preds(spark, sf_dir)), ["model", "year"])


@register("a17_residual_box_by_state", O.with_ctes(["reg_preds"], """
SELECT model, state, quantile_cont(r, 0.0) AS q0, quantile_cont(r, 0.25) AS q1, quantile_cont(r, 0.5) AS median,
  quantile_cont(r, 0.75) AS q3, quantile_cont(r, 1.0) AS q100
FROM (SELECT *, y_true - y_pred AS r FROM reg_preds) WHERE r IS NOT NULL GROUP BY model, state"""),
          ["q0", "q1", "median", "q3", "q100"])
def q_a17_state(spark, sf_dir):
    """Exact residual box statistics by model and state."""
    return M.residual_box_stats(M.add_residuals(reg_preds(spark, sf_dir)), ["model", "state"])


@register("o3_worst_predictions", O.with_ctes(["reg_preds"], """
SELECT *, y_true - y_pred AS residual, abs(y_true - y_pred) AS abs_residual FROM reg_preds
ORDER BY abs(y_true - y_pred) DESC NULLS LAST, model, county_fips, crop, year, checkpoint LIMIT 20"""),
          ["y_true", "y_pred", "residual", "abs_residual"])
def q_o3(spark, sf_dir):
    """C17 + O3: the 20 largest absolute residuals (a top-k report)."""
    r = M.add_residuals(reg_preds(spark, sf_dir))
    return M.worst_predictions(r, 20, tiebreak=["model", "county_fips", "crop", "year", "checkpoint"])


@register("j11_best_vs_reference", O.with_ctes(["reg_preds"], """
SELECT a.model AS best_model, a.rmse AS model_rmse, b.model AS best_baseline, b.rmse AS baseline_rmse,
       a.rmse < b.rmse AS model_beats_baseline
FROM (SELECT model, rmse FROM m WHERE model <> 'zero_anomaly' ORDER BY rmse, model LIMIT 1) a,
     (SELECT model, rmse FROM m WHERE model = 'zero_anomaly' ORDER BY rmse, model LIMIT 1) b""",
    extra="""m AS (SELECT model, sqrt(avg((y_true - y_pred) * (y_true - y_pred))) AS rmse FROM reg_preds GROUP BY model)"""),
          ["model_rmse", "baseline_rmse"])
def q_j11(spark, sf_dir):
    """O5 + J11: best history-based baseline vs the zero-anomaly reference."""
    m = M.regression_metrics(reg_preds(spark, sf_dir), ["model"])
    return M.compare_best(m.filter(F.col("model") != "zero_anomaly"), m.filter(F.col("model") == "zero_anomaly"))


AUROC_SQL = O.with_ctes(["cls_preds"], """
SELECT model, sum(pos * (below + 0.5 * neg)) / (max(P) * max(N)) AS auroc,
       cast(max(P) AS bigint) AS n_pos, cast(max(N) AS bigint) AS n_neg
FROM (SELECT model, s, pos, neg,
        coalesce(sum(neg) OVER (PARTITION BY model ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below,
        sum(pos) OVER (PARTITION BY model) AS P, sum(neg) OVER (PARTITION BY model) AS N
      FROM (SELECT model, y_score AS s, count_if(y_true = 1) AS pos, count_if(y_true <> 1) AS neg
            FROM scores WHERE y_score IS NOT NULL AND y_true IS NOT NULL GROUP BY model, y_score))
GROUP BY model""", extra="""scores AS (
  SELECT 'historical_county_risk' AS model, severe_risk AS y_true, rate AS y_score FROM rates
  UNION ALL SELECT 'low_prior_anomaly', severe_risk, -prior_year_yield_anomaly FROM tc)""")


@register("a19_auroc", AUROC_SQL, ["auroc"])
def q_a19(spark, sf_dir):
    """Exact AUROC of two risk scores (ties count 1/2)."""
    train, test = labelled_split(spark, sf_dir)
    tc = test.filter(F.col("severe_risk").isNotNull())
    s1 = B.historical_county_rate(train, tc).select(F.lit("historical_county_risk").alias("model"),
                                                    F.col("severe_risk").alias("y_true"), "y_score")
    s2 = tc.select(F.lit("low_prior_anomaly").alias("model"), F.col("severe_risk").alias("y_true"),
                   (-F.col("prior_year_yield_anomaly")).alias("y_score"))
    return M.auroc(s1.unionByName(s2))


# ------------------------------------------------------------------ ingest
from pitpanel.sources import landing as L  # noqa: E402
from pitpanel.sources import payloads as PL  # noqa: E402
from pitpanel.sources import records as R  # noqa: E402

NUM_RE = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
CLEAN_SQL_BODY = """
SELECT try_cast(trim(year) AS int) AS year, trim(state_name) AS state, trim(county_name) AS county,
  lpad(trim(split_part(trim(state_fips_code), '.', 1)), 2, '0')
    || lpad(trim(split_part(trim(county_ansi), '.', 1)), 3, '0') AS county_fips,
  trim(commodity_desc) AS crop, try_cast(trim(replace(trim("Value"), ',', '')) AS double) AS value,
  trim(unit_desc) AS unit
FROM {src} WHERE regexp_full_match(replace(trim("Value"), ',', ''), '""" + NUM_RE + """')"""


@register("c7_clean_yield_records", O.with_ctes(["dirty"], CLEAN_SQL_BODY.format(src="dirty")), ["value"])
def q_c7(spark, sf_dir):
    """Raw text records -> clean typed yields (suppressed values dropped)."""
    return R.clean_yield_records(A.dirty(spark, sf_dir))


@register("f9_source_filter", O.with_ctes(["dirty"], CLEAN_SQL_BODY.format(src="""(SELECT * FROM dirty
  WHERE commodity_desc IN ('BUILDING', 'MACHINERY') AND state_name IN ('ASIA', 'EUROPE', 'AMERICA')
    AND try_cast(year AS int) BETWEEN 1996 AND 2000)""")), ["value"])
def q_f9(spark, sf_dir):
    """F9 + C7: source predicates (commodity, state, year range) then cleaning."""
    d = R.source_filter(A.dirty(spark, sf_dir), crops=["BUILDING", "MACHINERY"],
                        states=["ASIA", "EUROPE", "AMERICA"], start_year=1996, end_year=2000)
    return R.clean_yield_records(d)


@register("s1_csv_roundtrip", O.with_ctes(["dirty"], """
SELECT year, state_name, county_name, commodity_desc, unit_desc, "Value",
  lpad(split_part(trim(state_fips_code), '.', 1), 2, '0') AS state_fips_code,
  lpad(split_part(trim(county_ansi), '.', 1), 3, '0') AS county_ansi,
  lpad(split_part(trim(county_fips), '.', 1), 5, '0') AS county_fips
FROM dirty"""))
def q_s1(spark, sf_dir):
    """S11 + S1 + C1-C4: write raw records as CSV into the shared folder,
    read them back as text only (ids never inferred numeric), normalise ids."""
    import uuid
    from pitpanel.session import ensure_checkpoint_dir
    from pitpanel.sources.sinks import write_table
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/s1-{uuid.uuid4().hex}"
    write_table(A.dirty(spark, sf_dir), path, fmt="csv")
    return R.normalize_id_columns(R.read_csv_as_text(spark, path))


CENTROID_RAW_SQL = """craw AS (
  SELECT cast(n_nationkey // 1000 AS varchar) AS STATEFP, cast(n_nationkey % 1000 AS varchar) AS COUNTYFP,
         '  ' || lower(n_name) || ' ' AS COUNAME,
         CASE WHEN n_nationkey % 7 = 3 THEN '' ELSE cast(n_nationkey * 1.5 AS varchar) END AS LATITUDE,
         cast(-10.0 * n_regionkey AS varchar) AS LONGITUDE
  FROM nation)"""


def centroid_raw(spark, sf_dir):
    n = A.table(spark, sf_dir, "nation")
    k = F.col("n_nationkey")
    return n.select(F.floor(k / 1000).cast("string").alias("STATEFP"), (k % 1000).cast("string").alias("COUNTYFP"),
                    F.concat(F.lit("  "), F.lower("n_name"), F.lit(" ")).alias("COUNAME"),
                    F.when(k % 7 == 3, F.lit("")).otherwise((k * 1.5).cast("string")).alias("LATITUDE"),
                    (F.lit(-10.0) * F.col("n_regionkey")).cast("string").alias("LONGITUDE"))


@register("j8_requested_centroids", O.with_ctes(["dirty"], """
SELECT lpad(STATEFP, 2, '0') || lpad(COUNTYFP, 3, '0') AS county_fips, upper(trim(COUNAME)) AS county,
       lpad(STATEFP, 2, '0') AS state_fips, try_cast(LATITUDE AS double) AS lat, try_cast(LONGITUDE AS double) AS lon
FROM craw
WHERE lpad(STATEFP, 2, '0') || lpad(COUNTYFP, 3, '0') IN (
        SELECT lpad(split_part(county_fips, '.', 1), 5, '0') FROM dirty WHERE state_name IN ('ASIA', 'EUROPE'))
  AND try_cast(LATITUDE AS double) IS NOT NULL AND try_cast(LONGITUDE AS double) IS NOT NULL""",
    extra=CENTROID_RAW_SQL), ["lat", "lon"])
def q_j8(spark, sf_dir):
    """S7 + J8: centroid dimension kept for requested ids (semi join)."""
    req = A.dirty(spark, sf_dir).filter(F.col("state_name").isin("ASIA", "EUROPE")).select("county_fips")
    return L.centroids(centroid_raw(spark, sf_dir), req)


@register("s8_completeness", O.with_ctes(["daily"], """
SELECT county_fips, count(DISTINCT year) AS years_present, count(DISTINCT year) = 5 AS complete
FROM daily WHERE year BETWEEN 1996 AND 2000 GROUP BY county_fips"""))
def q_s8(spark, sf_dir):
    """An entity is complete iff every required year (1996-2000) is landed."""
    return L.completeness(A.daily(spark, sf_dir), 1996, 2000)


@register("j9_remaining_entities", O.with_ctes(["daily"], """
SELECT lpad(cast(n_nationkey AS varchar), 5, '0') AS county_fips, n_name AS county FROM nation
WHERE lpad(cast(n_nationkey AS varchar), 5, '0') NOT IN (
  SELECT county_fips FROM daily WHERE year BETWEEN 1992 AND 1998 GROUP BY county_fips
  HAVING count(DISTINCT year) = 7)
UNION ALL
SELECT county_fips, county FROM (
  SELECT lpad(cast(n_nationkey AS varchar), 5, '0') AS county_fips, n_name || '#' AS county FROM nation)
WHERE county_fips NOT IN (
  SELECT county_fips FROM daily WHERE year BETWEEN 1996 AND 2000 GROUP BY county_fips
  HAVING count(DISTINCT year) = 5)"""))
def q_j9(spark, sf_dir):
    """S8 + J9 + U3: entities still to load for two required ranges."""
    n = A.table(spark, sf_dir, "nation")
    ents = n.select(A._fips("n_nationkey").alias("county_fips"), F.col("n_name").alias("county"))
    d = A.daily(spark, sf_dir)
    a = L.remaining_entities(ents, d, 1992, 1998)
    b = L.remaining_entities(ents.withColumn("county", F.concat("county", F.lit("#"))), d, 1996, 2000)
    return a.unionByName(b)


@register("s9_merge_batches", O.with_ctes(["daily"], "SELECT * FROM daily"), ["PRECTOTCORR", "T2M", "T2M_MAX"])
def q_s9(spark, sf_dir):
    """An older batch (stale values) merged with a re-landed newer batch
    overlapping it; the newer batch wins per (entity, date)."""
    d = A.daily(spark, sf_dir)
    old = d.filter(F.col("date") < F.lit("1998-07-01").cast("date")) \
        .withColumn("PRECTOTCORR", F.lit(-1.0)).withColumn("T2M", F.lit(-1.0))
    new = d.filter(F.col("date") >= F.lit("1998-01-01").cast("date"))
    older_only = d.filter(F.col("date") < F.lit("1998-01-01").cast("date"))
    return L.merge_batches([old, older_only, new])


@register("s5_weather_payload", O.with_ctes(["daily"], """
SELECT county_fips, date,
  CASE WHEN day(date) % 13 = 0 THEN NULL ELSE PRECTOTCORR END AS PRECTOTCORR,
  CASE WHEN day(date) % 10 = 0 THEN NULL ELSE T2M END AS T2M,
  CASE WHEN day(date) % 10 = 0 THEN NULL ELSE T2M - 1.0 END AS T2M_MIN,
  T2M_MAX, cast(year(date) AS int) AS year, cast(month(date) AS int) AS month
FROM daily"""), ["PRECTOTCORR", "T2M", "T2M_MIN", "T2M_MAX"])
def q_s5(spark, sf_dir):
    """S5 + C11: per entity-year weather payloads {PARAM: {YYYYMMDD: v}}
    (sentinel -999 for some days, some dates absent from some parameters)
    unnested back to one row per date."""
    out = PL.unnest_weather_payload(weather_payloads(spark, sf_dir), keep=["county_fips"])
    return out.withColumn("year", F.col("year").cast("int")).withColumn("month", F.col("month").cast("int"))


def weather_payloads(spark, sf_dir):
    """One payload per (county, year)."""
    d = A.daily(spark, sf_dir)
    ds = F.date_format("date", "yyyyMMdd")
    day = F.dayofmonth("date")

    def entries(v, keep=None):
        e = F.struct(ds.alias("k"), v.alias("v"))
        return F.collect_list(e if keep is None else F.when(keep, e))

    g = d.groupBy("county_fips", "year").agg(
        F.map_from_entries(entries(F.when(day % 13 == 0, F.lit(-999.0)).otherwise(F.col("PRECTOTCORR")))).alias("p"),
        F.map_from_entries(entries(F.col("T2M"), day % 10 != 0)).alias("t"),
        F.map_from_entries(entries(F.col("T2M") - 1.0, day % 10 != 0)).alias("tn"),
        F.map_from_entries(entries(F.col("T2M_MAX"))).alias("tx"))
    payload = F.to_json(F.create_map(F.lit("PRECTOTCORR"), F.col("p"), F.lit("T2M"), F.col("t"),
                                     F.lit("T2M_MIN"), F.col("tn"), F.lit("T2M_MAX"), F.col("tx")))
    return g.select("county_fips", "year", payload.alias("payload"))


@register("s5_quarantined_weather", O.with_ctes(["daily"], """
SELECT reason, key, count(*) AS n FROM (
  SELECT CASE year WHEN 1995 THEN 'not a JSON object' WHEN 1996 THEN 'no payload' WHEN 1997 THEN 'unexpected shape'
                   WHEN 1998 THEN 'bad date key' ELSE 'unexpected shape' END AS reason,
         CASE year WHEN 1998 THEN '20209999' END AS key
  FROM (SELECT DISTINCT county_fips, year FROM daily) WHERE cast(county_fips AS int) % 2 = 0 AND year <= 1999)
GROUP BY reason, key
UNION ALL SELECT 'rows', NULL, count(*) FROM daily WHERE cast(county_fips AS int) % 2 = 1 OR year > 1999 OR year = 1998"""))
def q_s5_quarantine(spark, sf_dir):
    """S5 on bad input: for every second county, truncated, absent and shapeless
    payloads and ones with an impossible date; what is unnested and what is not."""
    good = F.col("payload")
    bad = F.when(F.col("year") == 1995, F.expr("substring(payload, 1, length(payload) - 2)")) \
        .when(F.col("year") == 1996, F.lit(None).cast("string")).when(F.col("year") == 1997, F.lit('{"T2M": 5}')) \
        .when(F.col("year") == 1998, F.regexp_replace("payload", r'^\{"PRECTOTCORR":\{', '{"PRECTOTCORR":{"20209999":1.0,')) \
        .when(F.col("year") == 1999, F.lit("{}")).otherwise(good)
    pl = weather_payloads(spark, sf_dir) \
        .withColumn("payload", F.when(F.col("county_fips").cast("int") % 2 == 0, bad).otherwise(good))
    rows = PL.unnest_weather_payload(pl, keep=["county_fips"])
    return PL.quarantined_weather(pl).groupBy("reason", "key").agg(F.count("*").alias("n")).unionByName(
        rows.agg(F.count("*").alias("n")).select(F.lit("rows").alias("reason"), F.lit(None).cast("string").alias("key"), "n"))


def record_payloads(spark, sf_dir):
    """One payload per (county, crop, year); those of 2001 carry an error."""
    d = A.dirty(spark, sf_dir).drop("county_fips")
    recs = F.collect_list(F.struct(*[F.col(c) for c in PL.RECORD_FIELDS]))
    g = d.groupBy("state_name", "county_name", "county_ansi", "commodity_desc", "year").agg(recs.alias("data"))
    error = F.to_json(F.struct(F.array(F.lit("record limit exceeded"), F.col("county_name")).alias("error")))
    return g.select(F.when(F.col("year") == "2001", error)
                    .otherwise(F.to_json(F.struct(F.col("data").alias("data")))).alias("payload"))


@register("s6_records_payload", O.with_ctes(["dirty"], "SELECT * EXCLUDE (county_fips) FROM dirty WHERE year <> '2001'"))
def q_s6(spark, sf_dir):
    """Record payloads {"data": [...]} unnested; payloads carrying
    {"error": [...]} (here: year 2001) are quarantined."""
    return PL.unnest_records(record_payloads(spark, sf_dir))[0]


@register("s6_quarantined_payloads", O.with_ctes(["dirty"], """
SELECT 'record limit exceeded; ' || county_name AS error, count(*) AS n
FROM (SELECT DISTINCT county_name, commodity_desc FROM dirty WHERE year = '2001') GROUP BY county_name"""))
def q_s6_errors(spark, sf_dir):
    """The quarantined payloads, counted by error."""
    return PL.unnest_records(record_payloads(spark, sf_dir))[1].groupBy("error").agg(F.count("*").alias("n"))


DEFECT_SQL = """
SELECT *, CASE WHEN coalesce(commodity_desc, '') NOT LIKE 'B%' THEN CASE WHEN year = '2001' THEN 'error' ELSE 'rows' END
    WHEN year = '1995' THEN 'not a JSON object' WHEN year = '1996' THEN 'no payload' WHEN year IN ('1997', '1998', '2001') THEN 'error'
    WHEN year = '1999' THEN 'unexpected shape' WHEN year = '2000' THEN 'empty' ELSE 'rows' END AS outcome,
  CASE WHEN year = '2001' THEN 'record limit exceeded; ' || county_name
    WHEN coalesce(commodity_desc, '') LIKE 'B%' AND year = '1997' THEN 'limit'
    WHEN coalesce(commodity_desc, '') LIKE 'B%' AND year = '1998' THEN '' END AS error
FROM (SELECT state_name, county_name, county_ansi, commodity_desc, year, count(*) AS n FROM dirty GROUP BY ALL)"""


def defective_payloads(spark, sf_dir):
    """The record payloads; those of crops on B broken by year: truncated,
    absent, an error text, an empty error beside data, no records, no data."""
    year = F.get_json_object("payload", "$.data[0].year")
    crop = F.get_json_object("payload", "$.data[0].commodity_desc")
    broken = F.when(year == "1995", F.expr("substring(payload, 1, length(payload) - 2)")) \
        .when(year == "1996", F.lit(None).cast("string")) \
        .when(year == "1997", F.lit('{"data": [], "error": "limit"}')) \
        .when(year == "1998", F.concat(F.expr("substring(payload, 1, length(payload) - 1)"), F.lit(',"error":[]}'))) \
        .when(year == "1999", F.lit('{"data": [1, 2]}')).when(year == "2000", F.lit('{"data": []}')).otherwise(F.col("payload"))
    return record_payloads(spark, sf_dir).withColumn("payload", F.when(crop.startswith("B"), broken).otherwise(F.col("payload")))


@register("s6_payload_balance", O.with_ctes(["dirty"], """
SELECT outcome, count(*) AS payloads, cast(sum(CASE WHEN outcome = 'rows' THEN n ELSE 0 END) AS bigint) AS records
FROM g GROUP BY outcome""", extra=f"g AS ({DEFECT_SQL})"))
def q_s6_balance(spark, sf_dir):
    """S6 on bad input: every payload is unnested, empty or in the quarantine."""
    return PL.payload_balance(defective_payloads(spark, sf_dir))


@register("s6_quarantine_reasons", O.with_ctes(["dirty"], """
SELECT outcome AS reason, error, count(*) AS n FROM g WHERE outcome NOT IN ('rows', 'empty') GROUP BY outcome, error""",
    extra=f"g AS ({DEFECT_SQL})"))
def q_s6_reasons(spark, sf_dir):
    """S6 on bad input: the quarantine by reason and error text."""
    return PL.unnest_records(defective_payloads(spark, sf_dir))[1].groupBy("reason", "error").agg(F.count("*").alias("n"))


@register("u_year_set_ops", O.with_ctes(["annual", "daily"], """
SELECT 'intersect' AS op, year FROM (SELECT year FROM annual INTERSECT SELECT year FROM daily)
UNION ALL SELECT 'except', year FROM (SELECT year FROM daily EXCEPT SELECT year FROM annual)
UNION ALL SELECT 'distinct', year FROM (SELECT DISTINCT year FROM annual)"""))
def q_u(spark, sf_dir):
    """Intersect / except / distinct of period sets."""
    a = A.annual(spark, sf_dir).select("year")
    d = A.daily(spark, sf_dir).select("year")
    return (a.intersect(d).select(F.lit("intersect").alias("op"), "year")
            .unionByName(d.subtract(a).select(F.lit("except").alias("op"), "year"))
            .unionByName(a.distinct().select(F.lit("distinct").alias("op"), "year")))


# The modeling-panel layout (column, pandas-style dtype) for the A13 oracle.
PANEL_LAYOUT = [
    ("county_fips", "object"), ("year", "int64"), ("state", "object"), ("county", "object"), ("crop", "object"),
    ("actual_yield", "float64"), ("expected_yield", "float64"), ("yield_anomaly", "float64"),
    ("yield_anomaly_pct", "float64"), ("prior_year_yield_anomaly", "float64"), ("prior_year_yield", "float64"),
    ("rolling_3yr_mean_yield_anomaly", "float64"), ("rolling_3yr_std_yield_anomaly", "float64"),
    ("rolling_3yr_mean_yield", "float64"), ("rolling_3yr_std_yield", "float64"), ("checkpoint", "object"),
    ("cumulative_precip", "float64"), ("mean_temp", "float64"), ("max_temp", "float64"),
    ("extreme_heat_days", "int64"), ("dry_days", "int64"), ("longest_dry_spell", "int64"),
    ("growing_degree_days", "float64"), ("obs_days", "int64"), ("max_consecutive_dry_days", "int64"),
    ("precip_last_30_days_before_checkpoint", "float64"), ("heat_days_last_30_days_before_checkpoint", "float64"),
    ("gdd_last_30_days_before_checkpoint", "float64"), ("extreme_heat_days_after_july_1", "float64"),
    ("is_partial_year", "bool"), ("precip_anomaly", "float64"),
    ("precip_anomaly_from_county_checkpoint_mean", "float64"), ("gdd_anomaly_from_county_checkpoint_mean", "float64"),
    ("heat_days_anomaly_from_county_checkpoint_mean", "float64"),
    ("dry_days_anomaly_from_county_checkpoint_mean", "float64"),
    ("temp_mean_anomaly_from_county_checkpoint_mean", "float64"), ("precip_pct_of_county_checkpoint_mean", "float64"),
    ("weeks_d0", "int64"), ("weeks_d1", "int64"), ("weeks_d2", "int64"), ("weeks_d3", "int64"), ("weeks_d4", "int64"),
    ("weeks_d2_plus", "int64"), ("max_drought_category", "int64"), ("mean_drought_severity", "float64"),
    ("year_index", "int64"), ("heat_dry_stress", "int64"), ("heat_dry_spell", "int64"),
]
A13_SQL = O.with_ctes(["panel"], "\nUNION ALL\n".join(
    f"SELECT '{c}' AS \"column\", count_if({c} IS NULL) AS missing_count, "
    f"round_even(cast(count_if({c} IS NULL) AS double) * 100.0 / cast(count(*) AS double), 2) AS missing_pct, "
    f"'{t}' AS dtype FROM panel_all" for c, t in PANEL_LAYOUT))


@register("a13_missingness_report", A13_SQL, ["missing_pct"])
def q_a13(spark, sf_dir):
    """Column missingness of the panel before the missing-target drop."""
    p = P.build_panel(targets_df(spark, sf_dir), weather_df(spark, sf_dir), drought_df(spark, sf_dir),
                      drop_missing_target=False)
    return P.missingness_report(p)


@register("c16_checkpoint_label", O.with_ctes(["runs"], """
SELECT county_fips, year, obs_days,
  CASE WHEN obs_days < 120 THEN 'partial' ELSE 'full_season' END AS checkpoint
FROM (SELECT county_fips, year, count(*) AS obs_days FROM runs GROUP BY county_fips, year)"""))
def q_c16(spark, sf_dir):
    """Checkpoint label derived from the season flag (here with an
    explicit 120-day season, as the test data never has 153 days)."""
    f = S.season_features(A.daily(spark, sf_dir), group_cols=["county_fips", "year"], full_days=120)
    return P.add_checkpoint_label(f).select("county_fips", "year", "obs_days", "checkpoint")


@register("s16_load_saved_panel", O.with_ctes(["panel"], """
SELECT * FROM panel"""), PANEL_DOUBLES)
def q_s16(spark, sf_dir):
    """S11 + S16: the panel saved as CSV in the shared folder, loaded back
    (ids normalised, declared types, label columns dropped): the whole panel."""
    import uuid
    from pitpanel.session import ensure_checkpoint_dir
    from pitpanel.sources.sinks import write_table
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/s16-{uuid.uuid4().hex}"
    lab = labelled_panel(spark, sf_dir).drop("split")
    write_table(stored_panel(spark, sf_dir).join(lab.select("county_fips", "crop", "year", "checkpoint", "severe_risk"),
                                                 ["county_fips", "crop", "year", "checkpoint"], "left"), path, fmt="csv")
    return R.load_panel(spark, path, fmt="csv")


DROUGHT_CK_SQL = """dck AS (
  SELECT county_fips, year, checkpoint, count_if(D0 > 0) AS weeks_d0, count_if(D1 > 0) AS weeks_d1,
    count_if(D2 > 0) AS weeks_d2, count_if(D3 > 0) AS weeks_d3, count_if(D4 > 0) AS weeks_d4,
    count_if(D2 + D3 + D4 > 0) AS weeks_d2_plus, max(dom) AS max_drought_category, avg(dom) AS mean_drought_severity
  FROM (SELECT w.*, cast(year(w.date) AS int) AS year, ck.checkpoint,
          CASE WHEN D4 > 0 THEN 4 WHEN D3 > 0 THEN 3 WHEN D2 > 0 THEN 2 WHEN D1 > 0 THEN 1 ELSE 0 END AS dom
        FROM weekly w JOIN ck ON month(w.date) * 100 + day(w.date) <= ck.end_key
        WHERE month(w.date) BETWEEN 4 AND 8)
  GROUP BY county_fips, year, checkpoint)"""


@register("j3_panel_checkpoint_drought", O.with_ctes(["panel"], """
SELECT p.* REPLACE (d.weeks_d0 AS weeks_d0, d.weeks_d1 AS weeks_d1, d.weeks_d2 AS weeks_d2, d.weeks_d3 AS weeks_d3,
                    d.weeks_d4 AS weeks_d4, d.weeks_d2_plus AS weeks_d2_plus,
                    d.max_drought_category AS max_drought_category, d.mean_drought_severity AS mean_drought_severity)
FROM panel p LEFT JOIN dck d ON p.county_fips = d.county_fips AND p.year = d.year AND p.checkpoint = d.checkpoint""",
    extra=DROUGHT_CK_SQL), PANEL_DOUBLES)
def q_j3(spark, sf_dir):
    """J3 with checkpoint keys on both sides: drought features cut at each
    checkpoint (the leak-free option, N11) joined without fan-out."""
    d = WK.weekly_features_by_checkpoint(A.weekly(spark, sf_dir))
    return P.build_panel(targets_df(spark, sf_dir), weather_df(spark, sf_dir), d)


@register("f8_explorer_filter", O.with_ctes(["reg_preds"], """
SELECT * FROM reg_preds WHERE crop = 'BUILDING' AND state = 'EUROPE' AND year = 2001"""), ["y_true", "y_pred"])
def q_f8(spark, sf_dir):
    """F8: the explorer filter (crop x state x year) over baseline predictions."""
    return M.explore(reg_preds(spark, sf_dir).select(*PRED_COLS), crop="BUILDING", state="EUROPE", year=2001)


@register("a15_stage_summary", O.with_ctes(["targets"], """
SELECT count(*) AS rows, count(DISTINCT county_fips) AS entities, min(year) AS min_year, max(year) AS max_year,
       avg(actual_yield) AS mean_actual_yield FROM targets"""), ["mean_actual_yield"])
def q_a15(spark, sf_dir):
    """Stage summary (rows, entities, year range, mean measure)."""
    return P.stage_summary(targets_df(spark, sf_dir), value_col="actual_yield")


# ------------------------------------------------------------------ models (rows-only checks)
from pitpanel.operators import ablation as AB  # noqa: E402
from pitpanel.operators import features as FS  # noqa: E402
from pitpanel.operators import linear as LN  # noqa: E402
from pitpanel.operators import trees as TR  # noqa: E402
from pitpanel.session import cut_lineage  # noqa: E402
from pitpanel.operators import ml as ML  # noqa: E402

_MODELS: dict[tuple[int, str], tuple[object, dict]] = {}


def model_predictions(spark, sf_dir):
    key = (id(spark._jsparkSession), sf_dir)

    def build():
        train, test = labelled_split(spark, sf_dir)
        numeric, categorical = FS.select_feature_columns(stored_panel(spark, sf_dir))
        preds, models = ML.train_and_predict(train, test, numeric, categorical, return_models=True)
        _MODELS[key] = (spark._jsparkSession, models)
        return preds
    return stored(spark, sf_dir, "model_predictions", build)


def model_metrics(spark, sf_dir):
    p = model_predictions(spark, sf_dir)
    reg = M.grouped_metrics(p.filter(F.col("task") == "regression"), "regression", crop_checkpoint=True)
    cls = M.grouped_metrics(p.filter(F.col("task") == "classification"), "classification", crop_checkpoint=True)
    return reg.unionByName(cls, allowMissingColumns=True)


def ablation_metrics(spark, sf_dir):
    return stored(spark, sf_dir, "ablation", lambda: AB.run_ablation(
        stored_panel(spark, sf_dir), AB.crop_modes(stored_panel(spark, sf_dir)), n_test_years=2))


M5_NUMERIC = [c for c, t in PANEL_LAYOUT if t in ("int64", "float64")
              and c not in FS.LEAKAGE_COLUMNS | FS.IDENTIFIER_COLUMNS | {FS.YEAR_INDEX_FEATURE}]
M5_SQL = O.with_ctes(["lab"], "\nUNION ALL\n".join(
    f"SELECT county_fips, crop, year, checkpoint, state, '{c}' AS feature, "
    f"round((coalesce(cast({c} AS double), m) - a) / CASE WHEN s > 1e-12 THEN s ELSE 1.0 END, 6) + 0.0 AS value "
    f"FROM test, (SELECT m, avg(coalesce(cast({c} AS double), m)) AS a, stddev_pop(coalesce(cast({c} AS double), m)) AS s "
    f"FROM train, (SELECT median(cast({c} AS double)) AS m FROM train WHERE yield_anomaly IS NOT NULL) "
    f"WHERE yield_anomaly IS NOT NULL GROUP BY m) WHERE m IS NOT NULL" for c in M5_NUMERIC))


@register("m5_preprocessed_features", M5_SQL)
def q_m5(spark, sf_dir):
    """M1 + M5: the selected features of the test split, imputed and scaled by
    statistics of the training split (rounded to 6 decimals), one row each."""
    train, test = labelled_split(spark, sf_dir)
    numeric, categorical = FS.select_feature_columns(stored_panel(spark, sf_dir))
    fitted, kept, _ = ML.fit_preprocessing(train.filter(F.col("yield_anomaly").isNotNull()), numeric, categorical)
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), (F.round(f"__n_{c}", 6) + 0.0).alias("value"))
                                for c in kept])).alias("cell")
    return fitted.transform(test).select("county_fips", F.col("__c_crop").alias("crop"), "year",
                                         F.col("__c_checkpoint").alias("checkpoint"),
                                         F.col("__c_state").alias("state"), cells) \
        .select("county_fips", "crop", "year", "checkpoint", "state", "cell.*")


CORR_FEATURES = [*M5_NUMERIC, "yield_anomaly"]


@register("a20_correlations", O.with_ctes(["panel"], """
SELECT a.feature AS feature_a, b.feature AS feature_b,
  CASE WHEN min(a.value) < max(a.value) AND min(b.value) < max(b.value)
       THEN round(corr(a.value, b.value), 6) + 0.0 END AS corr
FROM cells a JOIN cells b ON a.id = b.id AND a.place < b.place AND (a.value IS NULL) = (b.value IS NULL)
GROUP BY a.feature, b.feature
UNION ALL
SELECT a.feature, b.feature, NULL FROM names a JOIN names b ON a.place < b.place
WHERE NOT EXISTS (SELECT 1 FROM panel)""", extra="""names AS (
  SELECT unnest([""" + ", ".join(f"'{c}'" for c in CORR_FEATURES) + f"""]) AS feature,
         unnest(range({len(CORR_FEATURES)})) AS place),
numbered AS (SELECT row_number() OVER () AS id, * FROM panel),
cells AS (
  SELECT id, unnest([""" + ", ".join(f"'{c}'" for c in CORR_FEATURES) + f"""]) AS feature,
         unnest(range({len(CORR_FEATURES)})) AS place,
         unnest([""" + ", ".join(f"cast({c} AS double)" for c in CORR_FEATURES) + """]) AS value FROM numbered)"""))
def q_a20(spark, sf_dir):
    """Correlations of all numeric features and the target (6 decimals)."""
    return M.correlation_long(stored_panel(spark, sf_dir), CORR_FEATURES) \
        .withColumn("corr", F.round("corr", 6) + 0.0)


RIDGE_FEATURES = ["cumulative_precip", "mean_temp"]


@register("m6_ridge_coefficients", O.with_ctes(["lab"], """
SELECT unnest(['cumulative_precip', 'mean_temp', 'intercept']) AS term,
  unnest([round(((n + 1.0) * n * c1 - n * r * n * c2) / ((n + 1.0) * (n + 1.0) - n * r * n * r), 4) + 0.0,
          round(((n + 1.0) * n * c2 - n * r * n * c1) / ((n + 1.0) * (n + 1.0) - n * r * n * r), 4) + 0.0,
          round(m, 4) + 0.0]) AS value
FROM (SELECT cast(count(*) AS double) AS n, covar_pop(x1, y) / stddev_pop(x1) AS c1,
        covar_pop(x2, y) / stddev_pop(x2) AS c2, covar_pop(x1, x2) / (stddev_pop(x1) * stddev_pop(x2)) AS r, avg(y) AS m
      FROM filled)""", extra="""med AS (
  SELECT median(cumulative_precip) AS m1, median(mean_temp) AS m2 FROM train WHERE yield_anomaly IS NOT NULL),
filled AS (
  SELECT coalesce(cumulative_precip, m1) AS x1, coalesce(mean_temp, m2) AS x2, yield_anomaly AS y
  FROM train, med WHERE yield_anomaly IS NOT NULL)"""), ["value"])
def q_m6(spark, sf_dir):
    """M5 + M6: the fitted ridge model on two imputed and scaled features (4
    decimals); the oracle solves the normal equations (alpha = 1)."""
    train, _ = labelled_split(spark, sf_dir)
    fitted = ML.fit_model(train, "ridge", RIDGE_FEATURES, [], "yield_anomaly").stages[-1]
    terms = [*zip(RIDGE_FEATURES, map(float, fitted.coefficients)), ("intercept", float(fitted.intercept))]
    return spark.createDataFrame(terms, "term string, value double") \
        .withColumn("value", F.round("value", 4) + 0.0)


# The batched learners on the training split.  Fixed parameters of the checks:
TREE_FEATURES = ["dry_days", "extreme_heat_days", "longest_dry_spell", "weeks_d2_plus", "weeks_d0"]
FOREST_CHECK = {"trees": 3, "max_leaves": None, "min_leaf": 1, "max_depth": 2, "seed": 7}
BOOST_CHECK = {"trees": 1, "max_depth": 2}


def design(spark, sf_dir, numeric, categorical, label):
    """Design rows of the training split (data set 0) and their columns; classes
    are balanced, and rows carry a hash of their keys."""
    train = labelled_split(spark, sf_dir)[0].where(F.col(label).isNotNull()).withColumn("_set", F.lit(0))
    key = F.conv(F.substring(F.md5(F.concat_ws("|", "county_fips", "crop", "year", "checkpoint")), 1, 7), 16, 10)
    train = train.withColumn("_row", key.cast("long"))
    if label == "severe_risk":
        train = ML.add_balanced_weights(train, label)
    columns = LN.design_columns(train, "_set", numeric, categorical)
    return LN.design_rows(train, "_set", columns, label, weight="__w" if label == "severe_risk" else None, key="_row"), columns[0]


def tree_splits(spark, sf_dir, spec):
    """A model fitted on ``TREE_FEATURES``, their columns, and its splits as rows:
    tree, node (root 1, children 2n and 2n + 1), feature, threshold, and both
    children's weights and values."""
    rows, columns = design(spark, sf_dir, TREE_FEATURES, [], "yield_anomaly")
    model = TR.fit_trees(rows, [spec])[spec.key]
    out = []
    for t, tree in enumerate(model["trees"]):
        todo = [(0, 1)]
        while todo:
            k, place = todo.pop()
            f = int(tree["feature"][k])
            if f >= 0:
                todo += [(int(tree["left"][k]), 2 * place), (int(tree["right"][k]), 2 * place + 1)]
                out.append((t, place, columns[f].feature, float(columns[f].edges[tree["bin"][k]]),
                            float(tree["weight"][tree["left"][k]]), float(tree["weight"][tree["right"][k]]),
                            float(tree["value"][tree["left"][k]]), float(tree["value"][tree["right"][k]])))
    return model, columns, spark.createDataFrame(
        out, "tree int, node int, feature string, threshold double, left_weight double, right_weight double, "
             "left_value double, right_value double")


def splits_sql(samples: str, min_leaf: int, rate: float) -> str:
    """CTEs of the first two levels of trees over ``samples`` (tree, id, g, h),
    by brute force over all cuts: ``splits``."""
    names = ", ".join(f"'{c}'" for c in TREE_FEATURES)
    values = ", ".join(f"coalesce(cast({c} AS double), m{k})" for k, c in enumerate(TREE_FEATURES))
    medians = ", ".join(f"median({c}) AS m{k}" for k, c in enumerate(TREE_FEATURES))

    def level(name, source):
        return f"""
{name}_cells AS (SELECT tree, node, place, v, sum(g) AS g, sum(h) AS h, count(*) AS n FROM {source} GROUP BY ALL),
{name}_cuts AS (SELECT *, sum(g) OVER w AS gl, sum(h) OVER w AS hl, sum(n) OVER w AS nl, sum(g) OVER a AS gt, sum(h) OVER a AS ht,
    sum(n) OVER a AS nt FROM {name}_cells WINDOW w AS (PARTITION BY tree, node, place ORDER BY v), a AS (PARTITION BY tree, node, place)),
{name}_gains AS (SELECT *, gl * gl / hl + (gt - gl) * (gt - gl) / nullif(ht - hl, 0) - gt * gt / ht AS gain
    FROM {name}_cuts WHERE nl >= {min_leaf} AND nt - nl >= {min_leaf}),
{name} AS (SELECT tree, node, place, v AS cut, (v + nxt) / 2 AS threshold, gain, hl AS left_weight, ht - hl AS right_weight,
    {rate} * gl / hl AS left_value, {rate} * (gt - gl) / (ht - hl) AS right_value
    FROM {name}_gains JOIN steps USING (place, v) WHERE gain > 1e-9
    QUALIFY row_number() OVER (PARTITION BY tree, node ORDER BY round(gain, 6) DESC, place, v) = 1)"""

    return f"""known AS (SELECT row_number() OVER (ORDER BY county_fips, crop, year, checkpoint) AS id, *,
    cast('0x' || substr(md5(county_fips || '|' || crop || '|' || year || '|' || checkpoint), 1, 7) AS bigint) AS row_hash
    FROM train WHERE yield_anomaly IS NOT NULL),
med AS (SELECT {medians} FROM known),
cells AS (SELECT id, unnest(range({len(TREE_FEATURES)})) AS place, unnest([{values}]) AS v FROM known, med),
steps AS (SELECT place, v, lead(v) OVER (PARTITION BY place ORDER BY v) AS nxt FROM (SELECT DISTINCT place, v FROM cells)),
samples AS ({samples}),
top_rows AS (SELECT tree, 1 AS node, id, place, v, g, h FROM samples JOIN cells USING (id) WHERE h > 0),
{level('top', 'top_rows')},
low_rows AS (SELECT r.tree, CASE WHEN c.v <= t.cut THEN 2 ELSE 3 END AS node, r.id, r.place, r.v, r.g, r.h
    FROM top_rows r JOIN top t USING (tree) JOIN cells c ON c.id = r.id AND c.place = t.place),
{level('low', 'low_rows')},
splits AS (SELECT *, ([{names}])[place + 1] AS feature FROM (SELECT * FROM top UNION ALL SELECT * FROM low))"""


SPLIT_DOUBLES = ["threshold", "left_weight", "right_weight", "left_value", "right_value"]
SPLIT_SELECT = "SELECT cast(tree AS int) AS tree, node, feature, " + ", ".join(SPLIT_DOUBLES) + " FROM splits"
FOREST_SAMPLES = "\nUNION ALL\n".join(
    f"SELECT {t} AS tree, id, yield_anomaly * n AS g, cast(n AS double) AS h FROM (SELECT id, yield_anomaly, "
    f"len([x for x in {[float(v) for v in TR._POISSON]} if x <= ((row_hash * {a} + {b}) % 2147483647) / 2147483647.0]) AS n FROM known)"
    for t in range(FOREST_CHECK["trees"]) for a, b in [TR.bootstrap_factors(FOREST_CHECK["seed"], t)])


@register("m8_boosting_first_tree", O.with_ctes(["lab"], SPLIT_SELECT, extra=splits_sql(
    "SELECT 0 AS tree, id, yield_anomaly - avg(yield_anomaly) OVER () AS g, 1.0::double AS h FROM known", 20, 0.1)),
    SPLIT_DOUBLES, digits=dict.fromkeys(SPLIT_DOUBLES, 6))
def q_m8(spark, sf_dir):
    """M8: the first two levels of the first boosted tree, against all cuts."""
    return tree_splits(spark, sf_dir, TR.Spec("m8", 0, "boosting", tuple(range(len(TREE_FEATURES))), **BOOST_CHECK))[2]


def forest_check(spark, sf_dir):
    return tree_splits(spark, sf_dir, TR.Spec("m7", 0, "forest", tuple(range(len(TREE_FEATURES))), **FOREST_CHECK))


@register("m7_forest_levels", O.with_ctes(["lab"], SPLIT_SELECT, extra=splits_sql(FOREST_SAMPLES, 1, 1.0)),
          SPLIT_DOUBLES, digits=dict.fromkeys(SPLIT_DOUBLES, 6))
def q_m7(spark, sf_dir):
    """M7: the first two levels of bootstrapped regression trees, against all cuts."""
    return forest_check(spark, sf_dir)[2]


@register("m16_forest_importance", O.with_ctes(["lab"], """
SELECT feature, sum(share) / sum(sum(share)) OVER () AS importance
FROM (SELECT feature, gain / sum(gain) OVER (PARTITION BY tree) AS share FROM splits) GROUP BY feature""",
    extra=splits_sql(FOREST_SAMPLES, 1, 1.0)), ["importance"], digits={"importance": 6})
def q_m16_forest(spark, sf_dir):
    """Importances of that forest."""
    model, columns, _ = forest_check(spark, sf_dir)
    share = TR.importances(model, len(columns))
    return spark.createDataFrame([(c.feature, float(v)) for c, v in zip(columns, share) if v > 0], "feature string, importance double")


def gradient_rows(spark, sf_dir, kind, label):
    """Each term's penalised gradient at the fitted optimum, per training row."""
    numeric, categorical = FS.select_feature_columns(stored_panel(spark, sf_dir))
    rows, columns = design(spark, sf_dir, numeric, categorical, label)
    rows = cut_lineage(rows)
    models = {kind: (0, tuple(range(len(columns))))}
    beta = LN.logistic_models(rows, models) if kind == "logistic" \
        else {kind: LN.ridge(LN.gram_matrices(rows)[0], range(len(columns)))}
    slope = LN.gradients(rows, models, beta, kind)[kind] / rows.count()
    return spark.createDataFrame([(c, float(g)) for c, g in zip(["intercept", *(c.name for c in columns)], slope)],
                                 "term string, gradient double").withColumn("gradient", F.round("gradient", 6) + 0.0)


def terms_sql(label):
    numbers = " UNION ALL ".join(f"SELECT '{c}' AS term, count({c}) AS n FROM known" for c in M5_NUMERIC)
    categories = " UNION ALL ".join(f"SELECT DISTINCT '{c}=' || {c}, 1 FROM known WHERE {c} IS NOT NULL"
                                    for c in FS.BASE_CATEGORICAL)
    return O.with_ctes(["lab"], f"""
SELECT term, 0.0::double AS gradient FROM (SELECT 'intercept' AS term, 1 AS n UNION ALL {numbers} UNION ALL {categories})
WHERE n > 0""", extra=f"known AS (SELECT * FROM train WHERE {label} IS NOT NULL)")


@register("m6_ridge_gradient", terms_sql("yield_anomaly"))
def q_m6_gradient(spark, sf_dir):
    """M6 on all features and categories: the normal equations hold (gradient
    per row, 6 decimals) for every term that SQL finds in the training rows."""
    return gradient_rows(spark, sf_dir, "ridge", "yield_anomaly")


@register("m9_logistic_gradient", terms_sql("severe_risk"))
def q_m9_gradient(spark, sf_dir):
    """M9 on all features and categories: the penalised, balanced log-loss is at
    its minimum (gradient per row, 6 decimals)."""
    return gradient_rows(spark, sf_dir, "logistic", "severe_risk")


def baseline_mode_metrics(spark, sf_dir):
    """Baseline metrics with the crop as mode and the checkpoint as feature group."""
    tagged = reg_preds(spark, sf_dir).withColumn("mode", F.col("crop")).withColumn("feature_group", F.col("checkpoint"))
    return M.grouped_metrics(tagged, "regression", group_cols=(), crop_checkpoint=False,
                             model_cols=("mode", "feature_group", "model"))


MODE_RMSE = """m AS (
  SELECT crop AS mode, checkpoint AS feature_group, model, sqrt(avg((y_pred - y_true) * (y_pred - y_true))) AS rmse,
    count(*) AS n
  FROM reg_preds WHERE y_true IS NOT NULL AND y_pred IS NOT NULL GROUP BY crop, checkpoint, model)"""


@register("m13_baseline_best_per_group", O.with_ctes(["reg_preds"], """
SELECT mode, feature_group, model, rmse FROM m
QUALIFY row_number() OVER (PARTITION BY mode, feature_group ORDER BY rmse, model) = 1""", extra=MODE_RMSE), ["rmse"])
def q_m13_baselines(spark, sf_dir):
    """M13 over the baseline metrics: the lowest RMSE of each mode and group."""
    return AB.best_per_group(baseline_mode_metrics(spark, sf_dir)).select("mode", "feature_group", "model", "rmse")


MODE_NAMES = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@register("m14_baseline_pivot", O.with_ctes(["reg_preds"], "SELECT feature_group, " + ", ".join(
    f'min(rmse) FILTER (WHERE mode = \'{c}\') AS "{c}"' for c in MODE_NAMES) + " FROM m GROUP BY feature_group",
    extra=MODE_RMSE), MODE_NAMES)
def q_m14_baselines(spark, sf_dir):
    """M14 over the baseline metrics: the group x mode table of the lowest RMSE."""
    return AB.ablation_pivot(baseline_mode_metrics(spark, sf_dir))


@register("m15_baseline_checkpoint_trend", O.with_ctes(["reg_preds"], """
SELECT model, arg_min(checkpoint, place) AS first_checkpoint, arg_min(rmse, place) AS first_rmse,
  arg_max(checkpoint, place) AS last_checkpoint, arg_max(rmse, place) AS last_rmse,
  round(arg_max(rmse, place) - arg_min(rmse, place), 6) + 0.0 AS rmse_change
FROM (SELECT *, 2 * end_key + CASE WHEN checkpoint = 'full_season' THEN 1 ELSE 0 END AS place
      FROM (SELECT model, checkpoint, sqrt(avg((y_pred - y_true) * (y_pred - y_true))) AS rmse FROM reg_preds
            WHERE y_true IS NOT NULL AND y_pred IS NOT NULL GROUP BY model, checkpoint) JOIN ck USING (checkpoint))
GROUP BY model"""), ["first_rmse", "last_rmse", "rmse_change"])
def q_m15_baselines(spark, sf_dir):
    """M15 over the baseline predictions: first against last checkpoint (the
    change, a difference of nearly equal numbers, to 6 decimals)."""
    trend = AB.checkpoint_trend(M.grouped_metrics(reg_preds(spark, sf_dir), "regression", crop_checkpoint=True))
    return trend.withColumn("rmse_change", F.round("rmse_change", 6) + 0.0)


@register("m11_model_predictions", None)
def q_m11(spark, sf_dir):
    """Ridge, random forest, gradient boosting, logistic regression
    and balanced random forest fitted on the training years, scored on test."""
    return model_predictions(spark, sf_dir)


@register("m11_model_metrics", None)
def q_m11m(spark, sf_dir):
    """A12 over the model predictions (with crop x checkpoint)."""
    return model_metrics(spark, sf_dir)


@register("j11_model_vs_baseline", None)
def q_j11m(spark, sf_dir):
    """Best model vs best baseline by overall RMSE."""
    mm = model_metrics(spark, sf_dir).filter((F.col("task") == "regression") & (F.col("group") == "overall"))
    bm = M.regression_metrics(reg_preds(spark, sf_dir), ["model"])
    return M.compare_best(mm, bm)


@register("m15_checkpoint_trend", None)
def q_m15(spark, sf_dir):
    """First vs last checkpoint RMSE per regression model."""
    return AB.checkpoint_trend(model_metrics(spark, sf_dir))


@register("m16_feature_importance", None)
def q_m16(spark, sf_dir):
    """Random-forest feature importances, sorted."""
    train, _ = labelled_split(spark, sf_dir)
    model_predictions(spark, sf_dir)
    model = _MODELS[(id(spark._jsparkSession), sf_dir)][1]["random_forest_reg"]
    return ML.feature_importance(model, train)


@register("m12_ablation_metrics", None)
def q_m12(spark, sf_dir):
    """F7 + M4 + M12: crop modes x feature groups x models, grouped metrics."""
    return ablation_metrics(spark, sf_dir)


@register("m13_best_per_group", None)
def q_m13(spark, sf_dir):
    """Best regression model per (mode, feature group)."""
    m = ablation_metrics(spark, sf_dir)
    return AB.best_per_group(m, "regression").unionByName(AB.best_per_group(m, "classification"),
                                                          allowMissingColumns=True)


@register("m14_ablation_pivot", None)
def q_m14(spark, sf_dir):
    """Feature group x mode table of the minimum RMSE."""
    return AB.ablation_pivot(ablation_metrics(spark, sf_dir), "regression")


from pitpanel.plans import defects as _defects  # noqa: E402, F401 - registers its queries


# ------------------------------------------------------------------ export
def spark_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def wrap(q: Query):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return finish(q.fn(spark, sf_dir), q.digits)
        run.__doc__ = q.fn.__doc__
        return run
    return {name: wrap(q) for name, q in REGISTRY.items()}
