"""Seasonal weather features.

Plan shape for the multi-checkpoint table (A5 + A6): one scan of the daily
table, one hash exchange on the entity-period keys, one sort, a run-length
window, a generator that fans each day out to the checkpoints whose cutoff
it precedes, and one hash aggregate whose keys are a superset of the window
keys -- so the aggregate reuses the window's partitioning (no 2nd shuffle).
An entity-period holds at most 366 days, so no window partition is large.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitpanel.functions.season import (
    CHECKPOINT_DAYS, CHECKPOINTS, DRY_DAY_MM, EXTREME_HEAT_C, FULL_SEASON_DAYS, GDD_BASE_TEMP_C,
    JULY_CHECKPOINTS, STRESS_LAST_N_DAYS, checkpoint_end_md, month_day_key, parse_month_day,
    season_filter, validate_checkpoints,
)
from pitpanel.functions.windows import gated_avg, ordered, prior, running
from pitpanel.schema import require_columns

# Default keys and source column names.
GROUP_COLS = ["county_fips", "state_fips", "year"]
PRECIP, TAVG, TMAX = "PRECTOTCORR", "T2M", "T2M_MAX"

WEATHER_COLUMNS = [
    "cumulative_precip", "mean_temp", "max_temp", "extreme_heat_days", "dry_days",
    "longest_dry_spell", "growing_degree_days", "obs_days", "is_partial_year",
]
STRESS_COLUMNS = [
    "max_consecutive_dry_days", "extreme_heat_days_after_july_1",
    "precip_last_30_days_before_checkpoint", "heat_days_last_30_days_before_checkpoint",
    "gdd_last_30_days_before_checkpoint",
]
# Climatology anomaly outputs -> source column.
ANOMALY_SOURCES = {
    "precip_anomaly_from_county_checkpoint_mean": "cumulative_precip",
    "gdd_anomaly_from_county_checkpoint_mean": "growing_degree_days",
    "heat_days_anomaly_from_county_checkpoint_mean": "extreme_heat_days",
    "dry_days_anomaly_from_county_checkpoint_mean": "dry_days",
    "temp_mean_anomaly_from_county_checkpoint_mean": "mean_temp",
}
PCT_SOURCES = {"precip_pct_of_county_checkpoint_mean": "cumulative_precip"}
ANOMALY_KEYS = ["county_fips", "checkpoint"]


def filter_season(df: DataFrame, date_col: str = "date", cutoff_date=None,
                  cutoff_month_day: str | None = None) -> DataFrame:
    """April..August, optional inclusive cutoff (month-day wins)."""
    return df.filter(season_filter(date_col, cutoff_date, cutoff_month_day))


def add_dry_runs(df: DataFrame, keys: Sequence[str], date_col: str = "date",
                 precip_col: str = PRECIP, threshold: float = DRY_DAY_MM) -> DataFrame:
    """A2 / W14 as prefix-stable per-day run lengths, for both NULL rules.

    ``_run_bridge``: NULL days are skipped (they neither count nor break);
    ``_run_break``: NULL days break a run.  The longest run within any
    prefix of days is ``max`` of these values over that prefix, so one pass
    serves every checkpoint cutoff.
    """
    p = F.col(precip_col)
    w = running(keys, [F.col(date_col), p])
    first = df.select("*",
                      F.count(p).over(w).alias("_nn"),
                      F.row_number().over(ordered(keys, [F.col(date_col), p])).alias("_rn"))
    dry = p <= threshold
    wet_known = p > threshold
    second = first.select(
        "*",
        F.max(F.when(wet_known, F.col("_nn"))).over(w).alias("_last_wet"),
        F.max(F.when(~dry | p.isNull(), F.col("_rn"))).over(w).alias("_last_break"),
    )
    return second.select(
        *df.columns,
        F.when(dry, F.col("_nn") - F.coalesce(F.col("_last_wet"), F.lit(0))).alias("_run_bridge"),
        F.when(dry, F.col("_rn") - F.coalesce(F.col("_last_break"), F.lit(0))).alias("_run_break"),
    )


def _gdd(t: Column, base: float) -> Column:
    return F.greatest(t - F.lit(base), F.lit(0.0))


def _season_aggs(precip_col: str, tavg_col: str, tmax_col: str, full_days: int,
                 heat: float, dry: float, base: float) -> list[Column]:
    p, t, tx = F.col(precip_col), F.col(tavg_col), F.col(tmax_col)
    return [
        F.coalesce(F.sum(p), F.lit(0.0)).alias("cumulative_precip"),
        F.avg(t).alias("mean_temp"),
        F.max(tx).alias("max_temp"),
        F.count_if(tx >= heat).alias("extreme_heat_days"),
        F.count_if(p <= dry).alias("dry_days"),
        F.coalesce(F.max("_run_bridge"), F.lit(0)).cast("long").alias("longest_dry_spell"),
        F.coalesce(F.sum(_gdd(t, base)), F.lit(0.0)).alias("growing_degree_days"),
        F.count(F.lit(1)).alias("obs_days"),
    ]


def add_precip_anomaly(df: DataFrame, keys: Sequence[str] = ("county_fips",),
                       year_col: str = "year", precip_col: str = "cumulative_precip",
                       out_col: str = "precip_anomaly") -> DataFrame:
    """Value minus the mean of all prior periods of the same entity."""
    w = prior(list(keys), [F.col(year_col)])
    return df.withColumn(out_col, F.col(precip_col) - gated_avg(precip_col, w, 1))


def season_features(daily: DataFrame, group_cols: Sequence[str] = GROUP_COLS,
                    cutoff_date=None, cutoff_month_day: str | None = None,
                    date_col: str = "date", precip_col: str = PRECIP, tavg_col: str = TAVG,
                    tmax_col: str = TMAX, full_days: int = FULL_SEASON_DAYS,
                    heat: float = EXTREME_HEAT_C, dry: float = DRY_DAY_MM,
                    base: float = GDD_BASE_TEMP_C, anomaly_keys: Sequence[str] = ("county_fips",)) -> DataFrame:
    """A1 + A2 + A3 + W1 for one cutoff: one row per ``group_cols``."""
    group_cols = list(group_cols)
    require_columns(daily, [*group_cols, date_col, precip_col, tavg_col, tmax_col], "season_features")
    d = filter_season(daily, date_col, cutoff_date, cutoff_month_day).dropna(subset=group_cols)
    runs = add_dry_runs(d, group_cols, date_col, precip_col, dry)
    feats = runs.groupBy(*group_cols).agg(*_season_aggs(precip_col, tavg_col, tmax_col, full_days, heat, dry, base))
    feats = feats.withColumn("is_partial_year", F.col("obs_days") < full_days)
    return add_precip_anomaly(feats, anomaly_keys)


def _checkpoint_array(names: Sequence[str]) -> Column:
    items = []
    for n in names:
        mm, dd = parse_month_day(checkpoint_end_md(n))
        items.append(F.struct(F.lit(n).alias("name"), F.lit(mm * 100 + dd).alias("end_key"),
                              F.lit(mm).alias("end_mm"), F.lit(dd).alias("end_dd")))
    return F.array(*items)


def fan_out_checkpoints(df: DataFrame, checkpoints: Sequence[str] | None = None,
                        date_col: str = "date") -> DataFrame:
    """A5 fan-out: each season day is emitted once per checkpoint whose
    cutoff it does not pass (at most 5 copies; a generator, not a join)."""
    names = validate_checkpoints(checkpoints)
    md = month_day_key(date_col)
    ck = F.explode(F.filter(_checkpoint_array(names), lambda c: md <= c["end_key"]))
    return df.withColumn("_ck", ck).withColumn("checkpoint", F.col("_ck.name"))


def checkpoint_weather(daily: DataFrame, checkpoints: Sequence[str] | None = None,
                       group_cols: Sequence[str] = GROUP_COLS, include_stress: bool = True,
                       include_season: bool = True, last_n_days: int = STRESS_LAST_N_DAYS,
                       date_col: str = "date", precip_col: str = PRECIP, tavg_col: str = TAVG,
                       tmax_col: str = TMAX, full_days: int = FULL_SEASON_DAYS,
                       heat: float = EXTREME_HEAT_C, dry: float = DRY_DAY_MM,
                       base: float = GDD_BASE_TEMP_C) -> DataFrame:
    """A5 (+W1) and A6 in one aggregation: one row per (group_cols, checkpoint).

    ``include_season`` gives A1 features + ``precip_anomaly`` per checkpoint;
    ``include_stress`` gives the five stress-timing features.
    """
    group_cols = list(group_cols)
    require_columns(daily, [*group_cols, date_col, precip_col, tavg_col, tmax_col], "checkpoint_weather")
    d = filter_season(daily, date_col).dropna(subset=group_cols)
    runs = add_dry_runs(d, group_cols, date_col, precip_col, dry)
    fan = fan_out_checkpoints(runs, checkpoints, date_col)
    p, t, tx, dt = F.col(precip_col), F.col(tavg_col), F.col(tmax_col), F.col(date_col)
    aggs: list[Column] = []
    if include_season:
        aggs += _season_aggs(precip_col, tavg_col, tmax_col, full_days, heat, dry, base)
    if include_stress:
        end_date = F.make_date(F.year(dt), F.col("_ck.end_mm"), F.col("_ck.end_dd"))
        in_win = F.datediff(end_date, dt) <= last_n_days - 1
        aggs += [
            F.coalesce(F.max("_run_break"), F.lit(0)).cast("long").alias("max_consecutive_dry_days"),
            F.count_if((F.month(dt) >= 7) & (tx >= heat)).cast("double").alias("_heat_after_july"),
            F.coalesce(F.sum(F.when(in_win, p)), F.lit(0.0)).alias("precip_last_30_days_before_checkpoint"),
            F.count_if(in_win & (tx >= heat)).cast("double").alias("heat_days_last_30_days_before_checkpoint"),
            F.coalesce(F.sum(F.when(in_win, _gdd(t, base))), F.lit(0.0)).alias("gdd_last_30_days_before_checkpoint"),
        ]
    out = fan.groupBy(*group_cols, "checkpoint").agg(*aggs)
    if include_stress:
        out = out.withColumn("extreme_heat_days_after_july_1",
                             F.when(F.col("checkpoint").isin(*JULY_CHECKPOINTS), F.col("_heat_after_july"))) \
            .drop("_heat_after_july")
    if include_season:
        out = out.withColumn("is_partial_year", F.col("obs_days") < full_days)
        anomaly_keys = [c for c in ("county_fips",) if c in group_cols] or group_cols[:1]
        out = add_precip_anomaly(out, [*anomaly_keys, "checkpoint"])
    return out


def stress_features(daily: DataFrame, checkpoints: Sequence[str] | None = None,
                    group_cols: Sequence[str] = GROUP_COLS, last_n_days: int = STRESS_LAST_N_DAYS,
                    **kw) -> DataFrame:
    """A6 alone (the J4 merge of A5 and A6 is the combined call above)."""
    return checkpoint_weather(daily, checkpoints, group_cols, include_stress=True,
                              include_season=False, last_n_days=last_n_days, **kw)


def add_weather_anomalies(df: DataFrame, keys: Sequence[str] = ANOMALY_KEYS,
                          year_col: str = "year") -> DataFrame:
    """W9 + W10: climatology anomalies vs the mean of prior periods of the
    same entity and checkpoint (only for source columns present).  All six
    share one window -> one exchange, one sort."""
    keys = [k for k in keys if k in df.columns]
    w = prior(keys, [F.col(year_col)])
    cols = []
    for out, src in ANOMALY_SOURCES.items():
        if src in df.columns:
            cols.append((F.col(src) - gated_avg(src, w, 1)).alias(out))
    for out, src in PCT_SOURCES.items():
        if src in df.columns:
            base = gated_avg(src, w, 1)
            cols.append(F.when(base.isNotNull() & (base != 0), F.col(src) / base).alias(out))
    return df.select("*", *cols)


def weather_anomaly_columns(df: DataFrame) -> list[str]:
    return [c for c in [*ANOMALY_SOURCES, *PCT_SOURCES] if c in df.columns]


def drop_incomplete_current_year(df: DataFrame, current_year: int, allow_partial: bool = False,
                                 year_col: str = "year", obs_col: str = "obs_days",
                                 full_days: int = FULL_SEASON_DAYS) -> DataFrame:
    """drop current-year rows flagged partial unless allowed.
    ``current_year`` is explicit so results do not depend on the clock."""
    if "is_partial_year" not in df.columns and obs_col in df.columns:
        df = df.withColumn("is_partial_year", F.col(obs_col) < full_days)
    if allow_partial or "is_partial_year" not in df.columns:
        return df
    partial_now = (F.col(year_col) == current_year) & F.coalesce(F.col("is_partial_year"), F.lit(False))
    return df.filter(~partial_now)


def expected_days(checkpoint_col: str = "checkpoint") -> Column:
    """Season days through each checkpoint (the better partial flag, N13)."""
    m = F.create_map(*[x for k, v in CHECKPOINT_DAYS.items() for x in (F.lit(k), F.lit(v))])
    return m[F.col(checkpoint_col)]


__all__ = [
    "CHECKPOINTS", "add_dry_runs", "add_precip_anomaly", "add_weather_anomalies",
    "checkpoint_weather", "drop_incomplete_current_year", "fan_out_checkpoints",
    "filter_season", "season_features", "stress_features",
]
