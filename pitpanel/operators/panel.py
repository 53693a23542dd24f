"""Modeling panel assembly (J1-J4, O4, C12-C16, F6, A13) and audits.

Join plan: the yield side and the checkpoint-weather side are both keyed by
(county_fips, year); neither is size-bounded (both grow with entities x
years), so no broadcast is forced -- AQE converts a join to broadcast at run
time only when the measured side is below ``autoBroadcastJoinThreshold``.
The lag table and the drought table are unique by their join keys by
construction (``keep_first``), so neither left join can fan out; the only
fan-out is the intended one-row-per-checkpoint of J1.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, IntegerType, LongType, StringType

from pitpanel.functions.ids import is_valid_fips, normalize_fips
from pitpanel.functions.season import FULL_SEASON_DAYS
from pitpanel.operators.lags import add_lag_columns, keep_first
from pitpanel.operators.season import drop_incomplete_current_year
from pitpanel.schema import require_columns, validate_merge_keys

# Panel keys, targets and defaults.
WEATHER_MERGE_KEYS = ["county_fips", "year"]
PANEL_KEYS = ["county_fips", "crop", "year", "checkpoint"]
TARGET_COLUMN = "yield_anomaly"
TARGET_COLUMNS = ["actual_yield", "expected_yield", "yield_anomaly", "yield_anomaly_pct"]
YEAR_INDEX_BASE = 2015
SORT_COLUMNS = ["state", "county", "crop", "year", "checkpoint"]


def valid_entities(df: DataFrame, id_col: str = "county_fips") -> DataFrame:
    """C1 + C12: normalised id, only 5-digit ids survive (aggregate rows go)."""
    return df.withColumn(id_col, normalize_fips(id_col)).filter(is_valid_fips(id_col))


def count_invalid_entities(df: DataFrame, id_col: str = "county_fips") -> DataFrame:
    """C12 drop count as a one-row aggregate."""
    return df.select(F.count_if(~F.coalesce(is_valid_fips(normalize_fips(id_col)), F.lit(False)))
                     .alias("dropped_rows"))


def add_year_index(df: DataFrame, base_year: int = YEAR_INDEX_BASE, year_col: str = "year") -> DataFrame:
    """C14."""
    return df.withColumn("year_index", F.col(year_col).cast("int") - base_year)


def add_interactions(df: DataFrame) -> DataFrame:
    """Heat x dry interactions, only when the sources exist."""
    if {"extreme_heat_days", "dry_days"} <= set(df.columns):
        df = df.withColumn("heat_dry_stress", F.col("extreme_heat_days") * F.col("dry_days"))
    if {"extreme_heat_days", "longest_dry_spell"} <= set(df.columns):
        df = df.withColumn("heat_dry_spell", F.col("extreme_heat_days") * F.col("longest_dry_spell"))
    return df


def add_checkpoint_label(df: DataFrame, full_days: int = FULL_SEASON_DAYS) -> DataFrame:
    """Keep an existing checkpoint; else from is_partial_year (NULL flag
    -> NULL), else from obs_days (missing -> partial), else full_season."""
    if "checkpoint" in df.columns:
        return df
    if "is_partial_year" in df.columns:
        lab = F.when(F.col("is_partial_year"), "partial").when(~F.col("is_partial_year"), "full_season")
    elif "obs_days" in df.columns:
        lab = F.when(F.col("obs_days") >= full_days, "full_season").otherwise("partial")
    else:
        lab = F.lit("full_season")
    return df.withColumn("checkpoint", lab)


def prepare_weather(weather: DataFrame, current_year: int | None = None,
                    allow_partial: bool = False) -> DataFrame:
    """Weather side of J1: id normalised, F5, colliding columns dropped (C13),
    one row per (county_fips, year[, checkpoint]) (O4)."""
    cols = weather.columns
    validate_merge_keys(weather, "weather features", WEATHER_MERGE_KEYS)
    w = weather.withColumns({"county_fips": normalize_fips("county_fips"), "year": F.col("year").cast("int")})
    if current_year is not None:
        w = drop_incomplete_current_year(w, current_year, allow_partial)
    w = w.drop(*[c for c in ("county", "state", "state_fips") if c in cols])
    keys = WEATHER_MERGE_KEYS + (["checkpoint"] if "checkpoint" in cols else [])
    order = [F.col("obs_days").isNull(), -F.col("obs_days")] if "obs_days" in cols else []
    return keep_first(w, keys, order)


def prepare_drought(drought: DataFrame, panel_has_checkpoint: bool) -> tuple[DataFrame, list[str]]:
    cols = drought.columns
    validate_merge_keys(drought, "drought features", WEATHER_MERGE_KEYS)
    d = drought.withColumns({"county_fips": normalize_fips("county_fips"), "year": F.col("year").cast("int")})
    keys = list(WEATHER_MERGE_KEYS)
    if "checkpoint" in cols and panel_has_checkpoint:
        keys.append("checkpoint")
    elif "checkpoint" in cols:
        d = d.drop("checkpoint")
    order = [F.col("weeks_d0").isNull(), -F.col("weeks_d0")] if "weeks_d0" in cols else []
    return keep_first(d, keys, order), keys


def build_panel(targets: DataFrame, weather: DataFrame, drought: DataFrame | None = None,
                current_year: int | None = None, allow_partial: bool = False,
                with_lags: bool = True, drop_missing_target: bool = True,
                year_index_base: int = YEAR_INDEX_BASE) -> DataFrame:
    """J1-J3 + C12-C15 + F6: the county x crop x year x checkpoint panel.

    With a checkpointed weather table the drought features (full season)
    are broadcast over every checkpoint row of an entity-year, as in the
    reference (N11); pass per-checkpoint drought features to avoid that.
    """
    tcols = targets.columns
    require_columns(targets, ["county_fips", "crop", "year", TARGET_COLUMN], "targets")
    y = targets.withColumns({"county_fips": normalize_fips("county_fips"), "year": F.col("year").cast("int")}) \
        .filter(is_valid_fips("county_fips"))                                   # C1 + C12
    if with_lags and {"actual_yield", "yield_anomaly"} <= set(tcols):
        y = add_lag_columns(y)                                                  # J2 (in place, no fan-out possible)
    w = prepare_weather(weather, current_year, allow_partial)
    wcols = w.columns
    panel = y.join(w, WEATHER_MERGE_KEYS, "left")                              # J1 (fan-out)
    has_ck = "checkpoint" in wcols or "checkpoint" in tcols
    if drought is not None:
        d, dkeys = prepare_drought(drought, has_ck)
        panel = panel.join(d, dkeys, "left")                                    # J3
    if "unit" in tcols:
        panel = panel.drop("unit")
    pcols = set(tcols) | set(wcols)
    extra = {"year_index": F.col("year").cast("int") - year_index_base}         # C14
    if {"extreme_heat_days", "dry_days"} <= pcols:                              # C15
        extra["heat_dry_stress"] = F.col("extreme_heat_days") * F.col("dry_days")
    if {"extreme_heat_days", "longest_dry_spell"} <= pcols:
        extra["heat_dry_spell"] = F.col("extreme_heat_days") * F.col("longest_dry_spell")
    panel = panel.withColumns(extra)
    if drop_missing_target:
        panel = panel.filter(F.col(TARGET_COLUMN).isNotNull())                  # F6
    return panel


def join_lag_table(yields: DataFrame, table: DataFrame, keys=("county_fips", "crop", "year")) -> DataFrame:
    """J2 as an explicit left join with the reference's guard: the table must
    be unique by ``keys`` (checked with one aggregate), so the row count
    cannot change."""
    if check_unique(table, list(keys)).limit(1).count():
        raise ValueError(f"lag table is not unique by {list(keys)}")
    return yields.join(table, list(keys), "left")


def unmatched_rows(panel: DataFrame, weather_cols: Sequence[str]) -> DataFrame:
    """Count of panel rows whose weather columns are all NULL (J1 report)."""
    cond = F.lit(True)
    for c in weather_cols:
        cond = cond & F.col(c).isNull()
    return panel.select(F.count_if(cond).alias("unmatched_rows"), F.count(F.lit(1)).alias("rows"))


def pandas_dtype(dt) -> str:
    """Schema type -> the dtype name a pandas-based report would print."""
    if isinstance(dt, (LongType, IntegerType)):
        return "int64"
    if isinstance(dt, DoubleType):
        return "float64"
    if isinstance(dt, BooleanType):
        return "bool"
    if isinstance(dt, StringType):
        return "object"
    return dt.simpleString()


def missingness_report(df: DataFrame) -> DataFrame:
    """(column, missing_count, missing_pct, dtype) in one aggregate pass
    + unpivot; sorted by pct desc at the sink (ties by column name)."""
    fields = df.schema.fields
    agg = df.select(F.count(F.lit(1)).alias("_n"),
                    *[F.count_if(F.col(f"`{f.name}`").isNull()).alias(f"_m{i}") for i, f in enumerate(fields)])
    stack = F.explode(F.array(*[
        F.struct(F.lit(f.name).alias("column"), F.col(f"_m{i}").alias("missing_count"),
                 F.lit(pandas_dtype(f.dataType)).alias("dtype"))
        for i, f in enumerate(fields)]))
    out = agg.select("_n", stack.alias("s")).select(
        "s.column", "s.missing_count",
        F.bround(F.try_divide(F.col("s.missing_count") * 100.0, F.col("_n")), 2).alias("missing_pct"), "s.dtype")
    return out


def panel_summary_by(df: DataFrame, by: str, target: str = TARGET_COLUMN) -> DataFrame:
    """A14 target distribution: count / mean / sample std by a column."""
    return df.filter(F.col(by).isNotNull()).groupBy(by).agg(
        F.count(F.col(target)).alias("n"), F.avg(target).alias("mean"),
        F.stddev_samp(target).alias("std"))


def panel_audit(df: DataFrame, keys: Sequence[str] = PANEL_KEYS) -> DataFrame:
    """A14 headline numbers as one row: rows, distinct entities / states,
    sorted distinct value lists and duplicate-key rows."""
    df = add_checkpoint_label(df)
    key_struct = F.struct(*[F.col(k) for k in keys])
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_distinct("county_fips").alias("n_counties"),
        F.count_distinct("state").alias("n_states"),
        F.array_sort(F.collect_set("state")).alias("states"),
        F.array_sort(F.collect_set("crop")).alias("crops"),
        F.array_sort(F.collect_set("year")).alias("years"),
        F.array_sort(F.collect_set("checkpoint")).alias("checkpoints"),
        (F.count(F.lit(1)) - F.count_distinct(key_struct)).alias("duplicate_rows"),
    )


def stage_summary(df: DataFrame, id_col: str = "county_fips", year_col: str = "year",
                  value_col: str | None = None) -> DataFrame:
    """Rows, distinct entities, year range (+ mean of a measure)."""
    aggs = [F.count(F.lit(1)).alias("rows"), F.count_distinct(id_col).alias("entities"),
            F.min(year_col).alias("min_year"), F.max(year_col).alias("max_year")]
    if value_col:
        aggs.append(F.avg(value_col).alias(f"mean_{value_col}"))
    return df.agg(*aggs)


def sort_panel(df: DataFrame) -> DataFrame:
    """O1: sink-only ordering."""
    return df.orderBy(*[c for c in SORT_COLUMNS if c in df.columns])


def check_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once (T8 / J2 guard) -- empty when unique."""
    return df.groupBy(*keys).count().filter(F.col("count") > 1)
