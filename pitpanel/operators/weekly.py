"""Weekly severity shares."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitpanel.functions.ids import normalize_fips
from pitpanel.functions.season import in_season, on_or_before

# Severity categories and source column-name variants.
CATEGORIES = ["D0", "D1", "D2", "D3", "D4"]
RENAME_VARIANTS = {"MapDate": "date", "FIPS": "county_fips", "CountyFIPS": "county_fips"}
DROUGHT_COLUMNS = ["weeks_d0", "weeks_d1", "weeks_d2", "weeks_d3", "weeks_d4",
                   "weeks_d2_plus", "max_drought_category", "mean_drought_severity"]
MAX_PCT_COLUMNS = ["d0_max_pct", "d1_max_pct", "d2_max_pct", "d3_max_pct", "d4_max_pct",
                   "d2_plus_max_pct"]


def clean_weekly(df: DataFrame, date_format: str | None = None) -> DataFrame:
    """Rename variants, parse date (bad -> drop), normalise id, derive
    year, absent/missing category -> 0, clip to [0, 100]."""
    for src, dst in RENAME_VARIANTS.items():
        if src in df.columns and dst not in df.columns:
            df = df.withColumnRenamed(src, dst)
    if "date" not in df.columns:
        raise KeyError("clean_weekly: 'date' column not found.")
    raw = F.col("date").cast("string")
    parsed = F.try_to_date(raw, date_format) if date_format else F.coalesce(
        F.try_to_date(raw, "yyyy-MM-dd"), F.try_to_date(raw, "yyyyMMdd"), F.try_to_date(raw, "M/d/yyyy"))
    if dict(df.dtypes)["date"] == "date":
        parsed = F.col("date")
    out = df.withColumn("date", parsed).filter(F.col("date").isNotNull())
    if "county_fips" in out.columns:
        out = out.withColumn("county_fips", normalize_fips("county_fips"))
    out = out.withColumn("year", F.year("date").cast("int"))
    for c in CATEGORIES:
        v = F.col(c).cast("string").try_cast("double") if c in out.columns else F.lit(0.0)
        v = F.coalesce(F.when(~F.isnan(v), v), F.lit(0.0))
        out = out.withColumn(c, F.greatest(F.least(v, F.lit(100.0)), F.lit(0.0)))
    return out.select("date", "county_fips", "year", *CATEGORIES)


def dominant_severity() -> Column:
    """Highest category with any coverage that week (0 also for none, N11)."""
    expr = F.lit(0)
    for i in range(1, 5):
        expr = F.when(F.col(f"D{i}") > 0, F.lit(i)).otherwise(expr)
    return expr


def weekly_features(df: DataFrame, group_cols: Sequence[str] = ("county_fips", "year"),
                    cutoff_date=None, with_max_pct: bool = False,
                    checkpoint_label: str | None = None) -> DataFrame:
    """A4 (+A18): per entity-year counts of weeks with D_i > 0, D2+ weeks,
    max and mean dominant severity.  Empty input gives an empty frame with
    the full schema (a DataFrame always carries its schema)."""
    d = df
    if "year" not in d.columns:
        d = d.withColumn("year", F.year("date").cast("int"))
    for c in CATEGORIES:
        if c not in d.columns:
            d = d.withColumn(c, F.lit(0.0))
        d = d.withColumn(c, F.coalesce(F.col(c).cast("double"), F.lit(0.0)))
    cond = in_season("date")
    if cutoff_date is not None:
        cond = cond & on_or_before("date", cutoff_date)
    d = d.filter(cond).dropna(subset=list(group_cols))
    d2p = F.col("D2") + F.col("D3") + F.col("D4")
    dom = dominant_severity()
    aggs = [F.count_if(F.col(c) > 0).alias(f"weeks_{c.lower()}") for c in CATEGORIES]
    aggs += [F.count_if(d2p > 0).alias("weeks_d2_plus"),
             F.max(dom).alias("max_drought_category"),
             F.avg(dom).alias("mean_drought_severity")]
    if with_max_pct:
        aggs += [F.max(c).alias(f"{c.lower()}_max_pct") for c in CATEGORIES]
        aggs += [F.max(d2p).alias("d2_plus_max_pct")]
    label = checkpoint_label or (str(cutoff_date) if cutoff_date is not None else "full_season")
    return d.groupBy(*group_cols).agg(*aggs).withColumn("checkpoint", F.lit(label))


def weekly_features_by_checkpoint(df: DataFrame, checkpoints: Sequence[str] | None = None,
                                  group_cols: Sequence[str] = ("county_fips", "year")) -> DataFrame:
    """Leak-free option (N11): drought features per checkpoint cutoff, using
    the same generator fan-out as the daily checkpoint table."""
    from pitpanel.operators.season import fan_out_checkpoints
    d = df if "year" in df.columns else df.withColumn("year", F.year("date").cast("int"))
    for c in CATEGORIES:
        d = d.withColumn(c, F.coalesce(F.col(c).cast("double"), F.lit(0.0))) if c in d.columns \
            else d.withColumn(c, F.lit(0.0))
    d = fan_out_checkpoints(d.filter(in_season("date")).dropna(subset=list(group_cols)), checkpoints)
    d2p = F.col("D2") + F.col("D3") + F.col("D4")
    dom = dominant_severity()
    aggs = [F.count_if(F.col(c) > 0).alias(f"weeks_{c.lower()}") for c in CATEGORIES]
    aggs += [F.count_if(d2p > 0).alias("weeks_d2_plus"), F.max(dom).alias("max_drought_category"),
             F.avg(dom).alias("mean_drought_severity")]
    return d.groupBy(*group_cols, "checkpoint").agg(*aggs)
