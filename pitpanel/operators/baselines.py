"""Lookup baselines.

Each baseline is fitted on the training split and applied to another split
with joins only: group statistics are aggregates of the training rows, the
fallback chain is a sequence of left joins resolved by key-presence flags
(N15: a key whose training targets are all missing still "exists" and
yields NULL, it does not fall through), and the single global statistic is
one scalar.  Lookup tables grow with the number of entities, so no
broadcast is forced; AQE broadcasts them at run time when they are small.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitpanel.functions.windows import prior_range

# Baseline names and default keys.
ENTITY_KEYS = ["county_fips", "crop"]
CROP_CHECKPOINT_KEYS = ["crop", "checkpoint"]
REGRESSION_BASELINES = ["zero_anomaly", "previous_year_anomaly", "county_historical_mean",
                        "crop_checkpoint_mean"]
CLASSIFICATION_BASELINES = ["majority_class", "historical_county_risk"]
RISK_RATE_THRESHOLD = 0.5


def zero_anomaly(test: DataFrame, out_col: str = "y_pred") -> DataFrame:
    """B1."""
    return test.withColumn(out_col, F.lit(0.0))


def previous_year(train: DataFrame, test: DataFrame, target: str = "yield_anomaly",
                  keys: Sequence[str] = ENTITY_KEYS, year_col: str = "year",
                  out_col: str = "y_pred") -> DataFrame:
    """Latest earlier-year target of the same entity.

    History = training rows with a target plus *every* test row (N10: test
    rows of earlier years enter the history with their true target, as in
    one-step-ahead scoring).  One range-framed window over history + test:
    ``max_by`` over ``year < t``; no prior row -> 0; a prior row whose target
    is NULL -> NULL.
    """
    keys = list(keys)
    hist = train.filter(F.col(target).isNotNull()).select(*keys, year_col, target) \
        .withColumn("_is_test", F.lit(False))
    both = test.withColumn("_is_test", F.lit(True)).unionByName(hist, allowMissingColumns=True)
    w = prior_range(keys, year_col)
    order_key = F.struct(F.col(year_col), F.col(target))
    n_prior = F.count(F.lit(1)).over(w)
    prev = F.max_by(F.col(target), order_key).over(w)
    scored = both.withColumn(out_col, F.when(n_prior == 0, F.lit(0.0)).otherwise(prev).cast("double"))
    return scored.filter(F.col("_is_test")).drop("_is_test")


def global_stat(df: DataFrame, col: str, how: str = "avg") -> float | None:
    """One scalar statistic of the training split (a single value to the driver)."""
    agg = F.avg(col) if how == "avg" else F.max(col)
    return df.agg(agg.alias("v")).first()["v"]


def fallback_lookup(train: DataFrame, test: DataFrame, levels: Sequence[Sequence[str]],
                    target: str = "yield_anomaly", out_col: str = "y_pred",
                    default: float | None = None, drop_null_target: bool = False) -> DataFrame:
    """Mean target looked up at each key level in turn, then a global
    default.  Level presence is a flag, so an all-NULL group still wins."""
    base = train.filter(F.col(target).isNotNull()) if drop_null_target else train
    out = test
    flags, vals = [], []
    for i, keys in enumerate(levels):
        keys = list(keys)
        stats = base.dropna(subset=keys).groupBy(*keys).agg(
            F.avg(target).alias(f"_v{i}"), F.lit(True).alias(f"_p{i}"))
        out = out.join(stats, keys, "left")
        flags.append(F.coalesce(F.col(f"_p{i}"), F.lit(False)))
        vals.append(F.col(f"_v{i}"))
    expr = F.lit(default).cast("double")
    for flag, val in reversed(list(zip(flags, vals))):
        expr = F.when(flag, val).otherwise(expr)
    out = out.withColumn(out_col, expr.cast("double"))
    return out.drop(*[f"_v{i}" for i in range(len(levels))], *[f"_p{i}" for i in range(len(levels))])


def truthy_global(value: float | None) -> float:
    """``global if global else 0.0`` (NaN is truthy; missing and 0 give 0)."""
    if value is None:
        return 0.0
    return value if value != 0 else 0.0


def county_historical_mean(train: DataFrame, test: DataFrame, target: str = "yield_anomaly",
                           keys: Sequence[str] = ENTITY_KEYS, crop_col: str = "crop",
                           out_col: str = "y_pred") -> DataFrame:
    """Entity mean -> crop mean -> global mean (or 0)."""
    g = truthy_global(global_stat(train, target))
    return fallback_lookup(train, test, [list(keys), [crop_col]], target, out_col, g)


def crop_checkpoint_mean(train: DataFrame, test: DataFrame, target: str = "yield_anomaly",
                         out_col: str = "y_pred") -> DataFrame:
    """(crop, checkpoint) mean -> crop mean -> global."""
    if "checkpoint" not in train.columns:
        raise KeyError("crop_checkpoint_mean requires a 'checkpoint' column")
    g = truthy_global(global_stat(train, target))
    return fallback_lookup(train, test, [CROP_CHECKPOINT_KEYS, ["crop"]], target, out_col, g)


def entity_mean(train: DataFrame, test: DataFrame, target: str = "yield_anomaly",
                key: str = "county_fips", out_col: str = "y_pred") -> DataFrame:
    """Single-key mean with global fallback."""
    g = truthy_global(global_stat(train, target))
    return fallback_lookup(train, test, [[key]], target, out_col, g)


def majority_label(train: DataFrame, label: str = "severe_risk") -> int:
    """Most frequent label, smallest on ties, 0 when there is none."""
    row = (train.filter(F.col(label).isNotNull()).groupBy(label).count()
           .orderBy(F.col("count").desc(), F.col(label).asc()).first())
    return int(row[label]) if row is not None else 0


def majority_class(train: DataFrame, test: DataFrame, label: str = "severe_risk",
                   out_col: str = "y_pred") -> DataFrame:
    """B5."""
    return test.withColumn(out_col, F.lit(majority_label(train, label)).cast("int"))


def historical_county_rate(train: DataFrame, test: DataFrame, label: str = "severe_risk",
                           keys: Sequence[str] = ENTITY_KEYS, out_col: str = "y_score") -> DataFrame:
    """Label rate of the entity -> crop -> global (a risk score)."""
    valid = train.filter(F.col(label).isNotNull()).withColumn(label, F.col(label).cast("double"))
    g = global_stat(valid, label)
    g = 0.0 if g is None else g
    return fallback_lookup(valid, test, [list(keys), ["crop"]], label, out_col, g)


def historical_county_risk(train: DataFrame, test: DataFrame, label: str = "severe_risk",
                           threshold: float = RISK_RATE_THRESHOLD, keys: Sequence[str] = ENTITY_KEYS,
                           out_col: str = "y_pred", keep_score: bool = False) -> DataFrame:
    """``historical rate >= threshold``."""
    rated = historical_county_rate(train, test, label, keys, "y_score")
    out = rated.withColumn(out_col, F.coalesce((F.col("y_score") >= threshold).cast("int"), F.lit(0)))
    return out if keep_score else out.drop("y_score")


def group_means(df: DataFrame, target: str = "yield_anomaly") -> DataFrame:
    """A8 in one pass: county-crop, crop, crop-checkpoint and global means as
    one GROUPING SETS aggregate (one Expand + one hash aggregate)."""
    g = df.groupingSets([["county_fips", "crop"], ["crop"], ["crop", "checkpoint"], []],
                        "county_fips", "crop", "checkpoint")
    out = g.agg(F.avg(target).alias("mean_target"), F.count(target).alias("n"),
                F.grouping_id().alias("_gid"))
    level = (F.when(F.col("_gid") == 1, "county_crop").when(F.col("_gid") == 5, "crop")
             .when(F.col("_gid") == 4, "crop_checkpoint").otherwise("global"))
    return out.withColumn("level", level).drop("_gid")


def regression_predictions(train: DataFrame, test: DataFrame, target: str = "yield_anomaly",
                           meta: Sequence[str] = ("year", "state", "county_fips", "crop", "checkpoint")) -> DataFrame:
    """B7 (regression half): every regression baseline as long predictions."""
    meta = list(meta)
    outs = {
        "zero_anomaly": zero_anomaly(test),
        "previous_year_anomaly": previous_year(train, test, target),
        "county_historical_mean": county_historical_mean(train, test, target),
        "crop_checkpoint_mean": crop_checkpoint_mean(train, test, target),
    }
    frames = [d.select(*meta, F.lit(n).alias("model"), F.lit("regression").alias("task"),
                       F.col(target).cast("double").alias("y_true"), F.col("y_pred").cast("double"))
              for n, d in outs.items()]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def classification_predictions(train: DataFrame, test: DataFrame, label: str = "severe_risk",
                               meta: Sequence[str] = ("year", "state", "county_fips", "crop", "checkpoint")) -> DataFrame:
    """B7 (classification half) on test rows with a label."""
    meta = list(meta)
    test_c = test.filter(F.col(label).isNotNull())
    outs = {"majority_class": majority_class(train, test_c, label),
            "historical_county_risk": historical_county_risk(train, test_c, label)}
    frames = [d.select(*meta, F.lit(n).alias("model"), F.lit("classification").alias("task"),
                       F.col(label).cast("int").alias("y_true"), F.col("y_pred").cast("int"))
              for n, d in outs.items()]
    return frames[0].unionByName(frames[1])
