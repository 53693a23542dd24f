"""Evaluation metrics.

All metric aggregates are algebraic (counts, sums, central moments), so
Spark combines them map-side: a group holding a third of all predictions
(the ``overall`` group always holds all of them) costs one partial row per
task in the shuffle, never a single hot task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitpanel.functions.prefix import global_prefix_sums

# Default grouping columns of the grouped metric tables.
GROUP_COLS = ["crop", "checkpoint", "year"]
REGRESSION_METRICS = ["rmse", "mae", "r2"]
CLASSIFICATION_METRICS = ["accuracy", "precision", "recall", "f1", "tn", "fp", "fn", "tp"]


def regression_aggs(y: str = "y_true", p: str = "y_pred") -> list[Column]:
    """A10: RMSE, MAE, R^2 (constant truth: 1 if perfect else 0, as sklearn)."""
    e = F.col(y) - F.col(p)
    sse = F.sum(e * e)
    sst = F.count(F.col(y)) * F.var_pop(F.col(y))
    r2 = F.when(sst == 0, F.when(sse == 0, F.lit(1.0)).otherwise(F.lit(0.0))).otherwise(1 - sse / sst)
    return [F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(F.abs(e)).alias("mae"), r2.alias("r2")]


def classification_aggs(y: str = "y_true", p: str = "y_pred") -> list[Column]:
    """Confusion counts and rates, zero-division -> 0."""
    yt, yp = F.col(y), F.col(p)
    tp = F.count_if((yt == 1) & (yp == 1))
    fp = F.count_if((yt != 1) & (yp == 1))
    fn = F.count_if((yt == 1) & (yp != 1))
    tn = F.count_if((yt != 1) & (yp != 1))
    n = F.count(F.lit(1))

    def ratio(a, b):
        return F.when(b > 0, a / b).otherwise(F.lit(0.0))

    return [ratio(tp + tn, n).alias("accuracy"), ratio(tp, tp + fp).alias("precision"),
            ratio(tp, tp + fn).alias("recall"), ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
            tn.alias("tn"), fp.alias("fp"), fn.alias("fn"), tp.alias("tp")]


def regression_metrics(df: DataFrame, by: Sequence[str] = (), y: str = "y_true", p: str = "y_pred") -> DataFrame:
    return df.groupBy(*by).agg(*regression_aggs(y, p), F.count(F.lit(1)).alias("n"))


def classification_metrics(df: DataFrame, by: Sequence[str] = (), y: str = "y_true", p: str = "y_pred") -> DataFrame:
    return df.groupBy(*by).agg(*classification_aggs(y, p), F.count(F.lit(1)).alias("n"))


def grouping_entries(group_cols: Sequence[str], crop_checkpoint: bool) -> Column:
    """One (group, group_value) entry per grouping set a row belongs to."""
    items = [F.struct(F.lit("overall").alias("group"), F.lit("all").alias("group_value"))]
    for c in group_cols:
        items.append(F.struct(F.lit(c).alias("group"), F.col(c).cast("string").alias("group_value")))
    if crop_checkpoint:
        items.append(F.struct(F.lit("crop_checkpoint").alias("group"),
                              F.concat(F.col("crop"), F.lit("/"), F.col("checkpoint")).alias("group_value")))
    return F.array(*items)


def grouped_metrics(preds: DataFrame, task: str, group_cols: Sequence[str] = GROUP_COLS,
                    crop_checkpoint: bool = True, model_cols: Sequence[str] = ("model",),
                    y: str = "y_true", p: str = "y_pred", min_rows: int = 2) -> DataFrame:
    """Overall + per-column + crop x checkpoint metrics per model.

    Each prediction is emitted once per grouping set it belongs to (what a
    GROUPING SETS Expand does); groups with fewer than ``min_rows`` rows are
    skipped, classification also skips single-class groups; NULL group
    values are skipped.  The overall row is always kept."""
    gc = [c for c in group_cols if c in preds.columns]
    cc = crop_checkpoint and {"crop", "checkpoint"} <= set(preds.columns)
    g = preds.select(*model_cols, y, p, F.explode(grouping_entries(gc, cc)).alias("_g")) \
        .select(*model_cols, y, p, "_g.group", "_g.group_value").filter(F.col("group_value").isNotNull())
    aggs = regression_aggs(y, p) if task == "regression" else classification_aggs(y, p)
    out = g.groupBy(*model_cols, "group", "group_value").agg(
        *aggs, F.count(F.lit(1)).alias("n"), F.min(y).alias("_ymin"), F.max(y).alias("_ymax"))
    keep = (F.col("group") == "overall") | (F.col("n") >= min_rows)
    if task != "regression":
        keep = (F.col("group") == "overall") | ((F.col("n") >= min_rows) & (F.col("_ymin") != F.col("_ymax")))
    return out.filter(keep).drop("_ymin", "_ymax").withColumn("task", F.lit(task))


def add_residuals(df: DataFrame, actual: str = "y_true", pred: str = "y_pred") -> DataFrame:
    """C17."""
    return df.withColumn("residual", F.col(actual) - F.col(pred)) \
        .withColumn("abs_residual", F.abs(F.col("residual")))


def residual_summary(df: DataFrame, by, residual: str = "residual") -> DataFrame:
    """Mean, sample std, MAE and count of residuals per group."""
    r = F.col(residual)
    by = [by] if isinstance(by, str) else list(by)
    return df.groupBy(*by).agg(F.avg(r).alias("mean_residual"), F.stddev_samp(r).alias("std_residual"),
                              F.avg(F.abs(r)).alias("mae"), F.count(r).alias("count"))


def worst_predictions(df: DataFrame, n: int = 20, abs_col: str = "abs_residual",
                      tiebreak: Sequence[str] = ()) -> DataFrame:
    """O3: top-n by absolute residual (TakeOrderedAndProject: each task keeps
    its own top-n, only n rows per task reach the final merge)."""
    return df.orderBy(F.col(abs_col).desc_nulls_last(), *[F.col(c) for c in tiebreak]).limit(n)


def best_row(df: DataFrame, metric: str, ascending: bool = True, tiebreak: Sequence[str] = ("model",)) -> DataFrame:
    """Best model overall (sort + first)."""
    o = F.col(metric).asc_nulls_last() if ascending else F.col(metric).desc_nulls_last()
    return df.orderBy(o, *[F.col(c) for c in tiebreak]).limit(1)


def compare_best(models: DataFrame, baselines: DataFrame, metric: str = "rmse",
                 lower_is_better: bool = True) -> DataFrame:
    """Best model vs best baseline on one metric, with a "beats" flag.
    Both sides are single-row reductions, joined on a constant key."""
    a = best_row(models, metric, lower_is_better).select(
        F.lit(1).alias("_k"), F.col("model").alias("best_model"), F.col(metric).alias(f"model_{metric}"))
    b = best_row(baselines, metric, lower_is_better).select(
        F.lit(1).alias("_k"), F.col("model").alias("best_baseline"), F.col(metric).alias(f"baseline_{metric}"))
    beats = F.col(f"model_{metric}") < F.col(f"baseline_{metric}") if lower_is_better \
        else F.col(f"model_{metric}") > F.col(f"baseline_{metric}")
    return a.join(b, "_k").drop("_k").withColumn("model_beats_baseline", beats)


def exact_quantiles(df: DataFrame, by: Sequence[str], value: str,
                    qs: dict[str, float], num_partitions: int | None = None) -> DataFrame:
    """Exact linear-interpolated quantiles per group, distributed.

    Distinct (group, value) counts are ranked with range-partitioned prefix
    sums (a hot group is split across tasks, never buffered in one), then
    only the rows holding the two ranks around each quantile position
    survive to the final per-group aggregate.  One output column per name."""
    by = list(by)
    if not by:                      # one global group: a constant key, no cross join
        out = exact_quantiles(df.withColumn("_all", F.lit(1)), ["_all"], value, qs, num_partitions)
        return out.drop("_all")
    base = df.filter(F.col(value).isNotNull()).dropna(subset=by) \
        .groupBy(*by, value).agg(F.count(F.lit(1)).alias("_c"))
    ranked = global_prefix_sums(base, [*by, value], ["_c"], num_partitions)
    # a group's ranks start where its first value's do: no prefix over groups
    groups = ranked.groupBy(*by).agg(F.min(F.col("_c_cum") - F.col("_c")).alias("_start"), F.sum("_c").alias("_n"))
    r = ranked.join(groups, by).select(*by, value, (F.col("_c_cum") - F.col("_start") - F.col("_c")).alias("_lo"),
                                       (F.col("_c_cum") - F.col("_start")).alias("_hi"), "_n")
    items = []
    for name, q in qs.items():
        h = F.lit(float(q)) * (F.col("_n") - 1)
        items.append(F.struct(F.lit(name).alias("stat"), h.alias("h"),
                              F.floor(h).alias("i0"), F.ceil(h).alias("i1")))
    ex = r.select("*", F.explode(F.array(*items)).alias("_q"))
    hit0 = (F.col("_q.i0") >= F.col("_lo")) & (F.col("_q.i0") < F.col("_hi"))
    hit1 = (F.col("_q.i1") >= F.col("_lo")) & (F.col("_q.i1") < F.col("_hi"))
    part = ex.filter(hit0 | hit1).groupBy(*by, F.col("_q.stat").alias("stat")).agg(
        F.first("_q.h").alias("h"), F.first("_q.i0").alias("i0"),
        F.max(F.when(hit0, F.col(value))).alias("v0"), F.max(F.when(hit1, F.col(value))).alias("v1"))
    val = F.col("v0") + (F.col("h") - F.col("i0")) * (F.col("v1") - F.col("v0"))
    return part.groupBy(*by).pivot("stat", list(qs)).agg(F.first(val))


def residual_box_stats(df: DataFrame, by: Sequence[str], residual: str = "residual",
                       num_partitions: int | None = None) -> DataFrame:
    """Min / q1 / median / q3 / max of residuals per group (exact)."""
    qs = {"q0": 0.0, "q1": 0.25, "median": 0.5, "q3": 0.75, "q100": 1.0}
    return exact_quantiles(df, by, residual, qs, num_partitions)


def auroc(df: DataFrame, score: str = "y_score", label: str = "y_true", by: Sequence[str] = ("model",),
          num_partitions: int | None = None) -> DataFrame:
    """Exact AUROC (ties count one half) per group without a global sort
    in one task: counts per (group, score), range-partitioned prefix sums of
    negatives, then one aggregate."""
    by = list(by)
    if not by:                      # one global group: a constant key, no cross join
        return auroc(df.withColumn("_all", F.lit(1)), score, label, ["_all"], num_partitions).drop("_all")
    c = df.filter(F.col(score).isNotNull() & F.col(label).isNotNull()).groupBy(*by, score).agg(
        F.count_if(F.col(label) == 1).alias("_pos"), F.count_if(F.col(label) != 1).alias("_neg"))
    cum = global_prefix_sums(c, [*by, score], ["_neg"], num_partitions, inclusive=False)
    groups = cum.groupBy(*by).agg(F.min("_neg_cum").alias("_start"), F.sum("_neg").alias("_N"),
                                  F.sum("_pos").alias("_P"))
    j = cum.join(groups, by)
    below = F.col("_neg_cum") - F.col("_start")
    out = j.groupBy(*by).agg(
        F.try_divide(F.sum(F.col("_pos") * (below + 0.5 * F.col("_neg"))),
                     F.first("_P") * F.first("_N")).alias("auroc"),
        F.first("_P").alias("n_pos"), F.first("_N").alias("n_neg"))
    return out.withColumn("auroc", F.when((F.col("n_pos") > 0) & (F.col("n_neg") > 0), F.col("auroc")))


def correlation_long(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pairwise Pearson correlations, long form, over the rows where both
    values are present; null where fewer than two rows or a constant side leave
    it undefined.  One aggregate by pair, combined on the map side, whatever
    the number of columns."""
    cols = list(cols)
    names = F.array(*[F.lit(c) for c in cols])
    left = df.select(F.array(*[F.col(f"`{c}`").cast("double") for c in cols]).alias("v")) \
        .select("v", F.posexplode("v").alias("i", "x"))
    pairs = left.select("i", "x", F.expr("posexplode(slice(v, i + 2, size(v)))").alias("step", "y")) \
        .select("i", (F.col("i") + F.col("step") + 1).alias("j"),
                F.when(F.col("y").isNotNull(), F.col("x")).alias("x"),
                F.when(F.col("x").isNotNull(), F.col("y")).alias("y"))
    # covariance and deviations as separate aggregates: a constant side then divides nothing
    moments = pairs.groupBy("i", "j").agg(F.covar_pop("x", "y").alias("cov"), F.stddev_pop("x").alias("sx"),
                                          F.stddev_pop("y").alias("sy"), F.min("x").alias("lx"), F.max("x").alias("hx"),
                                          F.min("y").alias("ly"), F.max("y").alias("hy"))
    varied = (F.col("lx") < F.col("hx")) & (F.col("ly") < F.col("hy"))
    return moments.select(names[F.col("i")].alias("feature_a"), names[F.col("j")].alias("feature_b"),
                          F.when(varied, F.col("cov") / (F.col("sx") * F.col("sy"))).alias("corr"))


def explore(preds: DataFrame, crop: str | None = None, state: str | None = None,
            year: int | None = None) -> DataFrame:
    """F8: the explorer's crop x state x year filter over a predictions table."""
    cond = F.lit(True)
    for col, v in (("crop", crop), ("state", state), ("year", year)):
        if v is not None:
            cond = cond & (F.col(col) == v)
    return preds.filter(cond)


def head(df: DataFrame, n: int = 5, order: Sequence[str] = ()) -> DataFrame:
    """A deterministic peek (sorted, limited)."""
    return (df.orderBy(*order) if order else df).limit(n)
