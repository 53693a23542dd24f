"""Feature-group ablation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pitpanel.functions.season import CHECKPOINTS
from pitpanel.operators import metrics as M
from pitpanel.operators.features import available_groups, feature_set
from pitpanel.operators.linear import design_columns, design_rows, gram_matrices, logistic_models, ridge
from pitpanel.operators.ml import LOGISTIC_C, N_TREES, RANDOM_STATE, RIDGE_ALPHA
from pitpanel.operators.scoring import score_rows
from pitpanel.operators.targets import TARGET_KEYS, apply_thresholds, risk_thresholds
from pitpanel.operators.trees import Spec, fit_trees
from pitpanel.session import cut_lineage

ABLATION_REG_MODELS = ["ridge", "hist_gradient_boosting_reg"]
ABLATION_CLF_MODELS = ["logistic_regression", "random_forest_clf"]


def crop_mode(panel: DataFrame, crop: str | None, crop_col: str = "crop") -> DataFrame:
    """the rows of one crop, or the pooled panel."""
    return panel if crop is None else panel.filter(F.col(crop_col) == crop)


def crop_modes(panel: DataFrame, crop_col: str = "crop") -> dict[str, str | None]:
    """The pooled mode and one mode for each crop of the panel."""
    crops = sorted(r[0] for r in panel.select(crop_col).where(F.col(crop_col).isNotNull()).distinct().collect())
    return {"pooled": None} | {f"{c.lower()}_only": c for c in crops}


def mode_split(panel: DataFrame, modes: dict[str, str | None], n_test_years: int,
               classification_target: str = "severe_risk") -> DataFrame:
    """The labelled temporal split of every mode as one table: ``_mode`` (place
    in ``modes``), ``split`` and the label learnt on the mode's training rows."""
    member = F.array(*[F.when(F.lit(True) if crop is None else F.col("crop") == crop, F.lit(k))
                       for k, crop in enumerate(modes.values())])
    rows = panel.where(F.col("year").isNotNull()).withColumn("_mode", F.explode(F.filter(member, lambda m: m.isNotNull())))
    years = {r["_mode"]: sorted(r["years"], reverse=True)
             for r in rows.groupBy("_mode").agg(F.collect_set("year").alias("years")).collect()}  # years: a handful
    for k, mode in enumerate(modes):
        if len(years.get(k, [])) <= n_test_years:
            raise ValueError(f"mode {mode!r}: {n_test_years} test years leave no training year")
    cutoff = F.create_map(*[F.lit(int(x)) for k, ys in years.items() for x in (k, ys[n_test_years - 1])])
    rows = rows.withColumn("split", F.when(F.col("year") < cutoff[F.col("_mode")], "train").otherwise("test"))
    keys = (*TARGET_KEYS, "_mode")
    return apply_thresholds(rows, risk_thresholds(rows.where("split = 'train'"), keys=keys), keys,
                            label_col=classification_target)


def run_ablation(panel: DataFrame, modes: dict[str, str | None], n_test_years: int = 3,
                 n_trees: int = N_TREES, groups: Sequence[str] | None = None,
                 regression_target: str = "yield_anomaly", classification_target: str = "severe_risk",
                 rounds: int = 100) -> DataFrame:
    """Modes x available feature groups x models -> grouped metrics
    tagged with (mode, feature_group).

    All models are fitted together: the rows of each (mode, task) are one data
    set of a common design table, ridge solves parts of one Gram matrix per
    data set, the logistic models share their Newton passes, and the trees of
    all groups grow side by side.  All predictions come from one pass over the
    test rows and are scored by one grouped aggregate."""
    spark = panel.sparkSession
    groups = list(groups) if groups else available_groups(panel)
    meta = [c for c in ("year", "state", "county_fips", "crop", "checkpoint") if c in panel.columns]
    numeric = list(dict.fromkeys(c for g in groups for c in feature_set(panel, g)[0]))
    categorical = list(dict.fromkeys(c for g in groups for c in feature_set(panel, g)[1]))
    split = cut_lineage(mode_split(panel, modes, n_test_years, classification_target))
    sets = F.filter(F.array(F.when(F.col(regression_target).isNotNull(), 2 * F.col("_mode")),
                            F.when(F.col(classification_target).isNotNull(), 2 * F.col("_mode") + 1)), lambda s: s.isNotNull())
    tagged = split.withColumn("_set", F.explode(sets)) \
        .withColumn("_y", F.when(F.col("_set") % 2 == 0, F.col(regression_target)).otherwise(F.col(classification_target)).cast("double"))
    sizes = {(r["split"], r["_set"], r["_y"]): r["n"] for r in tagged.groupBy("split", "_set", F.when(
        F.col("_set") % 2 == 1, F.col("_y")).alias("_y")).agg(F.count("*").alias("n")).collect()}
    balance, usable = [], set()
    for m in range(len(modes)):
        classes = {y: n for (part, s, y), n in sizes.items() if part == "train" and s == 2 * m + 1}
        if len(classes) >= 2 and any(part == "test" and s == 2 * m + 1 for part, s, _ in sizes):
            usable.add(2 * m + 1)
            balance += [F.when((F.col("_set") == 2 * m + 1) & (F.col("_y") == y), sum(classes.values()) / (len(classes) * n))
                        for y, n in classes.items()]
        usable.add(2 * m)
    train = tagged.where("split = 'train'").where(F.col("_set").isin(sorted(usable))) \
        .withColumn("_w", F.coalesce(*balance, F.lit(1.0))) \
        .withColumn("_row", F.pmod(F.xxhash64(*meta), F.lit(2**31 - 1)))
    columns = design_columns(train, "_set", numeric, categorical)
    rows = cut_lineage(design_rows(train, "_set", columns, "_y", weight="_w", key="_row")).persist()
    picks = {(s, g): tuple(k for k, c in enumerate(columns[s]) if c.feature in set(sum(feature_set(panel, g), [])))
             for s in columns for g in groups}
    names = {0: ABLATION_REG_MODELS, 1: ABLATION_CLF_MODELS}
    grams = gram_matrices(rows)
    linear = {f"{s}/{g}/{names[0][0]}": ridge(grams[s], at, RIDGE_ALPHA) for (s, g), at in picks.items() if s % 2 == 0 and s in grams}
    linear |= logistic_models(rows, {f"{s}/{g}/{names[1][0]}": (s, at) for (s, g), at in picks.items() if s % 2 == 1}, LOGISTIC_C)
    specs = [Spec(f"{s}/{g}/{names[0][1]}", s, "boosting", at, trees=rounds, seed=RANDOM_STATE) if s % 2 == 0 else
             Spec(f"{s}/{g}/{names[1][1]}", s, "forest", at, trees=n_trees, max_leaves=None, min_leaf=1,
                  draw=max(1, int(len(at) ** 0.5)), classes=True, seed=RANDOM_STATE) for (s, g), at in picks.items() if at]
    trees = fit_trees(rows, specs)
    rows.unpersist()
    test = design_rows(tagged.where("split = 'test'").where(F.col("_set").isin(sorted(set(columns) & usable))),
                       "_set", columns, "_y", keep=meta)
    at_of = {f"{s}/{g}": at for (s, g), at in picks.items()}
    scored = score_rows(test, meta, linear, trees, at_of)
    place = F.split("key", "/")
    number = place[0].cast("int")
    out = scored.select(*meta, F.array(*[F.lit(m) for m in modes])[F.floor(number / 2).cast("int")].alias("mode"),
                        place[1].alias("feature_group"), place[2].alias("model"),
                        F.when(number % 2 == 0, "regression").otherwise("classification").alias("task"),
                        "y_true", "y_pred", "y_proba")
    out = cut_lineage(out)
    keys = ("mode", "feature_group", "model")
    reg = M.grouped_metrics(out.filter(F.col("task") == "regression"), "regression",
                            crop_checkpoint=False, model_cols=keys)
    cls = M.grouped_metrics(out.filter(F.col("task") == "classification"), "classification",
                            crop_checkpoint=False, model_cols=keys)
    return reg.unionByName(cls, allowMissingColumns=True)


def best_per_group(metrics: DataFrame, task: str = "regression") -> DataFrame:
    """Lowest RMSE / highest F1 per (mode, feature_group), overall rows."""
    m = metrics.filter((F.col("task") == task) & (F.col("group") == "overall"))
    order = F.col("rmse").asc_nulls_last() if task == "regression" else F.col("f1").desc_nulls_last()
    w = Window.partitionBy("mode", "feature_group").orderBy(order, F.col("model"))
    return m.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def ablation_pivot(metrics: DataFrame, task: str = "regression") -> DataFrame:
    """feature_group x mode table of min RMSE / max F1."""
    m = metrics.filter((F.col("task") == task) & (F.col("group") == "overall"))
    modes = sorted(r[0] for r in m.select("mode").distinct().collect())
    agg = F.min("rmse") if task == "regression" else F.max("f1")
    return m.groupBy("feature_group").pivot("mode", modes).agg(agg)


def checkpoint_trend(metrics: DataFrame, order: Sequence[str] = tuple(CHECKPOINTS)) -> DataFrame:
    """RMSE at the first vs the last checkpoint (in calendar order) per model."""
    idx = F.create_map(*[x for i, c in enumerate(order) for x in (F.lit(c), F.lit(i))])
    m = metrics.filter((F.col("task") == "regression") & (F.col("group") == "checkpoint")) \
        .withColumn("_o", idx[F.col("group_value")]).filter(F.col("_o").isNotNull())
    return m.groupBy("model").agg(
        F.min_by("group_value", "_o").alias("first_checkpoint"), F.min_by("rmse", "_o").alias("first_rmse"),
        F.max_by("group_value", "_o").alias("last_checkpoint"), F.max_by("rmse", "_o").alias("last_rmse"),
    ).withColumn("rmse_change", F.col("last_rmse") - F.col("first_rmse"))
