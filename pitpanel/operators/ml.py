"""Models on the panel.

``train_and_predict`` fits all models at once with the batched learners of
``linear`` and ``trees``; single models that are saved and loaded are Spark ML.

Preprocessing is fitted on the training split only, with the package's own
aggregates so that it matches the reference exactly where it matters:
exact interpolated medians (distributed ranks, not a one-task buffer),
population standard deviation, smallest-on-ties most frequent category,
all-missing numeric columns dropped.  The fitted statistics are written
into a ``SQLTransformer`` statement, so preprocessing + estimator form one
``PipelineModel`` that saves, loads and scores as a unit.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pitpanel.operators import linear as LN
from pitpanel.operators import trees as TR
from pitpanel.operators.features import assert_no_leakage
from pitpanel.operators.metrics import exact_quantiles
from pitpanel.operators.scoring import score_rows
from pitpanel.session import cut_lineage

# Model names and hyper-parameters of the reference models.
RANDOM_STATE = 42
REGRESSION_MODELS = ["ridge", "random_forest_reg", "hist_gradient_boosting_reg"]
CLASSIFICATION_MODELS = ["logistic_regression", "random_forest_clf"]
RIDGE_ALPHA = 1.0
LOGISTIC_C = 1.0
N_TREES = 300
BOOST_ROUNDS = 100
#: The slot of categories that no training row has.
_UNKNOWN = "__unknown"


def _lit_double(v: float) -> str:
    return f"CAST('{float(v)!r}' AS DOUBLE)"


def _lit_str(v: str) -> str:
    return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"


def _q(c: str) -> str:
    return f"`{c}`"


@dataclass
class PrepStats:
    """Train-only statistics: per-column medians, (mean, scale) of the imputed
    column, most frequent category, training row count and class counts."""
    medians: dict[str, float]
    mean_std: dict[str, tuple[float, float]]
    modes: dict[str, str]
    n_rows: int
    class_counts: dict | None = None


def preprocessing_stats(train: DataFrame, numeric: Sequence[str], categorical: Sequence[str],
                        label: str | None = None) -> PrepStats:
    """M5 statistics in a handful of jobs for all columns at once.  Every
    statistic is per column, so one computation serves any feature subset."""
    numeric, categorical = list(numeric), list(categorical)
    med: dict[str, float] = {}
    if numeric:
        long = train.select(F.explode(F.array(*[
            F.struct(F.lit(c).alias("feature"), F.col(_q(c)).cast("double").alias("value")) for c in numeric]))
            .alias("s")).select("s.*")
        for r in exact_quantiles(long, ["feature"], "value", {"median": 0.5}).collect():
            if r["median"] is not None:
                med[r["feature"]] = float(r["median"])
    kept = [c for c in numeric if c in med]          # sklearn drops all-missing columns (N8)
    imp = {c: F.coalesce(F.col(_q(c)).cast("double"), F.lit(med[c])) for c in kept}
    row = train.agg(F.count(F.lit(1)).alias("n"),
                    *[F.avg(imp[c]).alias(f"m{i}") for i, c in enumerate(kept)],
                    *[F.stddev_pop(imp[c]).alias(f"s{i}") for i, c in enumerate(kept)]).first()
    mean_std = {}
    for i, c in enumerate(kept):
        sd = row[f"s{i}"]
        mean_std[c] = (row[f"m{i}"] or 0.0, sd if sd and sd > 1e-12 else 1.0)
    modes: dict[str, str] = {}
    if categorical:
        long_c = train.select(F.explode(F.array(*[
            F.struct(F.lit(c).alias("feature"), F.col(_q(c)).cast("string").alias("value")) for c in categorical]))
            .alias("s")).select("s.*").filter(F.col("value").isNotNull())
        counts = long_c.groupBy("feature", "value").count()
        w = Window.partitionBy("feature").orderBy(F.col("count").desc(), F.col("value").asc())
        for r in counts.withColumn("rn", F.row_number().over(w)).filter("rn = 1").collect():
            modes[r["feature"]] = r["value"]
    cc = None
    if label is not None:
        cc = {r[label]: r["count"] for r in train.groupBy(label).count().collect() if r[label] is not None}
    return PrepStats(med, mean_std, modes, int(row["n"]), cc)


def preprocessing_transformer(stats: PrepStats, numeric: Sequence[str], categorical: Sequence[str]):
    """The fitted statistics as one SQLTransformer -> (stage, kept numeric, categorical)."""
    kept = [c for c in numeric if c in stats.medians]
    exprs = ["*"]
    for c in kept:
        m, sd = stats.mean_std[c]
        exprs.append(f"(coalesce(CAST({_q(c)} AS DOUBLE), {_lit_double(stats.medians[c])}) - {_lit_double(m)}) "
                     f"/ {_lit_double(sd)} AS {_q('__n_' + c)}")
    for c in categorical:
        fill = _lit_str(stats.modes[c]) if c in stats.modes else "NULL"
        exprs.append(f"coalesce(CAST({_q(c)} AS STRING), {fill}) AS {_q('__c_' + c)}")
    sqlt = SQLTransformer(statement="SELECT " + ", ".join(exprs) + " FROM __THIS__")
    return sqlt, kept, list(categorical)


def fit_preprocessing(train: DataFrame, numeric: Sequence[str], categorical: Sequence[str]):
    """M5: train-only statistics -> (SQLTransformer, kept numeric, categorical)."""
    return preprocessing_transformer(preprocessing_stats(train, numeric, categorical), numeric, categorical)


def _feature_stages(sqlt, kept, categorical):
    stages = [sqlt]
    ohe_out = []
    if categorical:
        stages += [StringIndexer(inputCol=f"__c_{c}", outputCol=f"__i_{c}", handleInvalid="keep",
                                 stringOrderType="alphabetAsc") for c in categorical]
        ohe_out = [f"__o_{c}" for c in categorical]
        stages.append(OneHotEncoder(inputCols=[f"__i_{c}" for c in categorical], outputCols=ohe_out,
                                    dropLast=True, handleInvalid="keep"))
    stages.append(VectorAssembler(inputCols=[f"__n_{c}" for c in kept] + ohe_out, outputCol="features",
                                  handleInvalid="keep"))
    return stages


def make_estimator(name: str, train: DataFrame, label: str, n_trees: int = N_TREES, n_rows: int | None = None):
    """M6-M10 with parameters mapped onto the reference objectives."""
    if name == "ridge":
        row = train.agg(F.count(label).alias("n"), F.stddev_pop(label).alias("sd")).first()
        n, sd = row["n"] or 1, row["sd"] or 1.0
        # sklearn Ridge: SSE + alpha*|w|^2  <=>  Spark (1/2n) SSE + (lambda/2)|w|^2 on a
        # label-standardised normal-equation solve: lambda = alpha * sd_y / n.
        return LinearRegression(featuresCol="features", labelCol=label, predictionCol="y_pred",
                                regParam=RIDGE_ALPHA * sd / n, elasticNetParam=0.0, standardization=False,
                                solver="normal")
    if name == "random_forest_reg":
        return RandomForestRegressor(featuresCol="features", labelCol=label, predictionCol="y_pred",
                                     numTrees=n_trees, featureSubsetStrategy="all", maxDepth=FOREST_DEPTH, maxBins=FOREST_BINS,
                                     maxMemoryInMB=1024, cacheNodeIds=True, seed=RANDOM_STATE)
    if name == "hist_gradient_boosting_reg":
        return GBTRegressor(featuresCol="features", labelCol=label, predictionCol="y_pred", maxIter=100,
                            stepSize=0.1, maxDepth=5, maxBins=255, minInstancesPerNode=20, seed=RANDOM_STATE)
    if name == "logistic_regression":
        n = n_rows if n_rows is not None else train.count()
        # sklearn C * sum(w_i loss_i) + |w|^2/2 with balanced weights (sum w = n)
        #   <=>  Spark mean_w loss + (lambda/2)|w|^2 with lambda = 1 / (C * sum w).
        return LogisticRegression(featuresCol="features", labelCol=label, predictionCol="y_pred",
                                  probabilityCol="prob", weightCol="__w", regParam=1.0 / (LOGISTIC_C * max(n, 1)),
                                  standardization=False, maxIter=1000, family="binomial")
    if name == "random_forest_clf":
        return RandomForestClassifier(featuresCol="features", labelCol=label, predictionCol="y_pred",
                                      probabilityCol="prob", weightCol="__w", numTrees=n_trees,
                                      featureSubsetStrategy="sqrt", maxDepth=FOREST_DEPTH, maxBins=FOREST_BINS,
                                      maxMemoryInMB=1024,
                                      cacheNodeIds=True, seed=RANDOM_STATE)
    raise ValueError(f"Unknown model {name!r}")


def add_balanced_weights(df: DataFrame, label: str, counts: dict | None = None) -> DataFrame:
    """``n / (n_classes * n_c)`` per row, from class counts (a tiny aggregate)."""
    if counts is None:
        counts = {r[label]: r["count"] for r in df.groupBy(label).count().collect() if r[label] is not None}
    n, k = sum(counts.values()), max(len(counts), 1)
    m = F.create_map(*[x for c, v in counts.items() for x in (F.lit(c), F.lit(n / (k * v)))])
    return df.withColumn("__w", m[F.col(label)])


#: The deepest trees that Spark grows, and the split candidates of a feature.
FOREST_DEPTH = 30
FOREST_BINS = 255

PANEL_KEYS = ("county_fips", "crop", "year", "checkpoint")


def spread_by_key(df: DataFrame) -> DataFrame:
    """Training rows over the session's configured partitions by a hash of the
    panel keys (of all columns, where there is none): what a fit sees depends
    on data, seed and configuration, never on a row count."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [c for c in PANEL_KEYS if c in df.columns] or df.columns
    return df.repartition(n, *keys)


def fit_model(train: DataFrame, name: str, numeric: Sequence[str], categorical: Sequence[str], label: str,
              n_trees: int = N_TREES, stats: PrepStats | None = None, sized: bool = False) -> PipelineModel:
    """One model: preprocessing fitted on ``train`` + estimator, as a PipelineModel.
    ``stats`` (computed on exactly these training rows) may be shared by many fits."""
    assert_no_leakage(list(numeric), list(categorical))
    tr = train.filter(F.col(label).isNotNull())
    if stats is None:
        stats = preprocessing_stats(tr, numeric, categorical,
                                    label if name in CLASSIFICATION_MODELS else None)
    sqlt, kept, cats = preprocessing_transformer(stats, numeric, categorical)
    if not sized:
        tr = spread_by_key(tr)
    tr = tr.withColumn(label, F.col(label).cast("double"))
    if name in CLASSIFICATION_MODELS:
        counts = {float(k): v for k, v in (stats.class_counts or {}).items()} or None
        tr = add_balanced_weights(tr, label, counts)
    est = make_estimator(name, tr, label, n_trees, stats.n_rows)
    return Pipeline(stages=[*_feature_stages(sqlt, kept, cats), est]).fit(tr)


def predict(model: PipelineModel, df: DataFrame, meta: Sequence[str], label: str, name: str, task: str) -> DataFrame:
    out = model.transform(df)
    proba = vector_to_array(F.col("prob"))[1] if task == "classification" else F.lit(None).cast("double")
    y_pred = F.col("y_pred").cast("int" if task == "classification" else "double")
    y_true = F.col(label).cast("int" if task == "classification" else "double")
    return out.select(*meta, F.lit(name).alias("model"), F.lit(task).alias("task"), y_true.alias("y_true"),
                      y_pred.alias("y_pred"), proba.alias("y_proba"))


@dataclass
class BatchedModel:
    """A model of :func:`train_and_predict`: its design columns, and weights
    (intercept first) or trees."""
    name: str
    columns: list
    fitted: np.ndarray | dict


def _tree_spec(name: str, key: str, rows: int, n_features: int, n_trees: int) -> TR.Spec:
    at = tuple(range(n_features))
    if name == "hist_gradient_boosting_reg":
        return TR.Spec(key, rows, "boosting", at, trees=BOOST_ROUNDS, seed=RANDOM_STATE)
    classes = name == "random_forest_clf"
    return TR.Spec(key, rows, "forest", at, trees=n_trees, max_leaves=None, min_leaf=1,
                   draw=max(1, int(n_features ** 0.5)) if classes else None, classes=classes, seed=RANDOM_STATE)


def train_and_predict(train: DataFrame, test: DataFrame, numeric: Sequence[str], categorical: Sequence[str],
                      regression_target: str = "yield_anomaly", classification_target: str = "severe_risk",
                      meta: Sequence[str] = ("year", "state", "county_fips", "crop", "checkpoint"),
                      reg_models: Sequence[str] = REGRESSION_MODELS,
                      clf_models: Sequence[str] = CLASSIFICATION_MODELS, n_trees: int = N_TREES,
                      return_models: bool = False):
    """Every model fitted on train, scored on test -> long predictions.

    The labelled rows of each task are one data set of a common design table.
    Ridge is a solve on its Gram matrix, logistic regression takes Newton steps
    in one pass each, and the trees of all models grow side by side; scoring
    deals the models over passes of bounded size."""
    assert_no_leakage(list(numeric), list(categorical))
    for name in (*reg_models, *clf_models):
        if name not in (*REGRESSION_MODELS, *CLASSIFICATION_MODELS):
            raise ValueError(f"Unknown model {name!r}")
    meta = [c for c in meta if c in test.columns]
    labels, names = (regression_target, classification_target), {0: list(reg_models)}
    counts: dict = {}
    if classification_target in train.columns and clf_models:
        counts = {float(r[0]): r[1] for r in train.where(F.col(classification_target).isNotNull())
                  .groupBy(classification_target).count().collect()}
        if len(counts) >= 2 and test.where(F.col(classification_target).isNotNull()).limit(1).count():
            names[1] = list(clf_models)
    names = {s: found for s, found in names.items() if found}

    def tagged(df: DataFrame) -> DataFrame:
        return reduce(DataFrame.unionByName, [
            df.where(F.col(labels[s]).isNotNull()).withColumn("_y", F.col(labels[s]).cast("double")).withColumn("_set", F.lit(s))
            for s in names])

    n_rows = sum(counts.values())
    balance = [F.when((F.col("_set") == 1) & (F.col("_y") == y), n_rows / (len(counts) * n)) for y, n in counts.items()]
    # few columns in the hash: the optimiser restates it for every set of their later names
    fit_on = cut_lineage(tagged(train).withColumn("_w", F.coalesce(*balance, F.lit(1.0)))
                         .withColumn("_row", F.pmod(F.xxhash64(*[c for c in meta if c in train.columns], "_y"), F.lit(2**31 - 1))))
    columns = LN.design_columns(fit_on, "_set", numeric, categorical)
    missing = [labels[s] for s in names if s not in columns]
    if missing:
        raise ValueError(f"no training rows with {', '.join(missing)}")
    rows = cut_lineage(LN.design_rows(fit_on, "_set", columns, "_y", weight="_w", key="_row")).persist()
    keys = {f"{s}/all/{name}": (s, name) for s in names for name in names[s]}
    at_of = {f"{s}/all": tuple(range(len(columns[s]))) for s in names}
    logistic = {k: (s, at_of[f"{s}/all"]) for k, (s, name) in keys.items() if name == "logistic_regression"}
    fitted = LN.logistic_models(rows, logistic, LOGISTIC_C) if logistic else {}
    if "ridge" in names.get(0, ()):
        fitted["0/all/ridge"] = LN.ridge(LN.gram_matrices(rows)[0], at_of["0/all"], RIDGE_ALPHA)
    trees = TR.fit_trees(rows, [_tree_spec(name, k, s, len(columns[s]), n_trees)
                                for k, (s, name) in keys.items() if k not in fitted])
    rows.unpersist()
    scored = score_rows(LN.design_rows(tagged(test), "_set", columns, "_y", keep=meta), meta, fitted, trees, at_of)
    place = F.split("key", "/")
    preds = scored.select(*meta, place[2].alias("model"),
                          F.when(place[0] == "0", "regression").otherwise("classification").alias("task"),
                          "y_true", "y_pred", "y_proba")
    if return_models:
        return preds, {name: BatchedModel(name, columns[s], fitted[k] if k in fitted else trees[k])
                       for k, (s, name) in keys.items()}
    return preds


def feature_importance(model: PipelineModel | BatchedModel, sample: DataFrame) -> DataFrame:
    """Tree-model importances with slot names, sorted descending."""
    if isinstance(model, BatchedModel):
        if not isinstance(model.fitted, dict):
            raise ValueError("model has no feature importances")
        share = TR.importances(model.fitted, len(model.columns)).tolist()
        rows = [(c.feature if c.value is None else f"{c.feature}_{c.value}", v) for c, v in zip(model.columns, share)]
        rows += [(f"{f}_{_UNKNOWN}", 0.0) for f in dict.fromkeys(c.feature for c in model.columns if c.value is not None)]
    else:
        est = model.stages[-1]
        if not hasattr(est, "featureImportances"):
            raise ValueError("model has no feature importances")
        schema = model.transform(sample.limit(1)).schema["features"]
        attrs = schema.metadata.get("ml_attr", {}).get("attrs", {})
        names = {a["idx"]: a["name"] for group in attrs.values() for a in group}
        imp = est.featureImportances.toArray().tolist()
        rows = [(names.get(i, f"f{i}").removeprefix("__n_").replace("__o_", ""), float(v)) for i, v in enumerate(imp)]
    spark = sample.sparkSession
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.col("importance").desc())


def save_model(model: PipelineModel, path: str) -> None:
    """S13."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    """Missing model -> FileNotFoundError."""
    try:
        return PipelineModel.load(path)
    except Exception as e:  # noqa: BLE001 - surface a clear error
        raise FileNotFoundError(f"No saved model at {path}") from e


def score_panel(model_path: str, panel: DataFrame, name: str, task: str, label: str,
                meta: Sequence[str] = ("year", "state", "county_fips", "crop", "checkpoint"),
                out_path: str | None = None) -> DataFrame:
    """Batch-score a panel with a saved model and optionally store it."""
    preds = predict(load_model(model_path), panel, [c for c in meta if c in panel.columns], label, name, task)
    if out_path:
        preds.write.mode("overwrite").parquet(out_path)
    return preds
