"""End-to-end batch jobs: the entry points a user of the reference runs.

* :func:`build_panel_job`  -- raw yields + daily + weekly -> targets, weather
  features, drought features, modeling panel (partitioned by year),
  missingness report and audit tables.
* :func:`baselines_job`   -- panel -> temporal split -> train-only labels ->
  baseline predictions -> grouped metrics.
* :func:`models_job`      -- panel -> split -> labels -> Spark ML models ->
  predictions, grouped metrics, importances, model-vs-baseline comparison.
* :func:`ablation_job`    -- crop modes x feature groups x models -> metrics,
  best-per-group and pivot tables.

Every job writes Parquet into ``out_dir`` (a shared folder on a cluster) and
returns the main DataFrame read back from it, so later jobs start from the
written stage rather than the lineage.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitpanel.operators import ablation as AB
from pitpanel.operators import baselines as B
from pitpanel.operators import features as FS
from pitpanel.operators import metrics as M
from pitpanel.operators import ml as ML
from pitpanel.operators import panel as P
from pitpanel.operators import season as S
from pitpanel.operators import splits as SP
from pitpanel.operators import targets as T
from pitpanel.operators import weekly as WK
from pitpanel.sources.sinks import write_table


def _save(spark: SparkSession, df: DataFrame, out_dir: str, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
    path = f"{out_dir.rstrip('/')}/{name}"
    write_table(df, path, partition_by=partition_by)
    return spark.read.parquet(path)


def build_panel_job(spark: SparkSession, yields: DataFrame, daily: DataFrame, out_dir: str,
                    weekly: DataFrame | None = None, checkpoints: Sequence[str] | None = None,
                    group_cols: Sequence[str] = ("county_fips", "year"), current_year: int | None = None,
                    allow_partial: bool = False, method: str = "rolling") -> DataFrame:
    """Entry 1: features and the modeling panel."""
    targets = _save(spark, T.build_targets(yields, method=method), out_dir, "yield_targets")
    weather = S.add_weather_anomalies(S.checkpoint_weather(daily, checkpoints, group_cols))
    if current_year is not None:
        weather = S.drop_incomplete_current_year(weather, current_year, allow_partial)
    weather = _save(spark, weather, out_dir, "weather_features")
    drought = None
    if weekly is not None:
        drought = _save(spark, WK.weekly_features(WK.clean_weekly(weekly)).drop("checkpoint"), out_dir,
                        "drought_features")
    full = P.build_panel(targets, weather, drought, drop_missing_target=False)
    full = _save(spark, full, out_dir, "panel_all", ["year"])
    _save(spark, P.missingness_report(full), out_dir, "missingness_report")
    panel = _save(spark, full.filter(F.col(P.TARGET_COLUMN).isNotNull()), out_dir, "modeling_panel", ["year"])
    _save(spark, P.panel_audit(panel).select(
        "row_count", "n_counties", "n_states", "duplicate_rows",
        *[F.array_join(F.col(c).cast("array<string>"), ",").alias(c) for c in ("states", "crops", "years",
                                                                               "checkpoints")]),
        out_dir, "panel_audit")
    for by in ("crop", "checkpoint"):
        _save(spark, P.panel_summary_by(panel, by), out_dir, f"target_by_{by}")
    return panel


def labelled(panel: DataFrame, n_test_years: int = 3):
    p = panel.filter(F.col("checkpoint").isNotNull() & F.col("yield_anomaly").isNotNull())
    train, test = SP.temporal_split(p, n_test_years)
    SP.assert_no_year_overlap(train, test)
    return T.assign_risk_labels(train, test)


def baselines_job(spark: SparkSession, panel: DataFrame, out_dir: str, n_test_years: int = 3) -> DataFrame:
    """Entry 3 (baselines): predictions and grouped metrics (baseline layout)."""
    train, test = labelled(panel, n_test_years)
    train, test = train.persist(), test.persist()
    reg = _save(spark, B.regression_predictions(train, test), out_dir, "baseline_regression_predictions")
    cls = _save(spark, B.classification_predictions(train, test), out_dir, "baseline_classification_predictions")
    m = M.grouped_metrics(reg, "regression", crop_checkpoint=False).unionByName(
        M.grouped_metrics(cls, "classification", crop_checkpoint=False), allowMissingColumns=True)
    return _save(spark, m, out_dir, "baseline_metrics")


def models_job(spark: SparkSession, panel: DataFrame, out_dir: str, n_test_years: int = 3,
               include_county: bool = False, include_year_index: bool = False,
               n_trees: int = ML.N_TREES) -> DataFrame:
    """Entry 2: Spark ML models -> predictions, metrics, importances, comparison."""
    train, test = labelled(panel, n_test_years)
    train, test = train.persist(), test.persist()
    numeric, categorical = FS.select_feature_columns(panel, include_county, include_year_index)
    preds, models = ML.train_and_predict(train, test, numeric, categorical, n_trees=n_trees, return_models=True)
    preds = _save(spark, preds, out_dir, "ml_predictions")
    m = M.grouped_metrics(preds.filter("task = 'regression'"), "regression").unionByName(
        M.grouped_metrics(preds.filter("task = 'classification'"), "classification"), allowMissingColumns=True)
    m = _save(spark, m, out_dir, "ml_metrics")
    if "random_forest_reg" in models:
        _save(spark, ML.feature_importance(models["random_forest_reg"], train), out_dir, "feature_importance")
    _save(spark, AB.checkpoint_trend(m), out_dir, "checkpoint_trend")
    base = B.regression_predictions(train, test)
    overall = m.filter((F.col("task") == "regression") & (F.col("group") == "overall"))
    _save(spark, M.compare_best(overall, M.regression_metrics(base, ["model"])), out_dir, "model_vs_baseline")
    return m


def ablation_job(spark: SparkSession, panel: DataFrame, out_dir: str, modes: dict[str, str | None],
                 n_test_years: int = 3, n_trees: int = ML.N_TREES, groups: Sequence[str] | None = None) -> DataFrame:
    """Entry 3 (ablation): metrics long table + best-per-group + pivot."""
    m = _save(spark, AB.run_ablation(panel, modes, n_test_years, n_trees, groups), out_dir, "ablation_metrics")
    best = AB.best_per_group(m, "regression").unionByName(AB.best_per_group(m, "classification"),
                                                          allowMissingColumns=True)
    _save(spark, best, out_dir, "ablation_best")
    _save(spark, AB.ablation_pivot(m, "regression"), out_dir, "ablation_rmse_pivot")
    return m
