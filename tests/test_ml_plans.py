"""M1-M16 plumbing and physical-plan assertions."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from pitpanel.operators import features as FS
from pitpanel.operators import ml as ML
from pitpanel.operators import season as S
from tests.conftest import DAILY_SCHEMA, daily_rows


def _ml_panel(spark, n=160, seed=1):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        y = 2015 + i % 8
        rows.append((y, "IOWA" if i % 2 else "OHIO", f"1900{i % 4}", "x", ["CORN", "SOY"][i % 2],
                     ["may_31", "full_season"][(i // 2) % 2], float(rng.normal(150, 10)),
                     None if i % 7 == 0 else float(rng.normal(500, 50)), float(rng.normal(20, 2)), bool(i % 3),
                     float(rng.normal()), int(i % 3 == 0), float(rng.normal())))
    return spark.createDataFrame(rows, "year int, state string, county_fips string, county string, crop string, "
                                       "checkpoint string, expected_yield double, cumulative_precip double, "
                                       "mean_temp double, is_partial_year boolean, yield_anomaly double, "
                                       "severe_risk int, yield_anomaly_pct double")


def test_feature_selection_excludes_leakage(spark):
    p = _ml_panel(spark).withColumn("year_index", F.col("year") - 2015)
    num, cat = FS.select_feature_columns(p)
    assert set(num) == {"expected_yield", "cumulative_precip", "mean_temp"}
    assert cat == ["crop", "checkpoint", "state"]
    num2, cat2 = FS.select_feature_columns(p, include_county=True, include_year_index=True)
    assert "year_index" in num2 and "county_fips" in cat2
    with pytest.raises(ValueError):
        FS.assert_no_leakage(["yield_anomaly"], [])


def test_feature_groups(spark):
    p = _ml_panel(spark)
    assert FS.available_groups(p) == ["baseline_features", "weather_raw", "all_features"]
    assert FS.feature_set(p, "weather_raw") == (["expected_yield", "cumulative_precip", "mean_temp"], ["crop", "checkpoint", "state"])
    with pytest.raises(ValueError):
        FS.feature_set(p, "nope")


def test_preprocessing_train_only_stats(spark):
    p = _ml_panel(spark)
    train = p.filter("year < 2021")
    sqlt, kept, cats = ML.fit_preprocessing(train, ["cumulative_precip", "mean_temp"], ["crop"])
    pdf = train.toPandas()
    med = float(np.median(pdf.cumulative_precip.dropna()))
    assert f"'{med!r}'" in sqlt.getStatement()
    imp = pdf.cumulative_precip.fillna(med)
    z = sqlt.transform(train).select("__n_cumulative_precip").toPandas().iloc[:, 0]
    np.testing.assert_allclose(z, (imp - imp.mean()) / imp.std(ddof=0), rtol=1e-9)


def test_all_missing_column_dropped(spark):
    p = _ml_panel(spark).withColumn("empty", F.lit(None).cast("double"))
    _, kept, _ = ML.fit_preprocessing(p, ["empty", "mean_temp"], [])
    assert kept == ["mean_temp"]


def test_ridge_matches_closed_form(spark):
    p = _ml_panel(spark)
    model = ML.fit_model(p, "ridge", ["expected_yield", "mean_temp"], [], "yield_anomaly")
    pdf = p.toPandas()
    X = pdf[["expected_yield", "mean_temp"]].to_numpy()
    X = (X - X.mean(0)) / X.std(0)
    y = pdf.yield_anomaly.to_numpy()
    Xc, yc = X - X.mean(0), y - y.mean()
    w = np.linalg.solve(Xc.T @ Xc + 1.0 * np.eye(2), Xc.T @ yc)
    b = y.mean() - X.mean(0) @ w
    pred = model.transform(p).select("y_pred").toPandas().y_pred.to_numpy()
    np.testing.assert_allclose(pred, X @ w + b, rtol=1e-6, atol=1e-8)


def test_unseen_category_and_predictions(spark):
    p = _ml_panel(spark)
    train, test = p.filter("year < 2021"), p.filter("year >= 2021").withColumn("crop", F.lit("WHEAT"))
    preds = ML.train_and_predict(train, test, ["expected_yield", "mean_temp"], ["crop", "checkpoint"],
                                 reg_models=["ridge"], clf_models=["logistic_regression"], n_trees=5)
    assert preds.count() == 2 * test.count()
    cls = preds.filter("task = 'classification'").toPandas()
    assert cls.y_proba.between(0, 1).all() and set(cls.y_pred) <= {0, 1}


def test_tree_models_save_load_and_importance(spark, tmp_path):
    p = _ml_panel(spark)
    m = ML.fit_model(p, "random_forest_reg", ["expected_yield", "mean_temp"], ["crop"], "yield_anomaly", n_trees=5)
    imp = ML.feature_importance(m, p).collect()
    assert abs(sum(r["importance"] for r in imp) - 1.0) < 1e-9
    path = str(tmp_path / "rf")
    ML.save_model(m, path)
    scored = ML.score_panel(path, p, "random_forest_reg", "regression", "yield_anomaly")
    assert scored.count() == p.count()
    with pytest.raises(FileNotFoundError):
        ML.load_model(str(tmp_path / "missing"))


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_checkpoint_table_plan_is_python_free_and_scans_once(spark):
    d = spark.createDataFrame(daily_rows(), DAILY_SCHEMA)
    path = "/tmp/" + __import__("uuid").uuid4().hex
    d.write.parquet(path)
    src = spark.read.parquet(path)
    plan = _plan(S.checkpoint_weather(src))
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert plan.count("FileScan") == 1
    # daily rows: run-length windows + fan-out + aggregate share ONE exchange on (entity, period);
    # the only other exchange is the prior-years window over the small aggregated table
    assert plan.count("Exchange hashpartitioning") == 2
    assert plan.count("Exchange hashpartitioning(county_fips#") == 2
    stress_plan = _plan(S.stress_features(src))
    assert stress_plan.count("Exchange hashpartitioning") == 1


def test_entry_contract():
    import __spark_entry__ as E
    qs, sqls = E.queries(), E.oracle_sql()
    assert set(sqls) <= set(qs)
    assert set(qs) >= set(E.catalog.REGISTRY)


def test_models_are_fitted_together_without_udfs_of_the_jvm(spark):
    """All five models on repeated, unseen and null keys; trees have no depth limit."""
    p = _ml_panel(spark)
    train = p.filter("year < 2021").unionByName(p.filter("year < 2016"))
    test = p.filter("year >= 2021").withColumn("state", F.when(F.col("state") == "IOWA", "TEXAS")) \
        .withColumn("severe_risk", F.when(F.col("crop") == "CORN", F.col("severe_risk")))
    preds, models = ML.train_and_predict(train, test, ["expected_yield", "cumulative_precip", "mean_temp"],
                                         ["crop", "checkpoint", "state"], n_trees=4, return_models=True)
    assert "UDF" not in _plan(preds)
    got = {(r["model"], r["task"]): r["n"] for r in preds.groupBy("model", "task").agg(F.count("y_pred").alias("n")).collect()}
    labelled = test.filter("severe_risk IS NOT NULL").count()
    assert got == {(m, "regression"): test.count() for m in ML.REGRESSION_MODELS} \
        | {(m, "classification"): labelled for m in ML.CLASSIFICATION_MODELS}
    forest = models["random_forest_reg"].fitted
    assert len(forest["trees"]) == 4 and forest["spec"].max_depth is None
    imp = ML.feature_importance(models["random_forest_reg"], train).collect()
    assert abs(sum(r["importance"] for r in imp) - 1.0) < 1e-9
    assert {"crop_CORN", "state___unknown", "mean_temp"} <= {r["feature"] for r in imp}
    with pytest.raises(ValueError):
        ML.feature_importance(models["ridge"], train)
    with pytest.raises(ValueError):
        ML.train_and_predict(train, test, ["mean_temp"], [], reg_models=["nope"])
