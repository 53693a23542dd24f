"""A10-A12, A16, A17, A19, A20, O3, J11 against closed forms / brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from pitpanel.functions.prefix import global_prefix_sums
from pitpanel.operators import metrics as M


def test_regression_metrics(spark):
    y, p = [3.0, -0.5, 2.0, 7.0], [2.5, 0.0, 2.0, 8.0]
    df = spark.createDataFrame(list(zip(y, p)), "y_true double, y_pred double")
    r = M.regression_metrics(df).first()
    e = np.array(y) - np.array(p)
    assert r["rmse"] == pytest.approx(np.sqrt(np.mean(e ** 2)))
    assert r["mae"] == pytest.approx(np.mean(np.abs(e)))
    assert r["r2"] == pytest.approx(1 - np.sum(e ** 2) / np.sum((np.array(y) - np.mean(y)) ** 2))


def test_r2_constant_truth(spark):
    df = spark.createDataFrame([(1.0, 1.0), (1.0, 1.0)], "y_true double, y_pred double")
    assert M.regression_metrics(df).first()["r2"] == 1.0
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 1.0)], "y_true double, y_pred double")
    assert M.regression_metrics(df).first()["r2"] == 0.0


def test_classification_zero_division(spark):
    df = spark.createDataFrame([(0, 0), (0, 0), (1, 0)], "y_true int, y_pred int")
    r = M.classification_metrics(df).first()
    assert (r["precision"], r["recall"], r["f1"], r["tn"], r["fn"]) == (0.0, 0.0, 0.0, 2, 1)
    assert r["accuracy"] == pytest.approx(2 / 3)


def test_grouped_metrics_rules(spark):
    rows = [("m", 1, 1, "CORN", "may_31", 2020), ("m", 0, 1, "CORN", "may_31", 2020), ("m", 1, 1, "SOY", "may_31", 2021),
            ("m", 1, 0, "SOY", None, 2021)]
    df = spark.createDataFrame(rows, "model string, y_true int, y_pred int, crop string, checkpoint string, year int")
    g = {(r["group"], r["group_value"]) for r in M.grouped_metrics(df, "classification").collect()}
    # SOY is single-class (skipped), NULL checkpoint skipped, overall kept
    assert ("overall", "all") in g and ("crop", "CORN") in g and ("crop", "SOY") not in g
    assert ("checkpoint", "may_31") in g and ("crop_checkpoint", "CORN/may_31") in g
    greg = {(r["group"], r["group_value"]) for r in M.grouped_metrics(
        df.withColumn("y_true", F.col("y_true").cast("double")).withColumn("y_pred", F.col("y_pred").cast("double")),
        "regression").collect()}
    assert ("crop", "SOY") in greg and ("year", "2021") in greg


def test_prefix_sums(spark):
    df = spark.range(0, 1000).select((F.col("id") % 97).alias("k"), F.lit(1).alias("c")) \
        .groupBy("k").agg(F.sum("c").alias("c"))
    got = {r["k"]: r["c_cum"] for r in global_prefix_sums(df, ["k"], ["c"], 4).collect()}
    counts = np.bincount(np.arange(1000) % 97)
    assert all(got[k] == counts[:k + 1].sum() for k in range(97))


def test_prefix_sums_of_few_rows_take_few_tasks(spark, monkeypatch):
    from pitpanel.functions import prefix
    df = spark.range(0, 1000).select((F.col("id") % 97).alias("k"), F.lit(1).alias("c")) \
        .groupBy("k").agg(F.sum("c").alias("c"))
    parts, cut = [], prefix.cut_lineage
    monkeypatch.setattr(prefix, "cut_lineage", lambda df: parts.append(cut(df)) or parts[0])
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        got = {r["k"]: r["c_cum"] for r in global_prefix_sums(df, ["k"], ["c"]).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    counts = np.bincount(np.arange(1000) % 97)
    assert all(got[k] == counts[:k + 1].sum() for k in range(97))
    assert parts[0].rdd.getNumPartitions() <= 4


def test_exact_quantiles_match_numpy(spark):
    rng = np.random.default_rng(3)
    rows = [("a" if i % 3 else "b", float(v)) for i, v in enumerate(rng.integers(0, 20, 301))]
    df = spark.createDataFrame(rows, "g string, residual double")
    got = {r["g"]: r for r in M.residual_box_stats(df, ["g"], num_partitions=5).collect()}
    for g in ("a", "b"):
        vals = np.array([v for k, v in rows if k == g])
        for name, q in (("q0", 0), ("q1", .25), ("median", .5), ("q3", .75), ("q100", 1)):
            assert got[g][name] == pytest.approx(np.quantile(vals, q))


def test_auroc_matches_rank_formula(spark):
    rng = np.random.default_rng(5)
    y = rng.integers(0, 2, 400)
    s = np.round(rng.normal(size=400) + y, 1)      # ties on purpose
    df = spark.createDataFrame([("m", int(a), float(b)) for a, b in zip(y, s)], "model string, y_true int, y_score double")
    got = M.auroc(df, num_partitions=3).first()["auroc"]
    pos, neg = s[y == 1], s[y == 0]
    exp = np.mean([(p > neg).mean() + 0.5 * (p == neg).mean() for p in pos])
    assert got == pytest.approx(exp)


def test_worst_and_compare(spark):
    df = spark.createDataFrame([("a", 1.0, 5.0), ("b", 2.0, 2.5), ("c", 0.0, -3.0)], "model string, y_true double, y_pred double")
    w = M.worst_predictions(M.add_residuals(df), 2, tiebreak=["model"]).collect()
    assert [r["model"] for r in w] == ["a", "c"]
    m = M.regression_metrics(df, ["model"])
    c = M.compare_best(m.filter("model <> 'a'"), m.filter("model = 'a'")).first()
    assert c["best_model"] == "b" and c["model_beats_baseline"]


def test_correlations(spark):
    df = spark.createDataFrame([(1.0, 2.0, 5.0), (2.0, 4.0, 3.0), (3.0, 6.5, 1.0)], "a double, b double, c double")
    got = {(r["feature_a"], r["feature_b"]): r["corr"] for r in M.correlation_long(df, ["a", "b", "c"]).collect()}
    assert got[("a", "c")] == pytest.approx(-1.0) and len(got) == 3


def test_auroc_and_quantiles_do_not_depend_on_exchange_reuse(spark):
    """Many distinct scores, many groups, one hot group, reuse switched off."""
    import numpy as np
    from pyspark.sql import functions as F
    from pitpanel.operators.metrics import auroc, exact_quantiles
    df = spark.range(120_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), (F.col("id") % 50).cast("string"))).alias("model"),
        (F.pmod(F.xxhash64("id"), F.lit(10_000_019)) / 7).alias("y_score"),
        F.when(F.pmod(F.xxhash64("id", F.lit(5)), F.lit(10)) < 3, 1).otherwise(0).alias("y_true"))
    pdf = df.toPandas()
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        got = {r.model: r.auroc for r in auroc(df, num_partitions=16).collect()}
        med = {r.model: r.m for r in exact_quantiles(df, ["model"], "y_score", {"m": 0.5}, 16).collect()}
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")
    for model, g in pdf.groupby("model"):
        rank, pos = g.y_score.rank(), g.y_true == 1
        want = (rank[pos].sum() - pos.sum() * (pos.sum() + 1) / 2) / (pos.sum() * (~pos).sum())
        assert abs(got[model] - want) < 1e-9
        assert abs(med[model] - np.median(g.y_score)) < 1e-6
