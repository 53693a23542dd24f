"""Batched ridge, logistic regression, boosting and forests."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from pitpanel.operators import ablation, linear, scoring, trees


def tree_rows(spark, n=400, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.integers(0, 12, (n, 5)).astype(np.uint16)
    y = x[:, 0] * 2.0 - x[:, 1] + rng.integers(0, 5, n)
    label = (y > np.median(y)).astype(float)
    row = rng.integers(0, 2**31 - 2, n)
    data = [(s, bytearray(x[i].tobytes()), float(y[i] if s == 0 else label[i]), 1.0 + (s == 1) * float(label[i]), int(row[i]))
            for i in range(n) for s in (0, 1)]
    return spark.createDataFrame(data, "rows int, bins binary, y double, w double, row long"), x, y, label


SPECS = [trees.Spec("boost", 0, "boosting", (0, 1, 2, 3, 4), trees=5),
         trees.Spec("small", 0, "boosting", (1, 2), trees=12, max_leaves=4),
         trees.Spec("forest", 0, "forest", (0, 1, 3), trees=3, max_leaves=None, min_leaf=5),
         trees.Spec("classes", 1, "forest", (0, 1, 2, 3), trees=3, max_leaves=None, min_leaf=1, max_depth=4, draw=2, classes=True)]


def test_local_and_distributed_trees_are_the_same(spark):
    rows, x, y, label = tree_rows(spark)
    near = trees.fit_trees(rows.repartition(3), SPECS)
    far = trees.fit_trees(rows.repartition(5), SPECS, local_bytes=0)
    for key in near:
        assert len(near[key]["trees"]) == len(far[key]["trees"]) == near[key]["spec"].trees
        assert (trees.predict_rows(near[key], x) == trees.predict_rows(far[key], x)).all()
    assert np.corrcoef(trees.predict_rows(near["forest"], x), y)[0, 1] > 0.9
    assert ((trees.predict_rows(near["classes"], x) > 0.5) == label).mean() > 0.85


def brute_split(x, g, h, min_leaf):
    best = (0.0, None, None)
    for f in range(x.shape[1]):
        for b in range(x[:, f].max()):
            low = x[:, f] <= b
            if min(low.sum(), (~low).sum()) < min_leaf:
                continue
            gain = g[low].sum() ** 2 / h[low].sum() + g[~low].sum() ** 2 / h[~low].sum() - g.sum() ** 2 / h.sum()
            if gain > best[0] + 1e-9:
                best = (gain, f, b)
    return best


def test_boosting_equals_brute_force():
    """Best-first growth to ``max_leaves``, each split the best of all cuts."""
    rng = np.random.default_rng(2)
    x = rng.integers(0, 9, (300, 3)).astype(np.uint16)
    y = rng.integers(0, 50, 300) + 3.0 * x[:, 0] - x[:, 1] * x[:, 2]
    spec = trees.Spec("b", 0, "boosting", (0, 1, 2), trees=2, max_leaves=6)
    base, scale = float(y.mean()), 2.0**30
    got = trees.fit_local(spec, range(2), x, y, np.ones(300), np.zeros(300, np.int64), base, scale, 9)
    margin = np.full(300, base)
    for tree in got:
        g, leaves = y - margin, [np.arange(300)]
        while len(leaves) < 6:
            found = [brute_split(x[at], g[at], np.ones(len(at)), 20) for at in leaves]
            k = max(range(len(leaves)), key=lambda i: found[i][0])
            if found[k][1] is None:
                break
            at, (_, f, b) = leaves.pop(k), found[k]
            leaves += [at[x[at, f] <= b], at[x[at, f] > b]]
        step = np.zeros(300)
        for at in leaves:
            step[at] = 0.1 * g[at].mean()
        margin = margin + step
        assert np.allclose(tree["value"][trees.leaves_of(tree, x)], step, atol=1e-6)


def test_a_node_passes_over_constant_features():
    """Features are drawn until one can split, as the draw demands."""
    x = np.zeros((40, 6), np.uint16)
    x[:, 5] = np.arange(40) % 2
    y = x[:, 5].astype(float)
    spec = trees.Spec("f", 0, "forest", tuple(range(6)), trees=4, max_leaves=None, min_leaf=1, draw=1, bootstrap=False, classes=True)
    for tree in trees.fit_local(spec, range(4), x, y, np.ones(40), np.arange(40), 0.0, 2.0**20, 2):
        assert tree["feature"][0] == 5 and set(tree["value"][trees.leaves_of(tree, x)]) == {0.0, 1.0}


def test_bootstrap_counts_are_poisson():
    n = trees.bootstrap_counts(np.random.default_rng(1).integers(0, 2**31 - 2, 100_000), 42, 7)
    assert abs(n.mean() - 1) < 0.02 and abs(n.var() - 1) < 0.03


def frame(spark, n=300):
    rng = np.random.default_rng(4)
    rows = []
    for i in range(n):
        a, b, c = rng.normal(5, 2), rng.normal(0, 1), rng.choice(["u", "v", "w"])
        y = 2 * a - b + (c == "u") + rng.normal()
        rows.append((0, None if i % 17 == 0 else float(a), float(b), None if i % 23 == 0 else str(c), float(y),
                     float(y + rng.normal() > 10), None))
    return spark.createDataFrame(rows, "s int, a double, b double, c string, y double, label double, nothing double")


def test_design_ridge_and_logistic(spark):
    df = frame(spark)
    columns = linear.design_columns(df, "s", ["a", "b", "nothing"], ["c"])
    assert [c.name for c in columns[0]] == ["a", "b", "c=u", "c=v", "c=w"]
    rows = linear.design_rows(df, "s", columns, "y", keep=["b"]).toPandas()
    pdf = df.toPandas()
    a = pdf["a"].fillna(pdf["a"].median())
    x = np.stack([np.frombuffer(v) for v in rows["x"]])
    at = np.argsort(rows["b"].to_numpy())
    want = ((a - a.mean()) / a.std(ddof=0)).to_numpy()[np.argsort(pdf["b"].to_numpy())]
    assert np.allclose(x[at, 0], want)
    assert (x[:, 2:].sum(1) == 1).all()
    design = linear.design_rows(df, "s", columns, "y")
    beta = linear.ridge(linear.gram_matrices(design)[0], range(5))
    xc, yc = x - x.mean(0), rows["y"].to_numpy() - rows["y"].mean()
    w = np.linalg.solve(xc.T @ xc + np.eye(5), xc.T @ yc)
    assert np.allclose(beta[1:], w) and np.isclose(beta[0], rows["y"].mean() - x.mean(0) @ w)
    labelled = linear.design_rows(df, "s", columns, "label")
    models = {"all": (0, (0, 1, 2, 3, 4)), "a": (0, (0,)), "nowhere": (9, (0,))}
    fitted = linear.logistic_models(labelled, models)
    slopes = linear.gradients(labelled, models, fitted, "logistic")
    assert np.abs(slopes["all"]).max() < 1e-5 and np.abs(slopes["a"]).max() < 1e-5 and "nowhere" not in slopes
    separated = df.withColumn("label", (F.col("a") > 5).cast("double")).where("a is not null")
    far = linear.logistic_models(linear.design_rows(separated, "s", columns, "label"), {"a": (0, (0,))})
    assert np.isfinite(far["a"]).all() and far["a"][1] > 1


def test_unseen_and_missing_categories(spark):
    df = frame(spark)
    columns = linear.design_columns(df, "s", ["a"], ["c"])
    new = spark.createDataFrame([(0, None, "other", 1.0), (0, 5.0, None, 1.0)], "s int, a double, c string, y double")
    x = sorted(tuple(np.frombuffer(r.x)[1:]) for r in linear.design_rows(new, "s", columns, "y").collect())
    assert x[0] == (0.0, 0.0, 0.0) and sum(x[1]) == 1.0


def test_edges_are_values_or_quantiles(spark):
    df = spark.range(5000).select(F.lit(0).alias("s"), F.col("id").cast("double").alias("many"), (F.col("id") % 7).alias("few"))
    few, many = (linear.design_columns(df, "s", [c], [])[0][0] for c in ("few", "many"))
    assert few.edges == (0.5, 1.5, 2.5, 3.5, 4.5, 5.5) and 240 <= len(many.edges) <= 255


def panel(spark):
    rng = np.random.default_rng(8)
    rows = []
    for fips in range(12):
        for crop in ("CORN", "SOY"):
            for year in range(2010, 2020):
                for checkpoint in ("july_1", "full_season"):
                    precip = float(rng.normal(300, 60))
                    y = (precip - 300) / 6 + rng.normal(0, 4) + (crop == "CORN")
                    rows.append((f"{fips:05d}", "IA" if fips % 2 else "IL", "c", crop, year, checkpoint, 150.0 + y, 150.0, y,
                                 y / 1.5, precip, float(rng.integers(0, 20))))
    return spark.createDataFrame(rows, "county_fips string, state string, county string, crop string, year int, checkpoint string, "
                                 "actual_yield double, expected_yield double, yield_anomaly double, yield_anomaly_pct double, "
                                 "cumulative_precip double, dry_days double")


def test_ablation_of_all_models(spark):
    p = panel(spark)
    modes = ablation.crop_modes(p)
    assert modes == {"pooled": None, "corn_only": "CORN", "soy_only": "SOY"}
    out = ablation.run_ablation(p, modes, n_test_years=2, n_trees=10, rounds=20).toPandas()
    overall = out[out["group"] == "overall"]
    assert len(overall) == 3 * 3 * 4  # modes x (baseline, weather_raw, all) x models
    n = overall[overall.task == "regression"].groupby("mode")["n"].first().to_dict()
    assert n == {"pooled": 96, "corn_only": 48, "soy_only": 48}
    rmse = overall[overall.task == "regression"].pivot_table(index="feature_group", columns=["mode", "model"], values="rmse")
    assert (rmse.loc["weather_raw"] < rmse.loc["baseline_features"]).all()
    best = overall[overall.task == "classification"].set_index(["mode", "feature_group", "model"])["accuracy"]
    assert best["pooled", "weather_raw", "logistic_regression"] > 0.8 and best["pooled", "weather_raw", "random_forest_clf"] > 0.75
    with pytest.raises(ValueError, match="no training year"):
        ablation.run_ablation(p, modes, n_test_years=10)


@pytest.mark.parametrize("rows", [2, 7, 40])
def test_sorted_rows_split_as_histograms_do(rows):
    rng = np.random.default_rng(rows)
    for _ in range(50):
        x = rng.integers(0, 6, (rows, 4)).astype(np.uint16)
        g, h, n = rng.integers(-50, 50, rows) * 1.0, rng.integers(1, 4, rows) * 1.0, np.ones(rows)
        for first_only in (False, True):
            features = [int(f) for f in rng.permutation(4)]
            want = trees.best_split(*trees.histograms(x, g, h, n, features, 6), features, 1, first_only)
            assert trees.best_sorted_split(x, g, h, n, features, 1, first_only) == want


def test_many_nodes_split_as_each_does():
    rng = np.random.default_rng(5)
    for classes in (False, True):
        x = rng.integers(0, 6, (300, 5)).astype(np.uint16)
        g, h, n = rng.integers(0 if classes else -50, 2 if classes else 50, 300) * 1.0, rng.integers(1, 4, 300) * 1.0, np.ones(300)
        rows = np.split(rng.permutation(300), np.sort(rng.choice(np.arange(1, 300), 60, replace=False)))
        features = np.array([rng.permutation(5)[:3] for _ in rows])
        got = trees.best_sorted_splits(x, g, h, n, rows, features, 2)
        for at, f, found in zip(rows, features.tolist(), got):
            assert found == trees.best_sorted_split(x[at], g[at], h[at], n[at], f, 2, False)


@pytest.mark.parametrize("spec", SPECS[2:])
def test_forests_search_many_nodes_at_once(spec, monkeypatch):
    rng = np.random.default_rng(6)
    x = rng.integers(0, 12, (400, 5)).astype(np.uint16)
    y = (x[:, 0] + rng.integers(0, 9, 400) > 9) * 1.0
    fit = lambda: trees.fit_local(spec, range(3), x, y, np.ones(400), np.arange(400), 0.0, 2.0**20, 64)
    calls, many = [], trees.best_sorted_splits
    monkeypatch.setattr(trees, "best_sorted_splits", lambda *a: calls.append(len(a[4])) or many(*a))
    got = fit()
    assert max(calls) > 3
    monkeypatch.setattr(trees, "FEW_ROWS", 0)  # every node on its own
    for a, b in zip(got, fit()):
        for k in a:
            np.testing.assert_array_equal(a[k], b[k])


def test_scoring_deals_models_over_bounded_passes(spark, monkeypatch):
    rows, x, y, label = tree_rows(spark, n=60)
    fitted = trees.fit_trees(rows, [trees.Spec("0/a/boost", 0, "boosting", (0, 1, 2), trees=6),
                                    trees.Spec("1/a/forest", 1, "forest", (0, 1), trees=5, max_leaves=None, min_leaf=1, classes=True)])
    test = rows.withColumn("x", F.lit(np.ones(5).tobytes())).withColumn("year", F.col("row"))
    linear_ = {"0/a/ridge": np.arange(6.0)}
    at_of = {"0/a": (0, 1, 2, 3, 4), "1/a": (0, 1, 2, 3, 4)}
    sent = []
    broadcast = spark.sparkContext.broadcast
    monkeypatch.setattr(type(spark.sparkContext), "broadcast", lambda self, value: sent.append(len(value)) or broadcast(value))
    got = {}
    for limit in (1 << 20, 2000, 1):
        sent.clear()
        out = scoring.score_rows(test, ["year"], linear_, fitted, at_of, limit).toPandas()
        got[limit] = out.sort_values(["key", "year"], ignore_index=True), list(sent)
        assert len(out) == 3 * 60 and out.y_proba.isna().sum() == 120
    whole, passes = got[1 << 20]
    assert len(passes) == 1 and len(got[1][1]) == 12  # one model or tree each
    assert max(got[1][1]) < max(got[2000][1]) < passes[0]
    for limit in (2000, 1):
        np.testing.assert_allclose(got[limit][0].y_pred, whole.y_pred, rtol=1e-12)
    np.testing.assert_allclose(whole[whole.key == "0/a/ridge"].y_pred, 15.0)


def test_each_unit_of_work_has_one_task(spark, monkeypatch):
    rows, *_ = tree_rows(spark, n=60)
    specs = [trees.Spec(f"f{k}", 0, "forest", (0, 1), trees=60, max_leaves=None, min_leaf=5) for k in range(2)] + SPECS[:1]
    sizes, whole = [], type(rows).mapInArrow

    def spy(self, func, schema, *args):
        if "done" in str(schema):
            sizes.extend(self.rdd.glom().map(len).collect())
        return whole(self, func, schema, *args)
    monkeypatch.setattr(type(rows), "mapInArrow", spy)
    got = trees.fit_trees(rows, specs)
    assert sizes == [1] * 7  # three blocks of trees for each forest, boosting whole
    assert [len(got[s.key]["trees"]) for s in specs] == [60, 60, 5]
