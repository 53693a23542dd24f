"""C10, W2, W3, W13, T1-T4, A7, W11, W4-W8 on the reference's yield series."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from pitpanel.operators import lags as LG
from pitpanel.operators import targets as T

SERIES_19001 = [170, 175, 168, 180, 172, 177, 165, 183]
SERIES_17001 = [165, 160, 170, 155, 168, 162, 173, 158]


def _yields(spark, with_second=True):
    rows = [(2015 + i, "IOWA", "19001", "CORN", float(v)) for i, v in enumerate(SERIES_19001)]
    if with_second:
        rows += [(2015 + i, "ILLINOIS", "17001", "CORN", float(v)) for i, v in enumerate(SERIES_17001)]
    return spark.createDataFrame(rows, "year int, state string, county_fips string, crop string, value double")


def test_rolling_expected_matches_shifted_rolling(spark):
    t = T.build_targets(_yields(spark), window=5, min_periods=3).orderBy("county_fips", "year").toPandas()
    for c, s in (("19001", SERIES_19001), ("17001", SERIES_17001)):
        exp = pd.Series(s, dtype=float).shift(1).rolling(5, min_periods=3).mean()
        got = t[t.county_fips == c].expected_yield.reset_index(drop=True)
        np.testing.assert_allclose(got.astype(float), exp, equal_nan=True)


def test_anomaly_identities(spark):
    t = T.build_targets(_yields(spark)).toPandas().dropna(subset=["expected_yield"])
    np.testing.assert_allclose(t.yield_anomaly, t.actual_yield - t.expected_yield)
    np.testing.assert_allclose(t.yield_anomaly_pct, (t.yield_anomaly / t.expected_yield) * 100.0)


def test_pct_null_when_expected_zero(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, None)], "actual_yield double, expected_yield double")
    assert [r["yield_anomaly_pct"] for r in T.add_anomaly(df).collect()] == [None, None]


def test_trend_matches_polyfit(spark):
    t = T.build_targets(_yields(spark, False), method="trend", min_years=5).orderBy("year").toPandas()
    ys = np.array(SERIES_19001, dtype=float)
    yrs = np.arange(2015, 2023, dtype=float)
    for i in range(len(ys)):
        got = t.expected_yield.iloc[i]
        if i < 5:
            assert pd.isna(got)
        else:
            coef = np.polyfit(yrs[:i], ys[:i], 1)
            assert got == pytest.approx(float(np.polyval(coef, yrs[i])), rel=1e-9)


def test_unknown_method(spark):
    with pytest.raises(ValueError):
        T.build_targets(_yields(spark), method="median")


def test_leakage_future_mutation(spark):
    """Mutating years >= 2020 leaves every earlier expectation unchanged."""
    base = T.build_targets(_yields(spark))
    mutated_in = _yields(spark).withColumn("value", F.when(F.col("year") >= 2020, 9999.0).otherwise(F.col("value")))
    mut = T.build_targets(mutated_in)
    a = base.filter("year <= 2020").select("county_fips", "year", "expected_yield").orderBy("county_fips", "year").collect()
    b = mut.filter("year <= 2020").select("county_fips", "year", "expected_yield").orderBy("county_fips", "year").collect()
    assert a == b


def test_thresholds_from_train_only(spark):
    t = T.build_targets(_yields(spark), window=3, min_periods=2)
    train = t.filter("year < 2021")
    test = t.filter("year >= 2021")
    thr = {r["county_fips"]: r["risk_threshold"] for r in T.risk_thresholds(train).collect()}
    pdt = train.toPandas()
    for c, g in pdt.groupby("county_fips"):
        assert thr[c] == pytest.approx(g.yield_anomaly_pct.quantile(0.2))
    # changing test values never moves the thresholds
    test_mut = test.withColumn("yield_anomaly_pct", F.lit(-1e9))
    tr2, te2 = T.assign_risk_labels(train, test_mut)
    assert te2.filter("severe_risk = 1").count() == te2.filter("yield_anomaly_pct IS NOT NULL").count()


def test_unseen_entity_gets_null_label(spark):
    train = spark.createDataFrame([("A", "1", "CORN", -5.0), ("A", "1", "CORN", 3.0)],
                                  "state string, county_fips string, crop string, yield_anomaly_pct double")
    test = spark.createDataFrame([("A", "1", "CORN", -10.0), ("B", "9", "CORN", -10.0), ("A", "1", "CORN", None)],
                                 "state string, county_fips string, crop string, yield_anomaly_pct double")
    _, lab = T.assign_risk_labels(train, test)
    got = [(r["county_fips"], r["yield_anomaly_pct"], r["severe_risk"]) for r in lab.collect()]
    assert ("9", -10.0, None) in got and ("1", -10.0, 1) in got and ("1", None, None) in got


def test_descriptive_label_uses_all_rows(spark):
    t = T.add_descriptive_risk(T.build_targets(_yields(spark), window=3, min_periods=2))
    assert t.filter("severe_risk_descriptive = 1").count() > 0


def test_lag_features(spark):
    df = spark.createDataFrame([("1", "CORN", 2015 + i, float(v), float(i)) for i, v in enumerate([10, 20, 30, 40])],
                               "county_fips string, crop string, year int, actual_yield double, yield_anomaly double")
    r = LG.add_lag_features(df).orderBy("year").toPandas()
    assert r.prior_year_yield.tolist()[1:] == [10.0, 20.0, 30.0]
    np.testing.assert_allclose(r.rolling_3yr_mean_yield.iloc[1:], [10.0, 15.0, 20.0])
    assert pd.isna(r.rolling_3yr_std_yield.iloc[1])            # one value: std needs 2
    assert r.rolling_3yr_std_yield.iloc[3] == pytest.approx(10.0)


def test_lag_table_unique_and_yield_lags(spark):
    rows = [("1", "CORN", 2015, 1.0, 0.0, "S"), ("1", "CORN", 2015, 2.0, 0.0, "S"), ("1", "CORN", 2016, 3.0, 1.0, "S")]
    df = spark.createDataFrame(rows, "county_fips string, crop string, year int, actual_yield double, yield_anomaly double, state string")
    lt = LG.lag_table(df)
    assert lt.count() == 2
    yl = LG.add_yield_lags(df.filter("actual_yield <> 2.0"), 2).orderBy("year").collect()
    assert yl[1]["yield_lag_1"] == 1.0 and yl[1]["yield_lag_2"] is None
