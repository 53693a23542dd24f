"""T5-T8 splits and B1-B8 baselines (fallback chains, one-step history)."""

import pytest
from pyspark.sql import functions as F

from pitpanel.operators import baselines as B
from pitpanel.operators import splits as SP


def _panel(spark):
    rows = []
    for c in ("19001", "17001"):
        for y in range(2018, 2024):
            rows.append((y, "IOWA" if c == "19001" else "ILLINOIS", c, "CORN", "full_season", float(y - 2020),
                         float(y - 2020)))
    return spark.createDataFrame(rows, "year int, state string, county_fips string, crop string, checkpoint string, "
                                       "yield_anomaly double, yield_anomaly_pct double")


def test_temporal_split(spark):
    tr, te = SP.temporal_split(_panel(spark), 2)
    assert sorted({r[0] for r in te.select("year").collect()}) == [2022, 2023]
    assert tr.count() + te.count() == 12
    SP.assert_no_year_overlap(tr, te)
    with pytest.raises(ValueError):
        SP.temporal_split(_panel(spark), 6)


def test_overlap_detected(spark):
    p = _panel(spark)
    with pytest.raises(AssertionError):
        SP.assert_no_year_overlap(p, p.filter("year = 2020"))


def test_spatial_split(spark):
    tr, te = SP.spatial_split(_panel(spark), "IOWA")
    assert te.count() == 6 and tr.filter("state = 'IOWA'").count() == 0
    with pytest.raises(ValueError):
        SP.spatial_split(_panel(spark), "TEXAS")


def test_expanding_folds_grow(spark):
    f = SP.expanding_folds(_panel(spark), 3)
    sizes = {r["fold_year"]: r["count"] for r in f.filter("role = 'train'").groupBy("fold_year").count().collect()}
    assert sizes == {2021: 6, 2022: 8, 2023: 10}
    assert f.filter("role = 'test'").count() == 6


def test_sanity_check_duplicates(spark):
    p = _panel(spark).withColumn("actual_yield", F.lit(1.0)).withColumn("expected_yield", F.lit(1.0)) \
        .withColumn("county", F.lit("x"))
    SP.panel_sanity_check(p)
    with pytest.raises(ValueError):
        SP.panel_sanity_check(p.unionByName(p))


def test_previous_year_one_step(spark):
    tr, te = SP.temporal_split(_panel(spark), 2)
    r = {(x["county_fips"], x["year"]): x["y_pred"] for x in B.previous_year(tr, te).collect()}
    assert r[("19001", 2022)] == 1.0          # last training year 2021
    assert r[("19001", 2023)] == 2.0          # test 2022 entered the history (one step ahead)


def test_previous_year_no_history_is_zero(spark):
    tr = _panel(spark).filter("county_fips = '17001'")
    te = _panel(spark).filter("county_fips = '19001' AND year = 2018")
    assert B.previous_year(tr, te).first()["y_pred"] == 0.0


def test_fallback_chain(spark):
    """Unseen county -> crop mean; unseen crop -> global mean."""
    train = spark.createDataFrame([("19001", "CORN", 4.0), ("19001", "CORN", 8.0), ("19002", "SOY", 3.0)],
                                  "county_fips string, crop string, yield_anomaly double")
    test = spark.createDataFrame([("99999", "CORN"), ("99999", "WHEAT"), ("19001", "CORN")],
                                 "county_fips string, crop string")
    got = {(r["county_fips"], r["crop"]): r["y_pred"] for r in B.county_historical_mean(train, test).collect()}
    assert got[("99999", "CORN")] == 6.0 and got[("99999", "WHEAT")] == 5.0 and got[("19001", "CORN")] == 6.0


def test_present_key_with_null_mean_does_not_fall_through(spark):
    train = spark.createDataFrame([("1", "CORN", None), ("2", "CORN", 4.0)], "county_fips string, crop string, yield_anomaly double")
    test = spark.createDataFrame([("1", "CORN")], "county_fips string, crop string")
    assert B.county_historical_mean(train, test).first()["y_pred"] is None


def test_global_zero_when_empty(spark):
    train = spark.createDataFrame([], "county_fips string, crop string, yield_anomaly double")
    test = spark.createDataFrame([("1", "CORN")], "county_fips string, crop string")
    assert B.county_historical_mean(train, test).first()["y_pred"] == 0.0


def test_majority_and_risk(spark):
    train = spark.createDataFrame([("1", "CORN", 1), ("1", "CORN", 1), ("2", "CORN", 0), ("2", "CORN", 0), ("3", "CORN", None)],
                                  "county_fips string, crop string, severe_risk int")
    assert B.majority_label(train) == 0                 # tie -> smallest
    test = spark.createDataFrame([("1", "CORN"), ("2", "CORN"), ("9", "CORN")], "county_fips string, crop string")
    got = {r["county_fips"]: r["y_pred"] for r in B.historical_county_risk(train, test).collect()}
    assert got == {"1": 1, "2": 0, "9": 1}              # unseen -> crop rate 0.5 >= 0.5


def test_crop_checkpoint_requires_checkpoint(spark):
    df = spark.createDataFrame([("CORN", 1.0)], "crop string, yield_anomaly double")
    with pytest.raises(KeyError):
        B.crop_checkpoint_mean(df, df)


def test_group_means_levels(spark):
    levels = {r["level"] for r in B.group_means(_panel(spark)).collect()}
    assert levels == {"county_crop", "crop", "crop_checkpoint", "global"}
