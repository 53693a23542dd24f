"""C9, A4, A18, J1-J3, C12-C16, A13, A14 and the end-to-end panel."""

import datetime as dt

from pyspark.sql import functions as F

from pitpanel.operators import panel as P
from pitpanel.operators import season as S
from pitpanel.operators import targets as T
from pitpanel.operators import weekly as WK
from tests.conftest import DAILY_SCHEMA, daily_rows


def _weekly(spark):
    rows = [(dt.date(2020, 4, 6), "19001", 10.0, 5.0, 3.0, 1.0, 0.0),
            (dt.date(2020, 4, 13), "19001", 10.0, 5.0, 3.0, 1.0, 0.0),
            (dt.date(2020, 4, 20), "19001", 10.0, 5.0, 3.0, 1.0, 0.0)]
    return spark.createDataFrame(rows, "date date, county_fips string, D0 double, D1 double, D2 double, D3 double, D4 double")


def test_weekly_features(spark):
    r = WK.weekly_features(_weekly(spark), with_max_pct=True).first()
    assert (r["weeks_d0"], r["weeks_d3"], r["weeks_d4"], r["weeks_d2_plus"]) == (3, 3, 0, 3)
    assert r["max_drought_category"] == 3 and r["mean_drought_severity"] == 3.0
    assert r["checkpoint"] == "full_season" and r["d2_plus_max_pct"] == 4.0


def test_weekly_cutoff_and_empty(spark):
    r = WK.weekly_features(_weekly(spark), cutoff_date="2020-04-13").first()
    assert r["weeks_d0"] == 2 and r["checkpoint"] == "2020-04-13"
    empty = WK.weekly_features(_weekly(spark), cutoff_date="2020-03-01")
    assert empty.count() == 0 and "mean_drought_severity" in empty.columns


def test_clean_weekly_variants(spark):
    raw = spark.createDataFrame([("2020-04-06", "19001.0", "150", None), ("bad", "1", "1", "2")],
                                "MapDate string, FIPS string, D0 string, D1 string")
    r = WK.clean_weekly(raw).collect()
    assert len(r) == 1
    assert (r[0]["county_fips"], r[0]["year"], r[0]["D0"], r[0]["D1"], r[0]["D4"]) == ("19001", 2020, 100.0, 0.0, 0.0)


def _targets(spark):
    rows = []
    for c, st in (("19001", "IOWA"), ("17001", "ILLINOIS")):
        for crop in ("CORN", "SOYBEANS"):
            for i, y in enumerate(range(2016, 2021)):
                rows.append((y, st, c.lower(), c, crop, 150.0 + 3 * i + (5 if crop == "CORN" else 0), "BU"))
    df = spark.createDataFrame(rows, "year int, state string, county string, county_fips string, crop string, value double, unit string")
    return T.build_targets(df, window=3, min_periods=2)


def test_end_to_end_panel(spark):
    """2 counties x 2 crops x 3 valid years x 5 checkpoints, unique key."""
    daily = spark.createDataFrame(daily_rows("19001", "19", range(2016, 2021))
                                  + daily_rows("17001", "17", range(2016, 2021)), DAILY_SCHEMA)
    weather = S.add_weather_anomalies(S.checkpoint_weather(daily))
    drought = WK.weekly_features(_weekly(spark)).drop("checkpoint")
    panel = P.build_panel(_targets(spark), weather, drought)
    assert panel.count() == 2 * 2 * 3 * 5
    assert P.check_unique(panel, P.PANEL_KEYS).count() == 0
    assert "unit" not in panel.columns and {"year_index", "heat_dry_stress", "heat_dry_spell"} <= set(panel.columns)
    # drought broadcast over all checkpoints of 19001/2020 (full-season parity mode)
    assert panel.filter("county_fips = '19001' AND year = 2020 AND weeks_d0 = 3").count() == 10


def test_unmatched_yields_are_kept(spark):
    daily = spark.createDataFrame(daily_rows("19001", "19", range(2016, 2021)), DAILY_SCHEMA)
    panel = P.build_panel(_targets(spark), S.checkpoint_weather(daily))
    assert panel.filter("county_fips = '17001'").count() == 2 * 3
    assert panel.filter("county_fips = '17001' AND checkpoint IS NULL").count() == 2 * 3


def test_invalid_ids_dropped(spark):
    t = _targets(spark).withColumn("county_fips", F.when(F.col("county_fips") == "17001", "OTHER").otherwise(F.col("county_fips")))
    assert P.count_invalid_entities(t).first()[0] == 10
    assert P.valid_entities(t).count() == 10


def test_missingness_report(spark):
    df = spark.createDataFrame([(1.0, None), (None, None), (3.0, "x"), (4.0, None)], "a double, b string")
    rep = {r["column"]: (r["missing_count"], r["missing_pct"], r["dtype"]) for r in P.missingness_report(df).collect()}
    assert rep == {"a": (1, 25.0, "float64"), "b": (3, 75.0, "object")}


def test_checkpoint_label_rules(spark):
    df = spark.createDataFrame([(True, 100), (False, 160), (None, None)], "is_partial_year boolean, obs_days int")
    assert [r["checkpoint"] for r in P.add_checkpoint_label(df).collect()] == ["partial", "full_season", None]
    df2 = spark.createDataFrame([(100,), (160,), (None,)], "obs_days int")
    assert [r["checkpoint"] for r in P.add_checkpoint_label(df2).collect()] == ["partial", "full_season", "partial"]


def test_audit(spark):
    daily = spark.createDataFrame(daily_rows("19001", "19", range(2016, 2021)), DAILY_SCHEMA)
    panel = P.build_panel(_targets(spark), S.checkpoint_weather(daily))
    a = P.panel_audit(panel).first()
    assert a["duplicate_rows"] == 0 and a["crops"] == ["CORN", "SOYBEANS"] and a["n_counties"] == 2
    by = {r["crop"]: r["n"] for r in P.panel_summary_by(panel, "crop").collect()}
    assert by == {"CORN": 3 * 5 + 3, "SOYBEANS": 3 * 5 + 3}
