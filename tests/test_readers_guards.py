"""S2-S4, S10, J2 guard, J4 equivalence, F8, O1, O6, A15."""

import datetime as dt

import pytest

from pitpanel.operators import lags as LG
from pitpanel.operators import metrics as M
from pitpanel.operators import panel as P
from pitpanel.operators import season as S
from pitpanel.sources import records as R
from tests.conftest import DAILY_SCHEMA, daily_rows


def _csv(spark, tmp_path, df, name):
    path = str(tmp_path / name)
    df.write.option("header", True).csv(path)
    return path


def test_read_weather_features_csv(spark, tmp_path):
    df = spark.createDataFrame([("1001.0", "19", "2020", "full_season", "12.5", "true")],
                               "county_fips string, state_fips string, year string, checkpoint string, cumulative_precip string, is_partial_year string")
    r = R.read_weather_features(spark, _csv(spark, tmp_path, df, "w")).first()
    assert (r["county_fips"], r["year"], r["cumulative_precip"], r["is_partial_year"]) == ("01001", 2020, 12.5, True)


def test_read_daily_and_weekly_csv(spark, tmp_path):
    d = spark.createDataFrame([("19001", "2020-04-01", "1.5"), ("19001", "bad", "2.0")],
                              "county_fips string, date string, PRECTOTCORR string")
    rows = R.read_daily(spark, _csv(spark, tmp_path, d, "d")).orderBy("PRECTOTCORR").collect()
    assert rows[0]["date"] == dt.date(2020, 4, 1) and rows[1]["date"] is None and rows[0]["PRECTOTCORR"] == 1.5
    w = spark.createDataFrame([("2020-04-06", "19001", "5")], "date string, county_fips string, D2 string")
    r = R.read_weekly(spark, _csv(spark, tmp_path, w, "wk")).first()
    assert r["D2"] == 5.0 and r["D0"] == 0.0 and r["year"] == 2020


def test_union_frames(spark):
    a = spark.createDataFrame([(1, "x")], "k int, a string")
    b = spark.createDataFrame([(2, 3.0)], "k int, b double")
    assert R.union_frames([a, b]).count() == 2


def test_join_lag_table_guard(spark):
    y = spark.createDataFrame([("1", "C", 2020, 1.0, 0.5)], "county_fips string, crop string, year int, actual_yield double, yield_anomaly double")
    dup = spark.createDataFrame([("1", "C", 2020), ("1", "C", 2020)], "county_fips string, crop string, year int")
    with pytest.raises(ValueError):
        P.join_lag_table(y, dup)
    assert P.join_lag_table(y, LG.lag_table(y)).count() == 1


def test_in_place_lags_equal_join(spark):
    rows = [("1", "C", 2015 + i, "S", float(v), float(v) - 10) for i, v in enumerate([10, 12, 9, 14, 11])]
    y = spark.createDataFrame(rows, "county_fips string, crop string, year int, state string, actual_yield double, yield_anomaly double")
    a = LG.add_lag_columns(y).orderBy("year").collect()
    b = P.join_lag_table(y, LG.lag_table(y)).orderBy("year").collect()
    assert [r.asDict() for r in a] == [{k: r[k] for k in a[0].asDict()} for r in b]


def test_combined_equals_separate(spark):
    """A5 and A6 from one aggregate equal the two computed separately."""
    d = spark.createDataFrame(daily_rows(years=(2019, 2020)), DAILY_SCHEMA)
    both = S.checkpoint_weather(d).toPandas().sort_values(["year", "checkpoint"]).reset_index(drop=True)
    season = S.checkpoint_weather(d, include_stress=False).toPandas()
    stress = S.stress_features(d).toPandas()
    j = season.merge(stress, on=["county_fips", "state_fips", "year", "checkpoint"], how="left")
    j = j[both.columns].sort_values(["year", "checkpoint"]).reset_index(drop=True)
    assert len(j) == len(both)
    import pandas as pd
    pd.testing.assert_frame_equal(both, j, check_dtype=False)


def test_explore_head_sort_summary(spark):
    df = spark.createDataFrame([("CORN", "IOWA", 2020, "a", "19001", 1.0), ("SOY", "IOWA", 2020, "b", "19001", 2.0)],
                               "crop string, state string, year int, county string, county_fips string, v double")
    assert M.explore(df, crop="CORN", year=2020).count() == 1
    assert [r["crop"] for r in M.head(df, 1, ["v"]).collect()] == ["CORN"]
    assert [r["crop"] for r in P.sort_panel(df).collect()] == ["CORN", "SOY"]
    s = P.stage_summary(df, value_col="v").first()
    assert (s["rows"], s["entities"], s["min_year"], s["mean_v"]) == (2, 1, 2020, 1.5)
