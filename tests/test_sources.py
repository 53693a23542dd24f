"""Ingest of landed files and payloads."""

import datetime as dt
import json
import tempfile

import pytest

from pyspark.sql import functions as F

from pitpanel.operators.lags import keep_first
from pitpanel.sources import landing as L
from pitpanel.sources import payloads as PL
from pitpanel.sources import records as R

RAW = "year string, state_name string, county_name string, commodity_desc string, unit_desc string, Value string, state_fips_code string, county_ansi string"


def test_clean_records(spark):
    rows = [(" 2020 ", "IOWA ", "ADAIR", "CORN", "BU / ACRE", " 185.0", "19.0", "1.0"),
            ("2020", "IOWA", "ADAMS", "CORN", "BU / ACRE", "1,234.5", "19", "3"),
            ("2020", "IOWA", "OTHER", "CORN", "BU / ACRE", "(D)", "19", "998"),
            ("2020", "IOWA", "X", "CORN", "BU / ACRE", "", "19", None),
            ("2021", "IOWA", "Y", "CORN", "BU / ACRE", "(Z)", "19", "5")]
    out = R.clean_yield_records(spark.createDataFrame(rows, RAW)).orderBy("county").collect()
    assert [(r["county_fips"], r["value"], r["state"], r["year"]) for r in out] == [
        ("19001", 185.0, "IOWA", 2020), ("19003", 1234.5, "IOWA", 2020)]
    assert list(out[0].asDict()) == R.CLEAN_COLUMNS
    R.validate_yield_records(R.clean_yield_records(spark.createDataFrame(rows, RAW)))


def test_validation_all_missing(spark):
    rows = [("2020", "IOWA", "A", "CORN", "BU", "(D)", "19", "1")]
    with pytest.raises(ValueError):
        R.validate_yield_records(R.clean_yield_records(spark.createDataFrame(rows, RAW)))


def test_source_filter(spark):
    rows = [("2015", "IOWA", "A", "CORN", "BU", "1", "19", "1"), ("2016", "OHIO", "A", "CORN", "BU", "1", "39", "1"),
            ("2016", "IOWA", "A", "SOYBEANS", "BU", "1", "19", "1"), ("2016", "IOWA", "A", "CORN", "BU", "1", "19", "1")]
    out = R.source_filter(spark.createDataFrame(rows, RAW), crops=["CORN"], states=["IOWA"], start_year=2016)
    assert out.count() == 1


def test_csv_text_round_trip(spark):
    path = tempfile.mkdtemp(prefix="pitpanel-csv-")
    df = spark.createDataFrame([("17001.0", "1001"), ("01001", None)], "county_fips string, other string")
    df.write.mode("overwrite").option("header", True).csv(path + "/t")
    back = R.normalize_id_columns(R.read_csv_as_text(spark, path + "/t"))
    assert dict(back.dtypes)["county_fips"] == "string"
    assert sorted(r["county_fips"] for r in back.collect()) == ["01001", "17001"]


def test_saved_csv_panel_keeps_its_types(spark, tmp_path):
    rows = [("01001", 2001, "CORN", "june_30", 3, 0.1 + 0.2, True, None), ("01003", 2002, "CORN", None, None, None, None, 1.5)]
    panel = spark.createDataFrame(rows, "county_fips string, year int, crop string, checkpoint string, dry_days bigint, "
                                        "cumulative_precip double, is_partial_year boolean, my_measure double")
    panel.write.option("header", True).csv(str(tmp_path / "p"))
    back = R.load_panel(spark, str(tmp_path / "p"), fmt="csv")
    assert dict(back.dtypes) == dict(panel.dtypes)
    assert sorted(back.select(*panel.columns).collect(), key=str) == sorted(panel.collect(), key=str)


def test_load_panel_drops_labels(spark):
    path = tempfile.mkdtemp(prefix="pitpanel-panel-") + "/p"
    spark.createDataFrame([("1001.0", "2020", True, 1, 0)], "county_fips string, year string, is_partial_year boolean, severe_risk int, severe_risk_descriptive int") \
        .write.parquet(path)
    p = R.load_panel(spark, path).first()
    assert p["county_fips"] == "01001" and p["year"] == 2020 and p["checkpoint"] == "partial"
    assert "severe_risk" not in p.asDict()


def test_weather_payload(spark):
    payload = json.dumps({"PRECTOTCORR": {"20200401": 1.5, "20200402": -999.0, "20200403": 0.0},
                          "T2M": {"20200401": 10.0, "20200403": 12.0},
                          "T2M_MAX": {"20200401": 15.0, "20200402": 16.0, "20200403": 17.0, "20200404": 18.0}})
    df = spark.createDataFrame([("19001", payload)], "county_fips string, payload string")
    out = PL.unnest_weather_payload(df, keep=["county_fips"]).orderBy("date").collect()
    assert [r["date"] for r in out] == [dt.date(2020, 4, d) for d in (1, 2, 3)]     # keys of the first parameter
    assert out[1]["PRECTOTCORR"] is None and out[1]["T2M"] is None and out[1]["T2M_MIN"] is None
    assert out[2]["T2M_MAX"] == 17.0 and out[0]["month"] == 4


def test_record_payloads(spark):
    good = json.dumps({"data": [{"year": "2020", "Value": "185", "state_name": "IOWA"}]})
    empty = json.dumps({"data": []})
    bad = json.dumps({"error": ["exceeds limit"]})
    df = spark.createDataFrame([(good,), (empty,), (bad,)], "payload string")
    rows, errors = PL.unnest_records(df)
    assert rows.count() == 1 and rows.first()["Value"] == "185"
    assert errors.first()["error"] == "exceeds limit"


def test_no_payload_is_lost(spark):
    """Truncated text, no JSON, a null, errors of any kind and other shapes are
    quarantined with their reason; the balance adds up to the input."""
    rows = [(json.dumps({"data": [{"year": "2020"}, {"year": "2021"}]}), "rows"), (json.dumps({"data": []}), "empty"),
            (json.dumps({}), "empty"), (json.dumps({"data": None}), "empty"), (None, PL.NO_PAYLOAD),
            ('{"data": [{"year": "20', PL.NOT_AN_OBJECT), ("<html>", PL.NOT_AN_OBJECT), ("", PL.NOT_AN_OBJECT),
            ("[1]", PL.NOT_AN_OBJECT), (json.dumps({"error": "limit"}), PL.ERROR_KEY),
            (json.dumps({"data": [{"year": "1"}], "error": []}), PL.ERROR_KEY), (json.dumps({"error": ["a", "b"]}), PL.ERROR_KEY),
            (json.dumps({"error": None}), PL.ERROR_KEY), (json.dumps({"data": "none"}), PL.BAD_SHAPE),
            (json.dumps({"data": [1, 2]}), PL.BAD_SHAPE), (json.dumps({"data": {"year": "1"}}), PL.BAD_SHAPE)]
    df = spark.createDataFrame([(i, p) for i, (p, _) in enumerate(rows)], "id int, payload string")
    good, errors = PL.unnest_records(df, keep=["id"])
    assert [(r["id"], r["year"]) for r in good.orderBy("id", "year").collect()] == [(0, "2020"), (0, "2021")]
    found = {r["id"]: r for r in errors.collect()}
    assert {i: r["reason"] for i, r in found.items()} == {i: why for i, (_, why) in enumerate(rows) if why not in ("rows", "empty")}
    assert (found[9]["error"], found[10]["error"], found[11]["error"], found[12]["error"]) == ("limit", "", "a; b", "")
    balance = {r["outcome"]: (r["payloads"], r["records"]) for r in PL.payload_balance(df).collect()}
    assert sum(n for n, _ in balance.values()) == len(rows) and balance["rows"] == (1, 2) and balance["empty"] == (3, 0)


def test_no_weather_payload_is_lost(spark):
    good = {"PRECTOTCORR": {"20200401": 1.5}, "T2M": {"20200401": 10.0}}
    rows = [json.dumps(good), json.dumps(good)[:-3], None, "oops", json.dumps({"PRECTOTCORR": 5}), "{}",
            json.dumps({"PRECTOTCORR": {"20201345": 1.0, "x": 2.0, "20200402": 3.0}})]
    df = spark.createDataFrame([(i, p) for i, p in enumerate(rows)], "id int, payload string")
    out = PL.unnest_weather_payload(df, keep=["id"]).orderBy("id").collect()
    assert [(r["id"], r["date"].day) for r in out] == [(0, 1), (6, 2)]
    bad = sorted((r["id"], r["reason"], r["key"]) for r in PL.quarantined_weather(df, keep=["id"]).collect())
    assert bad == [(1, PL.NOT_AN_OBJECT, None), (2, PL.NO_PAYLOAD, None), (3, PL.NOT_AN_OBJECT, None), (4, PL.BAD_SHAPE, None),
                   (5, PL.BAD_SHAPE, None), (6, PL.BAD_DATE, "20201345"), (6, PL.BAD_DATE, "x")]


def test_keep_first_does_not_depend_on_partitions(spark):
    """One key, tied order column: the survivor is the least of all columns."""
    df = spark.range(200).select(F.lit("k").alias("k"), F.lit(1).alias("obs"), (200 - F.col("id")).alias("v"), F.lit(None).alias("n"))
    kept = {tuple(keep_first(df.repartition(n), ["k"], [-F.col("obs")]).first()) for n in (1, 3, 7)}
    assert kept == {("k", 1, 1, None)}


def test_resume_complete_only_if_all_years(spark):
    landed = spark.createDataFrame([("1", 2015), ("1", 2016), ("2", 2015), ("2", 2016), ("2", 2017)],
                                   "county_fips string, year int")
    c = {r["county_fips"]: r["complete"] for r in L.completeness(landed, 2015, 2017).collect()}
    assert c == {"1": False, "2": True}
    ents = spark.createDataFrame([("1",), ("2",), ("3",)], "county_fips string")
    assert sorted(r[0] for r in L.remaining_entities(ents, landed, 2015, 2017).collect()) == ["1", "3"]


def test_merge_latest_wins(spark):
    old = spark.createDataFrame([("1", dt.date(2020, 4, 1), 1.0), ("1", dt.date(2020, 4, 2), 1.0)], "county_fips string, date date, p double")
    new = spark.createDataFrame([("1", dt.date(2020, 4, 2), 2.0), ("1", dt.date(2020, 4, 3), 2.0)], "county_fips string, date date, p double")
    out = {r["date"].day: r["p"] for r in L.merge_batches([old, new]).collect()}
    assert out == {1: 1.0, 2: 2.0, 3: 2.0}


def test_centroids(spark):
    raw = spark.createDataFrame([("19", "1", " adair ", "41.3", "-94.4"), ("19", "3", "adams", "", "-94.7"),
                                 ("17", "1", "adams", "40.0", "-91.2")],
                                "STATEFP string, COUNTYFP string, COUNAME string, LATITUDE string, LONGITUDE string")
    req = spark.createDataFrame([("19001.0",), ("19003",)], "county_fips string")
    out = L.centroids(raw, req).collect()
    assert [(r["county_fips"], r["county"], r["state_fips"]) for r in out] == [("19001", "ADAIR", "19")]
