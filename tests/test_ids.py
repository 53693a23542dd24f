"""Identifier and numeric text handling."""

from pyspark.sql import functions as F

from pitpanel.functions.ids import (
    fips_from_parts, is_valid_fips, normalize_county_code, normalize_fips, normalize_state_fips,
    sentinel_to_null, to_number,
)


def _one(spark, expr, values, typ="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {typ}")
    return [r[0] for r in df.select(expr(F.col("x"))).collect()]


def test_fips_round_trips(spark):
    got = _one(spark, normalize_fips, ["17001.0", "1001.0", "1001", " 19169 ", None, "nan", "NaN", "None", "", "<NA>"])
    assert got == ["17001", "01001", "01001", "19169", None, None, None, None, None, None]


def test_zero_fill_never_truncates(spark):
    assert _one(spark, normalize_fips, ["123456"]) == ["123456"]


def test_state_and_county_widths(spark):
    assert _one(spark, normalize_state_fips, ["19.0", "1"]) == ["19", "01"]
    assert _one(spark, normalize_county_code, ["169.0", "1"]) == ["169", "001"]


def test_fips_from_parts_null_if_any_missing(spark):
    df = spark.createDataFrame([("19.0", "169.0"), ("1", "1"), (None, "1"), ("19", "nan")], "s string, c string")
    assert [r[0] for r in df.select(fips_from_parts("s", "c")).collect()] == ["19169", "01001", None, None]


def test_numeric_text(spark):
    got = _one(spark, to_number, ["185.0", "1,234.5", " (D)", "(Z)", "(NA)", "", None, "5D", "1e3"])
    assert got == [185.0, 1234.5, None, None, None, None, None, None, 1000.0]


def test_sentinel_exact_match_only(spark):
    got = _one(spark, sentinel_to_null, [-999.0, -999.5, 1.0], "double")
    assert got == [None, -999.5, 1.0]


def test_valid_fips(spark):
    got = _one(spark, is_valid_fips, ["19001", "1900", "OTHER", None, "190011"])
    assert [bool(g) for g in got] == [True, False, False, False, False]
