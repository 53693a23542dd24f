"""Registered queries vs their DuckDB oracle on the smallest test tables
(the same comparison the driver makes at sf0.01, on a subset)."""

import os

import pandas as pd

import pytest

SF = "/root/testdata/sf0.001"
SUBSET = ["j1_modeling_panel", "t2_severe_risk", "a5_checkpoint_weather", "a4_drought_features",
          "b7_regression_baselines", "a12_regression_metrics", "a17_residual_box", "a19_auroc",
          "c7_clean_yield_records", "s5_weather_payload", "j9_remaining_entities",
          "s2_weather_csv", "s3_weekly_csv", "s4_daily_csv", "s12_saved_predictions", "c12_valid_entities",
          "t8_gates", "m4_feature_groups"]


def _canon(df):
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        df[c] = df[c].map(lambda v: None if v is None or v is pd.NA or (isinstance(v, float) and v != v) else v)
        df[c] = df[c].map(lambda v: str(v)[:10] if hasattr(v, "year") and hasattr(v, "day") else v)
        df[c] = df[c].map(repr)
    return df.sort_values(list(df.columns)).reset_index(drop=True)


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
@pytest.mark.parametrize("name", SUBSET)
def test_query_matches_oracle(spark, name):
    duckdb = pytest.importorskip("duckdb")
    import __spark_entry__ as E
    con = duckdb.connect()
    for t in ("region", "nation", "customer", "supplier", "orders", "lineitem"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    s = E.queries()[name](spark, SF).toPandas()
    d = con.sql(E.oracle_sql()[name]).df()
    assert sorted(s.columns) == sorted(d.columns)
    assert len(s) == len(d)
    assert _canon(s).equals(_canon(d))
