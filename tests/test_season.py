"""F1-F5, A1-A6, W1, W9, W10 on hand-built daily fixtures."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from pitpanel.operators import season as S
from tests.conftest import DAILY_SCHEMA, daily_rows


def _series(spark, precip, tavg=None, tmax=None, county="19001", year=2020):
    n = len(precip)
    tavg = tavg or [20.0] * n
    tmax = tmax or [30.0] * n
    rows = [(county, "19", year, dt.date(year, 5, 1) + dt.timedelta(days=i), precip[i], tavg[i], tavg[i] - 5, tmax[i])
            for i in range(n)]
    return spark.createDataFrame(rows, DAILY_SCHEMA)


def test_longest_dry_spell_examples(spark):
    f = S.season_features(_series(spark, [0.0, 5.0, 0.0, 0.0, 0.0, 5.0])).first()
    assert f["longest_dry_spell"] == 3
    f = S.season_features(_series(spark, [5.0, 6.0, 7.0])).first()
    assert f["longest_dry_spell"] == 0


def test_two_null_rules(spark):
    """0,5,0,0,NULL,0,5 -> 3 when NULL days are skipped, 2 when they break."""
    d = _series(spark, [0.0, 5.0, 0.0, 0.0, None, 0.0, 5.0])
    assert S.season_features(d).first()["longest_dry_spell"] == 3
    st = S.stress_features(d, ["full_season"]).first()
    assert st["max_consecutive_dry_days"] == 2


def test_gdd_and_empty_sums(spark):
    f = S.season_features(_series(spark, [5.0] * 4, tavg=[8.0, 12.0, 15.0, 9.0])).first()
    assert f["growing_degree_days"] == pytest.approx(7.0)
    f = S.season_features(_series(spark, [None, None, None])).first()
    assert f["cumulative_precip"] == 0.0 and f["dry_days"] == 0 and f["obs_days"] == 3


def test_heat_and_dry_thresholds_inclusive(spark):
    f = S.season_features(_series(spark, [1.0, 1.01, 0.0], tmax=[35.0, 34.9, 36.0])).first()
    assert f["extreme_heat_days"] == 2 and f["dry_days"] == 2


def test_cutoffs_inclusive_and_before_april_empty(spark):
    d = spark.createDataFrame(daily_rows(years=(2020,)), DAILY_SCHEMA)
    assert S.filter_season(d, cutoff_month_day="05-31").agg(F.max("date")).first()[0] == dt.date(2020, 5, 31)
    assert S.filter_season(d, cutoff_date="2020-06-15").agg(F.max("date")).first()[0] == dt.date(2020, 6, 15)
    assert S.filter_season(d, cutoff_date="2020-03-15").count() == 0
    # month-day wins over the absolute date
    assert S.filter_season(d, cutoff_date="2020-04-02", cutoff_month_day="05-31").count() == 61


def test_checkpoint_fanout_counts_and_days(spark):
    rows = daily_rows(years=(2018, 2019, 2020)) + daily_rows(county="17001", state="17", years=(2018, 2019, 2020))
    d = spark.createDataFrame(rows, DAILY_SCHEMA)
    w = S.checkpoint_weather(d)
    assert w.count() == 5 * 2 * 3
    days = {r["checkpoint"]: r["obs_days"] for r in w.filter("county_fips = '19001' AND year = 2020").collect()}
    assert days == {"may_31": 61, "june_30": 91, "july_31": 122, "august_31": 153, "full_season": 153}


def test_unknown_checkpoint_errors(spark):
    d = spark.createDataFrame(daily_rows(years=(2020,)), DAILY_SCHEMA)
    with pytest.raises(ValueError):
        S.checkpoint_weather(d, ["june_15"])


def test_august_equals_full_season(spark):
    """N12 self-check."""
    d = spark.createDataFrame(daily_rows(), DAILY_SCHEMA)
    w = S.add_weather_anomalies(S.checkpoint_weather(d)).drop("checkpoint")
    a = w.filter(F.lit(True)).toPandas()
    cols = [c for c in a.columns]
    aug = S.checkpoint_weather(d, ["august_31"]).drop("checkpoint").toPandas().sort_values("year").reset_index(drop=True)
    full = S.checkpoint_weather(d, ["full_season"]).drop("checkpoint").toPandas().sort_values("year").reset_index(drop=True)
    pd.testing.assert_frame_equal(aug.drop(columns=["extreme_heat_days_after_july_1"]),
                                  full.drop(columns=["extreme_heat_days_after_july_1"]))
    assert cols


def test_heat_after_july_undefined_early(spark):
    d = spark.createDataFrame(daily_rows(years=(2020,)), DAILY_SCHEMA)
    w = {r["checkpoint"]: r["extreme_heat_days_after_july_1"] for r in S.stress_features(d).collect()}
    assert w["may_31"] is None and w["june_30"] is None and w["july_31"] == 0.0


def _brute(pdf, name, md, n=30):
    """Reference-style computation with pandas for one checkpoint."""
    out = []
    for (c, y), g in pdf.groupby(["county_fips", "year"]):
        g = g.sort_values("date")
        g = g[(g.date.dt.month >= 4) & (g.date.dt.month <= 8)]
        if md:
            mm, dd = map(int, md.split("-"))
            g = g[(g.date.dt.month < mm) | ((g.date.dt.month == mm) & (g.date.dt.day <= dd))]
        end = pd.Timestamp(year=y, month=int((md or "08-31")[:2]), day=int((md or "08-31")[3:]))
        win = g[(g.date >= end - pd.Timedelta(days=n - 1)) & (g.date <= end)]
        p = g.PRECTOTCORR
        dry = (p <= 1.0)
        runs, cur = 0, 0
        for v in dry:
            cur = cur + 1 if v else 0
            runs = max(runs, cur)
        pn = p.dropna()
        best, cur = 0, 0
        for v in pn <= 1.0:
            cur = cur + 1 if v else 0
            best = max(best, cur)
        out.append(dict(county_fips=c, year=y, checkpoint=name, cumulative_precip=float(pn.sum()),
                        longest_dry_spell=best, max_consecutive_dry_days=runs,
                        precip_last_30_days_before_checkpoint=float(win.PRECTOTCORR.sum()),
                        growing_degree_days=float(np.maximum(0.0, g.T2M.dropna() - 10).sum())))
    return pd.DataFrame(out)


def test_checkpoint_features_match_brute_force(spark):
    rng = np.random.default_rng(7)
    rows = []
    for c in ("19001", "17001"):
        for y in (2019, 2020):
            d = dt.date(y, 3, 20)
            while d <= dt.date(y, 9, 10):
                if rng.random() > 0.1:   # calendar gaps
                    p = None if rng.random() < 0.05 else float(rng.choice([0.0, 0.5, 3.0]))
                    rows.append((c, c[:2], y, d, p, float(rng.normal(18, 6)), 0.0, float(rng.normal(30, 5))))
                d += dt.timedelta(days=1)
    pdf = pd.DataFrame(rows, columns=["county_fips", "state_fips", "year", "date", "PRECTOTCORR", "T2M",
                                      "T2M_MIN", "T2M_MAX"])
    pdf["date"] = pd.to_datetime(pdf["date"])
    d = spark.createDataFrame(rows, DAILY_SCHEMA)
    got = S.checkpoint_weather(d, group_cols=["county_fips", "year"]).toPandas()
    for name, md in S.CHECKPOINTS.items():
        exp = _brute(pdf, name, md).sort_values(["county_fips", "year"]).reset_index(drop=True)
        g = got[got.checkpoint == name].sort_values(["county_fips", "year"]).reset_index(drop=True)
        for col in ["cumulative_precip", "longest_dry_spell", "max_consecutive_dry_days",
                    "precip_last_30_days_before_checkpoint", "growing_degree_days"]:
            np.testing.assert_allclose(g[col].astype(float), exp[col].astype(float), rtol=1e-9, err_msg=f"{name} {col}")


def test_prior_only_anomalies_are_leak_free(spark):
    """Metamorphic: replacing every value of year >= 2020 by extremes leaves
    the features of earlier years unchanged."""
    base = daily_rows(years=(2017, 2018, 2019, 2020, 2021))
    mutated = [r if r[2] < 2020 else (r[0], r[1], r[2], r[3], 1e6, 99.0, 99.0, 99.0) for r in base]

    def feats(rows):
        d = spark.createDataFrame(rows, DAILY_SCHEMA)
        w = S.add_weather_anomalies(S.checkpoint_weather(d))
        return w.filter("year < 2020").toPandas().sort_values(["year", "checkpoint"]).reset_index(drop=True)

    pd.testing.assert_frame_equal(feats(base), feats(mutated))


def test_precip_anomaly_uses_prior_years_only(spark):
    d = spark.createDataFrame(daily_rows(years=(2018, 2019, 2020)), DAILY_SCHEMA)
    w = S.season_features(d).orderBy("year").collect()
    assert w[0]["precip_anomaly"] is None
    assert w[1]["precip_anomaly"] == pytest.approx(0.0)


def test_drop_incomplete_current_year(spark):
    rows = daily_rows(years=(2019,)) + [r for r in daily_rows(years=(2020,)) if r[3].month < 7]
    w = S.season_features(spark.createDataFrame(rows, DAILY_SCHEMA))
    assert sorted(r["year"] for r in S.drop_incomplete_current_year(w, 2020).collect()) == [2019]
    assert S.drop_incomplete_current_year(w, 2020, allow_partial=True).count() == 2
    assert S.drop_incomplete_current_year(w, 2021).count() == 2
