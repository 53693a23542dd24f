"""End-to-end jobs on a small fixture: panel -> baselines -> models -> ablation."""

import datetime as dt

import numpy as np

from pitpanel.plans import jobs as J
from tests.conftest import DAILY_SCHEMA, daily_rows


def test_jobs_end_to_end(spark, tmp_path):
    rng = np.random.default_rng(11)
    yrows, drows = [], []
    for c, st in (("19001", "IOWA"), ("19003", "IOWA"), ("17001", "ILLINOIS"), ("17003", "ILLINOIS")):
        drows += daily_rows(c, c[:2], range(2014, 2022), precip=float(rng.integers(0, 4)), tmax=float(rng.integers(30, 38)))
        for crop in ("CORN", "SOYBEANS"):
            for y in range(2014, 2022):
                yrows.append((y, st, c.lower(), c, crop, float(150 + rng.normal(0, 8)), "BU"))
    yields = spark.createDataFrame(yrows, "year int, state string, county string, county_fips string, crop string, value double, unit string")
    daily = spark.createDataFrame(drows, DAILY_SCHEMA)
    weekly = spark.createDataFrame([(dt.date(y, 5, 4), c, 20.0, 10.0, 5.0, 0.0, 0.0) for y in range(2014, 2022)
                                    for c in ("19001", "17001")],
                                   "date date, county_fips string, D0 double, D1 double, D2 double, D3 double, D4 double")
    out = str(tmp_path / "out")
    panel = J.build_panel_job(spark, yields, daily, out, weekly, method="rolling")
    assert panel.count() == 4 * 2 * 5 * 5          # 5 years with >= 3 prior years, 5 checkpoints
    assert spark.read.parquet(out + "/missingness_report").count() == len(spark.read.parquet(out + "/panel_all").columns)
    bm = J.baselines_job(spark, panel, out, n_test_years=2)
    assert bm.filter("group = 'overall'").count() == 6
    mm = J.models_job(spark, panel, out, n_test_years=2, n_trees=5)
    assert mm.filter("group = 'overall' AND task = 'regression'").count() == 3
    am = J.ablation_job(spark, panel, out, {"pooled": None, "corn_only": "CORN"}, n_test_years=2, n_trees=5,
                        groups=["weather_raw"])
    assert set(r[0] for r in am.select("mode").distinct().collect()) == {"pooled", "corn_only"}
