import datetime as dt
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    from pitpanel.session import ensure_checkpoint_dir
    s = (SparkSession.builder.master("local[4]").appName("pitpanel-tests")
         .config("spark.sql.shuffle.partitions", "4")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.driver.memory", "4g")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(s, tempfile.mkdtemp(prefix="pitpanel-test-ckpt-"))
    yield s


def daily_rows(county="19001", state="19", years=(2018, 2019, 2020), precip=5.0, july_precip=999.0,
               tavg=20.0, tmax=30.0):
    """Apr-Aug daily weather; July precipitation distinct (fixture shape of
    the reference's multi-checkpoint tests)."""
    rows = []
    for y in years:
        d = dt.date(y, 4, 1)
        while d <= dt.date(y, 8, 31):
            p = july_precip if d.month == 7 else precip
            rows.append((county, state, y, d, p, tavg, tavg - 5, tmax))
            d += dt.timedelta(days=1)
    return rows


DAILY_SCHEMA = "county_fips string, state_fips string, year int, date date, PRECTOTCORR double, T2M double, T2M_MIN double, T2M_MAX double"
