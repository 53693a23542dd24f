"""Streaming landing store: micro-batches merged, latest wins, restart-safe."""

import datetime as dt
import tempfile

from pitpanel.sources.landing import completeness
from pitpanel.streaming.landing import read_store, start_landing_stream

SCHEMA = "county_fips string, date date, PRECTOTCORR double"


def test_landing_stream_merges_batches(spark):
    base = tempfile.mkdtemp(prefix="pitpanel-stream-")
    landing, store, ckpt = f"{base}/landing", f"{base}/store", f"{base}/ckpt"
    b1 = [("1", dt.date(2015, 4, 1), 1.0), ("1", dt.date(2016, 4, 1), 1.0)]
    spark.createDataFrame(b1, SCHEMA).write.parquet(f"{landing}/b1")
    schema = spark.createDataFrame(b1, SCHEMA).schema
    start_landing_stream(spark, f"{landing}/*", store, schema, ckpt).awaitTermination()
    b2 = [("1", dt.date(2016, 4, 1), 2.0), ("2", dt.date(2016, 4, 1), 3.0)]
    spark.createDataFrame(b2, SCHEMA).write.parquet(f"{landing}/b2")
    start_landing_stream(spark, f"{landing}/*", store, schema, ckpt).awaitTermination()
    s = {(r["county_fips"], r["date"].year): r["PRECTOTCORR"] for r in read_store(spark, store).collect()}
    assert s == {("1", 2015): 1.0, ("1", 2016): 2.0, ("2", 2016): 3.0}
    c = {r["county_fips"]: r["complete"] for r in completeness(read_store(spark, store), 2015, 2016).collect()}
    assert c == {"1": True, "2": False}
