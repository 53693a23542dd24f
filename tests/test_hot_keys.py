"""Skew: one group holding a third of all rows is split across tasks by the
range-partitioned quantile / prefix-sum path, and results stay exact."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from pitpanel.operators import metrics as M
from pitpanel.operators import targets as T


def _skewed(spark, n=30000):
    # group "hot" has n/3 rows with many distinct values; 200 small groups share the rest
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("g"), (F.col("id") % 200).cast("string"))).alias("g"),
        ((F.col("id") * 7919) % 10007).cast("double").alias("residual"))


def test_hot_group_is_split_across_partitions(spark):
    df = _skewed(spark)
    part = df.filter("g = 'hot'").repartitionByRange(8, "g", "residual").withColumn("pid", F.spark_partition_id())
    sizes = [r["count"] for r in part.groupBy("pid").count().collect()]
    assert len(sizes) >= 4 and max(sizes) < 0.5 * sum(sizes)


def test_exact_quantiles_on_hot_group(spark):
    df = _skewed(spark)
    got = M.exact_quantiles(df, ["g"], "residual", {"q20": 0.2, "median": 0.5}, num_partitions=8) \
        .filter("g = 'hot'").first()
    vals = np.array([r[0] for r in df.filter("g = 'hot'").select("residual").collect()])
    assert got["q20"] == pytest.approx(np.quantile(vals, 0.2))
    assert got["median"] == pytest.approx(np.quantile(vals, 0.5))


def test_thresholds_with_hot_entity(spark):
    df = _skewed(spark).select(F.lit("S").alias("state"), F.col("g").alias("county_fips"), F.lit("C").alias("crop"),
                               F.col("residual").alias("yield_anomaly_pct"))
    thr = {r["county_fips"]: r["risk_threshold"] for r in T.risk_thresholds(df).collect()}
    vals = np.array([r[0] for r in df.filter("county_fips = 'hot'").select("yield_anomaly_pct").collect()])
    assert thr["hot"] == pytest.approx(np.quantile(vals, 0.2)) and len(thr) == 201
