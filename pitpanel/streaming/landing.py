"""Structured Streaming landing store for daily measurements.

New batch files dropped into a landing folder are picked up by a file-source
stream.  Each micro-batch is merged into the store with the latest batch
winning per (entity, date) (S9).  The store is partitioned by ``year``, and
a micro-batch rewrites only the year partitions it touches, by reading
them from the current version (partition pruning) and writing a new
version of just those partitions.  The stream's offsets live in the given
checkpoint location, so a restarted query resumes exactly after the last
committed micro-batch.  Completeness (S8) is then a batch aggregate over
the store.
"""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pitpanel.sources.landing import merge_batches


def _versions(spark: SparkSession, store_dir: str) -> list[str]:
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(store_dir)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]
    return sorted(n for n in names if n.startswith("v="))


def read_store(spark: SparkSession, store_dir: str) -> DataFrame | None:
    """Union of the newest version of every year partition."""
    vs = _versions(spark, store_dir)
    if not vs:
        return None
    frames = [spark.read.option("basePath", f"{store_dir}/{v}").parquet(f"{store_dir}/{v}") for v in vs]
    allv = frames[0].withColumn("_v", F.lit(vs[0]))
    for v, f in zip(vs[1:], frames[1:]):
        allv = allv.unionByName(f.withColumn("_v", F.lit(v)), allowMissingColumns=True)
    latest = allv.groupBy("year").agg(F.max("_v").alias("_v"))
    return allv.join(F.broadcast(latest), ["year", "_v"], "left_semi").drop("_v")


def merge_micro_batch(spark: SparkSession, store_dir: str, batch: DataFrame, batch_id: int,
                      keys: Sequence[str] = ("county_fips", "date")) -> None:
    """Merge one micro-batch: only the touched year partitions are rewritten
    (as a new version), older versions stay readable until superseded."""
    batch = batch.withColumn("year", F.year("date").cast("int"))
    years = [r[0] for r in batch.select("year").distinct().collect()]   # years in one batch: bounded
    if not years:
        return
    current = read_store(spark, store_dir)
    parts = [batch]
    if current is not None:
        parts = [current.filter(F.col("year").isin(years)).select(*batch.columns), batch]
    merged = merge_batches(parts, list(keys))
    merged.write.mode("overwrite").partitionBy("year").parquet(f"{store_dir}/v={batch_id:010d}")


def start_landing_stream(spark: SparkSession, landing_dir: str, store_dir: str, schema: StructType,
                         checkpoint_location: str, keys: Sequence[str] = ("county_fips", "date"),
                         available_now: bool = True):
    """Start (and with ``available_now`` drain) the landing stream."""
    stream = spark.readStream.schema(schema).parquet(landing_dir)

    def handle(df: DataFrame, batch_id: int) -> None:
        merge_micro_batch(spark, store_dir, df, batch_id, keys)

    w = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint_location)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def default_locations(spark: SparkSession, name: str) -> tuple[str, str]:
    """Store and stream-checkpoint folders under the session's shared
    ``spark.checkpoint.dir``."""
    from pitpanel.session import ensure_checkpoint_dir
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return os.path.join(base, f"{name}-store"), os.path.join(base, f"{name}-stream")
