"""Session helpers: a tuned builder for local runs and lineage cuts.

On a cluster the session comes from the platform; :func:`get_spark` is only
used by tests, tools and ``bench.py``.  Lineage is cut with reliable
``checkpoint()`` into the shared folder named by ``spark.checkpoint.dir``
(read from the session; only set here when it is missing, as in tests).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "pitpanel") -> SparkSession:
    master = master or f"local[{os.environ.get('BENCH_CPUS', '8')}]"
    n = shuffle_partitions or int(master.split("[")[-1].rstrip("]").replace("*", "8") or 8)
    builder = (
        SparkSession.builder.master(master).appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(n))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Return the session's checkpoint folder, setting one only if unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not (conf_dir or fallback) and not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    target = conf_dir or fallback or tempfile.mkdtemp(prefix="pitpanel-ckpt-")
    sc.setCheckpointDir(target)
    return sc.getCheckpointDir() or target


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint (survives executor loss); never ``localCheckpoint``."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
