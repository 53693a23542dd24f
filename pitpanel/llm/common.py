"""Helpers shared by the operators of this subpackage.

Texts are identified by a 128-bit digest wherever rows of equal text may be
folded, so null or repeated ``doc_id`` values never matter to a shuffle key.
Stages that are read more than once are written as Parquet into the folder
that ``spark.checkpoint.dir`` names; they survive the loss of any executor.
"""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Separators between words; ``bytes.split()`` splits on exactly these bytes.
SPACES = r"[\x20\x09-\x0D]+"

_LOCAL_ROOTS: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """The shared folder of the session.  Only a local session (tests) may
    lack one; it then gets a temporary folder."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[app] = tempfile.mkdtemp(prefix="pitpanel-llm-")
    return _LOCAL_ROOTS[app]


def _drop_folder(spark: SparkSession, path: str) -> None:
    with contextlib.suppress(Exception):  # the session may be gone already
        hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
        hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


def write_stage(df: DataFrame, name: str, bucket_by: str | None = None) -> DataFrame:
    """Write ``df`` once into the shared folder and read it back (lineage cut).

    With ``bucket_by`` the stage is a bucketed table, so later joins and
    aggregates on that column need no further shuffle of it.  Stages are
    removed when the driver exits.
    """
    spark = df.sparkSession
    tag = f"{name}_{uuid.uuid4().hex}"
    path = f"{shared_root(spark)}/{tag}"
    writer = df.write.option("compression", "zstd")
    atexit.register(_drop_folder, spark, path)
    if bucket_by is None:
        writer.parquet(path)
        return spark.read.schema(df.schema).parquet(path)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    writer.format("parquet").option("path", path).bucketBy(buckets, bucket_by).saveAsTable(tag)
    return spark.table(tag)


def drop_stage(stage: DataFrame) -> None:
    """Remove a stage that nothing reads any more.  The driver then collects its
    garbage: until it does, Spark keeps the shuffle files and broadcasts of the
    ended plans, and a loop of small jobs makes the heap grow to its limit."""
    spark = stage.sparkSession
    for path in {f.rsplit("/", 1)[0] for f in stage.inputFiles()}:
        _drop_folder(spark, path)
    spark._jvm.java.lang.System.gc()


def text_digest(text: Column | str) -> Column:
    """128 bits of SHA-256 over the UTF-8 text, as 16 bytes; null for null."""
    return F.unhex(F.substring(F.sha2(F.col(text) if isinstance(text, str) else text, 256), 1, 32))


def word_count(text: Column | str) -> Column:
    """Number of words ``[^\\x20\\x09-\\x0D]+`` (null text: 0), as long."""
    c = F.col(text) if isinstance(text, str) else text
    return F.size(F.array_remove(F.split(F.coalesce(c, F.lit("")), SPACES), "")).cast("long")


def fresh(df: DataFrame, name: str) -> str:
    """A column name based on ``name`` that ``df`` does not use yet."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


# ------------------------------------------------------------ inside tasks
def word_hashes(words: list[bytes]) -> np.ndarray:
    """Stable 64-bit hashes of words."""
    import xxhash
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit moves every output bit."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def window_hashes(h: np.ndarray, length: int, seed: int = 0) -> np.ndarray:
    """64-bit hash of every window of ``length`` consecutive values of ``h``.

    Hashes of doubling lengths are combined pairwise, so the work is
    logarithmic in ``length``; the result depends on the window's content only.
    """
    n = len(h) - length + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    with np.errstate(over="ignore"):
        level = mix64(h + np.uint64(0x9E3779B97F4A7C15 * (seed + 1) & (2**64 - 1)))
        size = 1
        while size * 2 <= length:
            level = mix64(level[:-size] * np.uint64(0x9FB21C651E98DF25) + level[size:])
            size *= 2
        if size < length:  # two overlapping halves
            level = mix64(level[:n] * np.uint64(0xD6E8FEB86659FD93) + level[length - size:length - size + n])
        return level[:n]


def spread(starts: np.ndarray, length: int, n: int) -> np.ndarray:
    """Mask of the ``n`` positions covered by windows of ``length`` at the
    distinct ``starts``."""
    edge = np.zeros(n + 1, np.int32)
    edge[starts] += 1
    edge[np.minimum(starts + length, n)] -= 1
    return np.cumsum(edge[:-1]) > 0


#: Bytes of text that are handled at once inside a task.
SLICE = 1 << 21


def text_batches(batches, column: str = "text"):
    """Slices of the Arrow batches with their texts as lists of UTF-8 bytes
    (null stays None): about ``SLICE`` bytes each, one text at least, so a
    task's memory does not grow with the length of a batch."""
    import pyarrow as pa
    import pyarrow.compute as pc
    for batch in batches:
        texts = batch.column(column).cast(pa.large_binary())
        ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
        at = 0
        while at < len(texts):
            before = ends[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(ends, before + SLICE, "right")))
            yield batch.slice(at, end - at), texts.slice(at, end - at).to_pylist()
            at = end


def numbered(df: DataFrame, leave_out: set[str] = frozenset()) -> tuple[list[Column], list[Column]]:
    """Expressions that give the columns of ``df`` names that no operator uses,
    and expressions that give them their own names back."""
    kept = [c for c in df.columns if c.lower() not in leave_out]
    return ([F.col(f"`{c}`").alias(f"_column_{i}") for i, c in enumerate(kept)],
            [F.col(f"_column_{i}").alias(c) for i, c in enumerate(kept)])
