"""Exact deduplication by Grace hash partitioning.

Records are dealt into buckets by their content hash; a bucket whose distinct
contents exceed ``bucket_bytes`` is partitioned again by the next hash level,
until each bucket fits the open-addressing table of one task, which compares
complete contents.  Shuffle files are the spill files; each record moves once,
since bucket sizes are measured first from (hash, length) rows.

Equal texts of one Arrow batch are combined before the shuffle, so a text that
a third of all rows share reaches its bucket as one record per batch, not per
row; a bucket that holds one such text streams through the table, which keeps
one copy.

Defined results: null text counts as empty; equal means identical after
lower-casing A-Z; the largest doc_id stays; null ids lose to any other id and
one of them stays only if the group has no other; of repeated rows with the
same id and text one stays.  An empty table gives an empty result.  Extra
columns are ignored.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitpanel.llm.common import text_batches, write_stage

BUCKET_BYTES = 64 << 20


class ContentTable:
    """Open addressing with linear probing; keys are complete contents."""

    def __init__(self) -> None:
        self.slots = [-1] * 1024
        self.entries: list[list] = []  # content, digest, rows, largest id

    def _free(self, start: int) -> int:
        mask = len(self.slots) - 1
        at = start & mask
        while self.slots[at] >= 0:
            at = (at + 1) & mask
        return at

    def add(self, content: bytes, digest: bytes, rows: int, doc_id: int | None) -> None:
        mask = len(self.slots) - 1
        start = int.from_bytes(digest[-8:], "big")
        at = start & mask
        while (k := self.slots[at]) >= 0:
            entry = self.entries[k]
            if entry[0] == content:
                entry[2] += rows
                if doc_id is not None and (entry[3] is None or doc_id > entry[3]):
                    entry[3] = doc_id
                return
            at = (at + 1) & mask
        self.slots[at] = len(self.entries)
        self.entries.append([content, digest, rows, doc_id])
        if 3 * len(self.entries) > 2 * len(self.slots):
            self.slots = [-1] * (2 * len(self.slots))
            for k, entry in enumerate(self.entries):
                self.slots[self._free(int.from_bytes(entry[1][-8:], "big"))] = k

    def columns(self, *which: int) -> list[list]:
        return [[e[k] for e in self.entries] for k in which]


def _digests(batches):
    for batch, texts in text_batches(batches):
        normal = [(t or b"").lower() for t in texts]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array([hashlib.sha256(t).digest() for t in normal], pa.binary()),
             pa.array([len(t) for t in normal], pa.int64())], ["doc_id", "digest", "n_bytes"])


def _combined(batches):
    for batch, texts in text_batches(batches):
        table = ContentTable()
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts):
            content = (text or b"").lower()
            table.add(content, hashlib.sha256(content).digest(), 1, doc_id)
        content, digest, rows, ids = table.columns(0, 1, 2, 3)
        yield pa.RecordBatch.from_arrays(
            [pa.array(digest, pa.binary()), pa.array(content, pa.binary()), pa.array(rows, pa.int64()),
             pa.array(ids, pa.int64())], ["digest", "content", "n", "doc_id"])


def _bucket_groups(batches):
    table = ContentTable()
    for batch in batches:
        for digest, content, n, doc_id in zip(*(batch.column(c).to_pylist()
                                                for c in ("digest", "content", "n", "doc_id"))):
            table.add(content, digest, n, doc_id)
    for at in range(0, len(table.entries), 10_000):
        part = table.entries[at:at + 10_000]
        yield pa.RecordBatch.from_arrays(
            [pa.array([e[1] for e in part], pa.binary()), pa.array([e[3] for e in part], pa.int64()),
             pa.array([e[2] for e in part], pa.int64())], ["digest", "keep_id", "group_size"])


def _bucket(level: int, fanout: int):
    return F.pmod(F.xxhash64("digest", F.lit(level)), F.lit(fanout)).cast("int")


def _grace(records: DataFrame, sizes: DataFrame, fanout: int, bucket_bytes: int, level: int) -> DataFrame:
    """Groups of ``records``; buckets that do not fit go one level deeper.
    ``sizes`` has one (digest, n_bytes) row per distinct content; the list of
    too large buckets has ``fanout`` entries at most."""
    bucket = _bucket(level, fanout)
    large = [r["b"] for r in sizes.groupBy(bucket.alias("b"))
             .agg(F.sum("n_bytes").alias("bytes"), F.count("*").alias("n"))
             .where((F.col("bytes") > bucket_bytes) & (F.col("n") > 1)).collect()]
    fits = records.where(~bucket.isin(large)) if large else records
    groups = fits.repartitionById(fanout, bucket) \
        .mapInArrow(_bucket_groups, "digest binary, keep_id long, group_size long")
    if not large:
        return groups
    return groups.unionByName(_grace(records.where(bucket.isin(large)), sizes.where(bucket.isin(large)),
                                     fanout, bucket_bytes, level + 1))


def exact_dedup(docs: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    rows = write_stage(docs.mapInArrow(_digests, "doc_id long, digest binary, n_bytes long"), "exact_rows")
    sizes = rows.groupBy("digest").agg(F.max("n_bytes").alias("n_bytes"))
    total = sizes.agg(F.sum("n_bytes")).first()[0] or 0
    fanout = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * total // bucket_bytes)
    records = docs.mapInArrow(_combined, "digest binary, content binary, n long, doc_id long")
    groups = _grace(records, sizes, int(fanout), bucket_bytes, 0)
    copies = rows.groupBy("doc_id", "digest").agg(F.count("*").cast("int").alias("n"))
    return copies.join(groups, "digest") \
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n")))) \
        .select("doc_id", "keep_id", "group_size",
                (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"),
                F.lower(F.hex("digest")).alias("text_sha256"))
