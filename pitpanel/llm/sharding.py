"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

Each shard owns ``vnodes`` points of the ring.  A document belongs to the
first point clockwise of its hash; when that shard is full, it continues
clockwise to the next shard with room.  Shard capacities sum to the number of
rows and differ by one at most, so the ``rows`` law holds exactly, while most
documents stay at their home shard when shards are added.

The walk needs row counts per ring slot only (``RING_SLOTS`` counts, a fixed
bound): the driver turns them into intervals of ranks, and Spark ranks the
documents of a slot.  Ranks come from small cells of the ring (about
``CELL_ROWS`` rows each, the number of cells grows with the input) plus the
summed counts of the cells before, so no window holds more than a cell.

Defined results: the ring key is doc_id, or the text for a null doc_id;
repeated rows are separate rows with slots of their own; a null text has size
1 and checksum 0; an empty table gives an empty result.  Columns of the input
with the name of a result column are replaced.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitpanel.llm.common import numbered, text_digest

RING_BITS = 12
RING_SLOTS = 1 << RING_BITS
CELL_ROWS = 8192


def ring_points(shards: int, vnodes: int) -> list[int]:
    """Owner of every ring slot: the shard of the first virtual node at or
    after it, clockwise.  A taken slot passes its virtual node to the next."""
    owner: dict[int, int] = {}
    for vnode in range(vnodes):
        for shard in range(shards):
            at = int(hashlib.md5(f"shard {shard} vnode {vnode}".encode()).hexdigest()[:8], 16) % RING_SLOTS
            while at in owner and len(owner) < RING_SLOTS:
                at = (at + 1) % RING_SLOTS
            owner.setdefault(at, shard)
    current = owner[min(owner)]
    out = [0] * RING_SLOTS
    for at in range(RING_SLOTS - 1, -1, -1):
        current = owner.get(at, current)
        out[at] = current
    return out


def allot(counts: list[int], owner: list[int], shards: int) -> list[tuple[int, int, int, int, int]]:
    """(slot, from rank, to rank, shard, first place in the shard): documents
    at home first, then the overflow of each slot clockwise."""
    total = sum(counts)
    cap = [total // shards + (s < total % shards) for s in range(shards)]
    used = [0] * shards
    out = []
    rest = []
    for slot, n in enumerate(counts):
        home = owner[slot]
        take = min(n, cap[home] - used[home])
        if take:
            out.append((slot, 0, take, home, used[home]))
            used[home] += take
        if take < n:
            rest.append((slot, take))
    for slot, placed in rest:
        at = slot
        while placed < counts[slot]:
            at = (at + 1) % RING_SLOTS
            shard = owner[at]
            take = min(counts[slot] - placed, cap[shard] - used[shard])
            if take:
                out.append((slot, placed, placed + take, shard, used[shard]))
                used[shard] += take
                placed += take
    return out


def ring_position(doc_id: Column, digest: Column) -> Column:
    """32-bit ring position of a document."""
    key = F.coalesce(doc_id.cast("string"), F.concat(F.lit("text "), F.hex(digest)), F.lit("text"))
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("long")


def shard_documents(docs: DataFrame, shards: int = 16, vnodes: int = 32) -> DataFrame:
    """``docs`` with size, text_crc32, law, shard, slot and grown_shard."""
    if not 0 < shards * vnodes <= RING_SLOTS:
        raise ValueError(f"shards * vnodes must be between 1 and {RING_SLOTS}")
    spark = docs.sparkSession
    mine = {"size", "text_crc32", "law", "shard", "slot", "grown_shard"}
    carried, restored = numbered(docs, mine)
    rows = docs.select(*carried,
                       F.struct(ring_position(F.col("doc_id"), text_digest("text")).alias("pos"),
                                F.col("doc_id").alias("id"), text_digest("text").alias("digest")).alias("_r"),
                       (F.octet_length(F.coalesce("text", F.lit(""))).cast("long") + 1).alias("size"),
                       F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("crc"))
    per_slot = {r["s"]: r["n"] for r in rows
                .groupBy(F.shiftright("_r.pos", 32 - RING_BITS).cast("int").alias("s"))
                .agg(F.count("*").alias("n")).collect()}
    counts = [per_slot.get(s, 0) for s in range(RING_SLOTS)]
    intervals = spark.createDataFrame(
        allot(counts, ring_points(shards, vnodes), shards) or [(0, 0, 0, 0, 0)],
        "_slot int, _from long, _to long, shard int, _first long")
    bits = max(RING_BITS, (sum(counts) // CELL_ROWS).bit_length())
    rows = rows.withColumn("_cell", F.shiftright("_r.pos", 32 - bits).cast("int"))
    before = Window.partitionBy("_slot").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = rows.groupBy("_cell").agg(F.count("*").alias("_n")) \
        .withColumn("_slot", F.shiftright("_cell", bits - RING_BITS)) \
        .select("_cell", "_slot", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    order = Window.partitionBy("_cell").orderBy("_r.pos", "_r.id", "_r.digest")
    ranked = rows.withColumn("_rank", F.row_number().over(order) - 1) \
        .join(cells, "_cell").withColumn("_rank", F.col("_rank") + F.col("_before"))
    placed = ranked.join(F.broadcast(intervals), "_slot") \
        .where((F.col("_rank") >= F.col("_from")) & (F.col("_rank") < F.col("_to")))
    return placed.select(*restored, "size", F.col("crc").alias("text_crc32"), F.lit("rows").alias("law"), "shard",
                         (F.col("_first") + F.col("_rank") - F.col("_from")).alias("slot"),
                         F.lit(None).cast("int").alias("grown_shard"))
