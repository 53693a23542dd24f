"""MinHash near-deduplication with tensored banding.

Two small collections of ``side`` keys per document (each key combines
``rows`` minhashes) are combined pairwise, so ``2 * side`` keys, from
``2 * side * rows`` minhashes, stand for ``side * side`` tables.  Two documents
meet in a table when a key of the first and a key of the second collection
agree; at similarity s they never meet with probability below
``2 * (1 - s**rows) ** side`` (with the defaults below 1e-5 at 0.8).

A table key can only be shared if both its parts are, so parts that occur
once are dropped before the pairs are formed.  Inside a table every document
is compared with the table's first one (a star, never all pairs).  Documents
of tables whose members then lie in several components are regrouped by the
rarest fifth of their shingles, of which two documents over the similarity
must share one; these groups are compared by stars from one member of the
lowest and highest component, and at last across the components that remain,
where a parity sketch of each set bounds the difference of a pair from below:
only pairs that it leaves open are compared.  So a link is lost only if the two documents never met.  Links are confirmed on
the full shingle sets.

Documents with equal shingle sets are folded before all this; they meet in a
component without being compared.  Components are found by passing on the
smallest label, with pointer jumping.

Defined results: texts without words (or null) have no shingles and are their
own component; shorter texts than a shingle are one shingle; component_id is
the smallest doc_id of the component, null ids count only if there is no
other; kept means doc_id equals component_id, so repeated rows of the smallest
id are all kept.  An empty table gives an empty result.  Extra columns are
ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from pitpanel.llm.common import drop_stage, fresh, mix64, text_batches, text_digest, window_hashes, word_hashes, write_stage

SHINGLE = 5
PERCENT = 80
SIDE = 12
ROWS = 2
#: Shingles hashed at once inside a task.
CHUNK = 1 << 18
#: Bits of the parity sketch of a set, in 64-bit words.
PARITY_WORDS = 16
#: Star rounds before the remaining components of a group are compared.
STAR_ROUNDS = 3


def shingle_set(text: bytes | None, length: int) -> np.ndarray:
    """Sorted distinct shingle hashes of a text, lower-cased in A-Z."""
    words = (text or b"").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = word_hashes(words)
    return np.unique(window_hashes(h, min(length, len(words)), seed=0 if len(words) >= length else len(words)))


def minhashes(sets: list[np.ndarray], count: int) -> np.ndarray:
    """``count`` minhashes for each non-empty set: one row per set."""
    salt = mix64(np.arange(1, 2 * count + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    out = np.empty((len(sets), count), np.uint64)
    at = 0
    while at < len(sets):
        end, n = at, 0
        while end < len(sets) and (end == at or n + len(sets[end]) <= CHUNK):
            n += len(sets[end])
            end += 1
        flat = np.concatenate(sets[at:end])
        starts = np.concatenate([[0], np.cumsum([len(s) for s in sets[at:end - 1]])]).astype(np.int64)
        with np.errstate(over="ignore"):
            for k in range(count):
                out[at:end, k] = np.minimum.reduceat((flat ^ salt[2 * k]) * (salt[2 * k + 1] | np.uint64(1)), starts)
        at = end
    return out


def _sketches(length: int, side: int, rows: int):
    def run(batches):
        for batch, texts in text_batches(batches):
            sets = [shingle_set(t, length) for t in texts]
            full = [i for i, s in enumerate(sets) if len(s)]
            mins = minhashes([sets[i] for i in full], 2 * side * rows)
            keys = np.zeros((len(full), 2 * side), np.uint64)
            with np.errstate(over="ignore"):
                for k in range(2 * side):
                    key = np.full(len(full), k, np.uint64)
                    for r in range(rows):
                        key = mix64(key * np.uint64(0x9FB21C651E98DF25) + mins[:, k * rows + r])
                    keys[:, k] = key
            parts: list = [None] * len(sets)
            for i, key in zip(full, keys.view(np.int64)):
                parts[i] = key
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("digest"),
                 pa.array([hashlib.sha256(s.tobytes()).digest()[:16] if len(s) else None for s in sets], pa.binary()),
                 pa.array([len(s) for s in sets], pa.int64()), pa.array(parts, pa.list_(pa.int64()))],
                ["doc_id", "digest", "set_key", "n_shingles", "parts"])
    return run


def parity_sketch(shingles: np.ndarray) -> np.ndarray:
    """For each of ``64 * PARITY_WORDS`` hash cells, whether an odd number of
    shingles falls into it.  Shared shingles cancel out in the XOR of two
    sketches, so its ones never outnumber the shingles that only one set has."""
    bits = 64 * PARITY_WORDS
    cells = (mix64(shingles ^ np.uint64(0xA0761D6478BD642F)) % np.uint64(bits)).astype(np.int64)
    return np.packbits((np.bincount(cells, minlength=bits) & 1).astype(np.uint8)).view(np.int64)


def _sets(length: int):
    def run(batches):
        for batch, texts in text_batches(batches):
            sets = [shingle_set(t, length) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())),
                 pa.array([parity_sketch(s) for s in sets], pa.list_(pa.int64()))], ["node", "shingles", "parity"])
    return run


def components(edges: DataFrame) -> DataFrame:
    """(node, comp) of the connected components of ``edges`` (a, b); ``comp``
    is the smallest node.  Nodes without an edge are not listed."""
    both = write_stage(edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
                       .union(edges.select("b", "a")).distinct(), "edges")
    labels = write_stage(both.groupBy(F.col("u").alias("node"))
                         .agg(F.least(F.min("v"), F.first("u")).alias("comp")), "labels")
    while True:
        near = both.join(labels.withColumnRenamed("node", "v"), "v") \
            .groupBy(F.col("u").alias("node")).agg(F.min("comp").alias("near"))
        hooked = labels.join(near, "node").select("node", "comp", F.least("comp", "near").alias("new"))
        up = labels.select(F.col("node").alias("new"), F.col("comp").alias("up"))
        seen = Observation()
        step = write_stage(
            hooked.join(up, "new").select("node", F.least("new", "up").alias("comp"), F.col("comp").alias("old"))
            .observe(seen, F.count_if(F.col("comp") != F.col("old")).alias("moved")).drop("old"), "labels")
        drop_stage(labels)
        labels = step
        if not seen.get["moved"]:
            drop_stage(both)
            return labels


def relabel(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """``rows`` with the component of their ``comp``, itself a node of the
    graph that ``labels`` (node, comp) describe; others stay."""
    return rows.join(labels.select(F.col("node").alias("comp"), F.col("comp").alias("_top")), "comp", "left") \
        .withColumn("comp", F.coalesce("_top", "comp")).drop("_top")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``pairs`` (a, b, ...) with ``linked``: the exact test on the full sets."""
    a = sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa"))
    b = sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb")).cast("long")
    return pairs.join(a, "a").join(b, "b").select(
        *pairs.columns, (100 * both >= percent * (F.size("sa") + F.size("sb") - both)).alias("linked"))


def near_links(docs: DataFrame, nodes: DataFrame, length: int, percent: int, side: int) -> list[DataFrame]:
    """Components of ``nodes`` by confirmed links, as (node, comp) frames to be
    applied one after the other (:func:`relabel`): every round links the
    components of the round before, so its graph is small."""
    parts = nodes.select("node", F.posexplode("parts").alias("at", "part"))
    shared = parts.groupBy("at", "part").agg(F.count("*").alias("n")).where("n > 1").select("at", "part")
    useful = parts.join(shared, ["at", "part"], "left_semi").groupBy("node").agg(
        F.collect_list(F.when(F.col("at") < side, F.struct("at", "part"))).alias("first"),
        F.collect_list(F.when(F.col("at") >= side, F.struct("at", "part"))).alias("second"))
    table = F.xxhash64("f.at", "f.part", "s.at", "s.part")
    keys = useful.select("node", "second", F.explode("first").alias("f")) \
        .select("node", "f", F.explode("second").alias("s")).select("node", table.alias("table"))
    tables = keys.groupBy("table").agg(F.min("node").alias("lead"), F.count("*").alias("n")) \
        .where("n > 1").drop("n")
    members = write_stage(keys.join(tables, "table"), "members")
    in_pairs = members.select("node").distinct()
    chosen = in_pairs.join(nodes.select("node", "text_of", "digest"), "node")
    texts = docs.select(F.col("doc_id").alias("text_of"), text_digest("text").alias("_digest"), "text")
    sets = write_stage(
        texts.join(chosen, F.col("_digest").eqNullSafe(F.col("digest"))
                   & texts["text_of"].eqNullSafe(chosen["text_of"]))
        .select("node", "text").dropDuplicates(["node"]).mapInArrow(_sets(length), "node long, shingles array<long>, parity array<long>"),
        "sets")
    stars = members.where("node <> lead").select(F.col("lead").alias("a"), F.col("node").alias("b")).distinct()
    tested = write_stage(_confirmed(stars, sets, percent), "links")
    labels = [components(tested.where("linked").select("a", "b"))]
    tested = tested.select("a", "b")
    named = members.withColumn("comp", F.col("node"))
    unsettled = _mixed(relabel(named, labels[0])).select("node").distinct()
    tokens = _prefix_tokens(unsettled.join(sets, "node"), percent).withColumn("comp", F.col("node"))
    still = Observation()
    open_ = write_stage(_led(relabel(tokens, labels[0])).observe(still, F.count("*").alias("rows")), "open")
    drop_stage(members)
    left, last = still.get["rows"], False
    for round_ in range(STAR_ROUNDS + 1):
        if not left:
            break
        last = last or round_ == STAR_ROUNDS
        new = _rest(open_.join(sets.select("node", "parity"), "node"), percent) if last else _stars(open_)
        new = new.dropDuplicates(["a", "b"]).join(tested, ["a", "b"], "left_anti")
        seen = Observation()
        new = write_stage(_confirmed(new, sets, percent)
                          .observe(seen, F.count_if("linked").alias("linked")), "links")
        if seen.get["linked"]:
            labels.append(components(new.where("linked").select(F.col("ca").alias("a"), F.col("cb").alias("b"))))
        if last:
            break
        tested = tested.unionByName(new.select("a", "b"))
        if not seen.get["linked"]:  # the same stars again would find nothing
            last = True
            continue
        still = Observation()
        mixed = write_stage(_led(relabel(open_.drop("low", "high"), labels[-1]))
                            .observe(still, F.count("*").alias("rows")), "open")
        drop_stage(open_)
        open_, left = mixed, still.get["rows"]
    drop_stage(open_)
    drop_stage(sets)
    return labels


def _mixed(named: DataFrame) -> DataFrame:
    """Members (table, node, comp, ...) of tables with more than one component."""
    mixed = named.groupBy("table").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low < high")
    return named.join(mixed.select("table"), "table")


def _led(named: DataFrame) -> DataFrame:
    """As :func:`_mixed`, with the leads of the table's stars: ``low``, the last
    member of its lowest component, and ``high``, the first of its highest
    (both structs of node and comp).  One aggregate finds components and
    leads, so a round of stars needs no shuffle to form its pairs."""
    member = F.struct("comp", (-F.col("node")).alias("back"))
    mixed = named.groupBy("table").agg(F.min(member).alias("l"), F.max(member).alias("h")).where("l.comp < h.comp")
    lead = [F.struct((-F.col(f"{x}.back")).alias("node"), F.col(f"{x}.comp").alias("comp")).alias(name)
            for x, name in (("l", "low"), ("h", "high"))]
    return named.join(mixed.select("table", *lead), "table")


def _prefix_tokens(sets: DataFrame, percent: int) -> DataFrame:
    """(table, node, after, n) of the rarest shingles of every set, as many as
    two sets that reach the similarity cannot both miss; ``after`` counts the
    set's shingles from this one on, of ``n``.  Shingles that occur once are
    left out at the end."""
    rows = sets.select("node", F.size("shingles").alias("n"), F.explode("shingles").alias("table"))
    counts = rows.groupBy("table").agg(F.count("*").alias("df"))
    size = F.size("all")
    prefix = F.slice(F.array_sort("all"), 1, (size - F.ceil(size * percent / 100) + 1).cast("int"))
    return rows.join(counts, "table").groupBy("node", "n") \
        .agg(F.collect_list(F.struct("df", "table")).alias("all")) \
        .select("node", "n", F.posexplode_outer(prefix).alias("at", "p")).where("p.df > 1") \
        .select(F.col("p.table").alias("table"), "node", (F.col("n") - F.col("at")).alias("after"), "n")


def _pair(one: Column, other: Column) -> list[Column]:
    """a, b and their components ca, cb of two (node, comp) structs, the smaller
    node first."""
    first, second = F.least(one, other), F.greatest(one, other)
    return [first["node"].alias("a"), second["node"].alias("b"), first["comp"].alias("ca"), second["comp"].alias("cb")]


def _stars(open_: DataFrame) -> DataFrame:
    """Pairs (a, b, ca, cb) of a member of the lowest and one of the highest
    component of each table with the members of its other components."""
    rows = open_.select(F.struct("node", "comp").alias("member"), F.explode(F.array("low", "high")).alias("lead"))
    return rows.where("member.comp <> lead.comp").select(*_pair(F.col("lead"), F.col("member")))


def _rest(open_: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b, ca, cb) of a group's members in different components that
    may still reach the similarity: from the first shared shingle on, the
    rarest, both sets must have enough shingles left, and the difference that
    the parity sketches prove must not be too large."""
    other = open_.select("table", F.col("node").alias("o"), F.col("comp").alias("oc"), F.col("after").alias("oa"),
                         F.col("n").alias("on"), F.col("parity").alias("op"))
    apart = sum((F.bit_count(F.col("parity")[i].bitwiseXOR(F.col("op")[i])) for i in range(PARITY_WORDS)), F.lit(0))
    return open_.join(other, "table").where("comp < oc") \
        .where((100 + percent) * F.least("after", "oa") >= percent * (F.col("n") + F.col("on"))) \
        .where((100 + percent) * apart <= (100 - percent) * (F.col("n") + F.col("on"))) \
        .select(*_pair(F.struct("node", "comp"), F.struct(F.col("o").alias("node"), F.col("oc").alias("comp"))))


def near_classes(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, side: int = SIDE,
                 rows: int = ROWS) -> DataFrame:
    """``docs`` rows as (doc_id, digest, n_shingles, comp): comp names the
    class, null for a text without shingles."""
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    sketched = write_stage(
        docs.select("doc_id", text_digest("text").alias("digest"), "text").mapInArrow(
            _sketches(shingle, side, rows),
            "doc_id long, digest binary, set_key binary, n_shingles long, parts array<long>"), "sketches")
    nodes = write_stage(
        sketched.where("n_shingles > 0").groupBy("set_key")
        .agg(F.min(F.struct("doc_id", "digest")).alias("r"), F.first("parts").alias("parts"))
        .select(F.monotonically_increasing_id().alias("node"), "set_key", F.col("r.doc_id").alias("text_of"),
                F.col("r.digest").alias("digest"), "parts"), "nodes")
    labels = near_links(docs, nodes, shingle, percent, side)
    classes = nodes.select("set_key", F.col("node").alias("comp"))
    for step in labels:
        classes = relabel(classes, step)
    return sketched.select("doc_id", "digest", "n_shingles", "set_key").join(classes, "set_key", "left") \
        .drop("set_key")


def near_dedup(docs: DataFrame, **options) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.  Options
    as for :func:`near_classes`."""
    named = near_classes(docs, **options)
    smallest = named.where("comp is not null").groupBy(F.col("comp").alias("_c")) \
        .agg(F.min("doc_id").alias("_id"))
    return named.join(smallest, F.col("comp") == F.col("_c"), "left").select(
        "doc_id", "n_shingles",
        F.when(F.col("comp").isNull(), F.col("doc_id")).otherwise(F.col("_id")).alias("component_id")) \
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def distinct_documents(docs: DataFrame, **options) -> DataFrame:
    """Whole rows of ``docs``, one of each class: that with the smallest
    doc_id (null ids last, then by digest; of repeated rows one).  Texts
    without words all stay."""
    named = near_classes(docs, **options)
    first = named.groupBy("comp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "digest"))
                                      .alias("r")).where("comp is not null")
    digest, id_, key = fresh(docs, "_digest"), fresh(docs, "_id"), fresh(docs, "_key")
    rows = docs.withColumn(digest, text_digest("text"))
    chosen = first.select(F.col("r.doc_id").alias(id_), F.col("r.digest").alias(key))
    one = rows.join(chosen, rows["doc_id"].cast("long").eqNullSafe(chosen[id_]) & (rows[digest] == chosen[key])) \
        .dropDuplicates([id_, key]).select(*docs.columns)
    blank = docs.where(F.coalesce("text", F.lit("")).rlike(r"^[\x20\x09-\x0D]*+$"))
    return one.unionByName(blank)
