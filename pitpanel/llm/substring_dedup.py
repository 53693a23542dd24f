"""Substring deduplication by level-wise doubling.

Windows of about half the wanted length are looked at first; only windows
repeated at one length are extended to twice that length, until no candidate
survives (or ``max_words`` is reached).  Of the shortest windows it is enough
to follow anchors: a window of ``min_words`` words contains a smallest hash
among its half-length windows, so two equal windows share that anchor, and a
text has about one anchor in ten words.  A window whose anchor occurs once
cannot be repeated.  From ``min_words`` on every surviving window is counted
by a 128-bit hash of its words.

Equal texts are folded first (``copies``), and the folded texts are written
once, bucketed by digest, so that every level joins its repeated hashes to the
texts without moving the texts again.  Counts are pre-aggregated in each task
and the repeated hashes return by a join that Spark may split, so a passage
that a third of all texts share is never gathered in one task.

Defined results: null and empty texts have no words and lose none; texts that
are shorter than a window lose none; repeated rows are copies of each other,
so all their words go (from ``min_words`` words on); doc_id is only carried
along and may be null or repeated.  An empty table gives an empty result.
Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from itertools import chain, compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitpanel.llm.common import (
    drop_stage, fresh, mix64, spread, text_batches, text_digest, window_hashes, word_hashes, write_stage)

MIN_WORDS = 35
_NEVER = np.uint64(2**64 - 1)


def sliding(x: np.ndarray, span: int, of=np.minimum) -> np.ndarray:
    """Minimum (or ``of``) of every ``span`` consecutive values."""
    n, size = len(x) - span + 1, 1
    while size * 2 <= span:
        x = of(x[:-size], x[size:])
        size *= 2
    return of(x[:n], x[span - size:span - size + n]) if size < span else x[:n]


def side_by_side(batches):
    """Slices of the batches: (batch, word lists, first position of every text
    in the slice and the end of the last, words left in its text from every
    position on)."""
    for batch, texts in text_batches(batches):
        words = [(t or b"").split() for t in texts]
        first = np.concatenate([[0], np.cumsum([len(w) for w in words])]).astype(np.int64)
        yield batch, words, first, np.repeat(first[1:], np.diff(first)) - np.arange(first[-1])


def anchors(h: np.ndarray, left: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the half-length windows (rounded up) and, for every window of
    ``length`` words inside one text, the smallest of those that it contains
    (0 for windows that run over the end of a text)."""
    half = (length + 1) // 2
    halves = window_hashes(h, half)
    least = sliding(halves, length - half + 1)
    return halves, np.where(left[:len(least)] >= length, least, np.uint64(0))


def _listed(first: np.ndarray, at: np.ndarray, *columns: np.ndarray, names=("pos", "h", "g")) -> pa.ListArray:
    """Per text the (position in the text, ...) of the chunk positions ``at``."""
    doc = np.searchsorted(first, at, "right") - 1
    offsets = np.searchsorted(at, first).astype(np.int32)
    fields = [pa.array((at - first[doc]).astype(np.int32)), *[pa.array(c.view(np.int64)) for c in columns]]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays(fields, list(names[:len(fields)])))


def _positions(first: np.ndarray, column: pa.ListArray) -> np.ndarray:
    """Chunk positions from the lists of positions of its texts, ascending."""
    offsets = np.asarray(column.offsets)
    flat = np.asarray(column.values)[offsets[0]:offsets[-1]].astype(np.int64)
    return np.sort(flat + np.repeat(first[:-1], np.diff(offsets)))


def _flat_hashes(words: list[list[bytes]]) -> np.ndarray:
    return word_hashes(list(chain.from_iterable(words)))


def _first_level(length: int):
    """Anchors of every text: half-length windows that are the smallest of
    some window of ``length`` words."""
    span = length - (length + 1) // 2 + 1

    def run(batches):
        for batch, words, first, left in side_by_side(batches):
            at, h = np.empty(0, np.int64), np.empty(0, np.uint64)
            if first[-1] >= length:
                h, least = anchors(_flat_hashes(words), left, length)
                edge = np.zeros(span - 1, np.uint64)
                at = np.flatnonzero(sliding(np.concatenate([edge, least, edge]), span, np.maximum) == h)
            yield pa.RecordBatch.from_arrays(
                [batch.column("digest"), pa.array(np.diff(first)),
                 pa.array([hashlib.sha256(b" ".join(w)).hexdigest() for w in words], pa.string()),
                 _listed(first, at, h[at])], ["digest", "n_words", "whole", "windows"])
    return run


def _candidates(length: int):
    """Windows of ``length`` words whose anchor is repeated, by 128-bit hash."""
    span = length - (length + 1) // 2 + 1

    def run(batches):
        for batch, words, first, left in side_by_side(batches):
            h = _flat_hashes(words)
            halves, least = anchors(h, left, length)
            known = np.full(len(halves), _NEVER)
            at = _positions(first, batch.column("repeated"))
            known[at] = halves[at]
            at = np.flatnonzero((sliding(known, span) == least) & (left[:len(least)] >= length))
            yield pa.RecordBatch.from_arrays(
                [batch.column("digest"), _listed(first, at, window_hashes(h, length)[at],
                                                 window_hashes(h, length, seed=1)[at])], ["digest", "windows"])
    return run


def _doubled(length: int):
    """From repeated windows of ``length`` words to windows of twice that
    length, both halves of which are repeated."""
    def run(batches):
        for batch in batches:
            found = batch.column("repeated")
            offsets = np.asarray(found.offsets)
            values = found.values.slice(offsets[0], offsets[-1] - offsets[0])
            doc = np.repeat(np.arange(len(found)), np.diff(offsets))
            key = doc << 32 | np.asarray(values.field("pos")).astype(np.int64)
            order = np.argsort(key)
            key, doc = key[order], doc[order]
            other = np.minimum(np.searchsorted(key, key + length), max(0, len(key) - 1))
            both = np.flatnonzero(key[other] == key + length)
            ids = []
            for name in ("h", "g"):
                x = np.asarray(values.field(name)).view(np.uint64)[order]
                with np.errstate(over="ignore"):
                    ids.append(mix64(x[both] * np.uint64(0x9FB21C651E98DF25) + x[other[both]]).view(np.int64))
            fields = [pa.array((key[both] & 0xFFFFFFFF).astype(np.int32)), pa.array(ids[0]), pa.array(ids[1])]
            lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(doc[both], np.arange(len(found) + 1)).astype(np.int32)),
                                             pa.StructArray.from_arrays(fields, ["pos", "h", "g"]))
            yield pa.RecordBatch.from_arrays([batch.column("digest"), lists], ["digest", "windows"])
    return run


def _removal(length: int):
    def run(batches):
        for batch, words, first, left in side_by_side(batches):
            gone = spread(_positions(first, batch.column("repeated")), length, int(first[-1]))
            kept = [b" ".join(compress(w, ~gone[a:b])) for w, a, b in zip(words, first, first[1:])]
            removed = np.diff(np.concatenate([[0], np.cumsum(gone)])[first])
            yield pa.RecordBatch.from_arrays(
                [batch.column("digest"), pa.array(removed), pa.array([k.decode() for k in kept], pa.string())],
                ["digest", "n_removed", "clean_text"])
    return run


def _repeated(stage: DataFrame, ids: list[str], keep: str) -> DataFrame:
    """Per text its windows that occur more than once anywhere."""
    rows = stage.select("digest", F.explode_outer("windows").alias("w")).where("w is not null") \
        .select("digest", "w.*")
    # written, so that both sides of the join are plain shuffles that Spark can
    # split where one window is in very many texts
    often = write_stage(rows.groupBy(*ids).agg(F.count("*").alias("n")).where("n > 1").select(*ids), "often")
    return rows.join(often, ids, "left_semi").groupBy("digest").agg(F.collect_list(F.expr(keep)).alias("repeated"))


def fold_texts(docs: DataFrame) -> DataFrame:
    """Distinct texts with their number of copies, bucketed by digest."""
    folded = docs.where(F.col("text").isNotNull()).select(text_digest("text").alias("digest"), "text") \
        .groupBy("digest").agg(F.first("text").alias("text"), F.count("*").alias("copies"))
    return write_stage(folded, "folded_texts", bucket_by="digest")


_WINDOWS = "windows array<struct<pos:int,h:long,g:long>>"


def repeated_passages(texts: DataFrame, min_words: int = MIN_WORDS, max_words: int | None = None) -> DataFrame:
    """One row per folded text: digest, n_words, n_removed, clean_text (the
    kept words joined by one space; null: unchanged or nothing left), whole
    (SHA-256 of all words), gone (nothing is left) and longest_level, the
    longest window of the doubling that is repeated (null: none).  Levels are
    ``min_words``, twice, four times, ... up to ``max_words`` or, if that is
    None, until no candidate survives."""
    if min_words < 2:
        raise ValueError("min_words must be at least 2")
    first = write_stage(texts.mapInArrow(
        _first_level(min_words),
        "digest binary, n_words long, whole string, windows array<struct<pos:int,h:long>>"), "anchors")

    def with_text(found: DataFrame) -> DataFrame:
        return texts.select("digest", "text").join(found.hint("shuffle_hash"), "digest")

    counts = write_stage(first.drop("windows"), "counts")
    stage = write_stage(with_text(_repeated(first, ["h"], "pos"))
                        .mapInArrow(_candidates(min_words), f"digest binary, {_WINDOWS}"), "windows")
    drop_stage(first)
    length, levels, flagged = min_words, [], None
    while True:
        found = write_stage(_repeated(stage, ["h", "g"], "struct(pos, h, g)"), "repeated")
        drop_stage(stage)
        if flagged is None:
            flagged = found
        elif found.isEmpty():
            break
        levels.append(found.select("digest", F.lit(length).alias("level")))
        length *= 2
        if max_words is not None and length > max_words:
            break
        stage = write_stage(found.mapInArrow(_doubled(length // 2), f"digest binary, {_WINDOWS}"), "windows")
    longest = levels[0]
    for one in levels[1:]:
        longest = longest.unionByName(one)
    longest = longest.groupBy("digest").agg(F.max("level").alias("level"))
    cleaned = with_text(flagged.select("digest", F.col("repeated.pos").alias("repeated"))) \
        .mapInArrow(_removal(min_words), "digest binary, n_removed long, clean_text string")
    gone = (F.col("copies") > 1) & (F.col("n_words") >= min_words)
    return counts.join(texts.select("digest", "copies"), "digest") \
        .join(cleaned, "digest", "left").join(longest, "digest", "left") \
        .select("digest", "n_words", "whole", gone.alias("gone"),
                F.when(gone, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
                F.when(~gone, F.col("clean_text")).alias("clean_text"),
                F.when(gone, F.col("n_words")).otherwise(F.col("level")).cast("long").alias("longest_level"))


def substring_dedup(docs: DataFrame, min_words: int = MIN_WORDS, max_words: int | None = None) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256,
    longest_level (see :func:`repeated_passages`)."""
    docs = docs.select("doc_id", "text")
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    found = write_stage(repeated_passages(fold_texts(docs), min_words, max_words).select(
        "digest", "n_words", "n_removed", "longest_level",
        F.when(F.col("gone"), nothing).otherwise(F.coalesce(F.sha2("clean_text", 256), "whole")).alias("kept_sha256")),
        "passages")
    return docs.select("doc_id", text_digest("text").alias("digest")).join(found, "digest", "left") \
        .select("doc_id", F.coalesce("n_words", F.lit(0).cast("long")).alias("n_words"),
                F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"),
                F.coalesce("kept_sha256", nothing).alias("kept_sha256"), "longest_level")


def cleaned_documents(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with the repeated passages taken out of ``text``: texts that
    lose words become their kept words joined by one space."""
    found = repeated_passages(fold_texts(docs), min_words, min_words)
    key = fresh(docs, "_digest")
    changed = found.select(F.col("digest").alias(key), F.when(F.col("gone"), F.lit("")).otherwise(
        F.col("clean_text")).alias(f"{key}_text")).where(F.col(f"{key}_text").isNotNull())
    return docs.withColumn(key, text_digest("text")).join(changed, key, "left") \
        .withColumn("text", F.coalesce(f"{key}_text", "text")).select(*docs.columns)
