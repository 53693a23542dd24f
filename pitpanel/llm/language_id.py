"""Language identification by rank-order profiles.

A profile is a list of the most frequent letter n-grams (one to three letters
inside a word, with word boundaries), by falling frequency.  A document's
profile is compared to each language's by the out-of-place distance: the sum
over the document's n-grams of the difference of ranks, or the profile length
for an n-gram that the language's profile lacks.

N-gram counts cover all training texts: each task counts its share in an array
per language, Spark sums the counts, and a language's profile is its first
``PROFILE`` n-grams.  Letters are reduced to ``ALPHABET`` classes (a to z, the
others by code point), so the n-gram space, and with it a language's counts
and profile, has a fixed size.  Profiles are ``PROFILE`` rows per language; the
number of languages is checked against ``MAX_LANGUAGES`` before they travel to
the tasks.

Defined results: a text that is null or has no letter is ``und`` with score 0,
as is every text when nothing can be learned; ties between languages go to the
first by code point; ties between n-grams to the smaller code; rows with null
lang are not learned from; null doc_id rows are held out (they have no
remainder).  Repeated rows count each.  An empty table gives an empty result.
Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

PROFILE = 300
MAX_LANGUAGES = 10_000
ALPHABET = 64
UNKNOWN = "und"
#: One-, two- and three-letter codes lie side by side.
_OFFSETS = (0, ALPHABET, ALPHABET + ALPHABET**2)
N_CODES = ALPHABET + ALPHABET**2 + ALPHABET**3


_CLASSES: list[np.ndarray] = []


def letter_classes() -> np.ndarray:
    """Class of every code point: 0 for no letter, 1-26 for a-z, 27-63 else
    (made once per process)."""
    if not _CLASSES:
        out = np.zeros(0x110000, np.uint8)
        for point in range(0x110000):
            c = chr(point)
            if c.isalpha():
                out[point] = point - 96 if "a" <= c <= "z" else 27 + point % 37
        _CLASSES.append(out)
    return _CLASSES[0]


def ngram_codes(text: str) -> np.ndarray:
    """Codes of all n-grams of a text, repeated as they occur; runs of other
    characters count as one boundary."""
    points = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "replace"), np.uint32)
    x = letter_classes()[points].astype(np.int32)
    x = x[np.concatenate([[True], (x[1:] > 0) | (x[:-1] > 0)])]
    two = x[:-1] * ALPHABET + x[1:]
    three = two[:-1] * ALPHABET + x[2:]
    return np.concatenate([x[x > 0], _OFFSETS[1] + two[(x[:-1] > 0) | (x[1:] > 0)],
                           _OFFSETS[2] + three[x[1:-1] > 0]])


def top_codes(codes: np.ndarray, size: int) -> np.ndarray:
    """The ``size`` most frequent codes, most frequent first, then by code."""
    found, n = np.unique(codes, return_counts=True)
    return found[np.lexsort((found, -n))[:size]]


def _counts(batches):
    counts: dict[str, np.ndarray] = {}
    for batch in batches:
        for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist()):
            if lang not in counts:
                counts[lang] = np.zeros(N_CODES, np.int64)
            counts[lang] += np.bincount(ngram_codes(text), minlength=N_CODES) if len(text) > N_CODES else 0
            if len(text) <= N_CODES:
                found, n = np.unique(ngram_codes(text), return_counts=True)
                counts[lang][found] += n
    for lang, all_ in counts.items():
        found = np.flatnonzero(all_)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(found), pa.string()), pa.array(found, pa.int32()),
             pa.array(all_[found], pa.int64())], ["lang", "code", "n"])


def learn_profiles(train: DataFrame, size: int = PROFILE) -> list[tuple[str, list[int]]]:
    """(lang, n-gram codes by falling frequency) of ``train`` (text, lang)."""
    counts = train.select("text", "lang").where("text is not null and lang is not null") \
        .mapInArrow(_counts, "lang string, code int, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    ranked = counts.withColumn("rank", F.row_number().over(
        Window.partitionBy("lang").orderBy(F.col("n").desc(), "code"))).where(F.col("rank") <= size)
    profiles = ranked.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("rank", "code"))).alias("p")) \
        .select("lang", F.col("p.code").alias("codes"))
    rows = profiles.orderBy("lang").limit(MAX_LANGUAGES + 1).collect()
    if len(rows) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    return [(r["lang"], list(r["codes"])) for r in rows]


def _predict(profiles: list[tuple[str, list[int]]], size: int):
    langs = [lang for lang, _ in profiles]

    def run(batches):
        known = np.unique(np.concatenate([np.asarray(c, np.int32) for _, c in profiles] or [np.empty(0, np.int32)]))
        place = np.full(N_CODES, len(known), np.int32)
        place[known] = np.arange(len(known))
        ranks = np.full((max(1, len(langs)), len(known) + 1), -1, np.int32)
        for k, (_, codes) in enumerate(profiles):
            ranks[k, place[np.asarray(codes, np.int32)]] = np.arange(len(codes))
        for batch in batches:
            pred, score = [], []
            for text in batch.column("text").to_pylist():
                codes = ngram_codes(text) if text and langs else np.empty(0, np.int32)
                if not len(codes):
                    pred.append(UNKNOWN)
                    score.append(0.0)
                    continue
                own = top_codes(codes, size)
                theirs = ranks[:, place[own]]
                out_of_place = np.where(theirs < 0, size, np.abs(theirs - np.arange(len(own)))).sum(axis=1)
                best = int(out_of_place.argmin())
                pred.append(langs[best])
                score.append(float(1.0 - out_of_place[best] / (size * len(own))))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(pred, pa.string()),
                 pa.array(score, pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])
    return run


def identify_language(docs: DataFrame, profiles: list[tuple[str, list[int]]], size: int = PROFILE) -> DataFrame:
    """``docs`` (doc_id, held_out, text) with lang_pred and score: one less the
    distance to the nearest profile as a share of the largest possible."""
    return docs.select(F.col("doc_id").cast("long"), "held_out", "text").mapInArrow(
        _predict(profiles, size), "doc_id long, held_out boolean, lang_pred string, score double")


def fold(modulus: int, held: int):
    """True for documents of the held-out fold (and those without an id)."""
    key = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    return F.coalesce(key % modulus == held, F.lit(True))


def language_id(docs: DataFrame, size: int = PROFILE) -> DataFrame:
    """Learn from the documents outside fold 2 of 4, predict all of them:
    doc_id, held_out, lang_pred, score."""
    docs = docs.withColumn("held_out", fold(4, 2))
    return identify_language(docs, learn_profiles(docs.where(~F.col("held_out")), size), size)
