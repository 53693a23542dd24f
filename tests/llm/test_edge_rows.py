"""Every operator on nasty rows: nulls in any column, empty and very long
texts, ties, repeated rows, clashing extra columns and empty tables."""

import hashlib

import pytest
from pyspark.sql import functions as F

from pitpanel.llm import (
    decontamination, exact_dedup, language_id, licenses, mixing, near_dedup, pii, sharding, substring_dedup, toxicity)

LONG = " ".join(f"word{i % 977}x{i % 31}" for i in range(60_000))
PASSAGE = " ".join(f"shared{i}" for i in range(40))
ROWS = [
    (1, "The quick brown fox jumps over it", "en", "a", 1),
    (1, "The quick brown fox jumps over it", "en", "a", 1),
    (2, "THE QUICK BROWN FOX JUMPS OVER IT", None, None, None),
    (3, None, None, "b", None),
    (4, "", "de", "b", 0),
    (5, " \t\n ", "de", None, 3),
    (None, "No id here but text", "en", "c", 1),
    (None, None, None, None, None),
    (6, LONG, "en", "c", 9),
    (7, "a " + PASSAGE + " b", "en", "a", 2),
    (8, "c " + PASSAGE + " d", "en", "b", 2),
    (9, "9" * 150_000 + " " + "é" * 50_000 + "@" + "a." * 3_000 + "b", "fr", "b", 5),
    (10, "1.2.3.4 mail me a@b.cd or +1 (555) 010-9999 card 4111 1111 1111 1111", "en", "c", 5),
]
EXTRA = ["size", "Shard", "taken", "_cell", "_r", "digest", "score", "kept", "node", "_o", "_digest", "h", "_h", "table",
         "epochs", "position", "_column_0", "_rank", "level", "w", "t", "p", "m"]


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    return df.withColumns({c: F.lit("clash") for c in EXTRA})


@pytest.fixture(scope="module")
def empty(docs):
    return docs.where("false")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (2, 0, 1), (None, 1, 1), (3, 1, None), (6, 0, 0), (6, 0, 0)],
                                 "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame([(1, PASSAGE), (1, PASSAGE), (2, None), (None, "short"), (3, "")],
                                 "item_id long, text string")


def by_id(df):
    out = {}
    for r in df.collect():
        out.setdefault(r["doc_id"], []).append(r)
    return out


def test_substring_dedup(docs, empty):
    got = by_id(substring_dedup.substring_dedup(docs))
    assert sum(map(len, got.values())) == len(ROWS)
    assert (got[7][0].n_words, got[7][0].n_removed) == (42, 40)
    assert got[7][0].kept_sha256 == hashlib.sha256(b"a b").hexdigest()
    assert got[3][0].n_words == got[4][0].n_words == got[5][0].n_words == 0
    assert got[6][0].n_words == 60_000
    assert substring_dedup.substring_dedup(empty).count() == 0
    clean = by_id(substring_dedup.cleaned_documents(docs))
    assert clean[7][0].text == "a b" and clean[3][0].text is None and clean[1][0].text == ROWS[0][1]
    assert list(substring_dedup.cleaned_documents(docs).columns) == docs.columns


def test_long_repeats_follow_the_doubling(spark):
    text = " ".join(f"w{i}" for i in range(300))
    df = spark.createDataFrame([(1, text + " x"), (2, text + " y"), (3, "z " * 100)], "doc_id long, text string")
    got = by_id(substring_dedup.substring_dedup(df))
    assert got[1][0].longest_level == 280 and got[1][0].n_removed == 300
    assert got[3][0].n_removed == 100  # repeats itself


def test_pii(docs, empty):
    got = by_id(pii.find_pii(docs))
    assert sum(map(len, got.values())) == len(ROWS)
    r = got[10][0]
    assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == (1, 1, 1, 1)
    assert r.spans.startswith("email:16:22,ip:0:7,card:")
    assert got[9][0].n_card == 0 and got[9][0].n_email == 0
    assert got[3][0].base_sha256 == hashlib.sha256(b"").hexdigest()
    assert pii.find_pii(empty).count() == 0


def test_decontamination(docs, empty, benchmark):
    got = decontamination.decontaminate(docs, benchmark)
    assert sorted((r.doc_id, r.item_id) for r in got.collect()) == [(7, 1), (8, 1)]
    left = decontamination.clean_documents(docs, benchmark)
    assert left.columns == docs.columns and left.count() == len(ROWS) - 2
    assert decontamination.decontaminate(empty, benchmark).count() == 0
    assert decontamination.decontaminate(docs, benchmark.where("false")).count() == 0


def test_clean_documents_go_by_text(spark, benchmark):
    """A contaminated row takes no clean row of the same, or no, id along."""
    rows = [(None, "x " + PASSAGE), (None, "clean without an id"), (None, None), (7, PASSAGE + " y"), (7, "clean seven"),
            (8, PASSAGE + " y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    left = {(r.doc_id, r.text) for r in decontamination.clean_documents(docs, benchmark).collect()}
    assert left == {(None, "clean without an id"), (None, None), (7, "clean seven")}


def test_exact_dedup(docs, empty):
    rows = exact_dedup.exact_dedup(docs).collect()
    assert len(rows) == len(ROWS)
    got = {}
    for r in rows:
        got.setdefault(r.text_sha256, []).append(r)
    assert all(sum(r.kept for r in g) == 1 and len(g) == g[0].group_size for g in got.values())
    fox = got[hashlib.sha256(ROWS[0][1].lower().encode()).hexdigest()]
    assert {r.keep_id for r in fox} == {2}
    assert {r.keep_id for r in got[hashlib.sha256(b"").hexdigest()]} == {4}
    assert exact_dedup.exact_dedup(empty).count() == 0


def test_exact_dedup_recursion(docs):
    whole = exact_dedup.exact_dedup(docs).orderBy(*exact_dedup.exact_dedup(docs).columns).collect()
    deep = exact_dedup.exact_dedup(docs, bucket_bytes=100_000)
    assert deep.orderBy(*deep.columns).collect() == whole


def test_sharding(docs, empty):
    out = sharding.shard_documents(docs, shards=4)
    rows = out.collect()
    assert len(rows) == len(ROWS) and out.columns[-6:] == ["size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    sizes = {}
    for r in rows:
        sizes.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in sizes.values())
    assert max(map(len, sizes.values())) - min(map(len, sizes.values())) <= 1
    assert [(r["size"], r.text_crc32) for r in rows if r.doc_id == 3] == [(1, 0)]
    assert sharding.shard_documents(empty).count() == 0


def test_licenses(spark, docs, empty):
    assert licenses.scan_licenses(docs).count() == 0
    assert licenses.scan_licenses(empty).count() == 0
    one = docs.limit(1).withColumn("text", F.concat(F.lit(LONG), F.lit(" released UNDER the MIT license! "), F.lit(LONG)))
    assert [(r.license, r.containment, r.n_places) for r in licenses.scan_licenses(one).collect()] == [("MIT", 1.0, 1)]


def test_near_dedup(docs, empty):
    got = by_id(near_dedup.near_dedup(docs, shingle=4))
    assert sum(map(len, got.values())) == len(ROWS)
    assert [r.component_id for r in got[1] + got[2]] == [1, 1, 1] and [r.kept for r in got[1] + got[2]] == [True, True, False]
    assert got[3][0].component_id == 3 and got[4][0].component_id == 4 and got[3][0].n_shingles == 0
    assert got[7][0].component_id == got[8][0].component_id == 7
    assert near_dedup.near_dedup(empty).count() == 0
    one = near_dedup.distinct_documents(docs)
    assert one.columns == docs.columns
    assert sorted(r.doc_id or 0 for r in one.collect()) == [0, 0, 1, 3, 4, 5, 6, 7, 9, 10]


def test_mixing(docs, empty):
    out = mixing.mixed_order(docs)
    rows = out.collect()
    assert len(rows) == len(ROWS) and all(r.taken <= 3 * r["size"] for r in rows)
    per = {}
    for r in rows:
        per.setdefault(r.source, [r.target, 0])[1] += r.taken
    assert all(abs(t - n) < 1 for t, n in per.values())
    positions = [r.position for r in rows if r.position is not None]
    assert positions == sorted(positions) and all(0 <= p <= 1 for p in positions)
    assert mixing.mixed_order(empty).count() == 0
    used = mixing.training_documents(docs)
    assert used.columns == docs.columns
    assert mixing.training_documents(empty).count() == 0
    assert mixing.training_documents(docs.where("text is null")).count() == 0


def test_language_id(docs, empty):
    got = by_id(language_id.language_id(docs))
    assert sum(map(len, got.values())) == len(ROWS)
    assert got[3][0].lang_pred == got[4][0].lang_pred == "und" and got[3][0].score == 0
    assert got[1][0].lang_pred == "en" and 0 <= got[1][0].score <= 1
    assert got[None][0].held_out
    assert language_id.language_id(empty).count() == 0
    assert {r.lang_pred for r in language_id.language_id(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def test_toxicity(docs, empty, labels):
    rows = toxicity.toxicity(docs, labels).collect()
    assert len(rows) == len(ROWS) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    assert toxicity.toxicity(empty, labels).count() == 0
    none = toxicity.toxicity(docs, labels.where("false")).collect()
    assert {r.predicted for r in none} == {0}
    assert toxicity.clean_documents(docs, labels.where("false")).columns == docs.columns
