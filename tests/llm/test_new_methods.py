"""Phrases, hard negatives and packing against brute force, and on nasty rows."""

import itertools
import os
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from pitpanel.llm import collocations, hard_negatives, packing
from tests.llm.test_edge_rows import LONG, ROWS, docs, empty  # noqa: F401 (fixtures)

SF = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


# ------------------------------------------------------------ phrases
def brute_phrases(rows, top, least):
    f, n = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        c = f.setdefault(lang, Counter())
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", re.sub("[A-Z]", lambda m: m.group().lower(), text or "")):
            w = [x for x in re.split("[ \t]+", piece) if x]
            n[lang] += len(w)
            for m in range(1, 5):
                for i in range(len(w) - m + 1):
                    c[tuple(w[i:i + m])] += 1
    out = []
    for lang, c in f.items():
        found = {g: a for g, a in c.items() if len(g) > 1 and a >= least}
        gone = {g[i:i + m] for g, a in found.items() for m in range(2, len(g)) for i in range(len(g) - m + 1)
                if 100 * a >= 80 * c[g[i:i + m]]}
        rows_ = []
        for g, a in found.items():
            if g not in gone:
                score, k = min((2000000 * a // (c[g[:k]] + c[g[k:]]), k) for k in range(1, len(g)))
                rows_.append((-score, -a, " ".join(g).encode(), c[g[:k]], c[g[k:]]))
        for i, (s, a, p, left, right) in enumerate(sorted(rows_)[:top], 1):
            out.append((lang, i, p.decode(), -a, left, right, n[lang], -s))
    return sorted(out)


def made_texts():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(40)] + ["É", "ê", "Zwei", "THE"]
    fixed = [["new", "York", "city"], ["a", "b", "a", "b"], ["in", "the", "long", "run"], ["x"] * 5]
    rows = []
    for i in range(300):
        out = []
        for _ in range(rng.randint(0, 40)):
            out += rng.choice(fixed) if rng.random() < 0.3 else [words[min(int(rng.expovariate(0.15)), len(words) - 1)]]
            if rng.random() < 0.1:
                out.append(rng.choice([".", " ,", "\n", "\t", ";"]))
        rows.append((rng.choice(["en", "en", None, "de", "und"]), rng.choice([" ", "  "]).join(out)))
    return rows + [("en", None), (None, ""), ("fr", " \t ")]


@pytest.mark.parametrize("top,limit", [(2000, 1 << 20), (12, 300)])
def test_phrases_equal_brute_force(spark, top, limit):
    """With a small ``top`` most of the frontier is never expanded; with a small
    ``limit`` each round is dealt over several passes."""
    rows = made_texts()
    df = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    got = sorted(tuple(r) for r in collocations.collocations(df, top=top, min_count=6, limit=limit).collect())
    want = brute_phrases(rows, top, 6)
    assert got == want and len({r[0] for r in want}) == 3


def test_phrases_on_nasty_rows(docs, empty):  # noqa: F811
    got = sorted(tuple(r) for r in collocations.collocations(docs, min_count=2).collect())
    assert got == brute_phrases([(r[2], r[1]) for r in ROWS], 2000, 2)
    assert collocations.collocations(empty).count() == 0


# ------------------------------------------------------------ hard negatives
def brute_negatives(rows):
    rows = [(i, (y + 1) % 10 if i is not None and i % 7 == 0 else y, [int(np.floor(256 * float(v))) for v in x])
            for i, x, y in rows if y is not None and x is not None and all(v is not None and np.isfinite(v) for v in x)]
    out = []
    for k, (i, y, q) in enumerate(rows):
        if i is None or i % 100:
            continue
        s = [sum(a * b for a, b in zip(q, x)) for _, _, x in rows]
        order = sorted((j for j in range(len(rows)) if len(rows[j][2]) == len(q)),
                       key=lambda j: (-s[j], rows[j][0] is None, rows[j][0] or 0, j))
        for p in [j for j in order if rows[j][1] == y and j != k][:5]:
            far = [j for j in order if rows[j][1] != y and 30 * s[p] <= 100 * s[j] <= 90 * s[p]][:10]
            out += [(i, rows[p][0], n, rows[j][0], s[p], s[j]) for n, j in enumerate(far, 1)]
    return sorted(out, key=str)


def made_vectors():
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(6, 8)) * 0.5
    rows = []
    for i in range(900):
        x = (centres[i % 6] + rng.normal(size=8) * 0.3).astype(np.float32).tolist()
        rows.append((i, x, int(rng.integers(0, 4))))
    same = rows[100][1]
    rows += [(1000 + i, same, i % 3) for i in range(300)]  # copies of one vector
    return rows + [(1301, None, 1), (1302, [1.0] * 8, None), (1303, [float("nan")] + [0.0] * 7, 1),
                   (1304, [None] + [0.0] * 7, 1), (None, [0.5] * 8, 2), (1400, [0.0] * 8, 1), (1500, [1.0, 2.0], 1),
                   (1501, [1.0, 3.0], 1), (1502, [0.5, 0.5], 2)]


def test_negatives_equal_brute_force(spark, monkeypatch):
    rows = made_vectors()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int") \
        .withColumns({c: F.lit("clash") for c in ("uid", "cell", "v", "score", "x")}).repartition(3)
    want = brute_negatives(rows)
    for budgets, chunk, cell in (((64, 256, None), 50, 16), (hard_negatives.BUDGETS, hard_negatives.CHUNK_ROWS, 256)):
        monkeypatch.setattr(hard_negatives, "BUDGETS", budgets)
        monkeypatch.setattr(hard_negatives, "CHUNK_ROWS", chunk)
        monkeypatch.setattr(hard_negatives, "CELL_ROWS", cell)
        got = sorted((tuple(r) for r in hard_negatives.hard_negatives(df).collect()), key=str)
        assert got == want
    assert hard_negatives.hard_negatives(df.where("false")).count() == 0


def test_the_heap_stops_early():
    """Far cells are neither asked for nor popped once a window is certified."""
    rng = np.random.default_rng(1)
    words = [rng.normal(size=(16, 4)) * 50 for _ in range(2)]
    index = hard_negatives.Index(words, [np.full(16, 5.0)] * 2, np.full(256, 10))
    q = np.concatenate([words[0][3], words[1][7]])
    top, popped = index.cells(q, 0, np.array([-np.inf]), np.array([np.inf]), 40)
    assert len(top) == 4 and popped == 4
    bar = float(q @ q) * 0.8
    rest, n = index.cells(q, popped, np.array([bar]), np.array([np.inf]), None)
    up1, up2, _, _ = index.bounds(q)
    assert set(top) | set(rest) == {a * 16 + b for a in range(16) for b in range(16) if up1[a] + up2[b] >= bar} | set(top)
    assert n < 256


# ------------------------------------------------------------ packing
def plan_cost(cuts, places, penalties, length):
    at = dict(zip(places, penalties))
    cost = 0
    for a, b in zip(cuts, cuts[1:]):
        size = b - a
        if size > length:
            return None
        cost += 1 + at[b] + (0 if size & (size - 1) == 0 else length - size)
    return cost


def test_cuts_equal_brute_force():
    rng = random.Random(7)
    for _ in range(60):
        length = rng.choice([8, 11, 16])
        places = [5]
        while len(places) < 11:
            places.append(places[-1] + rng.randint(1, 6))
        penalties = [0] + [rng.choice([0, 2, 5]) for _ in places[1:]]
        got = packing.best_cuts(places, penalties, length)
        plans = (plan_cost([places[0], *c, places[-1]], places, penalties, length)
                 for k in range(len(places)) for c in itertools.combinations(places[1:-1], k))
        assert got[0] == places[0] and got[-1] == places[-1]
        assert plan_cost(got, places, penalties, length) == min(p for p in plans if p is not None)


TRICKY = ["It's the dogs' end... can't we'll!", "Ünï¢ode ß É́ é Ａ１ ½ 東京タワー، مرحبا", "a<|endoftext|>b <|ENDOFTEXT|>",
          "x,,y.;z 3.14 1,000", "tab\tnew\nline nbsp em\x1cfs", "?!", "''s 'S don't.", "Straße ΣΑΣ İI ǅ", "́a"]


def check_pieces(rows, pieces, length=2048):
    from tokenizers import Tokenizer
    model = Tokenizer.from_file(packing.default_tokenizer())
    want = Counter()
    for doc_id, text in rows:
        ids = np.array(model.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
        want[doc_id, len(ids), zlib.crc32(ids.tobytes())] += 1
    whole = {k: n for k, n in want.items() if k[1] == 0}
    assert not whole
    by_sequence, tokens = {}, Counter()
    for p in pieces:
        by_sequence.setdefault(p.sequence_id, []).append((p.offset, p.length))
        tokens[p.doc_id, p.doc_tokens] += p.length
    for parts in by_sequence.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at and n > 0
            at += n
        assert at <= length
    for (doc_id, n, _), times in want.items():
        same = sum(t for (d, m, _), t in want.items() if (d, m) == (doc_id, n))
        assert tokens[doc_id, n] == n * same
    assert sum(tokens.values()) == sum(n * t for (_, n, _), t in want.items())
    one = {k: n for k, n in want.items() if sum(t for (d, _, _), t in want.items() if d == k[0]) == 1}
    for doc_id, n, _ in one:
        text = next(t for d, t in rows if d == doc_id)
        ids = np.array(model.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
        at = 0
        for p in sorted((p for p in pieces if p.doc_id == doc_id), key=lambda p: p.start):
            assert p.start == at and p.ids_crc32 == zlib.crc32(ids[at:at + p.length].tobytes())
            at += p.length
        assert at == n
    return by_sequence


def test_ids_equal_the_tokenizer():
    from tokenizers import Tokenizer
    model = Tokenizer.from_file(packing.default_tokenizer())
    ids = packing.Ids(packing.default_tokenizer())
    texts = [*TRICKY, *(t for _, t, *_ in ROWS if t), " ".join(TRICKY), "", "The the THE. the! The!! a!b ! é.É!"]
    for _ in range(2):  # learnt, then known
        for text, (got, stops) in zip(texts, ids.encode([t.encode() for t in texts])):
            assert got.tolist() == model.encode(text, add_special_tokens=False).ids + [1], text
            assert all(0 < s < len(got) for s in stops)


def test_packing_on_nasty_rows(spark, docs, empty):  # noqa: F811
    rows = [(r[0], r[1]) for r in ROWS] + [(100 + i, t) for i, t in enumerate(TRICKY)]
    df = docs.select("doc_id", "text", "size").unionByName(
        spark.createDataFrame(rows[len(ROWS):], "doc_id long, text string").withColumn("size", F.lit("clash")))
    for block in (packing.BLOCK_TOKENS, 20_000):
        check_pieces(rows, packing.pack(df, block_tokens=block).collect())
    check_pieces(rows, packing.pack(df, length=100).collect(), 100)
    assert packing.pack(empty).count() == 0


def test_stretches_do_not_show(spark, monkeypatch):
    """A block planned in stretches costs hardly more than planned at once."""
    text = " ".join("one two three four five. six seven, eight! nine" for _ in range(3000))
    df = spark.createDataFrame([(i, text[:7000 + 911 * i]) for i in range(40)], "doc_id long, text string").coalesce(1)

    def waste():
        sizes = [sum(n for _, n in s) for s in check_pieces([(r.doc_id, r.text) for r in df.collect()],
                                                            packing.pack(df).collect()).values()]
        return sum(0 if n & (n - 1) == 0 else 2048 - n for n in sizes), sum(sizes)
    at_once, total = waste()
    monkeypatch.setattr(packing, "STRETCH", 1 << 15)
    in_stretches, _ = waste()
    assert at_once < 0.01 * total and in_stretches < 0.01 * total


@needs_data
def test_packing_wastes_little(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    sizes = [sum(n for _, n in s) for s in check_pieces([tuple(r) for r in df.collect()], packing.pack(df).collect()).values()]
    assert sum(0 if n & (n - 1) == 0 else 2048 - n for n in sizes) < 0.01 * sum(sizes)


def test_words_are_looked_up_once_a_batch():
    """Repeated words cost no look-up each; odd white space, empty and null texts keep their ids."""
    ids = packing.Ids(packing.default_tokenizer())

    class Counting(type(ids.known)):
        asked = 0

        def __getitem__(self, key):
            Counting.asked += 1
            return super().__getitem__(key)

    ids.known = Counting()
    texts = [b"Word, other.\x0b\x1cword " * 2000, b"", None, b" \t\n", b"\xc2\xa0word\x0cother.",
             "R\u00e9. r\u00c9, re\u0301! \u0130. \u00bb. a\u0301\u0338? \u01c6: \u00aa. \u00b2. \u0416. \u00e9\u0307.".encode()]
    got = ids.encode(texts)
    assert Counting.asked <= 17
    for text, (found, stops) in zip(texts, got):
        whole = ids.tokenizer.encode((text or b"").decode(), add_special_tokens=False).ids
        assert found.tolist() == [*whole, packing.END_ID]
    assert [len(s) for _, s in got][:5] == [2000, 0, 0, 0, 1]
