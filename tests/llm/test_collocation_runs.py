"""Phrases counted as runs of hashed keys, and the order of tied prefixes."""

import random

import numpy as np
import pyarrow as pa
import pytest

from pitpanel.llm import collocations
from pitpanel.llm.common import word_hashes
from tests.llm.test_new_methods import brute_phrases, made_texts


def test_tied_prefixes_are_expanded_by_count(spark, monkeypatch):
    """300 pairs whose words always stand together tie at the highest bound; those
    of too low a count for the list are never looked for."""
    rows = [("en", f"left{i} right{i}. alone{i}.") for i in range(300) for _ in range(6 + i)]
    random.Random(1).shuffle(rows)
    sought, inner = [], collocations.sought_hashes

    def counted(found, *more):
        sought.append(found.num_rows)
        return inner(found, *more)

    monkeypatch.setattr(collocations, "sought_hashes", counted)
    df = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    got = sorted(tuple(r) for r in collocations.collocations(df, top=12, min_count=6).collect())
    assert got == brute_phrases(rows, 12, 6) and len(got) == 12
    assert 12 <= sum(sought) <= 60


def test_words_that_share_a_hash_are_told_apart(spark):
    """The first hashes fall into 50 classes, so words and languages clash."""
    def hashed(words, seed):
        return word_hashes(words) if seed else word_hashes(words) % np.uint64(50)

    rows = made_texts()
    df = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    got = sorted(tuple(r) for r in collocations.collocations(df, min_count=6, hashed=hashed).collect())
    assert got == brute_phrases(rows, 2000, 6)


@pytest.mark.parametrize("run", [1, 7, 1 << 20])
def test_a_task_sends_runs_not_a_row_for_each_phrase(monkeypatch, run):
    """However the keys are cut into runs, and also where keys share a hash, the sums are those of the phrases."""
    monkeypatch.setattr(collocations, "RUN", run)
    monkeypatch.setattr(collocations, "phrase_hashes", lambda columns: columns[-1] // np.uint64(1 << 62) * np.uint64(1 << 62))
    rng = np.random.default_rng(3)
    keys, f = rng.integers(0, 2**63, (9, 3)).astype(np.uint64)[rng.integers(0, 9, 200)], rng.integers(1, 5, 200)
    runs = collocations._Runs(2)
    sent = [*runs.add(2, keys, f), *runs.rest()]
    if run > 200:
        assert sum(b.num_rows for b in sent) <= 4
    whole = pa.Table.from_batches(sent).sort_by([("m", "ascending"), ("part", "ascending")]).to_batches()
    got = {}
    for b in collocations._sums(30)(whole):
        for m, n, key in zip(*(b.column(c).to_pylist() for c in ("m", "f", "key"))):
            assert m == 2 and tuple(key) not in got
            got[tuple(key)] = n
    want = {}
    for key, n in zip(keys.view(np.int64).tolist(), f.tolist()):
        want[tuple(key)] = want.get(tuple(key), 0) + n
    assert got == {k: n for k, n in want.items() if n >= 30} and got


def test_words_split_by_bytes():
    texts = [None, b"", b" \t ", b"a.b..c", "É!É x".encode(), b".", b"A  b\n", b"\xff x"]
    words, n = collocations.split_words(texts)
    want = [(((t or b"").translate(collocations._TABLE) + b"\xff").replace(b"\xff", b" \xff ")).split() for t in texts]
    assert words.to_pylist() == sum(want, []) and n.tolist() == [len(w) for w in want]
