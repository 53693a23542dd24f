"""The operators against brute force, and the parts that carry the methods."""

import os
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from pitpanel.llm import (
    decontamination, language_id, licenses, mixing, near_dedup, pii, sharding, substring_dedup, toxicity)
from pitpanel.llm import catalog
from pitpanel.llm.common import drop_stage, window_hashes, word_hashes, write_stage

SF = "/root/testdata/sf0.001"
SF_LABELS = "/root/testdata/sf0.01"
needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


@needs_data
@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_query_matches_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for table in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF}/{table}.parquet')")
    got = catalog.QUERIES[name](spark, SF).toPandas()
    want = con.sql(catalog.ORACLE_SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    key = [c for c in ("doc_id", "lang", "anchor_id", "positive_id", "rank") if c in want]
    got, want = (x[sorted(x.columns)].sort_values(key).reset_index(drop=True) for x in (got, want))
    assert len(got) == len(want)
    for c in want.columns:
        assert ((got[c] == want[c]) | (got[c].isna() & want[c].isna())).all(), c


def test_window_hashes_depend_on_content_only():
    words = [b"a", b"b", b"c", b"a", b"b", b"c", b"d"] * 20
    h = word_hashes(words)
    for length in (1, 2, 3, 7, 18, 35):
        got = window_hashes(h, length)
        groups = {}
        for p in range(len(words) - length + 1):
            groups.setdefault(tuple(words[p:p + length]), set()).add(int(got[p]))
        assert all(len(v) == 1 for v in groups.values()) and len(groups) == len(set(map(int, got)))


def test_anchors_are_shared_by_equal_windows():
    rng = np.random.default_rng(3)
    for _ in range(20):
        words = [b"%d" % i for i in rng.integers(0, 3, 120)]
        h = word_hashes(words)
        left = len(words) - np.arange(len(words))
        halves, least = substring_dedup.anchors(h, left, 35)
        assert all(least[p] in halves[p:p + 18] for p in range(len(words) - 34))


def test_near_copies_in_one_crowded_table(spark):
    """Copies with edits of one base, some close to each other only: links
    must equal those of brute force, whatever the star's centre is."""
    rng = np.random.default_rng(5)
    base = [f"b{i}" for i in range(120)]
    rows = []
    for k in range(150):
        words = list(base)
        for i in rng.choice(120, rng.integers(0, 9), replace=False):
            words[i] = f"e{rng.integers(0, 40)}"
        rows.append((k, " ".join(words)))
    sets = {k: {tuple(t.split()[i:i + 4]) for i in range(117)} for k, t in rows}
    parent = {k: k for k in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a in sets:
        for b in range(a):
            if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    got = near_dedup.near_dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), shingle=4).collect()
    assert {r.doc_id: r.component_id for r in got} == {k: find(k) for k in sets}


def test_parity_sketches_never_overstate_a_difference():
    rng = np.random.default_rng(3)
    for n, m, shared in [(0, 5, 0), (30, 30, 30), (200, 190, 150), (3000, 2500, 2000)]:
        x = rng.integers(0, 2**63, n + m - shared, dtype=np.uint64)
        a, b = x[:n], x[n - shared:]
        ones = sum(int(i).bit_count() for i in (near_dedup.parity_sketch(a) ^ near_dedup.parity_sketch(b)).view(np.uint64))
        assert ones <= n + m - 2 * shared
        assert (ones == 0) == (n + m == 2 * shared)


def test_stars_need_no_shuffle_of_their_own(spark):
    rows = [("t", 1, 1), ("t", 2, 1), ("t", 5, 5), ("t", 7, 7), ("t", 8, 7), ("u", 1, 1), ("u", 2, 1)]
    open_ = write_stage(near_dedup._led(spark.createDataFrame(rows, "table string, node long, comp long")), "open")
    stars = near_dedup._stars(open_)
    assert "Exchange" not in stars._jdf.queryExecution().executedPlan().toString()
    low, high = [(2, 5, 1, 5), (2, 7, 1, 7), (2, 8, 1, 7)], [(1, 7, 1, 7), (2, 7, 1, 7), (5, 7, 5, 7)]
    assert sorted(map(tuple, stars.collect())) == sorted(low + high)


def test_dropping_a_stage_collects_the_drivers_garbage(spark):
    stage = write_stage(spark.range(3), "few")
    left = spark._jvm.java.lang.ref.WeakReference("nothing but this reference has the Java copy")
    drop_stage(stage)
    assert left.get() is None


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "a long, b long")
    got = {r.node: r.comp for r in near_dedup.components(edges).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}


def _base(text):
    def luhn(d):
        return sum(int(c) if k % 2 == 0 else 2 * int(c) - (9 if int(c) > 4 else 0) for k, c in enumerate(reversed(d))) % 10 == 0
    checks = [
        (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
        (r"[0-9]([\x20-]?[0-9])+", lambda m: 16 <= len(re.sub("[^0-9]", "", m)) <= 19 and luhn(re.sub("[^0-9]", "", m))),
        (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= len(re.sub("[^0-9]", "", m)) <= 15)]
    return [f"{kind}:{m.start()}:{m.end()}" for kind, (p, ok) in zip(pii.KINDS, checks) for m in re.finditer(p, text) if ok(m[0])]


def test_base_spans_equal_the_plain_expressions(spark):
    rng = np.random.default_rng(7)
    alphabet = ["1", "25", "0", "4111", "a", "B", "@", ".", "-", " ", "+", "(", ")", "_", "%", "é", "😀", "\n", "256", "1.2.3.4",
                "4111111111111111", "x@y.z", "+1 555"]
    rows = [(i, "".join(rng.choice(alphabet, rng.integers(1, 40)))) for i in range(1500)]
    got = {r.doc_id: r.spans for r in pii.find_pii(spark.createDataFrame(rows, "doc_id long, text string"), rounds=1).collect()}
    want = {i: ",".join(_base(t)) for i, t in rows}
    assert all(got[i].startswith(want[i]) or set(want[i].split(",")) <= set(got[i].split(",")) for i in want)
    assert sum(got[i] == want[i] for i in want) > 1300


def test_bootstrap_finds_unseen_identifiers(spark):
    """Numbers in a context that seeds establish are found; the same shape in
    a context without seeds is not."""
    rows = [(i, f"some words then phone number: +1 555 010 {1000 + i} thanks") for i in range(30)]
    rows += [(100 + i, f"other words here phone number: 010-22{i:02d} thanks") for i in range(3)]
    rows += [(200 + i, f"the room of the house: 010-33{i:02d} and so on") for i in range(10)]
    got = {r.doc_id: r for r in pii.find_pii(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [got[100 + i].spans for i in range(3)] == ["phone:31:39"] * 3
    assert all(got[100 + i].n_phone == 0 and got[100 + i].n_context == 1 for i in range(3))
    assert all(got[200 + i].spans == "" for i in range(10)) and got[0].n_phone == 1 and got[0].n_context == 0


def test_bootstrap_takes_addresses_and_whole_tokens(spark):
    """IP spans of any octets are seeds, also behind a label, and unseen
    identifiers that begin with digits are found whole."""
    rows = [(i, f"the server at host address 192.168.{i}.10 is up") for i in range(20)]
    rows += [(50 + i, f"log line with ip=203.0.{i}.113 was seen") for i in range(20)]
    rows += [(100, "the server at host address 203.0.113.300 is up"), (101, "log line with ip=10.0.0.999 was seen"),
             (102, "the server at host address 12ab34 is up"), (103, "the server at host address 4111 1111 is up")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    seeds = [r for r in pii.candidates(pii.with_base_spans(docs, context=True)).collect() if r.kind == "ip"]
    assert sorted(r.value for r in seeds) == sorted([f"192.168.{i}.10" for i in range(20)] + [f"203.0.{i}.113" for i in range(20)])
    got = {r.doc_id: r.spans for r in pii.find_pii(docs).collect()}
    assert {k: got[k] for k in (100, 101, 102, 103)} == {100: "ip:27:40", 101: "ip:17:27", 102: "ip:27:33", 103: "ip:27:36"}
    assert got[0] == "ip:27:39" and got[50] == "ip:17:28"


def test_reparameterised_question(spark):
    item = ("A train leaves Paris at 9 and travels 120 km to reach the town of Lyon while another train "
            "leaves at 9 and needs 2 hours for the way back to the north")
    same = item.replace("120", "480").replace("Lyon", "Nantes").replace(" 9", " 7").replace("2 hours", "5 hours")
    mixed = item.replace("at 9", "at 7", 1).replace("the town", "a village").replace("another train", "one more bus")
    docs = spark.createDataFrame([(1, "Here it is: " + item), (2, "Now solve. " + same + " Good luck."), (3, mixed[:70]),
                                  (4, "A train leaves the town at 9")], "doc_id long, text string")
    bench = spark.createDataFrame([(7, item)], "item_id long, text string")
    got = {r.doc_id: r for r in decontamination.decontaminate(docs, bench).collect()}
    assert set(got) == {1, 2}
    assert got[1].changed_slots == 0 and got[2].changed_slots >= 4 and got[2].consistency == 1.0


def test_shifted_diagonals_do_not_outvote_a_copy(spark):
    """Runs of numbers align with themselves on shifted diagonals; a worksheet
    holds an exact copy beside variants whose values are mixed up."""
    items = ["find the mode of the list 3 7 3 5 7 3 9 3 7 and give its value",
             "sort the list 4 4 1 2 1 2 2 1 in rising order",
             "add 5 apples and 5 pears and 5 plums and 5 figs and 5 nuts to the 5 boxes"]
    variants = [f"add {a} apples and {a + 1} pears and {a + 2} plums and {a + 3} figs and {a + 4} nuts to the {a + 5} boxes"
                for a in range(10, 80, 10)]
    docs = spark.createDataFrame(
        [(0, items[0]), (1, "Task: " + items[1] + " please"), (2, ". ".join(variants[:4] + [items[2]] + variants[4:])),
         (3, variants[0]), (4, items[1].replace("4", "8").replace("1", "6"))], "doc_id long, text string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = {(r.doc_id, r.item_id): r for r in decontamination.decontaminate(docs, bench).collect()}
    assert {(0, 0), (1, 1), (2, 2), (4, 1)} <= set(got) and (3, 2) not in got
    assert all(got[k].consistency == 1.0 and got[k].changed_slots == 0 for k in ((0, 0), (1, 1), (2, 2)))
    assert got[4, 1].changed_slots > 0


def test_copies_in_another_case_or_layout(spark):
    items = ["Once Anna met Paul in Rome and then Carl went from Oslo to Bonn while Emma took Greta and Hans to Wien",
             "What is the capital of France?"]
    docs = spark.createDataFrame([(0, items[0].lower()), (1, items[0].replace(" ", "\n")), (2, "Q: " + items[1] + " A: Paris"),
                                  (3, "what is the price of it")], "doc_id long, text string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontamination.decontaminate(docs, bench).collect()}
    assert got == {(0, 0), (1, 0), (2, 1)}


def test_placeholders_alone_are_no_copy(spark):
    """Runs of numbers, and the pieces of an item scattered over a text, are
    clean; the same values in order are not."""
    items = ["12 + 5 * 3 - 4 / 2 =", "the quick brown fox jumps over the lazy dog near the old river bank today at noon"]
    words = items[1].split()
    pieces = " . ".join(" ".join(words[i:i + 5]) for i in reversed(range(len(words) - 4)))
    docs = spark.createDataFrame(
        [(0, "open ports are 80 443 8080 22 21 on that host"), (1, "scores 1 2 3 4 5 6 7 8 9 10"), (2, pieces),
         (3, "compute 12 + 5 * 3 - 4 / 2 = please"), (4, "and " + items[1] + " again"),
         (5, "12 + 5 * 3 - 4 / 7 ="), (6, "values 3 + 1 * 2 - 9 / 8 =")], "doc_id long, text string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontamination.decontaminate(docs, bench).collect()}
    assert got == {(3, 0), (4, 1)}
    left = {r.doc_id for r in decontamination.clean_documents(docs, bench).collect()}
    assert left == {0, 1, 2, 5, 6}


def test_names_first_short_items_and_passages(spark):
    """Names at a sentence start, items under a window, an inserted word and a
    long part of an item."""
    rng = np.random.default_rng(3)
    long_item = " ".join(f"w{chr(97 + a)}{chr(97 + b)}" for a, b in rng.integers(0, 26, (200, 2)))
    part = " ".join(long_item.split()[70:130])
    items = ["Alice buys 3 apples from Bob", "Name the largest planet", long_item, "Paris",
             "Once upon a time there was a tiny house in the deep green forest by the lake"]
    docs = spark.createDataFrame(
        [(0, "Carol buys 9 apples from Dave"), (1, "well. Eve buys 41 apples from Finn. ok"), (2, "Q name the largest planet now"),
         (3, "intro " + part + " outro"), (4, "intro " + " ".join(part.split()[:40])), (5, "Paris"), (6, "we saw Paris today"),
         (7, items[4].replace("tiny house", "tiny little house")), (8, "the largest of all the planets")], "doc_id long, text string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = {(r.doc_id, r.item_id): r for r in decontamination.decontaminate(docs, bench).collect()}
    assert set(got) >= {(0, 0), (1, 0), (2, 1), (3, 2), (5, 3)} and set(got) <= {(0, 0), (1, 0), (2, 1), (3, 2), (5, 3), (7, 4)}
    assert got[0, 0].changed_slots == 3 and got[0, 0].consistency == 1.0


@needs_data
def test_decontamination_against_substrings(spark):
    def norm(t):
        return " ".join(re.findall(r"\w+", (t or "").lower()))
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    bench = spark.read.parquet(f"{SF}/benchmark.parquet").collect()
    want = {(d.doc_id, b.item_id) for d in docs for b in bench if f" {norm(b.text)} " in f" {norm(d.text)} "}
    got = {(r.doc_id, r.item_id) for r in catalog.op3_decontamination(spark, SF).collect()}
    assert want and got == want


@needs_data
def test_licenses_against_containment(spark):
    templates = {k: v for k, v in licenses.TEMPLATES.items()}
    found = licenses.template_classes(templates)
    want = set()
    for d in spark.read.parquet(f"{SF_LABELS}/documents.parquet").collect():
        have = licenses.shingle_hashes(d.text.encode())
        for block, group in found.items():
            for name, shingles in group:
                for at in range(0, max(1, len(have)), block):
                    if np.isin(shingles, have[at:at + 2 * block]).mean() >= 0.8:
                        want.add((d.doc_id, name))
    got = {(r.doc_id, r.license) for r in catalog.op6_licenses(spark, SF_LABELS).collect()}
    assert want and got == want


def test_sharding_walk_keeps_most_rows_at_home():
    rng = np.random.default_rng(1)
    counts = rng.integers(0, 60, sharding.RING_SLOTS).tolist()
    owner = sharding.ring_points(16, 32)
    out = sharding.allot(counts, owner, 16)
    assert sum(b - a for _, a, b, _, _ in out) == sum(counts)
    per = Counter()
    for slot, a, b, shard, first in out:
        assert first == per[shard]
        per[shard] += b - a
    assert max(per.values()) - min(per.values()) <= 1
    assert sum(b - a for slot, a, b, shard, _ in out if owner[slot] == shard) > 0.7 * sum(counts)


def test_inverse_demand_inverts(spark):
    from pyspark.sql import functions as F
    df = spark.range(101).withColumn("x", F.col("id") / 100)
    for knots in mixing.SCHEDULES:
        total = sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(knots, knots[1:]))
        for r in df.select("x", mixing.inverse_demand(F.col("x"), knots).alias("t")).collect():
            area = 0.0
            for (t0, w0), (t1, w1) in zip(knots, knots[1:]):
                if r.t > t0:
                    end = min(r.t, t1)
                    w = w0 + (w1 - w0) * (end - t0) / (t1 - t0)
                    area += (end - t0) * (w0 + w) / 2
            assert abs(area / total - r.x) < 1e-9


def test_rank_order_profiles():
    codes = language_id.ngram_codes("aab")
    assert Counter(codes.tolist())[1] == 2 and len(codes) == 3 + 4 + 3
    assert language_id.top_codes(np.array([5, 5, 9, 2, 9, 7]), 3).tolist() == [5, 9, 2]
    assert len(language_id.ngram_codes("123 !?")) == 0


@needs_data
def test_language_accuracy(spark):
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF_LABELS}/documents.parquet").collect()}
    held = [r for r in catalog.op9_language_id(spark, SF_LABELS).collect() if r.held_out]
    assert all(zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in held)
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in held]) > 0.98


def test_machine_learns_a_pair():
    """Two terms that matter only together."""
    rng = np.random.default_rng(2)
    docs, labels = [], []
    for _ in range(1500):
        a, b = rng.random() < 0.5, rng.random() < 0.5
        words = set(rng.integers(100, 130, 4).tolist()) | ({1} if a else set()) | ({2} if b else set())
        docs.append(np.array(sorted(words), np.int32))
        labels.append(float(a and b))
    model = toxicity.fit(docs, np.array(labels))
    pred = toxicity.logistic(model.margins(docs)) >= 0.5
    assert (pred == np.array(labels)).mean() > 0.97
    assert model.factors[[1, 2]].prod(axis=0).sum() > 0


def test_machine_learns_a_pair_without_marginal_effect():
    """Half the rows of either term are toxic, as half of all rows are: only
    the pair tells."""
    rng = np.random.default_rng(4)
    docs, labels = [], []
    for i in range(2000):
        a, b = i % 2 == 0, i % 4 < 2
        docs.append(np.array(sorted(set(rng.integers(100, 130, 4).tolist()) | ({1} if a else set()) | ({2} if b else set())),
                             np.int32))
        labels.append(float(a == b))
    model = toxicity.fit(docs, np.array(labels))
    pred = toxicity.logistic(model.margins(docs)) >= 0.5
    assert (pred == np.array(labels)).mean() > 0.97
    assert model.factors[[1, 2]].prod(axis=0).sum() > 0


@needs_data
def test_pipeline_stages(spark):
    import corpus_pipeline
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    n = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
    out = corpus_pipeline.run(spark, SF)
    rows = out.collect()
    assert 0 < len(rows) <= 3 * n
    sizes = Counter(r.shard for r in rows)
    assert max(sizes.values()) - min(sizes.values()) <= 1


def test_texts_of_candidates_are_joined_by_one_plan(spark, monkeypatch):
    """No broadcast of the candidates' digests, which grow with the documents."""
    from pitpanel.llm import decontamination as D
    plans, write = {}, D.write_stage

    def recorded(df, name, *args):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return write(df, name, *args)

    monkeypatch.setattr(D, "write_stage", recorded)
    item = "a train leaves the old station at 9 and reaches the far coast after 40 minutes of travel"
    docs = spark.createDataFrame([(1, "so " + item), (2, "nothing of the kind is here at all")], "doc_id long, text string")
    bench = spark.createDataFrame([(7, item)], "item_id long, text string")
    assert [(r.doc_id, r.item_id) for r in D.decontaminate(docs, bench).collect()] == [(1, 7)]
    assert any("SortMergeJoin [digest" in line and "LeftSemi" in line for line in plans["text_windows"].splitlines())
