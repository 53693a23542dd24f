"""Phrase collocations by best-first branch-and-bound growth.

Phrases grow word by word.  A prefix ``p`` with count ``f(p)`` and first word
``w`` bounds the score of itself and of all that grows from it: with ``a`` the
phrase's count, its first cut gives ``a / (l + r) <= a / (f(w) + a)``, which
rises with ``a <= f(p)``.  So ``bound(p) = floor(2000000 f(p) / (f(p) + f(w)))``
is admissible.

Texts are split into words once and written as codes, slice by slice.  One
pass over them counts words and pairs of words.  Then each round expands, for every
language, the best bounds of the frontier: it counts all extensions of those
phrases by one word to either side.  The right ones are the growth; both sides
together settle whether a longer phrase swallows the expanded one.  Three-word
parts that the score of a four-word phrase lacks are asked for in the same
pass.  Phrases are ordered by (score, count) and prefixes by (bound, count), as a
phrase that reaches the bound of its prefix has no higher count.  The ``top``-th
best settled phrase of a language only rises; a language is done when no prefix
of its frontier reaches it (ties included), and what does not reach it is dropped.

A pass counts keys: the 64-bit hashes of the language and of each word, packed
into sorted runs, so Spark moves a few large values instead of a row for each
phrase.  Words and languages travel with their keys; if two of them share a
hash, all is done again with other hashes, so a key is a phrase.

What a pass looks for is sent to the tasks as at most ``LIMIT`` hashes; a larger
round is dealt over several passes.  A hash that matches another phrase by
chance makes a task count that phrase too, whole: counts and keys are exact.

Defined results: null text counts as empty, null language as ``und``; rows
count once each, repeated rows and ids too; ties go by count, then by phrase in
byte order; an empty table gives no rows.  Extra columns are ignored.
"""

from __future__ import annotations

import contextlib
import itertools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pitpanel.llm.common import drop_stage, mix64, text_batches, word_hashes, write_stage

TOP = 2000
MIN_COUNT = 30
MAX_WORDS = 4
#: Phrases that one pass looks for; the tasks get their hashes (8 bytes each).
LIMIT = 1 << 18

#: Rows of keys that a task holds until they are sorted and summed.
RUN = 1 << 20

_BREAK = b"\xff"  # in no UTF-8 text
_UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_ENDS = b".,;:!?\n\x0b\x0c\r"
_TABLE = bytes.maketrans(_UPPER + _ENDS, _UPPER.lower() + _BREAK * len(_ENDS))


# ------------------------------------------------------------ inside tasks
def seeded_hashes(words: list[bytes], seed: int) -> np.ndarray:
    return word_hashes([b"%d " % seed + w for w in words] if seed else words)


def phrase_hashes(columns) -> np.ndarray:
    """Hashes of phrases: a column for the language and one for each word."""
    h = mix64(columns[0])
    for c in columns[1:]:
        h = _longer(h, c)
    return h


def _longer(h: np.ndarray, word: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix64(h * np.uint64(0x9FB21C651E98DF25) + word)


def split_words(texts: list[bytes | None]) -> tuple[pa.BinaryArray, np.ndarray]:
    """Words of the texts, with a break after each piece, and their number by text."""
    texts = [t or b"" for t in texts]
    raw = np.frombuffer((_BREAK.join(texts) + _BREAK).translate(_TABLE), np.uint8)
    stays, ends = (raw != 0x20) & (raw != 0x09), raw == _BREAK[0]
    first = stays & ends
    first[0] = stays[0]
    first[1:] |= stays[1:] & (~stays[:-1] | ends[:-1])
    body = raw[stays]
    offsets = np.append(np.flatnonzero(first[stays]), len(body)).astype(np.int32)
    words = pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(body)])
    until = np.searchsorted(np.flatnonzero(first), np.cumsum([len(t) + 1 for t in texts]))
    return words, np.diff(until, prepend=0).astype(np.int32)


def _tokenised(hashed, seed: int):
    """One row for each slice of texts: its distinct words, their hashes, and
    codes of the words, text after text."""

    def run(batches):
        for batch, texts in text_batches(batches):
            if not any(texts):
                continue
            found, per_text = split_words(texts)
            codes = found.dictionary_encode()
            of_lang = pa.array(batch.column("lang").to_pylist(), pa.string()).dictionary_encode()
            langs, text = of_lang.dictionary.to_pylist(), pc.binary_join(
                pa.ListArray.from_arrays([0, len(codes.dictionary)], codes.dictionary), b"\n")[0].as_py()
            words = text.split(b"\n")
            yield pa.RecordBatch.from_arrays(
                [pa.array([langs], pa.list_(pa.string())), pa.array([words.index(_BREAK)], pa.int32()),
                 *(pa.array([x], pa.binary()) for x in (
                     hashed([x.encode() for x in langs], seed).tobytes(), of_lang.indices.to_numpy().astype(np.int32).tobytes(),
                     per_text.tobytes(), text, hashed(words, seed).tobytes(),
                     codes.indices.to_numpy().astype(np.int32).tobytes()))],
                ["langs", "break_id", "lang_hashes", "text_lang", "text_words", "words", "hashes", "ids"])

    return run


_TOKENS = "langs array<string>, break_id int, lang_hashes binary, text_lang binary, text_words binary, words binary, " \
          "hashes binary, ids binary"
#: What a pass reads that needs no words.
_CODES = ["break_id", "lang_hashes", "text_lang", "text_words", "hashes", "ids"]
#: Slices that Parquet's reader holds at once (each about as large as its text),
#: and bytes handed to a task at once.
_SLICES_PER_BATCH, _BATCH_BYTES = 4, 1 << 23


class _Slice:
    """The words of a slice of texts as codes."""

    def __init__(self, batch: pa.RecordBatch, k: int) -> None:
        of = lambda name, kind: np.frombuffer(batch.column(name)[k].as_buffer(), kind)
        self.ids = of("ids", np.int32)
        self.word_hash, self.lang_hash = of("hashes", np.uint64), of("lang_hashes", np.uint64)
        self.lang = np.repeat(of("text_lang", np.int32), of("text_words", np.int32))
        self.is_word = self.ids != batch.column("break_id")[k].as_py()
        self.columns = [self.lang_hash[self.lang], self.word_hash[self.ids]]

    def starts(self, m: int) -> np.ndarray:
        """Mask of the positions where ``m`` words stand in one piece."""
        n = max(len(self.ids) - m + 1, 0)
        ok = np.ones(n, bool)
        for k in range(m):
            ok &= self.is_word[k:k + n]
        return ok

    def keys(self, m: int, at: np.ndarray) -> np.ndarray:
        """Keys of the ``m``-word phrases that start at the positions ``at``."""
        out = np.empty((len(at), m + 1), np.uint64)
        out[:, 0] = self.columns[0][at]
        for k in range(m):
            out[:, k + 1] = self.columns[1][at + k]
        return out

    def each_word(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Language and code of each word, and its count."""
        key = self.lang.astype(np.int64) * len(self.word_hash) + self.ids
        key, n = np.unique(key[self.is_word], return_counts=True)
        return *np.divmod(key, len(self.word_hash)), n


def _slices(batches):
    for batch in batches:
        for k in range(batch.num_rows):
            yield batch, k, _Slice(batch, k)


def summed(keys: np.ndarray, f: np.ndarray, names: pa.Array | None):
    """Distinct keys in the order of their hashes, their sums of ``f``, their
    names and hashes, and whether a key has two names."""
    h = phrase_hashes(keys.T)
    order = np.argsort(h)
    of = h[order]
    new = np.append(True, of[1:] != of[:-1])
    again = np.flatnonzero(~new)
    if (np.take(keys, order[again], 0) != np.take(keys, order[again - 1], 0)).any():  # other keys with the same hash
        order = np.lexsort((*keys.T, h))
        new[1:] = (keys[order[1:]] != keys[order[:-1]]).any(axis=1)
        again = np.flatnonzero(~new)
    first, clash = np.flatnonzero(new), False
    if names is not None:
        clash = len(again) > 0 and not pc.all(pc.equal(*(names.take(pa.array(order[x])) for x in (again, again - 1)))).as_py()
        names = names.take(pa.array(order[first]))
    return np.take(keys, order[first], 0), np.add.reduceat(f[order], first), names, of[first], clash


#: The keys of one run whose hashes begin with the bits ``part``; ``m`` is -1
#: where two words or languages share a hash.
_RUNS = "m int, part int, keys binary, f binary, names array<binary>"
_SUMS = "m int, f long, key array<long>, name binary"


class _Runs:
    """Keys of a task, sorted and summed each time ``RUN`` rows have come."""

    def __init__(self, bits: int) -> None:
        self.bits, self.held = bits, {}

    def add(self, m: int, keys: np.ndarray, f: np.ndarray | None = None, names: pa.Array | None = None):
        f = np.ones(len(keys), np.int64) if f is None else f.astype(np.int64)
        for at in range(0, len(keys), RUN):
            held = self.held.setdefault(m, [])
            held.append((keys[at:at + RUN], f[at:at + RUN], None if names is None else names[at:at + RUN]))
            if sum(len(x[0]) for x in held) >= RUN:
                yield from self.packed(m)

    def rest(self):
        for m in list(self.held):
            yield from self.packed(m)

    def packed(self, m: int):
        keys, f, names = zip(*self.held.pop(m))
        keys, f, names, h, clash = summed(np.concatenate(keys), np.concatenate(f), pa.concat_arrays(names) if m < 2 else None)
        part = (h >> np.uint64(64 - self.bits)).astype(np.int32)
        edges = np.append(np.flatnonzero(np.diff(part, prepend=-1)), len(part)).astype(np.int32)
        n = len(edges) - 1
        binary = lambda x: pa.Array.from_buffers(pa.binary(), n, [
            None, pa.py_buffer(edges * np.int32(x.nbytes // len(x))), pa.py_buffer(x)])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(n, -1 if clash else m, np.int32)), pa.array(part[edges[:-1]]), binary(keys), binary(f),
             pa.nulls(n, pa.list_(pa.binary())) if names is None else pa.ListArray.from_arrays(pa.array(edges), names)],
            ["m", "part", "keys", "f", "names"])


def _words_and_pairs(bits: int):
    def run(batches):
        runs = _Runs(bits)
        for batch, k, s in _slices(batches):
            lang, word, n = s.each_word()
            names = pa.array(batch.column("words")[k].as_py().split(b"\n"), pa.binary())
            yield from runs.add(1, np.column_stack([s.lang_hash[lang], s.word_hash[word]]), n, names.take(pa.array(word)))
            langs = pa.array(batch.column("langs")[k].as_py(), pa.string()).cast(pa.binary())
            n = np.bincount(s.lang[s.is_word], minlength=len(langs))
            yield from runs.add(0, s.lang_hash[:, None], n, langs)
            yield from runs.add(2, s.keys(2, np.flatnonzero(s.starts(2))))
        yield from runs.rest()

    return run


def _sums(min_count: int):
    """Sums over all runs: keys of ``min_count`` or more, and all languages."""

    def total(m, blobs):
        if m < 0:
            return pa.RecordBatch.from_arrays([pa.array([-1], pa.int32()), pa.array([0], pa.int64()),
                                               pa.array([[]], pa.list_(pa.int64())), pa.nulls(1, pa.binary())], names)
        keys, f, name = zip(*blobs)
        keys, f, name, _, clash = summed(np.frombuffer(b"".join(keys), np.uint64).reshape(-1, m + 1),
                                         np.frombuffer(b"".join(f), np.int64), pa.concat_arrays(name) if m < 2 else None)
        if clash:
            return total(-1, None)
        kept = np.flatnonzero(f >= min_count) if m else np.arange(len(f))
        flat = pa.array(np.ascontiguousarray(keys[kept]).view(np.int64).ravel())
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(kept), m, np.int32)), pa.array(f[kept]),
             pa.ListArray.from_arrays(pa.array(np.arange(len(kept) + 1, dtype=np.int32) * np.int32(m + 1)), flat),
             pa.nulls(len(kept), pa.binary()) if name is None else name.take(pa.array(kept))], names)

    names = ["m", "f", "key", "name"]

    def run(batches):
        at, blobs = None, []
        for batch in batches:
            for k, of in enumerate(zip(batch.column("m").to_pylist(), batch.column("part").to_pylist())):
                if of != at and blobs:
                    yield total(at[0], blobs)
                    blobs = []
                at = of
                blobs.append((batch.column("keys")[k].as_py(), batch.column("f")[k].as_py(), batch.column("names")[k].values))
        if blobs:
            yield total(at[0], blobs)

    return run


class _Hashes:
    """Membership in a sorted array, behind a table of the leading bits."""

    def __init__(self, values: np.ndarray) -> None:
        self.values = np.sort(values)
        bits = min(max(int(len(values)).bit_length() + 3, 8), 24)
        self.shift = np.uint64(64 - bits)
        self.table = np.zeros(1 << bits, bool)
        self.table[(values >> self.shift).astype(np.int64)] = True

    def has(self, h: np.ndarray) -> np.ndarray:
        out = self.table[(h >> self.shift).astype(np.int64)]
        some = np.flatnonzero(out)
        if len(some):
            at = np.minimum(np.searchsorted(self.values, h[some]), len(self.values) - 1)
            out[some] = self.values[at] == h[some]
        return out


def _extensions(shared, bits: int):
    """Counts of the phrases of three words that extend a sought pair or are
    sought themselves, and of four words that extend a sought phrase of three."""

    def run(batches):
        sought, runs = {k: _Hashes(v) for k, v in shared.value.items()}, _Runs(bits)
        for _, _, s in _slices(batches):
            if len(s.ids) < 3:
                continue
            word = s.columns[1]
            h2 = _longer(phrase_hashes([s.columns[0], word])[:-1], word[1:])
            pair, three = sought["pair"].has(h2) & s.starts(2), s.starts(3)
            h3 = _longer(h2[:-1], word[2:])
            yield from runs.add(3, s.keys(3, np.flatnonzero(three & (pair[:-1] | pair[1:] | sought["ask"].has(h3)))))
            if len(s.ids) >= 4:
                triple = sought["triple"].has(h3) & three
                yield from runs.add(4, s.keys(4, np.flatnonzero(s.starts(4) & (triple[:-1] | triple[1:]))))
        yield from runs.rest()

    return run


def sought_hashes(rows: pa.Table, hashed, seed: int) -> dict[str, np.ndarray]:
    """Hashes of the phrases (kind, lang, gram) that a pass looks for, by kind."""
    def of(x):
        x = x.combine_chunks().dictionary_encode() if isinstance(x, pa.ChunkedArray) else x.dictionary_encode()
        return hashed([w.encode() for w in x.dictionary.to_pylist()], seed)[x.indices.to_numpy()]

    out = {}
    for kind, m in (("pair", 2), ("triple", 3), ("ask", 3)):
        some = rows.filter(pc.equal(rows.column("kind"), kind))
        words = pc.split_pattern(some.column("gram").combine_chunks(), " ").flatten()
        out[kind] = phrase_hashes([of(some.column("lang")), *of(words).reshape(-1, m).T]) if len(some) else np.empty(0, np.uint64)
    return out


# ------------------------------------------------------------ on the driver
def _floor_ratio(a: str, l: str, r: str):
    """floor(2000000 a / (l + r)); the product is a decimal and may pass 64 bits."""
    return F.expr(f"(cast({a} as decimal(20,0)) * cast(2000000 as decimal(7,0))) "
                  f"div (cast({l} as decimal(20,0)) + cast({r} as decimal(20,0)))")


def _scored(grams: DataFrame, counts: DataFrame) -> DataFrame:
    """Bound and, where all parts are counted, lowest cut of each phrase
    (lang, gram, m, a).  A part not counted yet counts as ``a``, the least it
    can be, so the score is then a bound only (``cut`` is null)."""
    part = {name: counts.select("lang", F.col("gram").alias(name), F.col("f").alias(f"n_{name}"))
            for name in ("head", "tail")}
    cuts = grams.withColumn("k", F.explode(F.expr("sequence(1, m - 1)"))) \
        .withColumn("head", F.expr("substring_index(gram, ' ', k)")) \
        .withColumn("tail", F.expr("substring_index(gram, ' ', k - m)")) \
        .join(part["head"], ["lang", "head"], "left").join(part["tail"], ["lang", "tail"], "left") \
        .withColumn("l", F.coalesce("n_head", "a")).withColumn("r", F.coalesce("n_tail", "a")) \
        .withColumn("part_score", _floor_ratio("a", "l", "r"))
    return cuts.groupBy("lang", "gram", "m", "a").agg(
        F.min(F.struct("part_score", "k", "l", "r")).alias("cut"),
        F.max(F.when(F.col("k") == 1, F.col("l"))).alias("first"),
        F.bool_and(F.col("n_head").isNotNull() & F.col("n_tail").isNotNull()).alias("known")) \
        .withColumn("bound", F.least(_floor_ratio("a", "a", "first"), F.when(F.col("m") == MAX_WORDS, F.col("cut.part_score")))) \
        .withColumn("cut", F.when(F.col("known"), F.col("cut"))) \
        .select("lang", "gram", "m", "a", "cut", "bound")


def _nth_best(rows: DataFrame, column: str, n: int, name: str) -> DataFrame:
    """Per language the ``n``-th largest (``column``, a), as a struct; no row if
    there are fewer.  ``column`` has integers up to a million, so a language has a
    bounded histogram; the counts of one value of it are told apart after that."""
    each = rows.groupBy("lang", column, "a").agg(F.count("*").alias("_n"))
    w = Window.partitionBy("lang").orderBy(F.desc(column))
    level = each.groupBy("lang", column).agg(F.sum("_n").alias("_n")) \
        .withColumn("_sum", F.sum("_n").over(w)).where(F.col("_sum") >= n) \
        .groupBy("lang").agg(F.max(F.struct(column, F.expr(f"{n} - _sum + _n").alias("_left"))).alias("_level"))
    w = Window.partitionBy("lang").orderBy(F.desc("a"))
    return each.join(level, "lang").where(F.col(column) == F.col(f"_level.{column}")) \
        .withColumn("_sum", F.sum("_n").over(w)).where(F.col("_sum") >= F.col("_level._left")) \
        .groupBy("lang").agg(F.max(F.struct(F.col(column).alias("score"), "a")).alias(name))


def _with_longest(nodes: DataFrame, counted: DataFrame | None) -> DataFrame:
    """Nodes with ``dropped``: a longer candidate holds 80 % of their rows."""
    if counted is None:
        return nodes.withColumn("dropped", F.lit(False))
    inner = F.explode(F.array(F.expr("substring_index(gram, ' ', m - 1)"), F.expr("substring_index(gram, ' ', 1 - m)")))
    longest = counted.select("lang", inner.alias("gram"), "f").groupBy("lang", "gram").agg(F.max("f").alias("_f"))
    return nodes.join(longest, ["lang", "gram"], "left").withColumn(
        "dropped", F.coalesce(F.expr("cast(_f as decimal(20,0)) * 100 >= cast(a as decimal(20,0)) * 80"), F.lit(False))) \
        .drop("_f")


def collocations(docs: DataFrame, top: int = TOP, min_count: int = MIN_COUNT, limit: int = LIMIT,
                 hashed=seeded_hashes) -> DataFrame:
    """The ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score."""
    spark = docs.sparkSession
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), "text")
    # enough parts that the tasks that sum them get about equally many
    bits = (8 * int(spark.conf.get("spark.sql.shuffle.partitions"))).bit_length()

    def counted(slices, pass_):
        with _small_batches(spark):
            return write_stage(slices.mapInArrow(pass_, _RUNS).repartition("m", "part").sortWithinPartitions("m", "part")
                               .mapInArrow(_sums(min_count), _SUMS), "phrase_sums")

    for seed in itertools.count():
        slices = write_stage(texts.mapInArrow(_tokenised(hashed, seed), _TOKENS), "phrase_tokens")
        short = counted(slices, _words_and_pairs(bits))
        if short.where("m < 0").isEmpty():
            break
        drop_stage(slices)
        drop_stage(short)
    langs = short.where("m = 0").select(F.expr("key[0] as lang_key"), F.expr("cast(name as string) as lang"), F.col("f").alias("n"))
    words = write_stage(short.where("m = 1").select(F.expr("key[0] as lang_key"), F.expr("key[1] as word_key"),
                                                    F.expr("cast(name as string) as word"), "f")
                        .join(langs.drop("n"), "lang_key"), "phrase_words")

    def named(sums):
        """Phrases in place of keys; each word of a counted phrase is counted too."""
        each = sums.select("key", "m", "f", F.expr("key[0] as lang_key"), F.posexplode(F.expr("slice(key, 2, m)")).alias("at", "word_key"))
        return each.join(words.drop("f"), ["lang_key", "word_key"]).groupBy("key", "m", "f") \
            .agg(F.first("lang").alias("lang"), F.sort_array(F.collect_list(F.struct("at", "word"))).alias("found")) \
            .select("lang", F.expr("array_join(transform(found, x -> x.word), ' ') as gram"), "m", "f")

    base = write_stage(words.select("lang", F.col("word").alias("gram"), F.lit(1).alias("m"), "f")
                       .unionByName(named(short.where("m = 2"))), "phrase_base")

    def extended(sought):
        shared = spark.sparkContext.broadcast(sought_hashes(sought.toArrow(), hashed, seed))
        sums = counted(slices.select(_CODES), _extensions(shared, bits))
        shared.destroy()
        return named(sums)

    return _grown(base, langs.select("lang", "n"), extended, top, limit, lambda: drop_stage(slices))


@contextlib.contextmanager
def _small_batches(spark):
    """Rows that hold a slice each reach the tasks a few at a time."""
    small = {"spark.sql.execution.arrow.maxBytesPerBatch": _BATCH_BYTES, "spark.sql.parquet.columnarReaderBatchSize": _SLICES_PER_BATCH}
    before = {name: spark.conf.get(name) for name in small}
    for name, value in small.items():
        spark.conf.set(name, str(value))
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def _grown(base: DataFrame, n_words: DataFrame, extended, top: int, limit: int, ended) -> DataFrame:
    nodes = write_stage(_scored(base.where("m = 2").withColumnRenamed("f", "a"), base)
                        .withColumn("expanded", F.lit(False)), "phrase_nodes")
    least = F.struct(F.lit(0).cast("long").alias("score"), F.lit(0).cast("long").alias("a"))
    longer, size = None, 2 * top
    for rounds in itertools.count():
        state = _with_longest(nodes, longer)
        settled = state.where(F.col("cut").isNotNull() & ~F.col("dropped") & (F.col("expanded") | (F.col("m") == MAX_WORDS)))
        tau = _nth_best(settled.withColumn("score", F.col("cut.part_score")), "score", top, "tau")
        state = write_stage(state.join(tau, "lang", "left").withColumn("tau", F.coalesce("tau", least))
                            .where(F.struct("bound", "a") >= F.col("tau")), "phrase_state")
        frontier = state.where(~F.col("expanded") & (F.col("m") < MAX_WORDS))
        reach = _nth_best(frontier, "bound", size, "reach")
        chosen = frontier.join(reach, "lang", "left").where(F.struct("bound", "a") >= F.coalesce("reach", least)) \
            .select("lang", "gram", F.when(F.col("m") == 2, "pair").otherwise("triple").alias("kind"))
        ask = state.where(F.col("cut").isNull()).select("lang", F.explode(F.array(
            F.expr("substring_index(gram, ' ', 3)"), F.expr("substring_index(gram, ' ', -3)"))).alias("gram"),
            F.lit("ask").alias("kind")).distinct()
        todo = write_stage(chosen.unionByName(ask), "phrase_todo")
        n = todo.count()
        if n == 0:
            break
        if n > limit:
            part = F.pmod(F.xxhash64("lang", "gram", F.lit(rounds)), F.lit(-(-n // limit)))  # dealt anew each round
            todo = todo.where(part == 0)
        more = extended(todo.select("kind", "lang", "gram"))
        if longer is not None:
            more = more.unionByName(longer).distinct()
        longer = write_stage(more, "phrase_longer")
        done = todo.where("kind <> 'ask'").select("lang", "gram", F.lit(True).alias("_now"))
        keep = state.drop("dropped", "tau").where(F.col("cut").isNotNull())
        fresh = longer.withColumnRenamed("f", "a").join(keep.select("lang", "gram"), ["lang", "gram"], "left_anti")
        nodes = write_stage(
            keep.unionByName(_scored(fresh, base.unionByName(longer)).withColumn("expanded", F.lit(False)))
            .join(done, ["lang", "gram"], "left")
            .withColumn("expanded", F.col("expanded") | F.coalesce("_now", F.lit(False))).drop("_now"), "phrase_nodes")
        drop_stage(state)
        size = min(4 * size, 1 << 40)
    ended()
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    best = state.where(F.col("cut").isNotNull() & ~F.col("dropped") & (F.struct("cut.part_score", "a") >= F.col("tau"))) \
        .select("lang", F.col("gram").alias("phrase"), "a", "cut.l", "cut.r", F.col("cut.part_score").alias("score"))
    for keys in (["lang", F.pmod(F.xxhash64("phrase"), F.lit(64))], ["lang"]):  # ties of any number stay spread
        best = best.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))) \
            .where(F.col("rank") <= top)
    return best.join(n_words, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r",
                                             "n", "score")
