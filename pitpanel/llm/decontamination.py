"""Benchmark decontamination by template canonicalisation.

Texts are reduced to templates: numbers, names (capitalised words, wherever
they stand) and units after a number become typed placeholders, everything else
is lower-cased words; arithmetic signs are words too.  A text is tokenised
once, and its names also count as plain words, so a copy in another case is
found.  Windows of five tokens are hash-joined with the windows of the
benchmark items; a document is a candidate for an item when it has at least
80 % of the item's distinct windows, or as many as a passage of 50 words.

Candidates are then aligned (document position minus item position).  An item
is contained

* with its own values, if windows with equal values cover 80 % of it, or 50 words
  of it, within a band of diagonals no wider than two fifths of the item, so
  that pieces scattered over a text do not add up;
* re-parameterised, if one diagonal covers 80 % of its windows, each value of
  the item stands there for one value of the document (80 % of the slots), and
  enough of its template is words, not placeholders, to tell it from any run
  of numbers or names (three words and a third of the tokens).

Items of three or four tokens are found inside a text by windows of their own
length, if their values are equal; items of one or two only as a whole text.

The windows of the documents are not shuffled while the benchmark's windows
are few enough to broadcast (counted first, ``BROADCAST_WINDOWS``); beyond
that the same join is a shuffle join of the windows.  Only matches are grouped, with
partial aggregation, by text digest; the texts of candidates alone are read a
second time, and of their windows those that an item has are written.  All of
it is DataFrame expressions.

Defined results: null and empty texts or items match nothing; repeated rows
are reported each; items are told apart by item_id and text; an empty table on
either side gives an empty result.  Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitpanel.llm.common import fresh, text_digest, write_stage

WINDOW = 5
CONTAINED = 0.8
CONSISTENT = 0.8
#: Words of an item that count as a leaked passage of it.
PASSAGE = 50
#: Words, and their share of the tokens, that a re-parameterised item must have.
LITERALS = 3
LITERAL_SHARE = 1 / 3
#: Items with fewer tokens are found as whole texts only.
EMBEDDED = 3
#: Item windows (at most about 40 bytes each) that may be broadcast.
BROADCAST_WINDOWS = 1_000_000
#: Units that follow a number.
UNITS = ("mm", "cm", "m", "km", "g", "kg", "mg", "lb", "oz", "l", "ml", "s", "ms", "min", "h", "hours", "minutes",
         "seconds", "days", "weeks", "months", "years", "inches", "feet", "miles", "meters", "metres", "liters",
         "litres", "dollars", "euros", "cents", "percent", "degrees")
_MARK = "\u0001"
_NUMBER = r"[0-9]++(?:[.,:/-][0-9]++)*+"
# the capital first and what precedes it after, so most places fail at once
_NAME = r"\p{Lu}(?<![\p{L}\p{M}\p{N}]\p{Lu})\p{Ll}\p{L}*+"
_SIGN = "+*=<>^"


def template(text: Column, values: bool) -> Column:
    """The template of a text, its tokens parted by spaces; a placeholder is a
    mark and its type: ``p`` name, followed by the name, ``n`` number, ``u``
    unit, with ``values`` followed by what they stand for."""
    value = "$0" if values else ""
    t = F.replace(F.coalesce(text, F.lit("")), F.lit(_MARK), F.lit(" "))
    t = F.regexp_replace(t, _NAME, f" {_MARK}p$0 ")
    t = F.regexp_replace(t, _NUMBER, f" {_MARK}n{value} ")
    t = F.regexp_replace(t, rf"({_MARK}n{'[0-9.,:/-]++' if values else ''}\s{{1,4}})"
                            rf"({'|'.join(UNITS)})(?![\p{{L}}\p{{N}}])", f"$1{_MARK}u{'$2' if values else ''}")
    t = F.regexp_replace(t, f"[{_SIGN}]", " $0 ")
    inner = r"(?<![0-9])[.,:/-]++|[.,:/-]++(?![0-9])|" if values else ""
    keep = ".,:/-" if values else ""
    return F.lower(F.regexp_replace(t, rf"{inner}[^a-z\x20\p{{L}}\p{{M}}\p{{N}}{_MARK}{_SIGN}{keep}]++", " "))


def _tokens(template: Column) -> Column:
    return F.array_remove(F.split(template, " "), "")


def _masked(template: Column, names: bool, values: bool = True) -> Column:
    """The tokens of a template without values (without ``values`` it has none
    but the names); without ``names`` these are plain words."""
    kinds = ("n" if values else "") + ("p" if names else "") + ("u" if values else "")
    bare = F.regexp_replace(template, rf"{_MARK}([{kinds}])[^\x20]*+", f"{_MARK}$1") if kinds else template
    return _tokens(bare if names else F.replace(bare, F.lit(_MARK + "p"), F.lit("")))


def _windows(tokens: str, length: int) -> Column:
    """Hashes of all windows of ``length`` in ``tokens`` (a column name); of
    lengths under ``EMBEDDED`` only a whole text is a window."""
    parts = ", ".join(f"{tokens}[i + {k}]" for k in range(length))
    fits = f"size({tokens}) {'>=' if length >= EMBEDDED else '='} {length}"
    return F.expr(f"case when {fits} then transform(sequence(0, size({tokens}) - {length}), i -> xxhash64({length}, {parts}))"
                  " else cast(array() as array<bigint>) end")


def _items(benchmark: DataFrame) -> DataFrame:
    """(item, item_id, names, n_windows, n_literals, n_tokens, item_at, window,
    item_slots): all windows of every item, with names as placeholders and as
    words."""
    items = benchmark.select("item_id", text_digest("text").alias("item_text"), "text") \
        .dropDuplicates(["item_id", "item_text"]) \
        .select(F.xxhash64("item_id", "item_text").alias("item"), "item_id", template(F.col("text"), True).alias("c")) \
        .withColumn("t", _tokens(F.col("c"))) \
        .withColumn("n_tokens", F.size("t")) \
        .withColumn("n_literals", F.size(F.filter("t", lambda x: ~F.startswith(x, F.lit(_MARK)) & x.rlike(r"\p{L}"))))
    return _placed(items, list(range(1, WINDOW + 1))).where(F.col("length") == F.least("n_tokens", F.lit(WINDOW))) \
        .withColumn("n_windows", F.col("n_tokens") - F.col("length") + 1) \
        .withColumnsRenamed({"at": "item_at", "slots": "item_slots"})


def _placed(texts: DataFrame, lengths: list[int]) -> DataFrame:
    """``texts`` rows with templates ``c`` as one row for every window: names,
    length, at, window and slots (place in the window, type and value)."""
    def rows(masked: str, names: bool, length: int) -> Column:
        kept = f"startswith(s.v, '{_MARK}')" + ("" if names else f" and not startswith(s.v, '{_MARK}p')")
        slots = f"filter(transform(slice(t, i + 1, {length}), (v, k) -> named_struct('k', k, 'v', v)), s -> {kept})"
        return F.expr(f"transform({masked}_{length}, (w, i) -> named_struct("
                      f"'names', {names}, 'length', {length}, 'at', i, 'window', w, 'slots', {slots}))")
    masks = {"_m": True, "_plain": False}
    return texts.withColumns({"t": _tokens(F.col("c"))} | {m: _masked(F.col("c"), names) for m, names in masks.items()}) \
        .withColumns({f"{m}_{k}": _windows(m, k) for m in masks for k in lengths}) \
        .withColumn("_rows", F.concat(*[rows(m, names, k) for m, names in masks.items() for k in lengths])) \
        .select(*[c for c in texts.columns if c not in ("c", "t")], F.explode_outer("_rows").alias("_row")) \
        .where("_row is not null").select("*", "_row.*").drop("_row")


def _enough(found: Column, contained: float) -> Column:
    """Whether so many windows are the item or a passage of it."""
    return (found >= contained * F.col("n_windows")) | (found >= PASSAGE - WINDOW + 1)


def _candidates(docs: DataFrame, items: DataFrame, lengths: list[int], contained: float) -> DataFrame:
    """(digest, item, names) of texts with enough windows."""
    # explode_outer: a filter on the array's size, which explode() brings along,
    # would be pushed into the lambdas that build the array
    distinct = write_stage(items.groupBy("item", "names", "window").agg(F.count("*").alias("times"))
                           .join(items.select("item", "names", "n_windows").distinct(), ["item", "names"]), "item_windows")
    side = F.broadcast(distinct) if distinct.count() <= BROADCAST_WINDOWS else distinct.hint("merge")
    hashes = F.array_distinct(F.concat(*[_windows(m, k) for m in ("m", "plain") for k in lengths]))
    rows = docs.select(text_digest("text").alias("digest"), template(F.col("text"), False).alias("c")) \
        .select("digest", _masked(F.col("c"), True, False).alias("m"), _masked(F.col("c"), False, False).alias("plain")) \
        .select("digest", F.explode_outer(hashes).alias("window"))
    return rows.join(side, "window").dropDuplicates(["digest", "item", "names", "window"]) \
        .groupBy("digest", "item", "names", "n_windows").agg(F.sum("times").alias("found")) \
        .where(_enough(F.col("found"), contained)).select("digest", "item", "names")


def _hits(docs: DataFrame, benchmark: DataFrame, contained: float, consistent: float) -> DataFrame:
    """(digest, item_id, containment, n, changed, consistency) of the texts that
    contain an item."""
    items = write_stage(_items(benchmark), "items")
    lengths = sorted({r.length for r in items.select("length").distinct().collect()}) or [WINDOW]  # five at most
    found = write_stage(_candidates(docs, items, lengths, contained), "template_matches")
    texts = docs.select(text_digest("text").alias("digest"), "text") \
        .join(found.select("digest").distinct().hint("merge"), "digest", "left_semi").dropDuplicates(["digest"]) \
        .select("digest", template(F.col("text"), True).alias("c"))
    placed = write_stage(_placed(texts, lengths).join(items.select("names", "window").distinct(), ["names", "window"],
                                                      "left_semi").drop("length"), "text_windows")
    key = ["digest", "item", "names"]
    pairs = found.join(items, ["item", "names"]).join(placed, ["digest", "names", "window"]) \
        .withColumn("diagonal", F.col("at") - F.col("item_at"))

    # with its own values: item positions covered within a band of diagonals
    band = F.floor(F.col("diagonal") / (1 + F.floor(F.col("n_windows") / 5)))
    same = pairs.where("item_slots = slots") \
        .select(*key, "n_windows", "item_at", F.explode(F.array(band, band - 1)).alias("band")).distinct() \
        .groupBy(*key, "n_windows", "band").agg(F.count("*").alias("found")) \
        .where(_enough(F.col("found"), contained)) \
        .groupBy("digest", "item").agg(F.max(F.col("found") / F.col("n_windows")).alias("same"))

    # re-parameterised: whole diagonals, then their values
    wordy = (F.col("n_literals") >= LITERALS) & (F.col("n_literals") >= LITERAL_SHARE * F.col("n_tokens")) \
        & (F.col("n_tokens") >= WINDOW)
    told = pairs.where(wordy)
    whole = told.groupBy(*key, "n_windows", "diagonal").agg(F.count("*").alias("found")) \
        .where(F.col("found") >= contained * F.col("n_windows")) \
        .select(*key, "diagonal", (F.col("found") / F.col("n_windows")).alias("covered"))
    values = told.join(whole, [*key, "diagonal"]) \
        .select(*key, "diagonal", "covered", "item_at", F.explode_outer(F.arrays_zip("item_slots", "slots")).alias("z")) \
        .select(*key, "diagonal", "covered", (F.col("item_at") + F.col("z.item_slots.k")).alias("slot"),
                F.col("z.item_slots.v").alias("asked"), F.col("z.slots.v").alias("given")).distinct()
    given = F.col("asked").isNotNull().cast("long")
    line = [*key, "diagonal", "covered"]
    changed = values.groupBy(*line, "asked", "given").agg(F.sum(given).alias("n")) \
        .groupBy(*line, "asked").agg(
            F.max("n").alias("most"), F.sum("n").alias("n"),
            F.sum(F.when(F.col("asked") != F.col("given"), F.col("n")).otherwise(0)).alias("changed")) \
        .groupBy(*line).agg(F.sum("most").alias("most"), F.sum("n").alias("n"), F.sum("changed").alias("changed")) \
        .where(F.col("most") >= consistent * F.col("n")) \
        .groupBy("digest", "item").agg(F.max(F.struct(
            (-F.col("changed")).alias("least"), "covered", "n", "changed", "most")).alias("best")) \
        .select("digest", "item", "best.*")

    named = items.select("item", "item_id").distinct()
    slots = items.where("names").select("item", "item_at", F.explode("item_slots").alias("x")) \
        .groupBy("item").agg(F.count_distinct(F.col("item_at") + F.col("x.k")).alias("n_slots"))
    by_value = F.coalesce(F.col("same") >= 1, F.col("n").isNull())
    return same.join(changed, ["digest", "item"], "full").join(named, "item").join(slots, "item", "left").select(
        "digest", "item_id", F.greatest("same", "covered").alias("containment"),
        F.when(by_value, F.coalesce("n_slots", F.lit(0))).otherwise(F.col("n")).alias("n"),
        F.when(by_value, F.lit(0)).otherwise(F.col("changed")).cast("long").alias("changed"),
        F.when(by_value | (F.col("n") == 0), F.lit(1.0)).otherwise(F.col("most") / F.col("n")).alias("consistency"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, contained: float = CONTAINED,
                  consistent: float = CONSISTENT) -> DataFrame:
    """One row per document and item that it contains: doc_id, item_id,
    containment, n_slots (values of the item, or those aligned on the best
    diagonal of a re-parameterised copy), consistency (their share that follows
    the item's values one to one) and changed_slots (aligned values that differ:
    a re-parameterised copy has some)."""
    docs = docs.select("doc_id", "text")
    hits = _hits(docs, benchmark, contained, consistent)
    rows = docs.select("doc_id", text_digest("text").alias("digest"))
    return rows.join(hits, "digest").select(
        "doc_id", "item_id", "containment", F.col("n").alias("n_slots"), "consistency", F.col("changed").alias("changed_slots"))


def clean_documents(docs: DataFrame, benchmark: DataFrame, contained: float = CONTAINED,
                    consistent: float = CONSISTENT) -> DataFrame:
    """``docs`` without the rows whose text contains a benchmark item; ids play
    no part, they may be null or repeated."""
    hits = write_stage(_hits(docs.select("doc_id", "text"), benchmark, contained, consistent)
                       .select("digest").distinct(), "template_hits")
    key = fresh(docs, "_text_digest")
    return docs.withColumn(key, text_digest("text")).join(hits.withColumnRenamed("digest", key), key, "left_anti").drop(key)
