"""Personal data: base detectors plus bootstrapped contextual extraction.

Base spans come from four regular expressions (leftmost, non-overlapping per
kind).  The patterns below match what the plain forms match, but start only
where a match can start and never backtrack, so very long texts stay linear
and need no deep stack.

The base spans, at their own places, seed a bootstrap over identifier-like
tokens (whole tokens with a digit, without a label as in ip=): a token's lexical patterns are the two words before it
and the words around it, with digits shown as 0.  The graph of patterns and
token values is scored in rounds: a pattern's confidence for a kind is the
smoothed mean of its values' scores, a value's score the noisy-or of its
patterns.  Tokens that are no base span but whose value is confident, under a
pattern that is, become further spans of that kind.

Everything is DataFrame expressions.  Counts are of distinct values, so copies
of a text do not lift a score, and the graph is aggregated before it is
joined; a pattern that a third of all tokens share is one row per value.

Defined results: null counts as empty; offsets are code points, end exclusive;
repeated rows each get their row; an empty table gives an empty result.  Extra
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitpanel.llm.common import text_digest, write_stage

KINDS = ("email", "ip", "card", "phone")
_EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
_IP = r"[0-9](?<![0-9]{2})[0-9]*+(?:\.[0-9]++){3}"
_CARD = r"[0-9](?:[\x20-]?[0-9])++"
_PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
_PATTERNS = dict(zip(KINDS, (_EMAIL, _IP, _CARD, _PHONE)))
#: A text without this character class has no span of the kind.
_NEEDS = {"email": "@", "ip": ".", "card": None, "phone": "+"}
_TOKEN = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9]*+[0-9][^\x20\x09-\x0D]*+"
_DIGITS = r"[0-9]++(?:-[0-9]++)*+(?=[.,;:!?)\]}>\"']*+(?:[\x20\x09-\x0D]|\z))"
#: Whole tokens; numbers written in groups are one.
_CANDIDATE = rf"{_EMAIL}|{_PHONE}|(?<![^\x20\x09-\x0D]){_DIGITS}(?:\x20{_DIGITS})*+|{_TOKEN}"
#: What precedes the value of a token: punctuation and a label.
_LEAD = r"^[^\p{L}\p{N}+]*+(?:[\p{L}_]++[=:][^\p{L}\p{N}+]*+)?+"
_OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]{1,2})"

ROUNDS = 3
#: A pattern needs this many distinct values, and scores are means over two more.
MIN_VALUES = 5
SMOOTHING = 2.0
CONFIDENT = 0.8
#: Characters of context kept on either side.
CONTEXT = 64
#: Matches whose lengths are summed together.
BLOCK = 256

_SPAN = "s:int,e:int,m:string"
#: Context fields of a match, for _with_offsets.
_AROUND = f", 'l', concat(right(coalesce(get(z, i - 1).m, ''), {CONTEXT}), right(x.p, {CONTEXT}))" \
          f", 'r', left(coalesce(get(z, i + 1).p, ''), {CONTEXT})"


def _valid(kind: str, m: str) -> str:
    """SQL condition on a match ``m``."""
    if kind == "email":
        return "true"
    if kind == "ip":
        return f"{m} rlike '^{_OCTET}([.]{_OCTET}){{3}}$'"
    if kind == "phone":
        return f"length(translate({m}, ' ().-+', '')) between 8 and 15"
    d = f"translate({m}, ' -', '')"
    digit = f"cast(substring({d}, length({d}) + 1 - i, 1) as int)"
    luhn = f"aggregate(sequence(1, length({d})), 0, (t, i) -> t + if(i % 2 = 1, {digit}, " \
           f"2 * {digit} - if({digit} > 4, 9, 0)))"
    return f"if(length({d}) between 16 and 19, {luhn} % 10 = 0, false)"


def _let(name: str, value: str, body: str) -> str:
    """SQL of ``body`` with ``name`` bound to a value that is computed once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _with_offsets(fields: str) -> str:
    """SQL: for the matches ``m`` of a text, given the pieces ``p`` between
    them, an array of structs with the start ``s``, the match ``m`` and
    ``fields`` (of ``z``, all pieces and matches, at ``i``).  Lengths are
    summed by blocks, so a text may have very many matches."""
    start = f"cast(o[i div {BLOCK}] + aggregate(slice(n, cast(i - i % {BLOCK} + 1 as int), i % {BLOCK}), 0, " \
            f"(t, v) -> t + v) + length(x.p) as int)"
    made = f"filter(transform(z, (x, i) -> named_struct('s', {start}, 'm', x.m{fields})), x -> x.m is not null)"
    sums = f"transform(sequence(0, cast(size(n) div {BLOCK} as int)), " \
           f"c -> aggregate(slice(n, c * {BLOCK} + 1, {BLOCK}), 0, (t, v) -> t + v))"
    before = "transform(b, (v, c) -> aggregate(slice(b, 1, c), 0, (t, u) -> t + u))"
    return _let("z", "arrays_zip(p, m)",
                _let("n", "transform(z, x -> length(x.p) + coalesce(length(x.m), 0))",
                     _let("b", sums, _let("o", before, made))))


def _located(keep: str, context: bool) -> Column:
    """Matches (s, e, m, with ``context`` also l and r) for which the condition
    ``keep`` on ``x.m`` holds."""
    kind, more = (f"{_SPAN},l:string,r:string", ", 'l', x.l, 'r', x.r") if context else (_SPAN, "")
    return F.expr(f"""case when size(m) = 0 then cast(array() as array<struct<{kind}>>) else
        transform(filter({_with_offsets(_AROUND if context else '')}, x -> {keep}),
                  x -> named_struct('s', x.s, 'e', x.s + length(x.m), 'm', x.m{more})) end""")


def with_base_spans(docs: DataFrame, context: bool = False) -> DataFrame:
    """``docs`` (doc_id, text) with one span array per kind and ``digest``."""
    out = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    for kind in KINDS:
        needs = F.col("text").contains(_NEEDS[kind]) if _NEEDS[kind] else F.col("text").rlike("[0-9][ -]?[0-9]")
        out = out.withColumn("p", F.when(needs, F.split("text", _PATTERNS[kind], -1)).otherwise(F.array())) \
            .withColumn("m", F.when(needs, F.regexp_extract_all("text", F.lit(_PATTERNS[kind]), F.lit(0)))
                        .otherwise(F.array()))
        out = out.withColumn(kind, _located(_valid(kind, "x.m"), context)).drop("p", "m")
    return out.withColumn("digest", text_digest("text"))


def _normal(words: Column) -> Column:
    """Context words with digits shown as 0 and without outer punctuation."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(words), "[0-9]+", "0"), r"[^\p{L}0@=+(): ]+", " "))


def _tagged(tag, *fields: str) -> Column:
    """All base spans as one array of (tag, s, e and ``fields``)."""
    def one(i: int, kind: str) -> Column:
        return F.transform(kind, lambda x: F.struct(tag(i, kind), *[x[f].alias(f) for f in ("s", "e", *fields)]))
    return F.flatten(F.array(*[one(i, kind) for i, kind in enumerate(KINDS, 1)]))


def candidates(spans: DataFrame) -> DataFrame:
    """Base spans (with context) and identifier-like tokens of every text with
    their patterns: digest, s, e, value, kind (of a base span; null for a
    token), inside (a token overlaps a base span) and patterns."""
    flat = _tagged(lambda i, kind: F.lit(kind).alias("kind"), "m", "l", "r")
    found = spans.where(F.col("text").rlike("[0-9@]")).select(
        "digest", flat.alias("base"), F.split("text", _CANDIDATE, -1).alias("p"),
        F.regexp_extract_all("text", F.lit(_CANDIDATE), F.lit(0)).alias("m"))
    fields = "'s', x.s, 'm', x.m, 'l', x.l, 'r', x.r"
    both = F.expr(f"""concat(
        transform(base, x -> named_struct('kind', x.kind, {fields})),
        transform({_with_offsets(_AROUND)}, x -> named_struct('kind', cast(null as string), {fields})))""")
    base = F.expr("transform(base, x -> named_struct('s', x.s, 'e', x.e))").alias("base")
    rows = found.select("digest", base, F.explode_outer(both).alias("c")).where("c is not null") \
        .select("digest", "base", "c.*") \
        .withColumn("lead", F.when(F.col("kind").isNull(), F.regexp_extract("m", _LEAD, 0)).otherwise("")) \
        .withColumn("value", F.expr("substring(m, length(lead) + 1)")) \
        .withColumn("value", F.when(F.col("kind").isNull(), F.regexp_replace(
            "value", r"(?<=[\p{L}\p{N}])[^\p{L}\p{N}]++$", "")).otherwise(F.col("value")))
    left = F.expr(f"right(concat(l, lead), {CONTEXT})")
    right = F.expr(f"left(concat(substring(m, length(lead) + length(value) + 1), r), {CONTEXT})")
    rows = rows.select("digest", "base", "kind", (F.col("s") + F.length("lead")).alias("s"), "value",
                       F.split(F.trim(_normal(left)), " +").alias("l"),
                       F.split(F.trim(_normal(right)), " +").alias("r")) \
        .withColumn("e", F.col("s") + F.length("value"))
    last, before = F.try_element_at("l", F.lit(-1)), F.try_element_at("l", F.lit(-2))
    patterns = F.array(F.concat_ws(" ", F.lit("before:"), before, last),
                       F.concat_ws(" ", F.lit("around:"), last, F.lit("_"), F.try_element_at("r", F.lit(1))))
    return rows.select(
        "digest", "s", "e", "value", "kind",
        F.expr("kind is null and exists(base, b -> b.s < e and s < b.e)").alias("inside"), patterns.alias("patterns"))


def bootstrap(found: DataFrame, rounds: int = ROUNDS, min_values: int = MIN_VALUES,
              confident: float = CONFIDENT) -> DataFrame:
    """Further spans (digest, kind, s, e) from the pattern-value graph."""
    rows = found.where("kind is not null or not inside").where("value <> ''") \
        .select("*", F.explode("patterns").alias("pattern"))
    edges = rows.groupBy("pattern", "value").agg(F.max("kind").alias("kind"))
    common = edges.groupBy("pattern").agg(F.count("*").alias("n_values")).where(F.col("n_values") >= min_values)
    edges = write_stage(edges.join(common, "pattern"), "edges")
    seeds = edges.where("kind is not null").groupBy("value", "kind").agg(F.lit(1.0).alias("score"))
    scores = write_stage(seeds, "scores")
    patterns = None
    for _ in range(rounds):
        patterns = write_stage(
            edges.drop("kind").join(scores, "value").groupBy("pattern", "kind")
            .agg(F.sum("score").alias("mass"), F.first("n_values").alias("n_values"))
            .withColumn("confidence", F.col("mass") / (F.col("n_values") + SMOOTHING))
            .where("confidence > 0.05"), "patterns")
        reached = edges.where("kind is null").drop("kind").join(patterns.select("pattern", "kind", "confidence"), "pattern") \
            .groupBy("value", "kind") \
            .agg((1 - F.exp(F.sum(F.log(F.greatest(1 - F.col("confidence"), F.lit(1e-9)))))).alias("score"))
        scores = write_stage(seeds.unionByName(reached.join(seeds.select("value"), "value", "left_anti")), "scores")
    sure = patterns.where(F.col("confidence") >= confident).select("pattern", F.col("kind").alias("of"))
    hits = rows.where("kind is null and not inside").join(sure, "pattern") \
        .join(scores.where(F.col("score") >= confident).select("value", F.col("kind").alias("of")), ["value", "of"])
    return hits.groupBy("digest", "s", "e").agg(F.min("of").alias("kind"))


def _written(spans: Column) -> Column:
    """kind:start:end by kind as listed, then start, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(F.array_sort(spans), lambda x: F.concat_ws(
        ":", F.element_at(names, x["k"]), x["s"].cast("string"), x["e"].cast("string"))), ",")


def find_pii(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """One row per document: doc_id, n_email, n_ip, n_card, n_phone,
    base_sha256, spans and n_context (spans that the bootstrap added)."""
    spans = with_base_spans(docs)
    base = _tagged(lambda i, kind: F.lit(i).alias("k"))
    stage = write_stage(spans.select("doc_id", "digest", base.alias("base")), "pii_base")
    found = write_stage(candidates(with_base_spans(docs, context=True)), "pii_candidates")
    order = F.create_map(*[x for i, k in enumerate(KINDS, 1) for x in (F.lit(k), F.lit(i))])
    extra = write_stage(bootstrap(found, rounds).groupBy("digest").agg(F.collect_list(
        F.struct(order[F.col("kind")].alias("k"), "s", "e")).alias("more")), "pii_more")
    out = stage.join(extra, "digest", "left").withColumn("more", F.coalesce("more", F.filter("base", lambda x: F.lit(False))))
    counts = [F.expr(f"cast(size(filter(base, x -> x.k = {i})) as long)").alias(f"n_{k}")
              for i, k in enumerate(KINDS, 1)]
    return out.select("doc_id", *counts, F.sha2(_written(F.col("base")), 256).alias("base_sha256"),
                      _written(F.concat("base", "more")).alias("spans"), F.size("more").cast("long").alias("n_context"))
