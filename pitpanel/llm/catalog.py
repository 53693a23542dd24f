"""Registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pitpanel.llm import collocations, decontamination, exact_dedup, hard_negatives, language_id, licenses, mixing, \
    near_dedup, packing, pii, sharding, substring_dedup, toxicity
from pitpanel.llm.common import read


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.substring_dedup(read(spark, sf_dir, "documents")).drop("longest_level")


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_pii(read(spark, sf_dir, "documents"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.decontaminate(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(read(spark, sf_dir, "documents"))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(read(spark, sf_dir, "documents")) \
        .select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(read(spark, sf_dir, "documents"))


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_dedup(read(spark, sf_dir, "documents"), shingle=4)


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed_order(read(spark, sf_dir, "documents")) \
        .select("doc_id", "size", "source_size", "target", "taken", "position")


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.language_id(read(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read(spark, sf_dir, "documents"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.hard_negatives(read(spark, sf_dir, "embeddings"))


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_substring_dedup, op2_pii, op3_decontamination, op4_exact_dedup, op5_sharding, op6_licenses, op7_near_dedup,
                            op8_mixing, op9_language_id, op10_toxicity, op11_collocations, op12_hard_negatives,
                            op13_packing)}


_WORDS = r"[x for x in regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+') if x <> '']"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP1_SQL = f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, {_WORDS} AS w FROM documents),
win AS (SELECT r, p, array_to_string(w[p:p + 34], ' ') AS t
        FROM (SELECT r, w, unnest(range(1, len(w) - 33)) AS p FROM d WHERE len(w) >= 35)),
rep AS (SELECT r, p FROM win WHERE t IN (SELECT t FROM win GROUP BY t HAVING count(*) > 1)),
gone AS (SELECT DISTINCT r, unnest(range(p, p + 35)) AS i FROM rep),
word AS (SELECT r, i, w[i] AS x FROM (SELECT r, w, unnest(range(1, len(w) + 1)) AS i FROM d)),
kept AS (SELECT r, string_agg(x, ' ' ORDER BY i) AS t FROM word ANTI JOIN gone USING (r, i) GROUP BY r),
n AS (SELECT r, count(*) AS n FROM gone GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN n USING (r) LEFT JOIN kept USING (r)"""

OP4_SQL = f"""
WITH d AS (SELECT doc_id, {_LOWER} AS t FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT doc_id, keep_id, group_size::BIGINT AS group_size,
       doc_id = keep_id AND row_number() OVER (PARTITION BY t, doc_id) = 1 AS kept, sha256(t) AS text_sha256
FROM d JOIN g USING (t)"""

OP7_SQL = f"""
WITH RECURSIVE d AS (SELECT doc_id, {_WORDS.replace("coalesce(text, '')", _LOWER)} AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[p:p + 3], ' ') AS x
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 2))) AS p FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
links AS (SELECT a.doc_id AS a, b.doc_id AS b FROM s a JOIN s b USING (x)
          JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id
          WHERE a.doc_id <> b.doc_id AND (na.n >= 4 OR nb.n >= 4 OR na.n = nb.n)
          GROUP BY a.doc_id, b.doc_id, na.n, nb.n HAVING 100 * count(*) >= 80 * (na.n + nb.n - count(*))),
reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
low AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, least(d.doc_id, coalesce(low.b, d.doc_id)) AS component_id,
       d.doc_id = least(d.doc_id, coalesce(low.b, d.doc_id)) AS kept
FROM d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN low ON low.a = d.doc_id"""

#: Schedules and cap as in mixing.py; exact integers up to one division.
OP8_SQL = f"""
WITH d AS (SELECT doc_id, source, text, len({_WORDS})::BIGINT AS size, md5(coalesce(doc_id::VARCHAR, '')) AS h
           FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight FROM s),
c AS (SELECT *, sum(source_size) OVER () AS total,
             3 * coalesce(sum(source_size) OVER (ORDER BY source_size * (6 // weight), source NULLS LAST
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS used,
             sum(weight) OVER (ORDER BY source_size * (6 // weight), source NULLS LAST
                 ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS remaining FROM w),
f AS (SELECT *, (total - used) * weight > 3 * source_size * remaining AS capped FROM c),
g AS (SELECT *, total - coalesce(sum(3 * source_size) FILTER (capped) OVER (), 0) AS rest,
             sum(weight) FILTER (NOT capped) OVER () AS open FROM f),
t AS (SELECT source, source_size, weight, (CASE WHEN capped THEN 3 * source_size ELSE weight * rest END)::BIGINT AS num,
             (CASE WHEN capped THEN 1 ELSE open END)::BIGINT AS den FROM g),
l AS (SELECT d.doc_id, d.size, t.source_size, t.weight, num::DOUBLE / den::DOUBLE AS target,
             (2 * num + den) // (2 * den) AS whole,
             coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h, d.doc_id
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
u AS (SELECT *, (greatest(least(whole - start, size), 0) + greatest(least(whole - start - source_size, size), 0)
                 + greatest(least(whole - start - 2 * source_size, size), 0))::BIGINT AS taken,
             CASE WHEN whole > 0 THEN start::DOUBLE / whole::DOUBLE END AS x FROM l)
SELECT doc_id, size, source_size, target, taken,
       CASE WHEN taken = 0 THEN NULL
            WHEN weight = 1 THEN 2.0 * x / (1.5 + sqrt(greatest(2.25 - 2.0 * x, 0.0)))
            WHEN weight = 2 THEN 2.0 * x / (1.0 + sqrt(1.0))
            WHEN x <= 0.3125 THEN 2.0 * x / (0.5 + sqrt(0.25 + x))
            ELSE 0.5 + 2.0 * (x - 0.3125) / (0.75 + sqrt(0.5625 + 5.0 * (x - 0.3125))) END AS position
FROM u"""

OP11_SQL = f"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang,
                  unnest(regexp_split_to_array({_LOWER}, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
p AS (SELECT lang, [x for x in regexp_split_to_array(piece, '[\\x20\\x09]+') if x <> ''] AS w FROM d),
g AS (SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS gram
      FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM p, (SELECT unnest([1, 2, 3, 4]) AS m) WHERE len(w) >= m)),
f AS (SELECT lang, gram, m, count(*) AS f FROM g GROUP BY ALL),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE m = 1 GROUP BY lang),
c AS (SELECT lang, gram, m, f AS a, string_split(gram, ' ') AS w FROM f WHERE m > 1 AND f >= 30),
cuts AS (SELECT lang, gram, m, a, k, array_to_string(w[1:k], ' ') AS head, array_to_string(w[k + 1:], ' ') AS tail
         FROM (SELECT *, unnest(range(1, m)) AS k FROM c)),
s AS (SELECT cuts.lang, cuts.gram, cuts.m, a, k, x.f AS l, y.f AS r,
             (2000000::HUGEINT * a // (x.f + y.f))::BIGINT AS score
      FROM cuts JOIN f x ON x.lang = cuts.lang AND x.gram = head JOIN f y ON y.lang = cuts.lang AND y.gram = tail),
low AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, gram ORDER BY score, k) = 1),
swallowed AS (SELECT DISTINCT c.lang, c.gram
              FROM (SELECT lang, a, m, w, k, unnest(range(1, m - k + 2)) AS i
                    FROM (SELECT *, unnest(range(2, m)) AS k FROM c)) b
              JOIN c ON c.lang = b.lang AND c.gram = array_to_string(b.w[i:i + k - 1], ' ')
              WHERE 100::HUGEINT * b.a >= 80::HUGEINT * c.a),
r AS (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(gram)) AS rank, gram AS phrase,
             a, l, r, score FROM low ANTI JOIN swallowed USING (lang, gram))
SELECT lang, rank, phrase, a, l, r, n, score FROM r JOIN n USING (lang) WHERE rank <= 2000"""

OP12_SQL = """
WITH v AS (SELECT row_number() OVER () AS u, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  [floor(256 * x::DOUBLE) for x in embedding] AS x
           FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
             AND len([1 for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT a.u, a.vec_id AS anchor_id, b.u AS o, b.vec_id AS id, a.label = b.label AS same,
             list_dot_product(a.x, b.x)::BIGINT AS score
      FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.u <> b.u),
p AS (SELECT u, anchor_id, o AS po, id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY u ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, positive_id,
       (row_number() OVER (PARTITION BY u, po ORDER BY score DESC, id))::INT AS rank, id AS negative_id,
       positive_score, score AS negative_score
FROM p JOIN s USING (u) WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10"""

ORACLE_SQL: dict[str, str] = {"op1_substring_dedup": OP1_SQL, "op4_exact_dedup": OP4_SQL,
                              "op7_near_dedup": OP7_SQL, "op8_mixing": OP8_SQL,
                              "op11_collocations": OP11_SQL, "op12_hard_negatives": OP12_SQL}
