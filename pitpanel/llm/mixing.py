"""Mixing sources to target weights along a time-varying curriculum.

Every source has a weight schedule over training time, piecewise linear
between knots.  Its integral, scaled to the source's target, is the cumulative
token demand; the words of a source are laid end to end in hash order (once
per epoch) and the demand is inverted in closed form at each document's first
word, which gives the document's training position.  Documents are then
range-sorted by position.

Targets: sources in code point order (null last) have the weights 1, 2, 3,
repeating, and share the sum of all sizes; no target exceeds ``MAX_EPOCHS``
times its source's size, and the excess is reshared by weight.  The capped
sources are a prefix of the order by size / weight, so a window over the
sources finds the level at once.  Arithmetic is on integers; a target is one
division.

Offsets within a source are sums over cells of about ``CELL_ROWS`` documents
plus a running sum inside the cell, so a source with a third of all rows is
spread over as many tasks as it has cells.

Defined results: a null text has size 0; documents of size 0 are taken 0 times
and have no position; the document on the edge of a target is taken in part
(``taken`` counts the words); repeated rows count as separate documents; an
empty table gives an empty result.  Input columns with the name of a result
column are replaced.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitpanel.llm.common import numbered, text_digest, word_count

WEIGHTS = (1, 2, 3)
MAX_EPOCHS = 3
CELL_ROWS = 8192
#: Column that breaks ties of the order: a hash of doc_id.
ORDER = "_curriculum_order"
#: Knots (training time, relative weight), one schedule per weight in turn:
#: sources of the first weight fade out, of the last weight fade in.
SCHEDULES = (((0.0, 1.5), (1.0, 0.5)), ((0.0, 1.0), (1.0, 1.0)), ((0.0, 0.5), (0.5, 0.75), (1.0, 2.0)))


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, cap: int = MAX_EPOCHS) -> DataFrame:
    """``sizes`` (source, source_size) with weight class, target as an exact
    fraction ``_num / _den``, and ``target``.  One row per source."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    lcm = math.lcm(*weights)
    k = F.col("_class")
    weight = F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]), k + 1)
    ranked = sizes.withColumn("_class", F.pmod(F.row_number().over(order) - 1, F.lit(len(weights)))) \
        .withColumn("_weight", weight) \
        .withColumn("_fill", F.col("source_size") * F.floor(F.lit(lcm) / F.col("_weight")))
    everything = Window.partitionBy()
    by_fill = Window.orderBy("_fill", F.col("source").asc_nulls_last())
    before = by_fill.rowsBetween(Window.unboundedPreceding, -1)
    capped = ranked.withColumn("_total", F.sum("source_size").over(everything)) \
        .withColumn("_used", F.coalesce(F.sum("source_size").over(before), F.lit(0)) * cap) \
        .withColumn("_left", F.sum("_weight").over(by_fill.rowsBetween(0, Window.unboundedFollowing))) \
        .withColumn("_capped", (F.col("_total") - F.col("_used")) * F.col("_weight")
                    > F.col("source_size") * cap * F.col("_left"))
    level = capped.withColumn("_rest", F.col("_total") - F.coalesce(
        F.sum(F.when(F.col("_capped"), F.col("source_size") * cap)).over(everything), F.lit(0))) \
        .withColumn("_open", F.sum(F.when(~F.col("_capped"), F.col("_weight"))).over(everything))
    return level.select(
        "source", "source_size", "_class",
        F.when(F.col("_capped"), F.col("source_size") * cap).otherwise(F.col("_weight") * F.col("_rest")).alias("_num"),
        F.when(F.col("_capped"), F.lit(1).cast("long")).otherwise(F.col("_open")).alias("_den")) \
        .withColumn("target", F.col("_num").cast("double") / F.col("_den").cast("double")) \
        .withColumn("_whole", F.expr("(2 * _num + _den) div (2 * _den)"))


def inverse_demand(share: Column, knots: Sequence[tuple[float, float]]) -> Column:
    """Training time at which a schedule has asked for ``share`` of its total:
    the inverse of its normalised integral, a quadratic on each segment."""
    areas = [(b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(knots, knots[1:])]
    total = sum(areas)
    done = 0.0
    out = None
    for (t0, w0), (t1, w1), area in zip(knots, knots[1:], areas):
        y = share * F.lit(total) - F.lit(done)
        slope = (w1 - w0) / (t1 - t0)
        root = F.sqrt(F.greatest(F.lit(w0 * w0) + F.lit(2 * slope) * y, F.lit(0.0)))
        part = F.lit(t0) + F.lit(2.0) * y / (F.lit(w0) + root)
        done += area
        out = F.when(share * F.lit(total) <= F.lit(done), part) if out is None \
            else out.when(share * F.lit(total) <= F.lit(done), part)
    return out.otherwise(F.lit(knots[-1][0]))


def curriculum(docs: DataFrame, weights: Sequence[int] = WEIGHTS, cap: int = MAX_EPOCHS,
               schedules: Sequence[Sequence[tuple[float, float]]] = SCHEDULES) -> DataFrame:
    """``docs`` with size, source_size, target, taken, position (of the first
    time the document is used; null if never) and epochs: an array of
    (position, words) for each time it is used.  Not sorted."""
    mine = {"size", "source_size", "target", "taken", "position", "epochs"}
    carried, restored = numbered(docs, mine)
    rows = docs.select(*carried, "source", word_count("text").alias("size"),
                       F.struct(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).alias("h"),
                                F.col("doc_id").alias("id"), text_digest("text").alias("digest")).alias("_o"))
    # the digest only breaks ties between rows of one id
    n = docs.count()
    bits = max(1, (n // CELL_ROWS).bit_length())
    rows = rows.withColumn("_cell", F.shiftright(F.conv(F.substring("_o.h", 1, 8), 16, 10).cast("long"), 32 - bits))
    cells = rows.groupBy("source", "_cell").agg(F.sum("size").alias("_n"))
    before = Window.partitionBy("source").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = cells.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    targets = source_targets(cells.groupBy("source").agg(F.sum("_n").alias("source_size")), weights, cap)
    plan = offsets.alias("o").join(targets.alias("t"), F.col("o.source").eqNullSafe(F.col("t.source"))) \
        .select(F.col("o.source").alias("_source"), F.col("_cell").alias("_at"), "_before", "source_size",
                "target", "_whole", "_class")
    inside = Window.partitionBy("source", "_cell").orderBy("_o.h", "_o.id", "_o.digest") \
        .rowsBetween(Window.unboundedPreceding, -1)
    laid = rows.withColumn("_in", F.coalesce(F.sum("size").over(inside), F.lit(0))) \
        .join(plan, F.col("source").eqNullSafe(F.col("_source")) & (F.col("_cell") == F.col("_at"))) \
        .withColumn("_start", F.col("_before") + F.col("_in"))

    def words(epoch: int) -> Column:
        start = F.col("_start") + F.col("source_size") * epoch
        return F.greatest(F.least(F.col("_whole") - start, F.col("size")), F.lit(0).cast("long"))

    def position(epoch: int) -> Column:
        share = (F.col("_start") + F.col("source_size") * epoch).cast("double") \
            / F.nullif(F.col("_whole"), F.lit(0).cast("long")).cast("double")
        out = F.when(F.col("_class") == 0, inverse_demand(share, schedules[0]))
        for k in range(1, len(weights)):
            out = out.when(F.col("_class") == k, inverse_demand(share, schedules[k % len(schedules)]))
        return out

    uses = F.array(*[F.struct(F.when(words(e) > 0, position(e)).alias("position"), words(e).alias("words"))
                     for e in range(cap)])
    out = laid.withColumn("_uses", F.filter(uses, lambda u: u["words"] > 0))
    return out.select(*restored, "size", "source_size", "target",
                      F.aggregate("_uses", F.lit(0).cast("long"), lambda a, u: a + u["words"]).alias("taken"),
                      F.try_element_at("_uses", F.lit(1))["position"].alias("position"),
                      F.col("_uses").alias("epochs"), F.col("_o.h").alias(ORDER))


def mixed_order(docs: DataFrame, **options) -> DataFrame:
    """The curriculum of ``docs`` range-sorted by first position (never used
    documents last); ties by hash, so no value of the position is hot."""
    return curriculum(docs, **options).orderBy(F.col("position").asc_nulls_last(), ORDER).drop(ORDER)


def training_documents(docs: DataFrame, **options) -> DataFrame:
    """Rows of ``docs`` as the training run reads them: one row for each use,
    range-sorted by position, with the columns of ``docs``.  A use of less
    than half of a document's words is left out, others are whole texts."""
    carried, restored = numbered(docs)
    used = curriculum(docs.select(*carried, "doc_id", "source", "text"), **options) \
        .withColumn("_use", F.explode("epochs")).where(F.col("_use.words") * 2 >= F.col("size"))
    return used.orderBy("_use.position", ORDER).select(*restored)
