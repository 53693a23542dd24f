"""Predictions of the batched models for design rows.

Models grow with the rows they were fitted on (a forest without a depth limit
has about two nodes a row), so a task never holds all of them: they are dealt
over passes of at most ``SCORE_BYTES``, and a forest larger than that is scored
in blocks of trees whose sums are added up by row, in the order of the trees.
"""

from __future__ import annotations

import pickle
import sys
from collections.abc import Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitpanel.operators.trees import leaves_of, predict_rows
from pitpanel.session import cut_lineage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Models (arrays of their nodes) that a task holds at a time.
SCORE_BYTES = 32 << 20
#: What a prediction reads of a tree.
_READ = ("feature", "bin", "left", "right", "value")


def _slim(model: dict) -> list[dict]:
    return [{k: tree[k] for k in _READ} for tree in model["trees"]]


def _size(trees: list[dict]) -> int:
    return sum(a.nbytes for tree in trees for a in tree.values())


def _packed(items, limit: int):
    """Items (value, bytes) in order, as lists of at most ``limit`` bytes or one item."""
    now, size = [], 0
    for value, n in items:
        if now and size + n > limit:
            yield now
            now, size = [], 0
        now.append(value)
        size += n
    if now:
        yield now


def score_rows(test: DataFrame, meta: Sequence[str], linear: dict, trees: dict, at_of: dict,
               limit: int = SCORE_BYTES) -> DataFrame:
    """Every model's prediction for the design rows of its data set: the meta
    columns, key, y_true, y_pred (a class for odd data sets) and y_proba.  Keys
    are data set/group/model; ``at_of`` has the columns of each data set/group."""
    kept = [f for f in test.schema.fields if f.name in meta]
    small = [(("linear", key, (tuple(at_of[key.rsplit("/", 1)[0]]), beta)), beta.nbytes) for key, beta in linear.items()]
    large = []
    for key, model in trees.items():
        slim = _slim(model)
        if _size(slim) <= limit:
            small.append((("trees", key, {**model, "trees": slim}), _size(slim)))
        else:
            blocks = _packed(((t, _size([t])) for t in slim), limit)
            large += [("block", key, (k, block)) for k, block in enumerate(blocks)]
    test = cut_lineage(test.withColumn("_n", F.monotonically_increasing_id()))  # read by every pass
    out = [_pass(test, kept, pieces) for pieces in _packed(small, limit)]
    if large:
        out.append(_whole(reduce(DataFrame.unionByName, [_pass(test, kept, [piece]) for piece in large]), kept, trees))
    odd = F.split("key", "/")[0].cast("int") % 2 == 1
    return reduce(DataFrame.unionByName, out).select(
        *[f.name for f in kept], "key", "y_true",
        F.when(odd, (F.col("value") > 0.5).cast("double")).otherwise(F.col("value")).alias("y_pred"),
        F.when(odd, F.col("value")).alias("y_proba"))


def _pass(test: DataFrame, kept: list, pieces: list) -> DataFrame:
    """The values of some models (or sums of blocks of trees) for all rows."""
    shared = test.sparkSession.sparkContext.broadcast(cloudpickle.dumps(pieces))
    fields = "".join(f"{f.name} {f.dataType.simpleString()}, " for f in kept)
    names = [f.name for f in kept]

    def run(batches):
        pieces = pickle.loads(shared.value)
        for batch in batches:
            sets = batch.column("rows").to_numpy()
            for s in np.unique(sets):
                mine = [p for p in pieces if p[1].startswith(f"{s}/")]
                if not mine:
                    continue
                part = batch.take(pa.array(np.flatnonzero(sets == s)))
                x, bins = (np.frombuffer(b"".join(part.column(c).to_pylist()), t).reshape(part.num_rows, -1)
                           for c, t in (("x", np.float64), ("bins", np.uint16)))
                for kind, key, model in mine:
                    block = 0
                    if kind == "linear":
                        at, beta = model
                        value = beta[0] + x[:, list(at)] @ beta[1:]
                        if s % 2:
                            value = 0.5 * (1 + np.tanh(value / 2))
                    elif kind == "trees":
                        value = predict_rows(model, bins)
                    else:
                        block, trees = model
                        value = np.sum([t["value"][leaves_of(t, bins)] for t in trees], 0)
                    yield pa.RecordBatch.from_arrays(
                        [*(part.column(c) for c in names), pa.array([key] * len(value)), part.column("y"), pa.array(value),
                         part.column("_n"), pa.array(np.full(len(value), block, np.int32))],
                        [*names, "key", "y_true", "value", "_n", "_block"])

    return test.mapInArrow(run, f"{fields}key string, y_true double, value double, _n long, _block int")


def _whole(sums: DataFrame, kept: list, trees: dict) -> DataFrame:
    """The values of models scored in blocks."""
    terms = {key: (model["base"], 1.0) if model["spec"].kind == "boosting" else (0.0, float(len(model["trees"])))
             for key, model in trees.items()}
    base, count = (F.create_map(*[F.lit(x) for key, t in terms.items() for x in (key, t[k])]) for k in (0, 1))
    total = F.aggregate(F.array_sort(F.collect_list(F.struct("_block", "value"))), F.lit(0.0), lambda a, b: a + b["value"])
    return sums.groupBy("_n", "key").agg(*[F.any_value(f.name).alias(f.name) for f in kept],
                                         F.any_value("y_true").alias("y_true"), total.alias("_sum")) \
        .select(*[f.name for f in kept], "key", "y_true", (base[F.col("key")] + F.col("_sum") / count[F.col("key")]).alias("value"),
                "_n", F.lit(0).alias("_block"))
