"""Hard negatives by exact search over an inverted multi-index.

Vectors are split in two halves, each half with a codebook of its own; a pair
of codewords is a cell.  For an anchor ``q`` a half with codeword ``c`` and
radius ``r`` (the farthest member) scores within ``q·c ± |q| r``; the sum over
both halves bounds the scores of a cell from above and below.  An anchor's
multi-sequence heap pops cells by falling upper bound.  Cells that lie wholly
above an anchor's windows are passed over, and the search ends where the next
bound is under the worst row that each window still accepts: what is left is
certified not to matter, so the result is exact.

First the positives are searched (one open window over the same label), then
each positive's window over the other labels.  A search runs in rounds of
growing row budgets; the last is unlimited.  Cells are dealt into chunks of
about ``CHUNK_ROWS`` rows and anchors into blocks, so a cell with a third of
all rows is spread and an anchor's rows are never gathered: each pair of chunk
and block gives one matrix product and its best rows.

The codebooks are fitted on at most ``SAMPLE`` rows; every row is indexed and
the radii are taken over all rows.  Scores are integers computed in floating
point, which is exact below the checked norms (2**24 or 2**53).

Defined results: rows with a null label, vector or component, or a component
that is not finite, take no part; rows of other dimensions are compared only
with each other; null ids sort last and are no anchors; rows with equal ids
count each; an empty table gives no rows.  Extra columns are ignored.  Scores
of 2**53 and more raise an error.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitpanel.llm.common import write_stage

#: Rows that the codebooks are fitted on, at most.
SAMPLE = 20_000
#: Largest codebook of a half; cells number its square.
CODEWORDS = 1024
CELL_ROWS = 256
CHUNK_ROWS = 2048
BLOCK = 256
#: Rows that an anchor's cells may hold, round by round.
BUDGETS = (4096, 65_536, None)

_STATE = ("uid long, vec_id long, label long, v binary, popped long, "
          "windows array<struct<w:int,lo:double,hi:double,bar:double>>")


def codebook(half: np.ndarray, k: int, seed: int, steps: int = 8) -> np.ndarray:
    """Lloyd's codewords of the rows of ``half``."""
    rng = np.random.default_rng(seed)
    words = half[rng.choice(len(half), min(k, len(half)), replace=False)]
    for _ in range(steps):
        near = nearest(half, words)[0]
        n = np.bincount(near, minlength=len(words))
        total = np.zeros_like(words)
        np.add.at(total, near, half)
        words = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], words)
    return words


def nearest(half: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row's codeword and its distance to it."""
    d2 = (words * words).sum(1)[None, :] - 2 * half @ words.T
    near = d2.argmin(1)
    return near, np.sqrt(((half - words[near]) ** 2).sum(1))


class Index:
    """Codewords and radii of both halves, and the number of rows in each cell."""

    def __init__(self, words: list, radii: list, rows: np.ndarray) -> None:
        self.words, self.radii, self.rows = words, radii, rows

    def bounds(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Upper and lower score bounds of the codewords of the two halves."""
        cut = self.words[0].shape[1]
        out = []
        for part, words, radius in ((q[:cut], self.words[0], self.radii[0]), (q[cut:], self.words[1], self.radii[1])):
            middle, reach = words @ part, math.sqrt(part @ part) * radius
            slack = 1e-9 * (np.abs(middle) + reach) + 1e-6  # floating-point error of the bounds
            out += [middle + reach + slack, middle - reach - slack]
        return out[0], out[2], out[1], out[3]

    def cells(self, q: np.ndarray, popped: int, bar: np.ndarray, hi: np.ndarray, budget: int | None) -> tuple[list, int]:
        """The next cells of the multi-sequence heap that some window (``bar`` to
        ``hi``) may need, and how many the heap has given out after them."""
        up1, up2, low1, low2 = self.bounds(q)
        by1, by2 = np.argsort(-up1, kind="stable"), np.argsort(-up2, kind="stable")
        s1, s2 = up1[by1].tolist(), up2[by2].tolist()
        heap, seen, out, n, rows = [(-(s1[0] + s2[0]), 0, 0)], {(0, 0)}, [], 0, 0
        worst = bar.min()
        while heap and (budget is None or rows < budget):
            bound, i, j = heap[0]
            if -bound < worst:
                break
            heapq.heappop(heap)
            n += 1
            for a, b in ((i + 1, j), (i, j + 1)):
                if a < len(s1) and b < len(s2) and (a, b) not in seen:
                    seen.add((a, b))
                    heapq.heappush(heap, (-(s1[a] + s2[b]), a, b))
            if n <= popped:
                continue
            c1, c2 = by1[i], by2[j]
            cell = int(c1) * len(s2) + int(c2)
            if self.rows[cell] and np.any((-bound >= bar) & (low1[c1] + low2[c2] <= hi)):
                out.append(cell)
                rows += int(self.rows[cell])
        return out, max(n, popped)


# ------------------------------------------------------------ inside tasks
def _vectors(column: pa.Array, dim: int) -> np.ndarray:
    return np.floor(256 * column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)).reshape(len(column), dim)


def _assign(words: list, dim: int, dtype: str):
    def run(batches):
        cut = words[0].shape[1]
        for batch in batches:
            x = _vectors(batch.column("x"), dim)
            (c1, d1), (c2, d2) = nearest(x[:, :cut], words[0]), nearest(x[:, cut:], words[1])
            packed = x.astype(dtype)
            yield pa.RecordBatch.from_arrays(
                [batch.column("uid"), batch.column("vec_id"), batch.column("label"), pa.array(c1.astype(np.int32)),
                 pa.array(c2.astype(np.int32)), pa.array(d1), pa.array(d2),
                 pa.array([r.tobytes() for r in packed], pa.binary())],
                ["uid", "vec_id", "label", "c1", "c2", "d1", "d2", "v"])

    return run


def _packed(table: pa.Table) -> pa.Table:
    """One row for a group: keys, and its columns as one binary each."""
    ids = table.column("vec_id")
    flat = {c: table.column(c).combine_chunks().to_numpy(zero_copy_only=False).astype(np.int64).tobytes()
            for c in ("uid", "label")}
    flat["null_id"] = ids.is_null().combine_chunks().to_numpy(zero_copy_only=False).tobytes()
    flat["vec_id"] = ids.fill_null(0).combine_chunks().to_numpy().astype(np.int64).tobytes()
    flat["v"] = b"".join(table.column("v").to_pylist())
    names = ["cell", "part", "uid", "vec_id", "null_id", "label", "v"]
    arrays = [pa.array([table.column(c)[0].as_py()], pa.int32()) for c in names[:2]] \
        + [pa.array([flat[c]], pa.binary()) for c in names[2:]]
    if "windows" in table.column_names:
        names.append("windows")
        arrays.append(pa.array([table.column("windows").to_pylist()], pa.list_(table.schema.field("windows").type)))
    return pa.Table.from_arrays(arrays, names=names)


_PACKED = "uid binary, vec_id binary, null_id binary, label binary, v binary"


def _matches(dim: int, dtype: str, k: int, same: bool):
    """Best rows of a chunk for each window of each anchor of a block."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                rows = {c: np.frombuffer(row[c], np.int64) for c in ("uid", "vec_id", "label")}
                null_id = np.frombuffer(row["null_id"], bool)
                x = np.frombuffer(row["v"], dtype).reshape(-1, dim)
                uid, label = np.frombuffer(row["a_uid"], np.int64), np.frombuffer(row["a_label"], np.int64)
                scores = np.frombuffer(row["a_v"], dtype).reshape(-1, dim) @ x.T
                may = label[:, None] == rows["label"][None, :]
                may = may & (uid[:, None] != rows["uid"][None, :]) if same else ~may
                windows = row["windows"]
                for w in range(max(map(len, windows), default=0)):
                    lo, hi = (np.array([ws[w][side] if w < len(ws) else empty for ws in windows])[:, None]
                              for side, empty in (("bar", math.inf), ("hi", -math.inf)))
                    a, r = np.nonzero(may & (scores >= lo) & (scores <= hi))
                    if not len(a):
                        continue
                    s = scores[a, r].astype(np.int64)
                    order = np.lexsort((rows["uid"][r], rows["vec_id"][r], null_id[r], -s, a))
                    a, r, s = a[order], r[order], s[order]
                    first = np.flatnonzero(np.r_[True, a[1:] != a[:-1]])
                    rank = np.arange(len(a)) - np.repeat(first, np.diff(np.r_[first, len(a)]))
                    a, r, s = (z[rank < k] for z in (a, r, s))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(uid[a]), pa.array(np.array([windows[i][w]["w"] for i in a], np.int32)),
                         pa.array(rows["uid"][r]), pa.array(rows["vec_id"][r], mask=null_id[r]), pa.array(s)],
                        ["uid", "w", "found_uid", "found_id", "score"])

    return run


def _plan(shared, dtype: str, budget: int | None):
    def run(batches):
        index = Index(*shared.value)
        for batch in batches:
            cells, popped = [], []
            for v, before, windows in zip(batch.column("v").to_pylist(), batch.column("popped").to_pylist(),
                                          batch.column("windows").to_pylist()):
                if not windows:
                    cells.append([])
                    popped.append(before)
                    continue
                c, n = index.cells(np.frombuffer(v, dtype).astype(np.float64), before,
                                   np.array([w["bar"] for w in windows]), np.array([w["hi"] for w in windows]), budget)
                cells.append(c)
                popped.append(n)
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("uid", "vec_id", "label", "v")] + [pa.array(popped, pa.int64()),
                 batch.column("windows"), pa.array(cells, pa.list_(pa.int32()))],
                ["uid", "vec_id", "label", "v", "popped", "windows", "cells"])

    return run


# ------------------------------------------------------------ on the driver
class _Search:
    """The written index of the rows of one dimension."""

    def __init__(self, rows: DataFrame, dim: int, n: int, norm: float) -> None:
        self.spark, self.dim = rows.sparkSession, dim
        self.dtype = "float32" if norm < 2**24 else "float64"
        k = min(CODEWORDS, max(2, math.ceil(math.sqrt(n / CELL_ROWS))))
        share = min(1.0, 1.2 * SAMPLE / n)
        pick = rows.where(F.pmod(F.xxhash64("uid"), F.lit(1 << 30)) < int(share * (1 << 30))).limit(SAMPLE)
        x = np.floor(256 * np.array([r.x for r in pick.select("x").collect()] or [[0.0] * dim], np.float64))
        words = [codebook(x[:, :dim // 2], k, 1), codebook(x[:, dim // 2:], k, 2)]
        self.rows = write_stage(rows.mapInArrow(
            _assign(words, dim, self.dtype), "uid long, vec_id long, label long, c1 int, c2 int, d1 double, d2 double, v binary")
            .withColumn("cell", F.col("c1") * F.lit(len(words[1])) + F.col("c2")), "vector_index")
        radii, counts = [np.zeros(len(w)) for w in words], np.zeros(len(words[0]) * len(words[1]), np.int64)
        for half, side in ((0, "1"), (1, "2")):
            for r in self.rows.groupBy(f"c{side}").agg(F.max(f"d{side}").alias("d")).collect():
                radii[half][r[0]] = r["d"]
        for r in self.rows.groupBy("cell").count().collect():
            counts[r["cell"]] = r["count"]
        parts = np.maximum(-(-counts // CHUNK_ROWS), 1)
        self.index = self.spark.sparkContext.broadcast((words, radii, counts))
        self.parts = self.spark.createDataFrame(
            [(int(c), int(parts[c])) for c in np.flatnonzero(counts)] or [(0, 1)], "cell int, parts int")
        chunk = self.rows.join(F.broadcast(self.parts), "cell") \
            .withColumn("part", F.pmod(F.xxhash64("uid"), F.col("parts")).cast("int"))
        self.chunks = write_stage(chunk.select("cell", "part", "uid", "vec_id", "label", "v").groupBy("cell", "part")
                                  .applyInArrow(_packed, f"cell int, part int, {_PACKED}"), "vector_chunks")

    def best(self, anchors: DataFrame, k: int, same: bool) -> DataFrame:
        """The ``k`` best rows for each window of ``anchors`` (``_STATE``
        without ``popped``): uid, w, rank, found_id, score."""
        state, found = anchors.withColumn("popped", F.lit(0).cast("long")), None
        order = [F.desc("score"), F.asc_nulls_last("found_id"), F.asc("found_uid")]
        blocks = max(1, -(-anchors.count() // BLOCK))
        for budget in BUDGETS:
            plan = write_stage(state.select("uid", "vec_id", "label", "v", "popped", "windows").mapInArrow(
                _plan(self.index, self.dtype, budget), _STATE + ", cells array<int>"), "vector_plan")
            if plan.agg(F.sum(F.size("cells"))).first()[0] == 0 and found is not None:
                break
            asked = plan.select(F.explode("cells").alias("cell"), F.pmod(F.xxhash64("uid"), F.lit(blocks)).cast("int").alias("part"),
                                "uid", "vec_id", "label", "v", "windows")
            packed = asked.groupBy("cell", "part").applyInArrow(
                _packed, f"cell int, part int, {_PACKED}, windows array<array<struct<w:int,lo:double,hi:double,bar:double>>>")
            pairs = packed.select("cell", F.col("uid").alias("a_uid"), F.col("label").alias("a_label"), F.col("v").alias("a_v"),
                                  "windows") \
                .join(F.broadcast(self.parts), "cell") \
                .withColumn("part", F.explode(F.expr("sequence(0, parts - 1)"))).drop("parts") \
                .join(self.chunks, ["cell", "part"]) \
                .select("a_uid", "a_label", "a_v", "windows", "uid", "vec_id", "null_id", "label", "v")
            hits = pairs.mapInArrow(_matches(self.dim, self.dtype, k, same),
                                    "uid long, w int, found_uid long, found_id long, score long")
            hits = hits if found is None else hits.unionByName(found.drop("rank"))
            found = write_stage(hits.withColumn("rank", F.row_number().over(Window.partitionBy("uid", "w").orderBy(*order)))
                                .where(F.col("rank") <= k), "vector_found")
            if budget is None:
                break
            bars = found.where(F.col("rank") == k).groupBy("uid") \
                .agg(F.map_from_entries(F.collect_list(F.struct("w", F.col("score").cast("double")))).alias("bars"))
            state = plan.drop("cells").join(bars, "uid", "left").withColumn("windows", F.expr(
                "transform(windows, x -> struct(x.w as w, x.lo as lo, x.hi as hi, "
                "greatest(x.lo, coalesce(try_element_at(bars, x.w), x.lo)) as bar))")).drop("bars")
        return found


def _of_dimension(rows: DataFrame, dim: int, n: int, norm: float, positives: int, negatives: int, low: int, high: int,
                  is_anchor: Column) -> DataFrame:
    search = _Search(rows, dim, n, norm)
    anchors = search.rows.where(is_anchor).select("uid", "vec_id", "label", "v")
    window = F.struct(F.lit(0).alias("w"), F.lit(-math.inf).alias("lo"), F.lit(math.inf).alias("hi"),
                      F.lit(-math.inf).alias("bar"))
    near = search.best(anchors.withColumn("windows", F.array(window)), positives, same=True)
    def floor_div(x: str) -> str:
        return f"((({x}) - pmod({x}, 100L)) div 100)"

    near = near.withColumn("lo", F.expr(f"cast(-{floor_div(f'-{low} * score')} as double)")) \
        .withColumn("hi", F.expr(f"cast({floor_div(f'{high} * score')} as double)"))
    spans = near.where("lo <= hi").groupBy("uid").agg(F.sort_array(F.collect_list(F.struct(
        F.col("rank").alias("w"), "lo", "hi", F.col("lo").alias("bar")))).alias("windows"))
    far = search.best(anchors.join(spans, "uid"), negatives, same=False)
    return far.select("uid", "w", F.col("rank"), F.col("found_id").alias("negative_id"), F.col("score").alias("negative_score")) \
        .join(near.select("uid", F.col("rank").alias("w"), F.col("found_id").alias("positive_id"),
                          F.col("score").alias("positive_score")), ["uid", "w"]) \
        .join(anchors.select("uid", F.col("vec_id").alias("anchor_id")), "uid") \
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def hard_negatives(vectors: DataFrame, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90,
                   every: int = 100) -> DataFrame:
    """Per anchor (``vec_id`` divisible by ``every``) and positive, the best
    rows of other labels that score ``low`` to ``high`` percent of the positive."""
    x = F.transform("embedding", lambda v: v.cast("double"))
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), x.alias("x")) \
        .where(F.col("label").isNotNull() & F.col("x").isNotNull()) \
        .where(F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < math.inf))) \
        .withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))) \
        .withColumn("uid", F.monotonically_increasing_id())
    rows = write_stage(rows, "vector_rows")
    norm = F.aggregate("x", F.lit(0.0), lambda s, v: s + (F.abs(v) * 256 + 1) * (F.abs(v) * 256 + 1))
    sizes = rows.groupBy(F.size("x").alias("dim")).agg(F.count("*").alias("n"), F.max(norm).alias("norm")) \
        .orderBy("dim").collect()  # one row for each dimension that occurs
    out = None
    for s in sizes:
        if s["norm"] >= 2**53:
            raise ValueError(f"scores of vectors with {s['dim']} components may pass 2**53")
        part = _of_dimension(rows.where(F.size("x") == s["dim"]), s["dim"], s["n"], s["norm"], positives, negatives, low,
                             high, (F.col("vec_id") % every == 0))
        out = part if out is None else out.unionByName(part)
    if out is None:
        out = vectors.sparkSession.createDataFrame(
            [], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    return out
