"""Histogram trees (M7, M8, M10, M16): boosting and forests, many models at once.

One statistic serves all of them: with ``g`` and ``h`` per row, a split gains
``GL^2/HL + GR^2/HR - G^2/H``.  Boosting takes ``g`` = residual and ``h`` = 1, a
forest ``g`` = weight * y and ``h`` = weight, which for 0/1 labels is the Gini
criterion.  Rows carry bins of their features, so a node needs one histogram.

A model asks for the histograms of its open nodes; all models' requests are
answered by one pass over the rows, in which each task adds up its own rows
and one row per (model, node) and task is shuffled.  Where the rows of a data
set are at most ``LOCAL_BYTES`` the same growth runs inside a task instead,
one task per model or block of trees.  Values are whole numbers on a fixed
scale, so sums do not depend on the order of rows, and both ways, and reruns
on other partitions, give the same trees.

Trees have no depth limit.  Boosting is best-first up to ``max_leaves``; a
forest splits as long as a split gains.  Bootstrap counts and feature draws
come from hashes of (row, tree) and (tree, node).
"""

from __future__ import annotations

import heapq
import pickle
import sys
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Rows of a data set (bins, target, weight) that one task may hold.
LOCAL_BYTES = 16 << 20
#: Nodes answered by one pass.
NODES_PER_PASS = 4096
#: Trees of a forest grown by one task, where rows are local.
TREE_BLOCK = 25
#: Boosted trees are added to the stored margins after so many rounds.
REFRESH = 10
#: Rows of the nodes whose splits are searched at once, and of such a node.
SPLIT_ROWS = 4096
FEW_ROWS = 96

_P = (1 << 31) - 1
#: Cumulative Poisson(1) probabilities: a row's count in a bootstrap sample.
_POISSON = np.cumsum(np.exp(-1.0) / np.cumprod(np.r_[1.0, np.arange(1.0, 12.0)]))


@dataclass(frozen=True)
class Spec:
    """One model: rows of data set ``rows``, columns ``features`` of its bins."""
    key: str
    rows: int
    kind: str                      # "boosting" or "forest"
    features: tuple[int, ...]
    trees: int = 100
    rate: float = 0.1
    max_leaves: int | None = 31
    min_leaf: int = 20
    max_depth: int | None = None
    draw: int | None = None        # features tried at a node; None: all
    bootstrap: bool = True
    classes: bool = False          # labels 0 and 1
    seed: int = 42


def _mix(x) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = np.asarray(x, np.uint64)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def bootstrap_factors(seed: int, tree: int) -> tuple[int, int]:
    """(a, b) of the hash ``(a * row + b) mod (2^31 - 1)`` that draws a tree's sample."""
    a, b = (int(v % np.uint64(_P - 1)) + 1 for v in _mix(np.array([2 * tree, 2 * tree + 1], np.uint64)
                                                         + np.uint64(seed * 0x9E3779B97F4A7C15 % 2**64)))
    return a, b


def bootstrap_counts(row: np.ndarray, seed: int, tree: int) -> np.ndarray:
    """How often each row (a hash under 2^31) is in the sample of ``tree``."""
    a, b = bootstrap_factors(seed, tree)
    u = ((row.astype(np.uint64) * np.uint64(a) + np.uint64(b)) % np.uint64(_P)).astype(np.float64) / _P
    return np.searchsorted(_POISSON, u, "right")


@dataclass
class Tree:
    """A tree; ``best[k]`` is None for a node known to stay a leaf."""
    feature: list[int] = field(default_factory=lambda: [-1])
    bin: list[int] = field(default_factory=lambda: [0])
    left: list[int] = field(default_factory=lambda: [-1])
    right: list[int] = field(default_factory=lambda: [-1])
    path: list[int] = field(default_factory=lambda: [1])
    depth: list[int] = field(default_factory=lambda: [0])
    stats: list[tuple] = field(default_factory=lambda: [(0.0, 0.0, 0.0)])
    gain: list[float] = field(default_factory=lambda: [0.0])
    tried: dict = field(default_factory=dict)   # node -> features tried so far
    best: dict = field(default_factory=dict)

    def order(self, node: int, spec: Spec, tree: int) -> list[int]:
        """Features in the order in which the node may try them."""
        if spec.draw is None or spec.draw >= len(spec.features):
            return list(spec.features)
        seed = _mix(np.uint64((spec.seed * 1_000_003 + tree) % 2**64)) ^ _mix(np.uint64(self.path[node]))
        rank = _mix(np.array(spec.features, np.uint64) + seed)
        return [spec.features[k] for k in np.argsort(rank, kind="stable")]

    def to_try(self, node: int, spec: Spec, tree: int) -> list[int]:
        order, done = self.order(node, spec, tree), self.tried.get(node, 0)
        return order[done:done + (spec.draw or len(order))]

    def receive(self, node: int, spec: Spec, tree: int, found: tuple | None, totals: tuple) -> None:
        """Result of a histogram: (feature, bin, left stats, right stats, gain)."""
        if node == 0:
            self.stats[0] = totals
        if found is None:
            self.tried[node] = self.tried.get(node, 0) + len(self.to_try(node, spec, tree))
            if self.tried[node] >= len(spec.features):
                self.best[node] = None
            return
        f, b, low, high, gain = found
        self.best[node] = gain
        self.feature[node], self.bin[node], self.gain[node] = f, b, gain
        for side, stats in ((self.left, low), (self.right, high)):
            k = len(self.feature)
            side[node] = k
            self.feature.append(-1)
            self.bin.append(0)
            self.left.append(-1)
            self.right.append(-1)
            self.path.append((2 * self.path[node] + (side is self.right)) % (1 << 61))
            self.depth.append(self.depth[node] + 1)
            self.stats.append(stats)
            self.gain.append(0.0)
            pure = spec.classes and stats[0] in (0.0, stats[1])
            if pure or stats[2] < 2 * spec.min_leaf or (spec.max_depth is not None and self.depth[k] >= spec.max_depth):
                self.best[k] = None

    def chosen(self, spec: Spec) -> tuple[set[int], list[int]]:
        """Nodes that best-first growth splits, and nodes it needs to know."""
        if spec.max_leaves is None:  # all that gain are split, in any order
            return ({k for k, gain in self.best.items() if gain is not None},
                    [k for k in range(len(self.feature)) if k not in self.best])
        if 0 not in self.best:
            return set(), [0]
        heap = [(-self.best[0], 0)] if self.best[0] is not None else []
        split, unknown = set(), []
        while heap and (spec.max_leaves is None or len(split) + 1 < spec.max_leaves):
            _, node = heapq.heappop(heap)
            split.add(node)
            for k in (self.left[node], self.right[node]):
                if k not in self.best:
                    unknown.append(k)
                elif self.best[k] is not None:
                    heapq.heappush(heap, (-self.best[k], k))
        return split, unknown

    def finished(self, spec: Spec, scale: float) -> dict:
        """Arrays of the final tree; only chosen nodes are split."""
        rate, unit = (spec.rate / scale, 1.0) if spec.kind == "boosting" else (1.0, scale)
        split, _ = self.chosen(spec)
        inner = np.array([k in split for k in range(len(self.feature))])
        g = np.array([s[0] for s in self.stats])
        h = np.array([s[1] for s in self.stats])
        value = np.divide(g, h, out=np.zeros(len(g)), where=h > 0) * rate
        return {"feature": np.where(inner, self.feature, -1).astype(np.int32), "bin": np.array(self.bin, np.int32),
                "left": np.array(self.left, np.int32), "right": np.array(self.right, np.int32), "value": value,
                "gain": np.where(inner, self.gain, 0.0), "weight": h / unit}


def leaves_of(tree: dict, bins: np.ndarray) -> np.ndarray:
    """The leaf of each row."""
    node = np.zeros(len(bins), np.int32)
    while True:
        f = tree["feature"][node]
        live = np.flatnonzero(f >= 0)
        if not len(live):
            return node
        at = node[live]
        low = bins[live, f[live]] <= tree["bin"][at]
        node[live] = np.where(low, tree["left"][at], tree["right"][at])


def best_split(g: np.ndarray, h: np.ndarray, n: np.ndarray, features: list[int], min_leaf: int, first_only: bool):
    """The best split of a node from its histograms (feature x bin), and its totals.
    ``first_only``: only the first feature that can split counts."""
    totals = (g[0].sum(), h[0].sum(), n[0].sum())
    gl, hl, nl = (np.cumsum(x, 1)[:, :-1] for x in (g, h, n))
    gr, hr, nr = totals[0] - gl, totals[1] - hl, totals[2] - nl
    ok = (nl >= min_leaf) & (nr >= min_leaf) & (hl > 0) & (hr > 0)
    if first_only and ok.any():
        ok[np.flatnonzero(ok.any(1))[0] + 1:] = False
    if not ok.any():
        return None, totals
    gain = np.full(ok.shape, -np.inf)
    gain[ok] = gl[ok] ** 2 / hl[ok] + gr[ok] ** 2 / hr[ok]
    k, b = np.unravel_index(int(gain.argmax()), gain.shape)
    before = totals[0] ** 2 / totals[1]
    won = float(gain[k, b] - before)
    if won <= 1e-12 * before:  # pure, or nothing to gain
        return None, totals
    return (features[k], int(b), (gl[k, b], hl[k, b], nl[k, b]), (gr[k, b], hr[k, b], nr[k, b]), won), totals


def best_sorted_split(bins: np.ndarray, g, h, n, features: list[int], min_leaf: int, first_only: bool):
    """``best_split`` of a node of few rows: its rows sorted by each feature,
    instead of sums over all bins.  Sums are of whole numbers, so both agree."""
    totals = (g.sum(), h.sum(), n.sum())
    x = bins[:, features].T
    order = np.argsort(x, 1, kind="stable")
    x = np.take_along_axis(x, order, 1)
    gl, hl, nl = (np.cumsum(v[order], 1)[:, :-1] for v in (g, h, n))
    hr, nr = totals[1] - hl, totals[2] - nl
    ok = (x[:, 1:] != x[:, :-1]) & (nl >= min_leaf) & (nr >= min_leaf) & (hl > 0) & (hr > 0)
    if first_only and ok.any():
        ok[np.flatnonzero(ok.any(1))[0] + 1:] = False
    if not ok.any():
        return None, totals
    at = np.flatnonzero(ok)
    gl, hl, nl, hr = gl.ravel()[at], hl.ravel()[at], nl.ravel()[at], hr.ravel()[at]
    gr = totals[0] - gl
    gain = gl ** 2 / hl + gr ** 2 / hr
    i = int(gain.argmax())
    k, j = divmod(int(at[i]), ok.shape[1])
    before = totals[0] ** 2 / totals[1]
    won = float(gain[i] - before)
    if won <= 1e-12 * before:  # pure, or nothing to gain
        return None, totals
    return (features[k], int(x[k, j]), (gl[i], hl[i], nl[i]), (gr[i], hr[i], totals[2] - nl[i]), won), totals


def best_sorted_splits(bins: np.ndarray, g, h, n, rows: list[np.ndarray], features: np.ndarray,
                       min_leaf: int) -> list[tuple]:
    """``best_sorted_split`` of many nodes side by side: their ``rows`` sorted
    by each of the node's ``features`` (node x feature)."""
    sizes = np.array([len(r) for r in rows])
    at, node = np.concatenate(rows), np.repeat(np.arange(len(rows)), sizes)
    ends = np.cumsum(sizes)
    starts, size = ends - sizes, len(at)
    x = bins[at, features[node].T]
    order = np.argsort(x, 1, kind="stable")
    by_node = np.argsort(node.astype(np.uint16)[order], 1, kind="stable")
    line = np.arange(len(x))[:, None]
    order = order[line, by_node]
    x = x[line, order]
    same = h is n
    sums = []
    for v in (g, h) if same else (g, h, n):
        low = np.cumsum(v[at][order], 1)
        before = np.where(starts > 0, low[0, starts - 1], 0.0)
        sums.append((low - before[node], low[0, ends - 1] - before))
    if same:
        sums.append(sums[1])
    (gl, tg), (hl, th), (nl, tn) = sums
    hr, nr = th[node] - hl, tn[node] - nl
    ok = np.zeros(x.shape, bool)
    ok[:, :-1] = x[:, 1:] != x[:, :-1]
    ok[:, ends - 1] = False
    ok &= (nl >= min_leaf) & (nr >= min_leaf) & (hl > 0) & (hr > 0)
    i = np.flatnonzero(ok)
    gl_, hl_, hr_ = gl.ravel()[i], hl.ravel()[i], hr.ravel()[i]
    gain = np.full(ok.shape, -np.inf)
    gain.ravel()[i] = gl_ ** 2 / hl_ + (tg[node][i % size] - gl_) ** 2 / hr_
    most = np.maximum.reduceat(gain, starts, 1)
    chosen = most.argmax(0)  # of equal gains the first feature and the lowest bin
    out = []
    for k, f in enumerate(chosen.tolist()):
        totals = (tg[k], th[k], tn[k])
        top = most[f, k]
        before = totals[0] ** 2 / totals[1] if totals[1] else 0.0
        won = float(top - before)
        if top == -np.inf or won <= 1e-12 * before:  # no split, pure, or nothing to gain
            out.append((None, totals))
            continue
        j = starts[k] + int(gain[f, starts[k]:ends[k]].argmax())
        low = (gl[f, j], hl[f, j], nl[f, j])
        out.append(((int(features[k, f]), int(x[f, j]), low,
                     (totals[0] - low[0], hr[f, j], nr[f, j]), won), totals))
    return out


def histograms(bins: np.ndarray, g, h, n, features: list[int], width: int) -> np.ndarray:
    """(3, feature, bin) sums of the rows."""
    key = (bins[:, features].astype(np.int64) + np.arange(len(features)) * width).ravel()
    size, m = len(features) * width, len(features)
    sums = [np.bincount(key, np.repeat(v, m), size).reshape(m, width) for v in ((g, h) if h is n else (g, h, n))]
    return np.stack(sums if len(sums) == 3 else [*sums, sums[1]])


def to_scale(limit: float) -> float:
    """The power of two that keeps whole multiples, summed to ``limit``, exact."""
    return 2.0 ** np.floor(np.log2(2.0 ** 52 / limit)) if limit > 0 else 1.0


def row_values(spec: Spec, tree: int, y, w, row, margin, scale):
    """g, h and n of the rows on the fixed scale."""
    if spec.kind == "boosting":
        ones = np.ones(len(y))
        return np.round((y - margin) * scale), ones, ones
    times = bootstrap_counts(row, spec.seed, tree) if spec.bootstrap else np.ones(len(y))
    return np.round(y * w * scale) * times, np.round(w * scale) * times, (times > 0).astype(float)


def _small_splits(bins, g, h, n, work: list[tuple], min_leaf: int) -> dict:
    """First tries of small nodes ``work`` (node, rows, features), in blocks of
    about ``SPLIT_ROWS`` rows; nodes have equally many features to try."""
    out, at = {}, 0
    while at < len(work):
        end, size = at, 0
        while end < len(work) and (end == at or size + len(work[end][1]) <= SPLIT_ROWS):
            size += len(work[end][1])
            end += 1
        if end > at + 1:
            nodes, rows, features = zip(*work[at:end])
            out.update(zip(nodes, best_sorted_splits(bins, g, h, n, rows, np.array(features), min_leaf)))
        at = end
    return out


def grow(tree: Tree, spec: Spec, number: int, bins, g, h, n, width: int) -> None:
    """Grow one tree over rows in memory."""
    rows = {0: np.flatnonzero(n > 0)}
    while True:
        _, unknown = tree.chosen(spec)
        if not unknown:
            return
        small = _small_splits(bins, g, h, n, [(k, rows[k], tree.to_try(k, spec, number)) for k in unknown
                                              if 0 < len(rows[k]) < min(FEW_ROWS, width)], spec.min_leaf)
        for node in unknown:
            at = rows[node]
            while node not in tree.best:
                features, again = tree.to_try(node, spec, number), node in tree.tried
                if len(at) == 0:
                    found, totals = None, (0.0, 0.0, 0.0)
                elif len(at) < width:
                    found, totals = small.pop(node, None) or best_sorted_split(
                        bins[at], g[at], h[at], n[at], features, spec.min_leaf, again)
                else:
                    gs, hs = g[at], h[at]
                    sums = histograms(bins[at], gs, hs, hs if h is n else n[at], features, width)
                    found, totals = best_split(*sums, features, spec.min_leaf, again)
                tree.receive(node, spec, number, found, totals)
            if tree.best[node] is not None:
                low = bins[at, tree.feature[node]] <= tree.bin[node]
                rows[tree.left[node]], rows[tree.right[node]] = at[low], at[~low]


def fit_local(spec: Spec, numbers: range, bins, y, w, row, base: float, scale, width: int) -> list[dict]:
    margin, out = np.full(len(y), base), []
    for t in numbers:
        tree = Tree()
        grow(tree, spec, t, bins, *row_values(spec, t, y, w, row, margin, scale), width)
        done = tree.finished(spec, scale)
        if spec.kind == "boosting":
            margin = margin + done["value"][leaves_of(done, bins)]
        out.append(done)
    return out


# ------------------------------------------------------------ over Spark
def _unpack(batch, width_of: dict):
    """Rows of a batch by data set: (set, bins, y, w, row, index)."""
    sets = batch.column("rows").to_numpy()
    for s in np.unique(sets):
        at = np.flatnonzero(sets == s)
        part = batch.take(pa.array(at))
        flat = np.frombuffer(b"".join(part.column("bins").to_pylist()), np.uint16)
        yield int(s), flat.reshape(len(at), -1), *(part.column(c).to_numpy() for c in ("y", "w", "row")), part


def _margin(spec: Spec, base: float, done: list[dict], bins: np.ndarray, start=None) -> np.ndarray:
    out = np.full(len(bins), base) if start is None else start.copy()
    for tree in done:
        out = out + tree["value"][leaves_of(tree, bins)]
    return out


def _sums(shared):
    """Histograms of all requested nodes over the rows of one task."""

    def run(batches):
        requests, scales, widths = pickle.loads(shared.value)
        total: dict[tuple, np.ndarray] = {}
        for batch in batches:
            for s, bins, y, w, row, part in _unpack(batch, widths):
                margins = part.column("margins").to_pylist()
                for spec, number, base, place, recent, partial, nodes in requests.get(s, ()):
                    margin = None
                    if spec.kind == "boosting":
                        margin = _margin(spec, base, recent, bins, np.array([m[place] for m in margins]))
                    g, h, n = row_values(spec, number, y, w, row, margin, scales[s])
                    node = leaves_of(partial, bins)
                    for k, features in nodes:
                        at = np.flatnonzero((node == k) & (n > 0))
                        found = histograms(bins[at], g[at], h[at], n[at], features, widths[s])
                        key = (spec.key, number, k)
                        total[key] = total[key] + found if key in total else found
        if total:
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in total]), pa.array([k[1] for k in total], pa.int32()),
                 pa.array([k[2] for k in total], pa.int32()), pa.array([v.tobytes() for v in total.values()], pa.binary())],
                ["key", "tree", "node", "sums"])

    return run


def _best(tries):
    def run(table: pa.Table) -> pa.Table:
        key, tree, node = (table.column(c)[0].as_py() for c in ("key", "tree", "node"))
        features, min_leaf, again = tries[key, tree, node]
        sums = sum(np.frombuffer(b, np.float64) for b in table.column("sums").to_pylist())
        found, totals = best_split(*sums.reshape(3, len(features), -1), features, min_leaf, again)
        f, b, low, high, gain = found or (-1, 0, (0.0,) * 3, (0.0,) * 3, 0.0)
        return pa.Table.from_pylist([{"key": key, "tree": tree, "node": node, "feature": f, "bin": b, "gain": gain,
                                      "stats": [float(x) for x in (*totals, *low, *high)]}], _BEST_ARROW)

    return run


_BEST = "key string, tree int, node int, feature int, bin int, gain double, stats array<double>"
_BEST_ARROW = pa.schema([("key", pa.string()), ("tree", pa.int32()), ("node", pa.int32()), ("feature", pa.int32()),
                         ("bin", pa.int32()), ("gain", pa.float64()), ("stats", pa.list_(pa.float64()))])


def _local(shared, scales: dict, widths: dict):
    """Models (blocks of trees) over the packed rows of their data set."""

    def run(batches):
        specs = {s.key: s for s in pickle.loads(shared.value)}
        for batch in batches:
            for r in batch.to_pylist():
                spec, s = specs[r["key"]], r["rows"]
                y, w, row = (np.frombuffer(r[c], t) for c, t in (("y", np.float64), ("w", np.float64), ("row", np.int64)))
                bins = np.frombuffer(r["bins"], np.uint16).reshape(len(y), -1)
                last = spec.trees if spec.kind == "boosting" else min(r["first"] + TREE_BLOCK, spec.trees)
                done = fit_local(spec, range(r["first"], last), bins, y, w, row, r["base"], scales[s], widths[s])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([spec.key]), pa.array([r["first"]], pa.int32()), pa.array([pickle.dumps(done)], pa.binary())],
                    ["key", "first", "done"])

    return run


def _pack(table: pa.Table) -> pa.Table:
    cols = {c: table.column(c).combine_chunks().to_numpy(zero_copy_only=False) for c in ("y", "w", "row")}
    order = np.lexsort((cols["y"], cols["row"]))  # any order gives the same trees; this one is fixed
    flat = np.frombuffer(b"".join(table.column("bins").to_pylist()), np.uint16).reshape(len(order), -1)
    return pa.Table.from_arrays(
        [pa.array([table.column("rows")[0].as_py()], pa.int32()), pa.array([flat[order].tobytes()], pa.binary()),
         *(pa.array([cols[c][order].tobytes()], pa.binary()) for c in ("y", "w", "row"))], names=["rows", "bins", "y", "w", "row"])


def fit_trees(rows: DataFrame, specs: list[Spec], local_bytes: int = LOCAL_BYTES) -> dict[str, dict]:
    """Fit all models.  ``rows``: rows int (data set), bins binary (uint16), y
    double, w double, row long (hash under 2^31).  Returns per model key:
    base, trees, and the spec.  Models are small: nodes, not rows, reach the driver."""
    spark = rows.sparkSession
    sizes = {r["rows"]: r for r in rows.groupBy("rows").agg(
        F.count("*").alias("n"), F.max(F.length("bins")).alias("bytes"), F.sum("y").alias("sum_y"),
        F.max(F.abs("y")).alias("max_y"), F.max("w").alias("max_w"), F.min("y").alias("min_y"),
        F.max("y").alias("top_y")).collect()}
    specs = [s for s in specs if s.rows in sizes]
    widths = {r["rows"]: r["w"] for r in rows.mapInArrow(_widths, "rows int, w int").groupBy("rows")
              .agg(F.max("w").alias("w")).collect()}
    scales = {}
    for s, r in sizes.items():
        reach = r["n"] * 8.0  # a row's bootstrap count stays under 12, its mean is 1
        span = max(abs(r["max_y"] or 0.0), (r["top_y"] - r["min_y"]), 0.5)
        scales[s] = to_scale(2 * span * (r["max_w"] or 1.0) * reach)
    base = {s: r["sum_y"] / r["n"] for s, r in sizes.items()}
    out = {s.key: {"spec": s, "base": base[s.rows] if s.kind == "boosting" else 0.0, "trees": []} for s in specs}
    small = {s for s, r in sizes.items() if r["n"] * (r["bytes"] + 24) <= local_bytes}
    local = [s for s in specs if s.rows in small]
    if local:
        # boosting, the longest, begins first; each unit of work has a task of its own
        units = [(s.rows, s.key, first, float(out[s.key]["base"])) for s in sorted(local, key=lambda s: s.kind != "boosting")
                 for first in range(0, s.trees, s.trees if s.kind == "boosting" else TREE_BLOCK)]
        work = spark.createDataFrame([(*u, k) for k, u in enumerate(units)],
                                     "rows int, key string, first int, base double, unit int")
        packed = rows.where(F.col("rows").isin(sorted(small))).groupBy("rows").applyInArrow(
            _pack, "rows int, bins binary, y binary, w binary, row binary")
        shared = spark.sparkContext.broadcast(cloudpickle.dumps(local))
        done = work.join(packed, "rows").repartitionById(len(units), "unit") \
            .mapInArrow(_local(shared, scales, widths), "key string, first int, done binary")
        for r in sorted(done.collect(), key=lambda r: r["first"]):
            out[r["key"]]["trees"] += pickle.loads(r["done"])
    far = [s for s in specs if s.rows not in small]
    if far:
        _fit_far(rows.where(F.col("rows").isin(sorted({s.rows for s in far}))), far, out, scales, widths)
    return out


def _widths(batches):
    for batch in batches:
        for s, bins, *_ in _unpack(batch, {}):
            yield pa.RecordBatch.from_arrays([pa.array([s], pa.int32()), pa.array([int(bins.max()) + 1], pa.int32())],
                                             ["rows", "w"])


def _fit_far(rows: DataFrame, specs: list[Spec], out: dict, scales: dict, widths: dict) -> None:
    """All models by passes over the rows; forests grow all their trees at
    once, boosting one tree a round."""
    spark = rows.sparkSession
    places = {}
    for s in specs:
        if s.kind == "boosting":
            places[s.key] = sum(1 for k in places if out[k]["spec"].rows == s.rows)
    bases = {}
    for s in specs:
        if s.kind == "boosting":
            bases.setdefault(s.rows, []).append(out[s.key]["base"])
    start = F.array().cast("array<double>")
    for s, values in bases.items():
        start = F.when(F.col("rows") == s, F.array(*[F.lit(float(v)) for v in values])).otherwise(start)
    stage = rows.withColumn("margins", start).persist()
    recent = {s.key: [] for s in specs}
    growing = {(s.key, t): Tree() for s in specs for t in (range(s.trees) if s.kind == "forest" else range(1))}
    by_key = {s.key: s for s in specs}
    finished: dict = {}
    while growing:
        requests, tries = {}, {}
        for (key, t), tree in growing.items():
            spec = by_key[key]
            nodes = [(k, tree.to_try(k, spec, t)) for k in tree.chosen(spec)[1]][:max(0, NODES_PER_PASS - len(tries))]
            if nodes:
                partial = {"feature": np.array(tree.feature, np.int32), "bin": np.array(tree.bin, np.int32),
                           "left": np.array(tree.left, np.int32), "right": np.array(tree.right, np.int32)}
                requests.setdefault(spec.rows, []).append(
                    (spec, t, out[key]["base"], places.get(key), recent[key], partial, nodes))
                tries.update({(key, t, k): (f, spec.min_leaf, k in tree.tried) for k, f in nodes})
        shared = spark.sparkContext.broadcast(cloudpickle.dumps((requests, scales, widths)))
        for r in stage.mapInArrow(_sums(shared), "key string, tree int, node int, sums binary") \
                .groupBy("key", "tree", "node").applyInArrow(_best(tries), _BEST).collect():
            st = r["stats"]
            found = None if r["feature"] < 0 else (r["feature"], r["bin"], tuple(st[3:6]), tuple(st[6:9]), r["gain"])
            growing[r["key"], r["tree"]].receive(r["node"], by_key[r["key"]], r["tree"], found, tuple(st[:3]))
            tries.pop((r["key"], r["tree"], r["node"]))
        for key, t, node in tries:  # no row has such a node
            growing[key, t].receive(node, by_key[key], t, None, (0.0, 0.0, 0.0))
        shared.destroy()
        for key, t in [k for k, tree in growing.items() if not tree.chosen(by_key[k[0]])[1]]:
            spec = by_key[key]
            done = growing.pop((key, t)).finished(spec, scales[spec.rows])
            finished.setdefault(key, {})[t] = done
            if spec.kind == "boosting":
                recent[key] = [*recent[key], done]
                if t + 1 < spec.trees:
                    growing[key, t + 1] = Tree()
        if places and max(len(recent[k]) for k in places) >= REFRESH:
            stage = _refreshed(stage, [(by_key[k], places[k], recent[k]) for k in places])
            recent = {k: [] for k in recent}
    stage.unpersist()
    for key, trees in finished.items():
        out[key]["trees"] = [trees[t] for t in sorted(trees)]


def _refreshed(stage: DataFrame, models: list) -> DataFrame:
    """The rows with the latest trees added to their margins, lineage cut."""
    from pitpanel.session import cut_lineage

    def run(batches):
        for batch in batches:
            margins = batch.column("margins").to_pylist()
            sets = batch.column("rows").to_numpy()
            flat = [np.frombuffer(b, np.uint16) for b in batch.column("bins").to_pylist()]
            for spec, place, trees in models:
                at = np.flatnonzero(sets == spec.rows)
                if len(at):
                    bins = np.stack([flat[k] for k in at])
                    new = _margin(spec, 0.0, trees, bins, np.array([margins[k][place] for k in at]))
                    for k, v in zip(at, new):
                        margins[k][place] = float(v)
            yield batch.set_column(batch.schema.get_field_index("margins"), "margins", pa.array(margins, pa.list_(pa.float64())))

    new = cut_lineage(stage.mapInArrow(run, stage.schema))
    stage.unpersist()
    return new.persist()


def predict_rows(model: dict, bins: np.ndarray) -> np.ndarray:
    """A model's value for rows of bins: the boosted sum or the mean over trees."""
    values = [t["value"][leaves_of(t, bins)] for t in model["trees"]]
    if model["spec"].kind == "boosting":
        return model["base"] + np.sum(values, 0) if values else np.full(len(bins), model["base"])
    return np.mean(values, 0) if values else np.zeros(len(bins))


def importances(model: dict, n_features: int) -> np.ndarray:
    """Mean over trees of each tree's normalised gains by feature."""
    total = np.zeros(n_features)
    for t in model["trees"]:
        inner = t["feature"] >= 0
        mine = np.bincount(t["feature"][inner], t["gain"][inner], n_features)
        total += mine / mine.sum() if mine.sum() > 0 else 0.0
    return total / total.sum() if total.sum() > 0 else total
