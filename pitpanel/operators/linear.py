"""Design matrices, ridge and logistic regression (M5, M6, M9) and pairwise
correlations (A20), for many data sets and feature groups at once.

The rows of all data sets are written once as vectors.  One pass adds up a Gram
matrix per data set in each task (rows never move; one small matrix per task
does), and any feature group's ridge is a solve on part of that matrix.  The
logistic models of all groups take a Newton step together in each pass.  Only
matrices whose size is the number of columns reach the driver.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pitpanel.operators.metrics import exact_quantiles

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Split candidates of a numeric column: all values if they are fewer, else quantiles.
MAX_BINS = 255
_MANY = 300


@dataclass(frozen=True)
class Column_:
    """One column of the design matrix: a scaled number, or one category."""
    feature: str
    value: str | None          # None: numeric
    fill: object = None        # median, or most frequent category
    mean: float = 0.0
    scale: float = 1.0
    edges: tuple[float, ...] = ()

    @property
    def name(self) -> str:
        return self.feature if self.value is None else f"{self.feature}={self.value}"


def design_columns(train: DataFrame, set_col: str, numeric: Sequence[str], categorical: Sequence[str],
                   max_bins: int = MAX_BINS) -> dict[int, list[Column_]]:
    """M5 for every data set at once, from its training rows: medians, mean and
    population deviation of the filled column, most frequent and distinct
    categories, and bin edges.  Columns without any value are left out."""
    numeric, categorical = list(numeric), list(categorical)
    out: dict[int, list[Column_]] = {r[0]: [] for r in train.select(set_col).distinct().collect()}

    def cells(columns, kind):
        return F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"`{c}`").cast(kind).alias("value"))
                                   for c in columns])).alias("s")

    if numeric:
        long = train.select(F.col(set_col).alias("_set"), cells(numeric, "double")).select("_set", "s.*")
        med = {(r["_set"], r["feature"]): r["median"]
               for r in exact_quantiles(long, ["_set", "feature"], "value", {"median": 0.5}).collect()}
        known = long.where(F.col("value").isNotNull())
        median = F.create_map(*[F.lit(x) for (s, f), m in med.items() for x in (f"{s}/{f}", float(m))]) if med else None
        if med:
            filled = long.withColumn("_m", median[F.concat_ws("/", "_set", "feature")]).where(F.col("_m").isNotNull()) \
                .withColumn("value", F.coalesce("value", "_m"))
            probs = [k / (max_bins + 1) for k in range(1, max_bins + 1)]
            stats = filled.groupBy("_set", "feature").agg(
                F.avg("value").alias("mean"), F.stddev_pop("value").alias("sd"),
                F.approx_count_distinct("value", 0.02).alias("distinct"),
                F.percentile_approx("value", F.array(*[F.lit(p) for p in probs]), 10_000).alias("marks"))
            stats = sorted(stats.collect(), key=lambda r: numeric.index(r["feature"]))
            names = [f"{r['_set']}/{r['feature']}" for r in stats if r["distinct"] <= _MANY]
            few = filled.where(F.concat_ws("/", "_set", "feature").isin(names)) \
                .groupBy("_set", "feature").agg(F.collect_set("value").alias("values"))  # about _MANY values at most
            exact = {(r["_set"], r["feature"]): sorted(r["values"]) for r in few.collect()} if names else {}
            for r in stats:
                values = exact.get((r["_set"], r["feature"]), [])
                if not values or len(values) > max_bins + 1:
                    values = sorted(set(r["marks"]))
                edges = tuple((a + b) / 2 for a, b in zip(values, values[1:]))
                sd = r["sd"] if r["sd"] and r["sd"] > 1e-12 else 1.0
                out[r["_set"]].append(Column_(r["feature"], None, med[r["_set"], r["feature"]], r["mean"], sd, edges))
        del known
    if categorical:
        long = train.select(F.col(set_col).alias("_set"), cells(categorical, "string")).select("_set", "s.*") \
            .where(F.col("value").isNotNull())
        counts = long.groupBy("_set", "feature", "value").count()
        w = Window.partitionBy("_set", "feature").orderBy(F.desc("count"), F.asc("value"))
        found = counts.withColumn("_top", F.first("value").over(w)).collect()  # one row for each category
        for r in sorted(found, key=lambda r: (categorical.index(r["feature"]), r["value"])):
            out[r["_set"]].append(Column_(r["feature"], r["value"], r["_top"], edges=(0.5,)))
    return out


def design_rows(df: DataFrame, set_col: str, columns: dict[int, list[Column_]], label: str | None,
                keep: Sequence[str] = (), weight: str | None = None, key: str | None = None) -> DataFrame:
    """Rows as vectors: rows (data set), x (float64), bins (uint16), y, w, row and ``keep``."""
    features = sorted({(c.feature, c.value is None) for cs in columns.values() for c in cs})
    chosen = [F.col(set_col).cast("int").alias("rows"),
              F.col(label).cast("double").alias("y") if label else F.lit(0.0).alias("y"),
              (F.col(weight).cast("double") if weight else F.lit(1.0)).alias("w"),
              (F.col(key) if key else F.lit(0)).cast("long").alias("row"),
              *[F.col(f"`{f}`").cast("double" if num else "string").alias(f"_f{k}") for k, (f, num) in enumerate(features)],
              *[F.col(c).alias(f"_k{k}") for k, c in enumerate(keep)]]
    source = df.select(*chosen)
    at = {f: f"_f{k}" for k, (f, _) in enumerate(features)}
    kept = [source.schema[f"_k{k}"] for k in range(len(keep))]
    schema = "rows int, y double, w double, row long, x binary, bins binary" + "".join(
        f", _k{k} {f.dataType.simpleString()}" for k, f in enumerate(kept))

    def run(batches):
        for batch in batches:
            sets = batch.column("rows").to_numpy()
            for s in np.unique(sets):
                part = batch.take(pa.array(np.flatnonzero(sets == s)))
                cols = columns[int(s)]
                x = np.zeros((part.num_rows, len(cols)))
                bins = np.zeros((part.num_rows, len(cols)), np.uint16)
                cache = {}
                for k, c in enumerate(cols):
                    if c.feature not in cache:
                        v = part.column(at[c.feature]).fill_null(c.fill)
                        cache[c.feature] = v.to_numpy(zero_copy_only=False)
                    v = cache[c.feature]
                    if c.value is None:
                        x[:, k] = (v - c.mean) / c.scale
                        bins[:, k] = np.searchsorted(c.edges, v, "left")
                    else:
                        x[:, k] = bins[:, k] = v == c.value
                yield pa.RecordBatch.from_arrays(
                    [part.column("rows"), part.column("y"), part.column("w"), part.column("row"),
                     pa.array([r.tobytes() for r in x], pa.binary()), pa.array([r.tobytes() for r in bins], pa.binary()),
                     *[part.column(f"_k{k}") for k in range(len(keep))]],
                    ["rows", "y", "w", "row", "x", "bins", *[f"_k{k}" for k in range(len(keep))]])

    out = source.mapInArrow(run, schema)
    return out.withColumnsRenamed({f"_k{k}": c for k, c in enumerate(keep)})


# ------------------------------------------------------------ sums over rows
def _add(table: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(b, np.float64) for b in table.column("sums").to_pylist())
    return pa.Table.from_arrays([pa.array([table.column("key")[0].as_py()]), pa.array([total.tobytes()], pa.binary())],
                                names=["key", "sums"])


def _matrices(batch, kinds=("x",)):
    sets = batch.column("rows").to_numpy()
    for s in np.unique(sets):
        part = batch.take(pa.array(np.flatnonzero(sets == s)))
        x = np.frombuffer(b"".join(part.column("x").to_pylist()), np.float64).reshape(part.num_rows, -1)
        yield int(s), x, part


def summed(rows: DataFrame, values) -> dict[str, np.ndarray]:
    """``values(set, x, batch)`` yields (key, array) for blocks of rows; their
    sums over all rows, added up in each task first."""

    def run(batches):
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            for s, x, part in _matrices(batch):
                for key, v in values(s, x, part):
                    total[key] = total[key] + v if key in total else v
        if total:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(total)), pa.array([np.ascontiguousarray(v, np.float64).tobytes() for v in total.values()], pa.binary())],
                ["key", "sums"])

    schema = "key string, sums binary"
    return {r["key"]: np.frombuffer(r["sums"], np.float64)
            for r in rows.mapInArrow(run, schema).groupBy("key").applyInArrow(_add, schema).collect()}


def gram_matrices(rows: DataFrame) -> dict[int, np.ndarray]:
    """Per data set ``Z'Z`` of ``Z = [1, x, y]``."""

    def values(s, x, part):
        z = np.column_stack([np.ones(len(x)), x, part.column("y").to_numpy()])
        yield str(s), (z.T @ z).ravel()

    return {int(k): v.reshape(int(np.sqrt(len(v))), -1) for k, v in summed(rows, values).items()}


def ridge(gram: np.ndarray, features: Sequence[int], alpha: float = 1.0) -> np.ndarray:
    """[intercept, weights of ``features``] minimising squared error plus
    ``alpha`` times the squared weights; the intercept is free."""
    n, at = gram[0, 0], [k + 1 for k in features]
    mean, mean_y = gram[0, at] / n, gram[0, -1] / n
    xx = gram[np.ix_(at, at)] - n * np.outer(mean, mean)
    xy = gram[at, -1] - n * mean * mean_y
    w = np.linalg.solve(xx + alpha * np.eye(len(at)), xy)
    return np.r_[mean_y - mean @ w, w]


def logistic_models(rows: DataFrame, models: dict[str, tuple[int, tuple[int, ...]]], c: float = 1.0,
                    steps: int = 50, tolerance: float = 1e-8) -> dict[str, np.ndarray]:
    """[intercept, weights] of every model (data set, features) minimising
    ``c * sum w log-loss + |weights|^2 / 2``: Newton steps of all models in one
    pass each, halved where the objective rises, until no gradient exceeds
    ``tolerance`` times the total weight."""
    spark = rows.sparkSession
    now = {k: np.zeros(len(f) + 1) for k, (_, f) in models.items()}
    best = {k: (np.inf, v) for k, v in now.items()}
    step = {k: np.zeros_like(v) for k, v in now.items()}
    open_ = set(models)
    for _ in range(steps):
        shared = spark.sparkContext.broadcast({k: (models[k], now[k]) for k in open_})

        def values(s, x, part):
            y, w = part.column("y").to_numpy(), part.column("w").to_numpy()
            for key, ((rows_, features), beta) in shared.value.items():
                if rows_ != s:
                    continue
                z = np.column_stack([np.ones(len(x)), x[:, list(features)]])
                t = z @ beta
                p = 0.5 * (1 + np.tanh(t / 2))
                loss = np.logaddexp(0, t) - y * t
                yield key, np.r_[w @ loss, w.sum(), z.T @ (w * (p - y)), ((z * (w * p * (1 - p))[:, None]).T @ z).ravel()]

        sums = summed(rows, values)
        shared.destroy()
        for k in sorted(open_):
            if k not in sums:  # a data set without rows
                open_.discard(k)
                continue
            m, beta = len(now[k]), now[k]
            free = np.r_[0.0, np.ones(m - 1)]
            value = c * sums[k][0] + 0.5 * (free * beta ** 2).sum()
            if value > best[k][0] * (1 + 1e-12):
                step[k] = step[k] / 2
                now[k] = best[k][1] + step[k]
                continue
            best[k] = (value, beta)
            grad = c * sums[k][2:2 + m] + free * beta
            if np.abs(grad).max() <= tolerance * max(sums[k][1], 1.0):
                open_.discard(k)
                continue
            hess = c * sums[k][2 + m:].reshape(m, m) + np.diag(free + 1e-12)
            step[k] = -np.linalg.solve(hess, grad)
            now[k] = beta + step[k]
        if not open_:
            break
    return {k: v for k, (_, v) in best.items()}


def gradients(rows: DataFrame, models: dict[str, tuple[int, tuple[int, ...]]], betas: dict[str, np.ndarray],
              kind: str, penalty: float = 1.0) -> dict[str, np.ndarray]:
    """The penalised gradient of each model at ``betas``, summed over all rows."""

    def values(s, x, part):
        y, w = part.column("y").to_numpy(), part.column("w").to_numpy()
        for key, (rows_, features) in models.items():
            if rows_ == s:
                z = np.column_stack([np.ones(len(x)), x[:, list(features)]])
                t = z @ betas[key]
                yield key, z.T @ (w * ((0.5 * (1 + np.tanh(t / 2)) if kind == "logistic" else t) - y))

    return {k: v + penalty * np.r_[0.0, betas[k][1:]] for k, v in summed(rows, values).items()}
