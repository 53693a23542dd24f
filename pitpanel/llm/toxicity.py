"""Toxicity by a factorization machine over hashed terms.

The score of a text is the logistic of a linear part and of the pairwise
interactions of its terms, each term having ``FACTORS + PAIR_FACTORS`` latent
factors; so a pair of terms can matter where neither does alone.  Terms are the distinct
lower-cased words and the stems (first ``STEMS`` letters) of words that come
``REPEATS`` times or more, hashed to ``BUCKETS`` places: an insult that a
language inflects has many forms, each rare, under one stem.

The machine is fitted in one task on a bounded, documented sample of the
labelled training rows: those with the ``MAX_TRAINING_ROWS`` smallest hashes
of doc_id (all of them, where there are fewer).  A machine fitted on three
quarters of them is first tried on the rest; the threshold with the best F1
there becomes 0.5 by a shift of the bias.  Spark selects the sample;
scoring covers every text, map-side, and ships the weights (a fixed size) with
the code.

Defined results: labels that are null are not learned from; with no labels
every score is 0.5 less a little, so nothing is rejected; null and empty texts
score as the bias alone; rows with a null doc_id are held out; repeated
labels count each; repeated rows are scored each; an empty table gives an
empty result.  Extra columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitpanel.llm.common import fresh, word_hashes
from pitpanel.llm.language_id import fold

BUCKETS = 1 << 17
FACTORS = 4
EPOCHS = 8
MAX_TRAINING_ROWS = 20_000
#: Rows that a term needs, where a hundredth of all rows is no less; rarer terms
#: would be learned by heart.
MIN_ROWS = 25
PENALTY = 0.9
STEMS = (5, 7)
REPEATS = (2, 3)
#: Toxic rows without which, and bounds within which, the threshold is moved.
CALIBRATION_ROWS = 20
CALIBRATION_RANGE = (0.2, 0.8)
#: Factors of every term, their own epochs and their L2 penalty for each row.
PAIR_FACTORS = 4
PAIR_EPOCHS = 12
PAIR_PENALTY = 0.1
_BATCH = 128
_RATE = 0.3
_FACTOR_RATE = 0.02
_PAIR_RATE = 0.03
_TERM = re.compile(r"[^\W\d_]+")


def terms(text: str | None) -> np.ndarray:
    """Places of the distinct terms of a text."""
    if not text:
        return np.empty(0, np.int32)
    words, stems = Counter(_TERM.findall(text.lower())), Counter()
    for word, n in words.items():
        for length in STEMS:
            if len(word) >= length:
                stems[word[:length]] += n
    found = [w.encode() for w in words]
    found += [f"{s}-{k}".encode() for s, n in stems.items() for k in REPEATS if n >= k]
    return np.unique((word_hashes(found) % np.uint64(BUCKETS)).astype(np.int32))


@dataclass
class Machine:
    """Bias, linear weights and latent factors of all places."""

    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def margins(self, docs: list[np.ndarray]) -> np.ndarray:
        """Raw scores; a document's terms each have the value 1."""
        out = np.full(len(docs), self.bias)
        full = [i for i, d in enumerate(docs) if len(d)]
        if not full:
            return out
        flat = np.concatenate([docs[i] for i in full])
        starts = np.concatenate([[0], np.cumsum([len(docs[i]) for i in full])[:-1]])
        v = self.factors[flat]
        total, squares = np.add.reduceat(v, starts), np.add.reduceat(v * v, starts)
        out[full] += np.add.reduceat(self.weights[flat], starts) + 0.5 * (total * total - squares).sum(axis=1)
        return out


def logistic(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


def fit(docs: list[np.ndarray], labels: np.ndarray, seed: int = 11) -> Machine:
    """Logistic loss in small batches, every row used in every epoch.  The
    linear part is follow-the-regularised-leader with an L1 penalty that grows
    as the root of the number of toxic rows (noise in a term's gradient does
    too).  ``FACTORS`` latent factors learn, by Adagrad, for the terms it keeps.
    ``PAIR_FACTORS`` more then learn, in ``PAIR_EPOCHS`` more epochs, for every
    term under an L2 penalty of their own, so that pairs of terms without a
    linear weight count.  Terms of fewer than ``MIN_ROWS`` rows, or a hundredth
    of the rows if that is less (three at least), are left out."""
    rng = np.random.default_rng(seed)
    common = np.bincount(np.concatenate(docs), minlength=BUCKETS) >= max(3, min(MIN_ROWS, len(docs) // 100))
    docs = [d[common[d]] for d in docs]
    share = (labels.sum() + 0.5) / (len(labels) + 1.0)
    model = Machine(float(np.log(share / (1 - share))), np.zeros(BUCKETS),
                    np.zeros((BUCKETS, FACTORS + PAIR_FACTORS)))
    model.factors[:, :FACTORS] = rng.normal(0, 0.01, (BUCKETS, FACTORS))
    pairs = rng.normal(0, 0.05, (BUCKETS, PAIR_FACTORS))
    l1 = PENALTY * np.sqrt(labels.sum())
    z, n, sv = np.zeros(BUCKETS), np.zeros(BUCKETS), np.ones((BUCKETS, FACTORS + PAIR_FACTORS))
    rates = np.repeat([_FACTOR_RATE, _PAIR_RATE], [FACTORS, PAIR_FACTORS])
    usable = np.array([i for i, d in enumerate(docs) if len(d)], np.int64)
    for epoch in range(EPOCHS + PAIR_EPOCHS):
        if epoch == EPOCHS:
            model.factors[:, FACTORS:] = pairs
        order = rng.permutation(usable)
        for at in range(0, len(order), _BATCH):
            rows = order[at:at + _BATCH]
            part = [docs[i] for i in rows]
            flat, sizes = np.concatenate(part), np.array([len(d) for d in part])
            error = logistic(model.margins(part)) - labels[rows]
            each = np.repeat(error, sizes)
            places, back = np.unique(flat, return_inverse=True)
            g = np.bincount(back, each, len(places))
            w, seen = model.weights[places], n[places]
            z[places] += g - (np.sqrt(seen + g * g) - np.sqrt(seen)) / _RATE * w
            n[places] = seen + g * g
            lead = z[places]
            w = np.where(np.abs(lead) <= l1, 0.0,
                         (np.sign(lead) * l1 - lead) / ((1 + np.sqrt(n[places])) / _RATE + 1))
            model.weights[places] = w
            v = model.factors[flat]
            total = np.add.reduceat(v, np.concatenate([[0], np.cumsum(sizes)[:-1]]))
            pull = each[:, None] * (np.repeat(total, sizes, axis=0) - v)
            old = model.factors[places]
            gv = np.stack([np.bincount(back, pull[:, f], len(places)) for f in range(pull.shape[1])], axis=1)
            gv[:, :FACTORS] = np.where(w[:, None] != 0, gv[:, :FACTORS] + old[:, :FACTORS], 0.0)
            gv[:, FACTORS:] += PAIR_PENALTY * np.bincount(back)[:, None] * old[:, FACTORS:]
            if epoch < EPOCHS:
                gv[:, FACTORS:] = 0.0
            sv[places] += gv * gv
            old -= rates * gv / np.sqrt(sv[places])
            old[w == 0, :FACTORS] *= 0.5
            model.factors[places] = old
            model.bias -= 0.02 * float(error.mean())
    model.factors[model.weights == 0, :FACTORS] = 0.0
    model.factors[~common] = 0.0
    return model


def best_threshold(scores: np.ndarray, labels: np.ndarray) -> float:
    """The score, within ``CALIBRATION_RANGE``, that parts ``labels`` with the
    best F1, halfway between two scores; 0.5 for few toxic rows."""
    if labels.sum() < CALIBRATION_ROWS:
        return 0.5
    order = np.argsort(-scores, kind="stable")
    ranked, found = scores[order], np.cumsum(labels[order])
    f1 = 2 * found / (np.arange(1, len(ranked) + 1) + labels.sum())
    cuts = (ranked + np.append(ranked[1:], 0.0)) / 2
    usable = (ranked != np.append(ranked[1:], -1.0)) & (cuts >= CALIBRATION_RANGE[0]) & (cuts <= CALIBRATION_RANGE[1])
    return float(cuts[np.argmax(np.where(usable, f1, -1.0))]) if usable.any() else 0.5


def fit_calibrated(docs: list[np.ndarray], labels: np.ndarray) -> Machine:
    """Every fourth row is held out to find the threshold, then all are learned."""
    held = np.arange(len(docs)) % 4 == 3
    threshold = 0.5
    if labels[held].sum() >= CALIBRATION_ROWS:
        trial = fit([d for d, h in zip(docs, held) if not h], labels[~held])
        threshold = best_threshold(logistic(trial.margins([d for d, h in zip(docs, held) if h])), labels[held])
    model = fit(docs, labels)
    model.bias -= float(np.log(threshold / (1 - threshold)))
    return model


def _fit_task(batches):
    docs, labels = [], []
    for batch in batches:
        docs += [terms(t) for t in batch.column("text").to_pylist()]
        labels += batch.column("toxic").to_pylist()
    if docs:
        model = fit_calibrated(docs, np.array(labels, np.float64))
        yield pa.RecordBatch.from_arrays(
            [pa.array([model.bias]), pa.array([model.weights.astype(np.float32).tobytes()], pa.binary()),
             pa.array([model.factors.astype(np.float32).tobytes()], pa.binary())], ["bias", "weights", "factors"])


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAINING_ROWS) -> Machine:
    """Fit on the labelled ``docs`` (doc_id, text), up to ``max_rows`` of them."""
    chosen = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()) \
        .select("doc_id", F.col("toxic").cast("double").alias("toxic")) \
        .orderBy(F.md5(F.col("doc_id").cast("string")), "doc_id", "toxic").limit(max_rows)
    rows = docs.select("doc_id", "text").join(chosen, "doc_id") \
        .orderBy(F.md5(F.col("doc_id").cast("string")), "doc_id", "toxic", "text").limit(max_rows).coalesce(1)
    found = rows.select("text", "toxic").mapInArrow(_fit_task, "bias double, weights binary, factors binary").first()
    if found is None:
        return Machine(-0.01, np.zeros(BUCKETS, np.float32), np.zeros((BUCKETS, FACTORS + PAIR_FACTORS), np.float32))
    return Machine(found["bias"], np.frombuffer(found["weights"], np.float32),
                   np.frombuffer(found["factors"], np.float32).reshape(BUCKETS, FACTORS + PAIR_FACTORS))


def score(docs: DataFrame, model: Machine, name: str = "score") -> DataFrame:
    """``docs`` with a column ``name`` between 0 and 1."""
    from pyspark.sql.types import DoubleType, StructField, StructType
    kept = docs.drop(name)

    def run(batches):
        for batch in batches:
            values = logistic(model.margins([terms(t) for t in batch.column("text").to_pylist()]))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(values, pa.float64())],
                                             [*batch.schema.names, name])
    return kept.mapInArrow(run, StructType([*kept.schema.fields, StructField(name, DoubleType())]))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Learn from the labels outside fold 0 of 5, score all documents: doc_id,
    held_out, score, predicted."""
    model = train(docs, labels.where(~fold(5, 0)))
    return score(docs.select("doc_id", fold(5, 0).alias("held_out"), "text"), model) \
        .select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def clean_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without those predicted to be toxic."""
    flag = fresh(docs, "_toxicity")
    model = train(docs, labels.where(~fold(5, 0)))
    return score(docs, model, flag).where(F.col(flag) < 0.5).drop(flag)
