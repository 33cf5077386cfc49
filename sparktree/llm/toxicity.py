"""Toxicity by a classifier chain over hashed words.

Categories are predicted in a fixed order by linear models on the words a text holds; the model of a category also gets
the earlier categories' probabilities. In training those are out of fold: the models that give them haven't seen the
document, so later models learn how far earlier ones can be trusted. Models are fitted with NumPy on a bounded sample
of labelled documents; all documents are then scored in one pass without a shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from . import textkit as T
from .importance import labelled_sample

#: Hashed words; a model uses the `chosen` of them that tell most about its category.
BUCKETS = 1 << 18
#: Words here are runs of letters, digits and bytes beyond ASCII.
NOT_WORD = np.ones(256, bool)
NOT_WORD[128:] = NOT_WORD[48:58] = NOT_WORD[65:91] = NOT_WORD[97:123] = False


def words_held(t: T.Texts) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of words and their texts, each pair once."""
    w = T.words(t, NOT_WORD)
    bucket = (T.word_hashes(t, w, T.LOWER) % np.uint64(BUCKETS)).astype(np.int64)
    both = np.unique(w.doc * BUCKETS + bucket)
    return both % BUCKETS, both // BUCKETS


@dataclass
class Linear:
    """sigmoid(bias + sum of weights of the words held + weights of earlier probabilities)."""

    buckets: np.ndarray
    weights: np.ndarray
    earlier: np.ndarray
    bias: float

    def dense(self) -> np.ndarray:
        out = np.zeros(BUCKETS)
        out[self.buckets] = self.weights
        return out


@dataclass
class Chain:
    categories: list[str]
    models: list[Linear]
    thresholds: list[float]
    table: np.ndarray = field(default=None, repr=False)  # categories x BUCKETS

    def probabilities(self, bucket: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
        out = np.zeros((n, len(self.models)))
        for k, m in enumerate(self.models):
            z = np.bincount(doc, self.table[k][bucket], n) + m.bias + out[:, :k] @ m.earlier
            out[:, k] = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        return out


def _fit(bucket, doc, y, earlier, chosen: int, rounds: int = 80, ridge: float = 0.3) -> Linear:
    """Logistic regression by accelerated gradient steps with a diagonal bound on the curvature."""
    n, k = len(y), earlier.shape[1]
    positives = max(1.0, y.sum())
    if not 0 < y.sum() < n:
        return Linear(np.zeros(0, np.int64), np.zeros(0), np.zeros(k), 20.0 if n and y.sum() == n else -20.0)
    with_word, with_both = np.bincount(bucket, minlength=BUCKETS), np.bincount(bucket, y[doc], BUCKETS)
    odds = np.log((with_both + 0.5) / (positives + 1)) - np.log((with_word - with_both + 0.5) / (n - positives + 1))
    told = np.where(with_word >= 3, np.abs(odds) * np.sqrt(with_word), 0)
    best = np.sort(np.argsort(-told, kind="stable")[:chosen])
    best = best[told[best] > 0]
    index = np.full(BUCKETS, -1)
    index[best] = np.arange(len(best))
    use = index[bucket] >= 0
    col, row = index[bucket[use]], doc[use]
    size = np.bincount(row, minlength=n) + k + 1.0
    curvature = 0.25 * np.bincount(col, size[row], len(best)) + ridge
    w, v, b = np.zeros(len(best)), np.zeros(k), float(np.log(positives / (n - positives)))
    curve_v, curve_b = 0.25 * (earlier**2 * size[:, None]).sum(0) + ridge, 0.25 * size.sum() + 1e-3
    last, at, step = (w, v, b), (w, v, b), 1.0
    for _ in range(rounds):
        w, v, b = at
        p = 1 / (1 + np.exp(-np.clip(np.bincount(row, w[col], n) + earlier @ v + b, -30, 30)))
        g = p - y
        new = (w - (np.bincount(col, g[row], len(best)) + ridge * w) / curvature, v - (earlier.T @ g + ridge * v) / curve_v, b - g.sum() / curve_b)
        following = (1 + np.sqrt(1 + 4 * step * step)) / 2
        at = tuple(x + (step - 1) / following * (x - o) for x, o in zip(new, last))
        last, step = new, following
    w, v, b = last
    return Linear(best, w, v, float(b))


def fit_chain(bucket: np.ndarray, doc: np.ndarray, labels: np.ndarray, categories: list[str], folds: int = 5, chosen: int = 1024) -> Chain:
    """labels: documents x categories of 0 and 1. Documents are dealt to folds in turn."""
    n = len(labels)
    fold = np.arange(n) % folds
    held_out = np.zeros((n, len(categories)))
    chain = Chain(categories, [], [])
    for k in range(len(categories)):
        y = labels[:, k].astype(float)
        for f in range(folds):
            train = fold != f
            rank = np.cumsum(train) - 1
            use = train[doc]
            m = _fit(bucket[use], rank[doc[use]], y[train], held_out[train, :k], chosen)
            z = np.bincount(doc, m.dense()[bucket], n) + m.bias + held_out[:, :k] @ m.earlier
            held_out[~train, k] = 1 / (1 + np.exp(-np.clip(z[~train], -30, 30)))
        chain.models.append(_fit(bucket, doc, y, held_out[:, :k], chosen))
        chain.thresholds.append(_threshold(held_out[:, k], y))
    chain.table = np.stack([m.dense() for m in chain.models])
    return chain


def _threshold(p: np.ndarray, y: np.ndarray, near: float = 0.002) -> float:
    """Where out-of-fold probabilities give the best F1, or `near` it: the middle, in log odds, of that stretch."""
    if not y.sum():
        return 1.0
    order = np.argsort(-p, kind="stable")
    hits = np.cumsum(y[order])
    f1 = 2 * hits / (np.arange(1, len(y) + 1) + y.sum())
    good = np.flatnonzero(f1 >= f1.max() - near)
    ends = np.clip(p[order[[good[0], min(good[-1] + 1, len(y) - 1)]]], 1e-9, 1 - 1e-9)
    return float(1 / (1 + np.exp(-np.mean(np.log(ends / (1 - ends))))))


def _features(batches):
    for batch in batches:
        parts = []
        for t in T.chunks(batch.column("text")):
            bucket, doc = words_held(t)
            parts += np.split(bucket.astype(np.int32), np.searchsorted(doc, np.arange(1, len(t.starts))))
        yield pa.RecordBatch.from_arrays([batch.column("id_"), pa.array(parts, pa.list_(pa.int32()))], names=["id_", "buckets"])


def _predict(batches, passed: list[str], names: list[str], chain):
    c: Chain = chain.value
    for batch in batches:
        p = [c.probabilities(*words_held(t), len(t.starts)) for t in T.chunks(batch.column("text"))]
        p = np.concatenate(p) if p else np.zeros((0, len(names)))
        yield pa.RecordBatch.from_arrays([*(batch.column(x) for x in passed), *(pa.array(p[:, k]) for k in range(len(names)))], names=[*passed, *names])


def train_chain(docs: DataFrame, labels: DataFrame, categories: list[str], most_labelled: int = 12_000, folds: int = 5) -> Chain:
    """A chain over label columns, from at most most_labelled labelled documents (those of least hash).

    Of rows that repeat a doc_id, those of one text count once and of several texts one, the same on each run.
    """
    known = labels
    for c in categories:
        known = known.filter(F.col(c).isNotNull())
    packed = sum((F.col(c).cast("int") * (1 << k) for k, c in enumerate(categories)), F.lit(0))
    sample = labelled_sample(known.select("doc_id", packed.alias("packed")), "packed", most_labelled)
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), F.col("doc_id") == F.col("id_")).select("id_", "text")
    id_type = rows.schema["id_"]
    found = rows.mapInArrow(_features, StructType([id_type, StructField("buckets", _ints())])).groupBy("id_").agg(F.min("buckets").alias("buckets"))
    table = found.join(F.broadcast(sample), "id_").toPandas().sort_values("id_")  # bounded by most_labelled
    sizes = table["buckets"].map(len).to_numpy() if len(table) else np.zeros(0, np.int64)
    bucket = np.concatenate([*table["buckets"], np.zeros(0, np.int64)]).astype(np.int64)
    doc = np.repeat(np.arange(len(table)), sizes.astype(np.int64))
    y = np.stack([(table["label_"].to_numpy().astype(np.int64) >> k) & 1 for k in range(len(categories))], 1)
    return fit_chain(bucket, doc, y, categories, folds)


def _ints():
    from pyspark.sql.types import ArrayType, IntegerType

    return ArrayType(IntegerType())


def classify(docs: DataFrame, chain: Chain) -> DataFrame:
    """The columns of docs(text, ...) with p_<category> and is_<category> for each category of the chain; one row per row.

    A null or empty text holds no words and gets the chain's answer to that; repeated rows get equal answers; columns
    of the new names are replaced. An empty table gives an empty table.
    """
    names = [f"p_{c}" for c in chain.categories]
    passed = [c for c in docs.columns if c not in names and c not in [f"is_{x}" for x in chain.categories]]
    shared = docs.sparkSession.sparkContext.broadcast(chain)
    schema = StructType([*(docs.schema[c] for c in passed), *(StructField(n, DoubleType()) for n in names)])
    out = docs.select(*passed).mapInArrow(lambda it: _predict(it, passed, names, shared), schema)
    return out.withColumns({f"is_{c}": F.col(f"p_{c}") >= t for c, t in zip(chain.categories, chain.thresholds)})


__all__ = ["Chain", "classify", "fit_chain", "train_chain"]
