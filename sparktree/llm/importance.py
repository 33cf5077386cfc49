"""Quality classification by importance resampling: two hashed n-gram models and a Gumbel top-k.

Words, pairs of words, and the shapes of both are hashed to buckets. One pass over all documents counts the buckets in
raw text and, for a bounded sample of labelled documents, in target text. A document's log weight is the sum over its
n-grams of log p_target / p_raw, where the target's counts are shrunk towards what raw text lets expect, so that words
the sample happens not to hold cost nothing.

That sum grows with the text: between two long documents it differs by hundreds, beside which a Gumbel variate is
nothing. So it is normalised: the mean of an n-gram is turned into the log odds that the document is of the target, by a
logistic curve fitted to the labelled sample. Odds are importance weights up to a factor. k, the number to sample, is fixed
first: given, or else the sum of these probabilities over all documents, which is how many of the target are to be
expected. Adding a Gumbel variate, a hash of the seed and the document, to the log odds and taking the k largest keys
samples k documents without replacement in proportion to their weights.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from . import textkit as T
from .scratch import materialise, release, without

#: Buckets of words, pairs, shapes, and pairs of shapes; their number bounds what reaches the driver.
PARTS = (1 << 15, 1 << 15, 1 << 13, 1 << 13)
BUCKETS = sum(PARTS)
#: Kinds of bytes in a word's shape: small and capital letters, digits, letters beyond ASCII; other bytes as they are.
SHAPE = T.AS_IS.copy()
SHAPE[97:123], SHAPE[65:91], SHAPE[48:58], SHAPE[128:] = SHAPE[97], SHAPE[65], SHAPE[48], SHAPE[97]


def ngrams(t: T.Texts) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the n-grams of texts, and the text of each."""
    w = T.words(t)
    h = T.word_hashes(t, w, T.LOWER)
    kind = SHAPE[t.data] if len(t.data) else np.zeros(0, np.uint64)
    n = len(w.starts)
    again = np.zeros(n, np.uint64)
    again[1:] = (h[1:] == h[:-1]) & (w.doc[1:] == w.doc[:-1])
    shape = np.minimum(w.ends - w.starts, 3).astype(np.uint64) * np.uint64(2) + again
    for at in (w.starts, np.minimum(w.starts + 1, w.ends - 1), np.maximum(w.ends - 2, w.starts), w.ends - 1):
        shape = shape * np.uint64(T.BASE) + kind[at]
    shape = T.mix(shape)
    (at, pairs), (_, shapes) = T.windows(h, w.doc, 2), T.windows(shape, w.doc, 2)
    out, first = [], 0
    for size, g in zip(PARTS, (h, pairs, shape, shapes)):
        out.append((g % np.uint64(size)).astype(np.int64) + first)
        first += size
    return np.concatenate(out), np.concatenate([w.doc, w.doc[at], w.doc, w.doc[at]])


def _count(batches):
    raw, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    for batch in batches:
        chosen = batch.column("target_").to_numpy(zero_copy_only=False).astype(bool)
        for t in T.chunks(batch.column("text")):
            g, doc = ngrams(t)
            raw += np.bincount(g, minlength=BUCKETS)
            target += np.bincount(g[chosen[t.first + doc]], minlength=BUCKETS)
    at = np.flatnonzero(raw)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(raw[at]), pa.array(target[at])], names=["bucket", "n_raw", "n_target"])


def log_ratios(raw: np.ndarray, target: np.ndarray, prior: float = 2.0) -> np.ndarray:
    """log p_target / p_raw of each bucket, with `prior` occurrences added to what was seen and what was to be expected."""
    out, first = np.zeros(BUCKETS), 0
    for size in PARTS:
        part = slice(first, first + size)
        expected = raw[part] * (target[part].sum() / max(1, raw[part].sum()))
        out[part] = np.log((target[part] + prior) / (expected + prior)) if target[part].sum() else 0.0
        first += size
    return out


def _score(batches, passed: list[str], ratios):
    r = ratios.value
    for batch in batches:
        n = batch.num_rows
        weight, grams = np.zeros(n), np.zeros(n, np.int64)
        for t in T.chunks(batch.column("text")):
            g, doc = ngrams(t)
            at = slice(t.first, t.first + len(t.starts))
            weight[at] = np.bincount(doc, r[g], len(t.starts))
            grams[at] = np.bincount(doc, minlength=len(t.starts))
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in passed), pa.array(grams), pa.array(weight)], names=[*passed, "n_grams", "log_weight"])


def gumbel(seed: int, *on: Column) -> Column:
    u = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), *on), 11).cast("double") + F.lit(0.5)) / F.lit(float(1 << 53))
    return -F.log(-F.log(u))


def labelled_sample(labels: DataFrame, column: str, most: int, seed: int = 11) -> DataFrame:
    """id_, label_: at most `most` labelled documents, those of least hash. Labels of one document that differ count as the greater."""
    one = labels.filter(F.col(column).isNotNull() & F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("id_")).agg(F.max(column).cast("int").alias("label_"))
    return one.orderBy(F.xxhash64(F.lit(seed), "id_"), "id_").limit(most)


def top_k_key(keyed: DataFrame, key: str, k: int, enough: int = 10_000) -> float:
    """The k-th largest key of a table, exactly, by histograms: each pass narrows to one bin of a thousand. None if k rows aren't there."""
    low, high, n = keyed.agg(F.min(key), F.max(key), F.count(key)).first()
    if k <= 0 or n is None or n < k:
        return None
    above = 0
    rows = keyed.select(F.col(key).cast("double").alias("key")).filter("key is not null")
    while n > enough and high > low:
        width = (high - low) / 1000
        bins = {b: c for b, c in rows.filter((F.col("key") >= low) & (F.col("key") <= high)).groupBy(F.least(F.lit(999), F.floor((F.col("key") - low) / width)).alias("b")).count().collect()}
        for b in sorted(bins, reverse=True):
            if above + bins[b] >= k:
                break
            above += bins[b]
        inside = rows.filter((F.col("key") >= low) & (F.col("key") <= high) & (F.least(F.lit(999), F.floor((F.col("key") - low) / width)) == b))
        new = inside.agg(F.min("key"), F.max("key")).first()
        if tuple(new) == (low, high):
            break
        (low, high), n = new, bins[b]
    if high == low:
        return low
    rest = rows.filter((F.col("key") >= low) & (F.col("key") <= high)).orderBy(F.col("key").desc()).limit(k - above).agg(F.min("key")).first()[0]
    return rest


def calibrated(mean: np.ndarray, of_target: np.ndarray, rounds: int = 50, ridge: float = 1e-3) -> tuple[float, float]:
    """Slope and intercept of the log odds of the target by Newton's method. The ridge keeps them finite where the two are apart."""
    a, b, best = 0.0, 0.0, None
    scale = max(1e-9, float(mean.std()))
    x = mean / scale

    def loss(a: float, b: float) -> float:
        z = a * x + b
        return float(np.sum(np.logaddexp(0, z) - of_target * z) + ridge * (a * a + b * b) / 2)

    best = loss(a, b)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -40, 40)))
        w, g = p * (1 - p), p - of_target
        h = np.array([[np.sum(w * x * x) + ridge, np.sum(w * x)], [np.sum(w * x), np.sum(w) + ridge]])
        step = np.linalg.solve(h, [np.sum(g * x) + ridge * a, np.sum(g) + ridge * b])
        size = 1.0
        while size > 1e-6 and loss(a - size * step[0], b - size * step[1]) > best:
            size /= 2
        a, b = a - size * step[0], b - size * step[1]
        now = loss(a, b)
        if best - now < 1e-9:
            break
        best = now
    return a / scale, b


def resample(docs: DataFrame, labels: DataFrame, k: int | None = None, most_labelled: int = 20_000, seed: int = 11) -> DataFrame:
    """The rows and columns of docs(doc_id, text, ...) with n_grams, log_weight, log_odds, gumbel_key and kept.

    The target is the text of documents labelled quality = 1 in labels(doc_id, quality), of which at most most_labelled
    rows are used. kept: the k documents of largest key (more only where keys tie, as those of equal rows do). Without k,
    as many are sampled as are expected to be of the target. Without labels of the target, or without k and others to
    tell it from, all documents are kept; with k and no others, the log odds are the mean log weights. A null or empty
    text has no n-grams, weight 0 and is judged by its key like others; a null doc_id and repeated rows are judged row by
    row. An empty table gives an empty table. Columns of these five names are replaced, all others stay.
    """
    spark = docs.sparkSession
    passed = without(docs, "n_grams", "log_weight", "log_odds", "gumbel_key", "kept")
    docs = docs.select(*passed)
    sample = labelled_sample(labels, "quality", most_labelled, seed).withColumnsRenamed({"id_": "known_id", "label_": "known"})
    texts = docs.select("doc_id", "text").join(F.broadcast(sample), F.col("doc_id") == F.col("known_id"), "left").select("doc_id", "text", "known")
    flagged = texts.select("text", (F.coalesce("known", F.lit(0)) > 0).alias("target_"))
    counts = flagged.mapInArrow(_count, "bucket long, n_raw long, n_target long").groupBy("bucket").agg(F.sum("n_raw"), F.sum("n_target"))
    raw, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    for bucket, a, b in counts.collect():  # a row for each bucket, whatever the input
        raw[bucket], target[bucket] = a, b
    ratios = spark.sparkContext.broadcast(log_ratios(raw, target))

    def scored(rows: DataFrame, keep: list[str]) -> DataFrame:
        schema = StructType([*(rows.schema[c] for c in keep), StructField("n_grams", LongType()), StructField("log_weight", DoubleType())])
        return rows.mapInArrow(lambda it: _score(it, keep, ratios), schema)

    mean = F.col("log_weight") / F.greatest(F.col("n_grams"), F.lit(1))

    def keyed(rows: DataFrame, slope: float, intercept: float) -> DataFrame:
        return rows.withColumn("log_odds", F.lit(slope) * mean + F.lit(intercept)).withColumn("gumbel_key", F.col("log_odds") + gumbel(seed, F.col("doc_id")))

    if not target.any():
        return keyed(scored(docs, passed), 1.0, 0.0).withColumn("kept", F.lit(True))
    weights = materialise(scored(texts, ["doc_id", "known"]), "weights")
    known = weights.filter("known is not null").select(mean.alias("mean"), "known").toPandas()  # bounded by most_labelled
    good = known["known"].to_numpy() > 0
    told = good.any() and not good.all()
    order = np.lexsort((good, known["mean"].to_numpy()))  # one order of sums, whatever the tasks'
    slope, intercept = calibrated(known["mean"].to_numpy()[order], good[order].astype(float)) if told else (1.0, 0.0)
    keys = keyed(weights, slope, intercept)
    if k is None and told:
        k = int(round(keys.agg(F.sum((1 / (1 + F.exp(-F.col("log_odds")))).cast("decimal(38,12)"))).first()[0] or 0))
    cut = None if k is None else top_k_key(keys, "gumbel_key", k)
    out = keyed(scored(docs, passed), slope, intercept)
    release(weights)
    return out.withColumn("kept", F.lit(k is None or k > 0) if cut is None else F.col("gumbel_key") >= cut)


__all__ = ["calibrated", "gumbel", "labelled_sample", "resample", "top_k_key"]
