"""Quality rules as a ledger: every rule is evaluated once, and policies are masks over the stored failure bits.

`ledger` measures each whole text and sets bit k of `failed` where rule k of RULES fails. A policy names a version and
the rules it rejects by; applying one, or asking what a rule contributes to it, reads only the ledger: `ablation`
first counts documents by bit pattern (at most 2 ** rules of them, in partial sums), then tests each pattern's bits.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from . import textkit as T

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_shouted")
IS_SYMBOL = np.zeros(256, bool)
IS_SYMBOL[list(b"#*$%&|<>")] = True
IS_UPPER, IS_LOWER = np.zeros(256, bool), np.zeros(256, bool)
IS_UPPER[65:91] = IS_LOWER[97:123] = True
WINDOW = 5


@dataclass(frozen=True)
class Rule:
    name: str
    fails: Callable[[Callable[[str], Column]], Column]


#: In the order of their bits, which is fixed: new rules go to the end.
RULES = (
    Rule("few_words", lambda c: c("n_words") < 10),
    Rule("repeated_windows", lambda c: 100 * c("n_repeat_words") > 20 * c("n_words")),
    Rule("symbols", lambda c: 5 * c("n_symbols") > c("n_words")),
    Rule("shouting", lambda c: 2 * c("n_shouted") > c("n_words")),
    Rule("repeated_lines", lambda c: (c("n_lines") >= 4) & (2 * c("n_dup_lines") > c("n_lines"))),
    Rule("short_words", lambda c: c("word_chars") < 2 * c("n_words")),
    Rule("long_words", lambda c: c("word_chars") > 20 * c("n_words")),
)
BIT = {r.name: 1 << k for k, r in enumerate(RULES)}
#: Rules by version of the policy. A version, once used, doesn't change.
POLICIES = {
    "base": ("few_words", "repeated_windows"),
    "v1": tuple(BIT),
}


def mask_of(policy: str) -> int:
    return sum(BIT[name] for name in POLICIES[policy])


def _repeats(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each key: whether it occurs twice or more, and whether an equal one stands before it."""
    order = np.argsort(keys, kind="stable")
    same = np.zeros(len(keys) + 1, bool)
    same[1:-1] = keys[order[1:]] == keys[order[:-1]]
    twice, later = np.empty(len(keys), bool), np.empty(len(keys), bool)
    twice[order] = same[1:] | same[:-1]
    later[order] = same[:-1]
    return twice, later


def _by_doc(hashes: np.ndarray, doc: np.ndarray) -> np.ndarray:
    return T.mix(hashes + doc.astype(np.uint64) * np.uint64(T.BASE))


def measures(t: T.Texts) -> dict[str, np.ndarray]:
    """MEASURES of each text."""
    docs, w = len(t.starts), T.words(t)
    n_words = np.diff(w.first)
    sums = T.prefix_sums(t.data)
    hashes = T.span_hashes(sums, w.starts, w.ends)
    out = {"n_words": n_words, "n_symbols": T.counted(IS_SYMBOL[t.data], t.starts, t.ends)}
    out["word_chars"] = np.bincount(w.doc, T.counted(T.code_points(t.data), w.starts, w.ends), docs).astype(np.int64)
    shouted = (T.counted(IS_UPPER[t.data], w.starts, w.ends) > 0) & (T.counted(IS_LOWER[t.data], w.starts, w.ends) == 0)
    out["n_shouted"] = np.bincount(w.doc, shouted, docs).astype(np.int64)
    # windows of words that occur again in their text, and the words that they cover
    at, h = T.windows(hashes, w.doc, WINDOW)
    at = at[_repeats(_by_doc(h, w.doc[at]))[0]]
    edges = np.zeros(len(w.starts) + 1, np.int64)
    np.add.at(edges, at, 1)
    np.add.at(edges, at + WINDOW, -1)
    out["n_repeat_words"] = np.bincount(w.doc, np.cumsum(edges)[:-1] > 0, docs).astype(np.int64)
    # lines that hold a word
    breaks = np.flatnonzero(t.data == 10)
    starts, ends = np.sort(np.concatenate([t.starts, breaks + 1])), np.sort(np.concatenate([breaks, t.ends]))
    owner = np.repeat(np.arange(docs), T.counted(t.data == 10, t.starts, t.ends) + 1)
    worded = T.counted(~T.IS_SPACE[t.data], starts, ends) > 0
    starts, ends, owner = starts[worded], ends[worded], owner[worded]
    later = _repeats(_by_doc(T.span_hashes(sums, starts, ends), owner))[1]
    out["n_dup_lines"] = np.bincount(owner, later, docs).astype(np.int64)
    out["n_lines"] = np.bincount(owner, minlength=docs)
    return out


def _measure(batches, passed: list[str]):
    for batch in batches:
        found = [measures(t) for t in T.chunks(batch.column("text"))]
        cols = [pa.array(np.concatenate([f[m] for f in found]) if found else [], pa.int64()) for m in MEASURES]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in passed), *cols], names=[*passed, *MEASURES])


def ledger(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns `keep` of docs(text, ...) with MEASURES and failed, the rules' bits; one row per row.

    A null text has no words and fails as an empty one does; nulls elsewhere are carried along. Repeated rows get a row
    each. An empty table gives an empty ledger.
    """
    passed = list(keep)
    schema = StructType([*(docs.schema[c] for c in passed), *(StructField(m, LongType()) for m in MEASURES)])
    rows = docs.select(*passed, *([] if "text" in passed else ["text"])).mapInArrow(lambda it: _measure(it, passed), schema)
    bits = F.lit(0).cast("long")
    for r in RULES:
        bits = bits.bitwiseOR(F.when(r.fails(F.col), F.lit(BIT[r.name])).otherwise(F.lit(0)).cast("long"))
    return rows.withColumn("failed", bits)


def kept_by(policy: str, failed: Column | None = None) -> Column:
    return (F.col("failed") if failed is None else failed).bitwiseAND(F.lit(mask_of(policy))) == 0


def ablation(rows: DataFrame, policy: str = "v1") -> DataFrame:
    """rule, n_failed, n_only, n_kept_without: per rule of a policy, documents that fail it, that only it rejects, and that are kept without it."""
    spark, mask = rows.sparkSession, mask_of(policy)
    patterns = rows.groupBy("failed").agg(F.count(F.lit(1)).alias("n"))
    rules = spark.createDataFrame([(name, BIT[name]) for name in POLICIES[policy]], "rule string, bit long")
    failed, bit = F.col("failed"), F.col("bit")
    counted = patterns.select("failed", "n", F.explode(F.array(*(F.struct(F.lit(name).alias("rule"), F.lit(BIT[name]).cast("long").alias("bit")) for name in POLICIES[policy]))).alias("r")).select("failed", "n", "r.*")
    if_ = lambda test: F.sum(F.when(test, F.col("n")).otherwise(0)).alias
    sums = counted.groupBy("rule").agg(
        if_(failed.bitwiseAND(bit) != 0)("n_failed"),
        if_(failed.bitwiseAND(F.lit(mask)) == bit)("n_only"),
        if_(failed.bitwiseAND(F.lit(mask).bitwiseXOR(bit)) == 0)("n_kept_without"),
    )
    return rules.select("rule").join(sums, "rule", "left").na.fill(0)
