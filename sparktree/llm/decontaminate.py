"""Benchmark decontamination by spaced seeds, with DataFrame functions only.

Text and benchmark items are cut into lower-case words. A seed is a fixed mask of word positions: the words it selects
are hashed, those between are ignored. Hashes of both sides are joined; a hit fixes how the two texts lie against each
other, and along that diagonal equal words are counted. A document is contaminated by an item if some stretch of
STRETCH successive positions has at least MATCHED equal words. The three masks are lossless for that: whichever three
positions of thirteen differ, one of the masks fits between them, so substitutions can't hide an overlap.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STRETCH, MATCHED = 13, 10
MASKS = ((0, 1, 2, 4, 5), (0, 1, 3, 6, 8), (0, 1, 2, 6, 8))
#: A side of a join is broadcast up to so many rows; beyond, the join is by shuffle.
FEW_SEEDS, FEW_ITEMS = 1_000_000, 20_000


def word_hashes(text: Column) -> Column:
    words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[\x20\x09-\x0D]+"), lambda x: x != "")
    return F.transform(words, lambda x: F.xxhash64(x))


def _seeds(tokens: DataFrame, at: str) -> DataFrame:
    """A row for each position and mask: the columns of tokens(h, ...), the position and the seed's hash.

    A seed that reaches past the end of its text hashes the words it has; a hit by one is verified like any other. Outer generators keep the optimizer from testing, and so computing, the arrays a second time.
    """
    rows = tokens.select("*", F.explode_outer(F.sequence(F.lit(0), F.greatest(F.size("h") - 1 - min(m[-1] for m in MASKS), F.lit(0)))).alias(at))
    seeds = F.array(*(F.xxhash64(F.lit(k), *(F.get(F.col("h"), F.col(at) + o) for o in m)) for k, m in enumerate(MASKS)))
    return rows.select("*", F.explode_outer(seeds).alias("seed"))


def contaminated(docs: DataFrame, benchmark: DataFrame, few_seeds: int = FEW_SEEDS, few_items: int = FEW_ITEMS) -> DataFrame:
    """doc_id, item_id, matched: a row for each pair of docs(doc_id, text) and benchmark(item_id, text) that overlaps.

    matched is the largest number of equal words in a stretch. Null and empty texts overlap with nothing, and so do
    items of fewer than MATCHED words, which prove too little. Rows that repeat a doc_id or an item_id count as one;
    nulls there are ids too. Empty tables give no rows; other columns are ignored.
    """
    items = benchmark.select("item_id", word_hashes(F.col("text")).alias("h")).filter(F.size("h") >= MATCHED)
    ours = _seeds(items, "ipos").select("seed", "item_id", "ipos")
    n_items, n_words = items.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("h")), F.lit(0))).first()
    ours = F.broadcast(ours) if n_words * len(MASKS) <= few_seeds else ours
    words = items.select(F.col("item_id").alias("i_"), F.col("h").alias("ih"))
    words = F.broadcast(words) if n_items <= few_items and n_words <= few_seeds else words
    seeds = _seeds(docs.select("doc_id", word_hashes(F.col("text")).alias("h")), "dpos").select("doc_id", "dpos", "seed")
    hits = seeds.join(ours, "seed").select("doc_id", "item_id", (F.col("dpos") - F.col("ipos")).alias("diagonal")).distinct()
    # to verify, texts with hits are cut into words again, each once, and an item's words come once with all its diagonals:
    # arrays of words never multiply by hits
    lying = hits.groupBy("doc_id", "item_id").agg(F.collect_list("diagonal").alias("diagonals"))
    asked = lying.join(words, F.col("item_id").eqNullSafe(F.col("i_"))).groupBy(F.col("doc_id").alias("d_")).agg(F.collect_list(F.struct("item_id", "diagonals", "ih")).alias("hits"))
    found = docs.select("doc_id", "text").join(asked, F.col("doc_id").eqNullSafe(F.col("d_"))).select("doc_id", "hits", word_hashes(F.col("text")).alias("h"))
    found = found.select("doc_id", F.explode(F.transform("hits", lambda x: F.struct(x["item_id"].alias("item_id"), F.array_max(F.transform(x["diagonals"], lambda d: _best(x["ih"], d, F.col("h")))).cast("long").alias("matched")))).alias("f"))
    return found.select("doc_id", "f.*").filter(F.col("matched") >= MATCHED).groupBy("doc_id", "item_id").agg(F.max("matched").alias("matched"))


def _best(ih: Column, diagonal: Column, h: Column) -> Column:
    """The largest number of equal words in STRETCH successive positions of a diagonal."""
    equal = F.transform(ih, lambda w, i: F.coalesce((F.get(h, diagonal + i) == w).cast("int"), F.lit(0)))
    return F.aggregate(
        equal,
        F.struct(F.array_repeat(F.lit(0), STRETCH).alias("last"), F.lit(0).alias("sum"), F.lit(0).alias("best")),
        lambda a, x: F.struct(F.concat(F.slice(a["last"], 2, STRETCH - 1), F.array(x)).alias("last"), (a["sum"] + x - a["last"][0]).alias("sum"), F.greatest(a["best"], a["sum"] + x - a["last"][0]).alias("best")),
        lambda a: a["best"],
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    """The rows of docs that no benchmark item overlaps, with all their columns."""
    leaks = contaminated(docs, benchmark, **how).select(F.col("doc_id").alias("leak_")).distinct()
    return docs.join(leaks, F.col("doc_id").eqNullSafe(F.col("leak_")), "left_anti")
