"""Mixing sources to target weights by pivotal dependent rounding, with DataFrame functions only.

Every document gets a fractional number of copies, its source's target over its source's size. Whole copies are kept;
of the fractions, documents are paired and mass (words) moves at random from one to the other until one of the two is
whole, which leaves each expectation and the source's sum of words as they are. A source's documents are dealt by
hash to blocks of bounded size; a block rounds all its documents but one, whose fraction goes up a reduction tree to a
block of such residuals, until each source has one left, which is rounded to the nearer whole, so that the source
misses its target by half that document at most. Large documents are paired first, so that what is left is small.

Random numbers are hashes of the seed and the document, so reruns and lost executors don't change the result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from .scratch import materialise, without

#: Words, as everywhere in this package: runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: Documents a block rounds; a source of any size takes a tree of log(size) / log(BLOCK) levels.
BLOCK = 64
#: Two hashes name a row: with one, some of 10**10 rows would share a name, and with it their fate.
KEY = "struct<one:bigint,two:bigint>"
#: Up to so many sources, a table with a row for each is broadcast; beyond, it is joined by shuffle.
FEW = 10_000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = (3.0, 1.0, 2.0), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """source, source_size, target: sources by code point, null last, take weights in turn and share `share` times all sizes.

    A target stops at `most` times its source's size and the excess is shared anew by weight: with sources ordered by
    capacity over weight, the capped ones are a prefix, and the prefix's end follows from running sums. One row per
    source: a table of names, not of documents.
    """
    from pyspark.sql import Window

    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    in_turn = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.pmod(F.row_number().over(in_turn) - 1, F.lit(len(weights)))
    weight = reduce(lambda c, kv: c.when(turn == kv[0], F.lit(float(kv[1]))), enumerate(weights), F.when(F.lit(False), F.lit(0.0)))
    s = by_source.withColumn("weight", weight).withColumn("most", F.lit(most) * F.col("source_size"))
    everything = Window.partitionBy()
    by_ratio = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    s = s.withColumn("budget", F.lit(share) * F.sum("source_size").over(everything))
    s = s.withColumn("capped_before", F.coalesce(F.sum("most").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
    s = s.withColumn("weight_left", F.sum("weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing)))
    s = s.withColumn("level", (F.col("budget") - F.col("capped_before")) / F.col("weight_left"))
    # the first source that isn't capped sets the level for all after it
    s = s.withColumn("free_level", F.min(F.when(F.col("weight") * F.col("level") <= F.col("most"), F.struct(F.col("most") / F.col("weight"), F.col("level").alias("level")))).over(everything)["level"])
    target = F.least(F.col("most"), F.coalesce(F.col("weight") * F.col("free_level"), F.col("most")))
    return s.select("source", "source_size", F.greatest(target, F.lit(0.0)).alias("target"))


def _coin(seed: int, *on: Column) -> Column:
    """A number in (0, 1) that depends on the seed and the columns only."""
    return (F.shiftrightunsigned(F.xxhash64(F.lit(seed), *on), 11).cast("double") + F.lit(0.5)) / F.lit(float(1 << 53))


def _fold(items: Column, seed: int, level: int) -> Column:
    """Pairs the items (key, words, part) of a block in turn; gives what was decided and the one that is left."""
    item = f"struct<key:{KEY},words:double,part:double>"
    zero = F.struct(F.lit(None).cast(item).alias("held"), F.array().cast(f"array<struct<key:{KEY},extra:int>>").alias("done"))

    def step(acc: Column, x: Column) -> Column:
        held = acc["held"]
        # words that can move to the held item, and from it, until one of the two is at 0 or 1
        to_held = F.least((1 - held["part"]) * held["words"], x["part"] * x["words"])
        from_held = F.least(held["part"] * held["words"], (1 - x["part"]) * x["words"])
        moves_in = _coin(seed + level, held["key"], x["key"]) * (to_held + from_held) < from_held
        fills = (1 - held["part"]) * held["words"] <= x["part"] * x["words"]  # the held one reaches 1 first
        empties = held["part"] * held["words"] <= (1 - x["part"]) * x["words"]  # it reaches 0 first
        settled = F.when(moves_in, F.when(fills, F.struct(held["key"].alias("key"), F.lit(1).alias("extra"))).otherwise(F.struct(x["key"].alias("key"), F.lit(0).alias("extra")))).otherwise(
            F.when(empties, F.struct(held["key"].alias("key"), F.lit(0).alias("extra"))).otherwise(F.struct(x["key"].alias("key"), F.lit(1).alias("extra")))
        )
        moved = F.when(moves_in, to_held).otherwise(-from_held)
        x_stays = settled["key"] == held["key"]
        left = F.when(x_stays, F.struct(x["key"].alias("key"), x["words"].alias("words"), (x["part"] - moved / x["words"]).alias("part"))).otherwise(
            F.struct(held["key"].alias("key"), held["words"].alias("words"), (held["part"] + moved / held["words"]).alias("part"))
        )
        left = F.struct(left["key"].alias("key"), left["words"].alias("words"), F.greatest(F.lit(0.0), F.least(F.lit(1.0), left["part"])).alias("part"))
        return F.when(held.isNull(), F.struct(x.cast(item).alias("held"), acc["done"].alias("done"))).otherwise(F.struct(left.cast(item).alias("held"), F.concat(acc["done"], F.array(settled)).alias("done")))

    return F.aggregate(items, zero, step)


def round_copies(parts: DataFrame, seed: int = 7, block: int = BLOCK) -> DataFrame:
    """key, extra (0 or 1) for every row of parts (group, key unique, words > 0, 0 < part < 1)."""
    spark = parts.sparkSession
    rest = parts.select("group", "key", F.col("words").cast("double"), F.col("part").cast("double"))
    decided: list[DataFrame] = []
    level = 0
    while True:
        sizes = rest.groupBy(F.col("group").alias("of")).agg(F.count(F.lit(1)).alias("n"))
        largest, groups = sizes.agg(F.max("n"), F.count(F.lit(1))).first()
        if largest is None:
            break
        if largest == 1:
            decided.append(rest.select("key", (F.col("part") >= 0.5).cast("int").alias("extra")))
            break
        last = largest <= block
        # a block takes block / 2 documents on average; the number of blocks of a group follows its size
        n = F.lit(1) if last else F.greatest(F.lit(1), F.ceil(F.col("n") / F.lit(block / 2)))
        sizes = F.broadcast(sizes) if groups <= FEW else sizes
        dealt = rest.join(sizes, F.col("group").eqNullSafe(F.col("of"))).select("group", "key", "words", "part", F.pmod(F.xxhash64(F.lit(seed * 31 + level), "key"), n).alias("block"))
        folded = dealt.groupBy("group", "block").agg(F.sort_array(F.collect_list(F.struct((-F.col("words")).alias("order"), "key", "words", "part"))).alias("items"))
        folded = folded.select("group", _fold(F.transform("items", lambda x: F.struct(x["key"].alias("key"), x["words"].alias("words"), x["part"].alias("part"))), seed, level).alias("f"))
        folded = materialise(folded.select("group", "f.held", "f.done"), f"mix-level{level}")
        decided.append(folded.select(F.inline("done")))
        rest = folded.select("group", "held.key", "held.words", "held.part")
        settled = (F.col("part") <= 1e-9) | (F.col("part") >= 1 - 1e-9)  # the last pair ended on whole copies both
        decided.append(rest.filter(settled).select("key", F.round("part").cast("int").alias("extra")))
        rest = rest.filter(~settled)
        level += 1
    if not decided:
        return spark.createDataFrame([], f"key {KEY}, extra int")
    return reduce(DataFrame.unionAll, decided)


def _numbered(docs: DataFrame, *others: str) -> DataFrame:
    """id, of, size, hash, again: what names a row of docs. again counts the rows that are equal in all the others."""
    from pyspark.sql import Window

    rows = docs.select(F.col("doc_id").alias("id"), F.col("source").alias("of"), word_count(F.col("text")).alias("size"), F.xxhash64("text").alias("hash"), *others)
    return rows.withColumn("again", F.row_number().over(Window.partitionBy("id", "of", "size", "hash").orderBy(F.lit(1))))


def _plan(docs: DataFrame, weights: tuple[float, ...], share: float, most: float, seed: int) -> DataFrame:
    name = ("id", "of", "hash", "again")
    sizes = _numbered(docs).withColumn("key", F.struct(F.xxhash64(F.lit(seed), *name).alias("one"), F.xxhash64(F.lit(~seed), *reversed(name)).alias("two")))
    sizes = materialise(sizes.withColumnRenamed("of", "source"), "mix-sizes")
    targets = materialise(source_targets(sizes, weights, share, most), "mix-targets")
    t = targets.withColumnRenamed("source", "of")
    whole = sizes.join(F.broadcast(t) if targets.count() <= FEW else t, F.col("source").eqNullSafe(F.col("of")), "left").drop("of")
    ratio = F.when(F.col("size") > 0, F.least(F.lit(float(most)), F.col("target") / F.col("source_size"))).otherwise(F.lit(0.0))
    base = F.floor(ratio + F.lit(1e-12))
    part = F.greatest(F.lit(0.0), ratio - base)
    whole = whole.withColumn("base", base.cast("int")).withColumn("part", F.when(part > 1e-9, part).otherwise(F.lit(0.0)))
    rounded = round_copies(whole.filter("part > 0").select(F.col("source").alias("group"), "key", F.col("size").alias("words"), "part"), seed)
    extra = rounded.groupBy("key").agg(F.max("extra").alias("extra"))
    copies = F.col("base") + F.when(F.col("part") > 0, F.coalesce("extra", F.lit(0))).otherwise(F.lit(0))
    return whole.join(extra, "key", "left").withColumn("copies", copies.cast("int"))


def mix_sources(docs: DataFrame, weights: tuple[float, ...] = (3.0, 1.0, 2.0), share: float = 1.5, most: float = 2.0, seed: int = 7) -> DataFrame:
    """doc_id, source, size, source_size, target, copies, taken: one row per row of docs(doc_id, text, source).

    A document gets floor(target / source_size) copies or one more; at most `most` of them. Documents without words
    (null or empty text) have size 0, no copies and take nothing; a null source is a source, the last in order. Rows
    that repeat are documents of their own, told apart by their text or else by their number. An empty table gives no
    rows. Other columns are ignored.
    """
    out = _plan(docs, weights, share, most, seed)
    return out.select(F.col("id").alias("doc_id"), "source", "size", "source_size", F.col("target").cast(DoubleType()), "copies", (F.col("size") * F.col("copies")).alias("taken"))


def mixed_documents(docs: DataFrame, weights: tuple[float, ...] = (3.0, 1.0, 2.0), share: float = 1.5, most: float = 2.0, seed: int = 7) -> DataFrame:
    """The mix itself: every row of docs as often as mix_sources says of that row, with copy = 0, 1, ...

    All columns stay but one named copy, which is replaced.
    """
    columns = without(docs, "copy")
    plan = _plan(docs, weights, share, most, seed).filter("copies > 0").select(F.struct("id", F.col("source").alias("of"), "size", "hash", "again").alias("name"), "copies")
    rows = _numbered(docs, F.struct(*columns).alias("row")).select("row", F.struct("id", "of", "size", "hash", "again").alias("name"))
    return rows.join(plan, "name").select("row.*", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("copy"))


__all__ = ["mix_sources", "mixed_documents", "round_copies", "source_targets", "word_count"]
