"""Near-duplicate documents by ProbMinHash signatures, banding and verification.

A text's elements are its windows of five lower-case words (a shorter text is one element), weighted by how often they
occur. Each element sends arrivals to a signature's registers: a Poisson process of its weight as rate, whose times and
registers are hashes of the element alone. A register keeps the element that arrives first, so two texts agree in one
with the probability Jaccard similarity of their weights. An element is left as soon as its next arrival comes after
all registers' times. Registers are hashed in bands; texts that share a band are candidates.

A link is a Jaccard similarity of sets, of which that of weights can fall far short where texts repeat an element
unequally often. So a text that repeats any element has a second signature with all weights 1, whose registers agree with
the probability of the set similarity, and sends the bands of both. Without repeats the two signatures are the same.

Texts of equal elements are one class from the start, found by a digest, so that copies cost one row each. Of the
others, candidates are verified by the Jaccard similarity of their elements, in rounds that never list a bucket's pairs:

1. every text of a bucket against the bucket's hub, the text that has most bucket mates;
2. in buckets that then still hold several components, every text outside the largest one against all texts of other
   components. A text of which fewer than 80 % of the elements occur in any other text of those buckets can be linked to
   none and is left out first. Buckets are cut into pairs of blocks of bounded size; similarities are counted from
   inverted lists in NumPy, and only links that join two components leave the task.

So a large group of near copies costs a link or so a text, and no candidate that could join two components is left out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from . import textkit as T
from .components import components
from .scratch import materialise, release

WORDS = 5
BANDS, ROWS = 24, 5
REGISTERS = BANDS * ROWS
#: Texts of a bucket on either side of a comparison in one task.
BLOCK = 1024


def elements(t: T.Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct elements of each text with their counts: text, hash, count, ordered by text and hash."""
    w = T.words(t)
    h = T.word_hashes(t, w, T.LOWER)
    at, wide = T.windows(h, w.doc, WORDS)
    doc = w.doc[at]
    sizes = np.diff(w.first)
    short = np.flatnonzero((sizes > 0) & (sizes < WORDS))
    if len(short):
        own = np.zeros(len(short), np.uint64)
        for k in range(WORDS - 1):
            has = sizes[short] > k
            own[has] = own[has] * np.uint64(T.BASE) + h[w.first[short[has]] + k]
        doc, wide = np.concatenate([doc, short]), np.concatenate([wide, T.mix(own + np.uint64(WORDS))])
    order = np.lexsort((wide, doc))
    doc, wide = doc[order], wide[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (wide[1:] != wide[:-1])
    first = np.flatnonzero(new)
    return doc[first], wide[first], np.diff(np.append(first, len(doc)))


def _exponential(h: np.ndarray) -> np.ndarray:
    return -np.log(((h >> np.uint64(11)).astype(np.float64) + 0.5) * (1.0 / (1 << 53)))


def signatures(doc: np.ndarray, element: np.ndarray, weight: np.ndarray, n: int, registers: int = REGISTERS) -> np.ndarray:
    """ProbMinHash: n x registers labels of the elements that arrive first (0 where a text has none)."""
    times = np.full(n * registers, np.inf)
    labels = np.zeros(n * registers, np.uint64)
    doc, element, rate, x = doc, element, weight.astype(np.float64), np.zeros(len(doc))
    arrival, burst = 0, 1
    while len(doc):
        for _ in range(burst):  # a burst of arrivals between two tests of who is done
            arrival += 1
            h = T.mix(element + np.uint64(arrival * 0xD1342543DE82EF95 & 0xFFFFFFFFFFFFFFFF))
            x = x + _exponential(h) / rate
            at = doc * registers + (T.mix(h) % np.uint64(registers)).astype(np.int64)
            np.minimum.at(times, at, x)
            won = times[at] == x
            labels[at[won]] = element[won]
        latest = times.reshape(n, registers).max(1)
        on = x < latest[doc]
        if not on.all():
            doc, element, rate, x = doc[on], element[on], rate[on], x[on]
        burst = min(32, burst * 2) if arrival > 2 else 1
    return labels.reshape(n, registers)


def _bands(labels: np.ndarray) -> np.ndarray:
    band = np.zeros((len(labels), BANDS), np.uint64)
    for r in range(ROWS):
        band = band * np.uint64(T.BASE) + labels[:, r::ROWS]
    return T.mix(band + np.arange(BANDS, dtype=np.uint64) * np.uint64(0x9FB21C651E98DF25))


def bands_of(doc: np.ndarray, element: np.ndarray, count: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Bands by text, and how many each text has: those of its weights, and those of its set where they differ."""
    weighted = _bands(signatures(doc, element, count, n))
    repeats = np.zeros(n, bool)
    repeats[doc[count > 1]] = True
    place, on = np.cumsum(repeats) - 1, repeats[doc]
    plain = weighted.copy()
    plain[repeats] = _bands(signatures(place[doc[on]], element[on], np.ones(on.sum()), int(repeats.sum())))
    both = np.concatenate([weighted, plain], 1)
    sent = np.concatenate([np.ones((n, BANDS), bool), plain != weighted], 1)
    return both[sent], sent.sum(1)


def _fingerprint(batches):
    for batch in batches:
        out = {k: [] for k in ("n", "key", "bands", "n_bands")}
        for t in T.chunks(batch.column("text")):
            n = len(t.starts)
            doc, element, count = elements(t)
            sizes = np.bincount(doc, minlength=n)
            mixed = T.mix(element)
            first = np.concatenate([[0], np.cumsum(sizes)])
            sums = [np.concatenate([[np.uint64(0)], np.cumsum(v)]) for v in (mixed, T.mix(mixed + np.uint64(1)))]
            key = np.stack([s[first[1:]] - s[first[:-1]] for s in sums], 1)
            band, n_bands = bands_of(doc, element, count, n)
            out["n"].append(sizes)
            out["key"].append(key)
            out["bands"].append(band.view(np.int64))
            out["n_bands"].append(n_bands)
        if not out["n"]:
            continue
        key = np.concatenate(out["key"])
        ends = np.concatenate([[0], np.cumsum(np.concatenate(out["n_bands"]))]).astype(np.int32)
        bands = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(out["bands"])))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.concatenate(out["n"])), pa.array(key[:, 0].copy().view(np.int64)), pa.array(key[:, 1].copy().view(np.int64)), bands], names=["doc_id", "n", "key1", "key2", "bands"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n (distinct elements), key1 and key2 (a digest of the set), bands."""
    schema = StructType([docs.schema["doc_id"], StructField("n", LongType()), StructField("key1", LongType()), StructField("key2", LongType()), StructField("bands", ArrayType(LongType()))])
    return docs.select("doc_id", "text").mapInArrow(_fingerprint, schema)


def _element_sets(batches):
    for batch in batches:
        sets = []
        for t in T.chunks(batch.column("text")):
            doc, element, _ = elements(t)
            sets += [e.tobytes() for e in np.split(element, np.searchsorted(doc, np.arange(1, len(t.starts))))]
        yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(sets, pa.binary())], names=["node", "elements"])


def _verify(batches, least: float):
    for batch in batches:
        (da, oa), (db, ob) = T.views(batch.column("ea")), T.views(batch.column("eb"))
        good = np.zeros(batch.num_rows, bool)
        for k in range(batch.num_rows):
            x = np.frombuffer(da[oa[k] : oa[k + 1]].tobytes(), np.uint64)
            y = np.frombuffer(db[ob[k] : ob[k + 1]].tobytes(), np.uint64)
            if min(len(x), len(y)) < least * max(len(x), len(y)):
                continue
            both = np.sort(np.concatenate([x, y]), kind="stable")
            common = int((both[1:] == both[:-1]).sum())
            good[k] = common >= least * (len(both) - common) - 1e-9
        mask = pa.array(good)
        yield pa.RecordBatch.from_arrays([batch.column("a").filter(mask), batch.column("b").filter(mask)], names=["a", "b"])


def verified(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """Of pairs (a, b), those whose element sets have a Jaccard similarity of at least `least`."""
    one, two = sets.select(F.col("node").alias("a"), F.col("elements").alias("ea")), sets.select(F.col("node").alias("b"), F.col("elements").alias("eb"))
    both = pairs.select("a", "b").join(one.hint("merge"), "a").join(two.hint("merge"), "b").select("a", "b", "ea", "eb")
    return both.mapInArrow(lambda it: _verify(it, least), pairs.select("a", "b").schema)


def _joining(rows: pa.Table, least: float) -> list[tuple[int, int]]:
    """Links between components of one pair of blocks: side 0 against side 1, or all against all (side 2)."""
    side, nodes, roots = rows["side"].to_numpy(), rows["node"].to_numpy(), rows["root"].to_numpy()
    data, offsets = T.views(rows["elements"])
    data, offsets = np.frombuffer(data.tobytes(), np.uint64), offsets // 8
    size = np.diff(offsets)
    left, right = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
    owner = np.repeat(np.arange(len(size)), size)
    listed = side[owner] != 0
    place = np.full(len(size), -1)
    place[right] = np.arange(len(right))
    order = np.argsort(data[listed], kind="stable")
    sorted_, holder = data[listed][order], place[owner[listed][order]]
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out = []
    step = max(1, 2_000_000 // max(1, len(sorted_)))  # texts whose shared elements fit in memory at once
    for s in range(0, len(left), step):
        part = left[s : s + step]
        at = np.concatenate([np.arange(offsets[i], offsets[i + 1]) for i in part])
        mine = np.repeat(np.arange(len(part)), size[part])
        lo, hi = np.searchsorted(sorted_, data[at], "left"), np.searchsorted(sorted_, data[at], "right")
        n = hi - lo
        hits = np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())
        common = np.bincount(np.repeat(mine, n) * len(right) + holder[hits], minlength=len(part) * len(right)).reshape(len(part), len(right))
        either = size[part][:, None] + size[right][None, :] - common
        good = (common >= least * either - 1e-9) & (roots[part][:, None] != roots[right][None, :])
        for i, j in zip(*np.nonzero(good)):
            a, b = find(int(roots[part[i]])), find(int(roots[right[j]]))
            if a != b:
                parent[max(a, b)] = min(a, b)
                out.append((int(nodes[part[i]]), int(nodes[right[j]])))
    return out


def _links_across(batches, least: float):
    """The same for rows sorted by (bucket, task), of which a group may go on in the next batch."""
    held: list[pa.RecordBatch] = []

    def links(table: pa.Table) -> pa.RecordBatch:
        bucket, task = table["bucket"].to_numpy(), table["task"].to_numpy()
        cut = np.flatnonzero(np.append(True, (bucket[1:] != bucket[:-1]) | (task[1:] != task[:-1])))
        found = [x for s, e in zip(cut, np.append(cut[1:], len(bucket))) for x in _joining(table.slice(s, e - s), least)]
        return pa.RecordBatch.from_arrays([pa.array([max(x) for x in found], pa.int64()), pa.array([min(x) for x in found], pa.int64())], names=["a", "b"])

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        table = pa.Table.from_batches(held)
        bucket, task = table["bucket"].to_numpy(), table["task"].to_numpy()
        other = np.flatnonzero((bucket != bucket[-1]) | (task != task[-1]))
        if len(other):
            whole = int(other[-1]) + 1
            yield links(table.slice(0, whole))
            held = table.slice(whole).to_batches()
    if held:
        yield links(pa.Table.from_batches(held))


def _links_between(buckets: DataFrame, roots: DataFrame, sets: DataFrame, least: float, made: list[DataFrame]) -> DataFrame:
    """Links that join components which still share a bucket. buckets: bucket, node; sets: node, elements; made: gets the tables it reads."""
    now = buckets.join(roots, "node", "left").select("bucket", "node", F.coalesce("root", "node").alias("root"))
    by = now.groupBy("bucket", "root").agg(F.count(F.lit(1)).alias("n"))
    mixed = by.groupBy("bucket").agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("size"), F.max("n").alias("n_largest"), F.max_by("root", F.struct("n", "root")).alias("largest")).filter("k > 1")
    # aggregates are tables of their own before they are joined, so that Spark can split a hot bucket's rows
    mixed = materialise(mixed, "mixed-sizes")
    rows = materialise(now.join(mixed, "bucket").withColumn("outside", F.col("root") != F.col("largest")), "mixed-buckets")
    # an outside text needs 80 % of its elements in other texts to be like any of them
    nodes = rows.groupBy("node").agg(F.max("outside").alias("outside"))
    listed = nodes.join(sets.hint("merge"), "node").mapInArrow(_listed, "node long, outside boolean, size long, element long")
    listed = materialise(listed, "mixed-elements")
    made += [mixed, rows, listed]
    repeated = listed.groupBy("element").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("element")
    able = listed.filter("outside").join(repeated.hint("merge"), "element").groupBy("node").agg(F.count(F.lit(1)).alias("n"), F.first("size").alias("size")).filter(F.col("n") >= least * F.col("size") - 1e-9).select("node", F.lit(True).alias("able"))
    rows = rows.join(able, "node", "left").filter("able or not outside").withColumn("outside", F.col("outside") & F.col("able").isNotNull())
    rows = materialise(rows, "able-buckets")
    made.append(rows)
    left = rows.groupBy("bucket").agg(F.count_if("outside").alias("n_out"), F.count_if(~F.col("outside")).alias("n_in")).filter("n_out > 0 and n_out + n_in > 1")
    left = materialise(left, "mixed-left")
    made.append(left)
    rows = rows.select("bucket", "node", "root", "outside").join(left, "bucket")
    blocks = lambda n: F.greatest(F.lit(1), F.ceil(F.col(n) / F.lit(BLOCK))).cast("int")
    bo, bi = blocks("n_out"), blocks("n_in")
    own = F.pmod(F.xxhash64("node"), F.when(F.col("outside"), bo).otherwise(bi)).cast("int")
    part = lambda kind, i, j, side: F.struct(F.concat_ws("-", F.lit(kind), i.cast("string"), j.cast("string")).alias("task"), side.cast("int").alias("side"))
    among = F.transform(F.sequence(F.lit(0), bo - 1), lambda j: part("o", F.least(own, j), F.greatest(own, j), F.when(own == j, 2).when(own < j, 0).otherwise(1)))
    against = F.when(F.col("n_in") > 0, F.transform(F.sequence(F.lit(0), bi - 1), lambda j: part("i", own, j, F.lit(0)))).otherwise(F.array().cast("array<struct<task:string,side:int>>"))
    inside = F.transform(F.sequence(F.lit(0), bo - 1), lambda i: part("i", i, own, F.lit(1)))
    dealt = rows.withColumn("t", F.explode(F.when(F.col("outside"), F.concat(among, against)).otherwise(inside))).select("bucket", F.xxhash64("t.task").alias("task"), "t.side", "node", "root")
    full = dealt.join(sets.hint("merge"), "node").select("bucket", "task", "side", "node", "root", "elements")
    full = full.repartition("bucket", "task").sortWithinPartitions("bucket", "task")
    return full.mapInArrow(lambda it: _links_across(it, least), "a long, b long").distinct()


def _listed(batches):
    for batch in (b.slice(k, 256) for b in batches for k in range(0, b.num_rows, 256)):
        data, offsets = T.views(batch.column("elements"))
        size = np.diff(offsets) // 8
        at = pa.array(np.repeat(np.arange(batch.num_rows), size))
        yield pa.RecordBatch.from_arrays([batch.column("node").take(at), batch.column("outside").take(at), pa.array(np.repeat(size, size)), pa.array(np.frombuffer(data.tobytes(), np.int64))], names=["node", "outside", "size", "element"])


def near_duplicates(docs: DataFrame, least: float = 0.8) -> DataFrame:
    """doc_id, class_id: one row for each doc_id of docs(doc_id integer, text, ...); class_id is the least doc_id of its class.

    Classes are the components of links between texts whose sets of five-word windows have a Jaccard similarity of at
    least `least`, as far as their signatures share a band (at 0.8: 99.99 %). Null, empty and blank texts have no
    elements, are like nothing and form a class each, as does a null doc_id. Rows that repeat a doc_id are one document if
    their texts are equal; if they differ, the classes of all of them are one. An empty table gives no rows.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    prints = materialise(fingerprints(rows), "fingerprints")
    full = prints.filter("n > 0 and doc_id is not null")
    # texts of equal elements are one node, named by its least doc_id
    # (aggregates are written before they are joined: only then can Spark split the side of a key with very many rows)
    distinct = materialise(full.groupBy("key1", "key2").agg(F.min("doc_id").alias("node")), "distinct-texts")
    members = materialise(full.select("doc_id", "key1", "key2").join(distinct, ["key1", "key2"]).select("doc_id", "node").distinct(), "members")
    # the node's row: copies have the same bands
    own = full.join(distinct.select(F.col("node").alias("doc_id"), "key1", "key2"), ["doc_id", "key1", "key2"], "left_semi")
    bands = own.select(F.col("doc_id").alias("node"), F.explode("bands").alias("bucket"))
    shared = materialise(bands.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).filter("size > 1"), "shared-buckets")
    buckets = materialise(bands.join(shared, "bucket").select("bucket", "node", "size"), "buckets")
    weight = buckets.groupBy("node").agg(F.sum("size").alias("mates"))
    sets = materialise(_sets_of(rows, weight.select("node")), "elements")
    ranked = buckets.join(weight, "node")
    hub = materialise(ranked.groupBy("bucket").agg(F.min_by("node", F.struct(-F.col("mates"), "node")).alias("hub")), "hubs")
    pairs = buckets.join(hub, "bucket").filter("node <> hub").select(F.greatest("node", "hub").alias("a"), F.least("node", "hub").alias("b")).distinct()
    links = verified(pairs, sets, least)
    # a doc_id with several texts ties their nodes together
    several = members.groupBy("doc_id").agg(F.min("node").alias("b"), F.max("node").alias("a")).filter("a <> b").select("doc_id")
    tied = members.join(several, "doc_id", "left_semi")
    links = materialise(links.unionByName(tied.select(F.col("doc_id").alias("a"), F.col("node").alias("b"))), "near-links")
    roots = materialise(components(links), "roots")
    made: list[DataFrame] = []
    more = materialise(_links_between(buckets.select("bucket", "node"), roots, sets, least, made), "near-links")
    if not more.isEmpty():
        last, roots = roots, materialise(components(links.unionByName(more)), "roots")
        release(last)
    release(distinct, shared, buckets, sets, hub, links, more, *made)
    classes = members.join(roots, "node", "left").select("doc_id", F.coalesce("root", "node").alias("class_id")).groupBy("doc_id").agg(F.min("class_id").alias("class_id"))
    alone = prints.filter("n = 0 or doc_id is null").select("doc_id").distinct().join(members.select(F.col("doc_id").alias("m_")).distinct(), F.col("doc_id") == F.col("m_"), "left_anti")
    return classes.unionByName(alone.select("doc_id", F.col("doc_id").alias("class_id")))


def _sets_of(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    some = rows.join(nodes.hint("merge"), F.col("doc_id") == F.col("node"), "left_semi").select(F.col("doc_id").alias("node"), "text")
    return some.mapInArrow(_element_sets, "node long, elements binary").dropDuplicates(["node"])


def without_near_duplicates(docs: DataFrame, least: float = 0.8) -> DataFrame:
    """The rows of docs, with all columns, whose doc_id names its class: one document stays of each."""
    ids = near_duplicates(docs, least).filter("doc_id is null or doc_id = class_id").select(F.col("doc_id").alias("stays_"))
    return docs.join(ids, F.col("doc_id").cast("long").eqNullSafe(F.col("stays_")), "left_semi")


__all__ = ["near_duplicates", "signatures", "without_near_duplicates"]
