"""Removal of long repeated byte strings by a common-prefix-aware distributed merge sort of suffixes.

A byte goes if it is covered by a LENGTH-byte string that also starts anywhere else in the corpus. To compare all
suffixes is neither needed nor possible at scale, so sorting is confined, without loss, to where repeats can be:

1. Of the GRAM-byte strings within a LENGTH-byte string, the first one of least hash is its anchor. Where it stands is a
   function of the string alone, so equal strings have equal anchors at equal offsets. Successive strings of a text with
   the same anchor make a stretch, about one for (LENGTH - GRAM) / 2 bytes; a stretch whose anchor's hash occurs once in
   the corpus holds no repeat. That is all that hashes are used for.
2. All other stretches are sorted, each by one key: the suffix from its anchor on, then the bytes before the anchor from
   right to left. A task sorts its own keys, of which equal ones are one entry with a count, and writes them
   as a run of front-coded blocks (length of the prefix shared with the key before, and the rest).
3. Runs are cut into ranges at sampled keys and exchanged; a range merges its runs with a loser tree whose comparisons
   start behind the prefix already known, and which gives out each key with the prefix it shares with the one before.
   An entry of count 2 is repeated as a whole. Of others, the string that starts d bytes before the anchor is repeated if some
   other entry shares the d bytes before it and LENGTH - d from it on: the latter are the entries around it between which
   the common prefix never falls below LENGTH - d, and the same holds for the former in the order of the bytes before.
4. A boundary between ranges may cut the entries of one anchor, of which a hot passage can have any number. How much an entry
   shares with the boundary bounds what it shares with all entries beyond. Strings that could so be repeated
   there are brought together by hash, one of each kind from a range, and then compared by their bytes.

Matches never cross texts. No string is held to be equal to another by a hash.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from . import textkit as T
from .scratch import materialise, release

LENGTH, GRAM = 200, 48
#: Bytes of keys that a task sorts at once; a task with more writes several runs.
RUN_BYTES = 64 << 20
#: Entries of a block of a run, entries of a range on average, and entries that are decided at once (or more, if one anchor has more).
BLOCK, RANGE, BATCH = 1024, 20_000, 40_000
#: Keys sampled to place the ranges' boundaries, and so the most ranges; results don't depend on it.
SPLITTER_SAMPLE = 20_000


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minima of x over windows of `width`, by doubling."""
    n, size, y = len(x) - width + 1, 1, x
    while size * 2 <= width:
        y = np.minimum(y[:-size], y[size:])
        size *= 2
    return np.minimum(y[:n], y[width - size : width - size + n])


def stretches(t: T.Texts, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """Of texts: the text of each stretch, its first and last string, its anchor, and the anchor's hash."""
    empty = np.zeros(0, np.int64)
    if len(t.data) < length:
        return empty, empty, empty, empty, empty.astype(np.uint64)
    width = length - gram + 1
    sums = T.prefix_sums(t.data)
    grams = T.mix((sums[gram:] - sums[:-gram]) * T.powers(T.INVERSE, len(sums))[: len(sums) - gram])
    least = sliding_min(grams, width)
    valid = np.zeros(len(least) + 1, np.int8)
    long = t.ends - t.starts >= length
    np.add.at(valid, t.starts[long], 1)
    np.add.at(valid, t.ends[long] - length + 1, -1)
    valid = np.cumsum(valid[:-1], dtype=np.int8) > 0
    new = valid.copy()
    # a string that starts at its anchor is the last one with it, though the next may have another of the same hash
    new[1:] &= ~valid[:-1] | (least[1:] != least[:-1]) | (grams[: len(least) - 1] == least[:-1])
    new[t.starts[long]] = True
    first = np.flatnonzero(new)
    if not len(first):
        return empty, empty, empty, empty, empty.astype(np.uint64)
    last_at = np.flatnonzero(valid)
    last = last_at[np.searchsorted(last_at, np.append(first[1:], len(least))) - 1]
    anchor = last + np.lib.stride_tricks.sliding_window_view(grams, width)[last].argmin(1)
    # equal empty texts share a start: the owner is the last of those, which is the one with bytes
    doc = np.searchsorted(t.starts, first, "right") - 1
    return doc, first - t.starts[doc], last - t.starts[doc], anchor - t.starts[doc], least[first]


def _text_hash(t: T.Texts) -> np.ndarray:
    return T.span_hashes(T.prefix_sums(t.data), t.starts, t.ends).view(np.int64)


def _scan(batches):
    for batch in batches:
        for t in T.chunks(batch.column("text")):
            doc, first, last, anchor, least = stretches(t)
            ids = batch.column("doc_id").take(pa.array(doc + t.first))
            small = [pa.array(x.astype(np.int16)) for x in (last - first, anchor - last)]
            yield pa.RecordBatch.from_arrays([ids, pa.array(_text_hash(t)[doc]), pa.array(least.view(np.int64)), pa.array(first.astype(np.int32)), *small], names=["doc_id", "text_hash", "least", "first", "more", "ahead"])


def _pack(batches):
    """Texts compressed, so that they can be shuffled at less cost."""
    squeeze = zstandard.ZstdCompressor(level=3, write_content_size=True)
    for batch in batches:
        texts, hashes = [], []
        for t in T.chunks(batch.column("text")):
            hashes.append(_text_hash(t))
            texts += [squeeze.compress(t.data[a:b].tobytes()) for a, b in zip(t.starts, t.ends)]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.concatenate([*hashes, np.zeros(0, np.int64)]), pa.int64()), pa.array(texts, pa.binary())], names=["doc_id", "text_hash", "packed"])


def common_prefix(x: bytes, y: bytes, known: int = 0) -> int:
    """The length of the longest common prefix, of which `known` bytes needn't be looked at."""
    n = min(len(x), len(y))
    step = 16
    while known < n:
        a, b = x[known : known + step], y[known : known + step]
        if a == b:
            known += len(a)
            step *= 2
            continue
        n = min(len(a), len(b))
        differ = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
        return known + (n - (differ.bit_length() + 7) // 8 if differ else n)
    return n


def front_code(suffixes: Iterable[bytes]) -> tuple[list[int], list[bytes]]:
    """Of sorted strings: the prefix shared with the one before, and the rest."""
    shared, rest, before = [], [], b""
    for s in suffixes:
        k = common_prefix(before, s)
        shared.append(k)
        rest.append(s[k:])
        before = s
    return shared, rest


def front_decode(shared: Iterable[int], rest: Iterable[bytes]) -> Iterator[tuple[int, bytes]]:
    before = b""
    for k, r in zip(shared, rest):
        before = before[:k] + r
        yield k, before


def merge_runs(runs: list[Iterator[tuple[int, bytes, object]]]) -> Iterator[tuple[int, bytes, object]]:
    """Merges sorted runs of (prefix shared with the one before, string, payload) with a loser tree.

    Each run's head carries how long a prefix it shares with the string that went out last. Of two heads the one that
    shares more comes first; only if they share equally much are bytes compared, from there on. What went out carries the
    prefix it shares with what went out before it.
    """
    k = 1
    while k < len(runs):
        k *= 2
    heads: list[tuple[int, bytes, object] | None] = [next(r, None) for r in runs] + [None] * (k - len(runs))
    known = [0] * k
    tree = [-1] * k  # losers; tree[0] the winner

    def play(a: int, b: int) -> tuple[int, int]:
        """Winner and loser; notes what the loser shares with the winner."""
        x, y = heads[a], heads[b]
        if x is None or y is None:
            return (b, a) if x is None else (a, b)
        if known[a] != known[b]:
            return (a, b) if known[a] > known[b] else (b, a)
        p = common_prefix(x[1], y[1], known[a])
        if len(x[1]) == p or len(y[1]) > p and x[1][p] < y[1][p]:
            known[b] = p
            return a, b
        known[a] = p
        return b, a

    def build(node: int) -> int:
        if node >= k:
            return node - k
        winner, tree[node] = play(build(2 * node), build(2 * node + 1))
        return winner

    winner = build(1) if k > 1 else 0
    while heads[winner] is not None:
        _, s, payload = heads[winner]
        yield known[winner], s, payload
        heads[winner] = next(runs[winner], None)
        if heads[winner] is not None:
            known[winner] = heads[winner][0]
        node = (winner + k) // 2
        while node:
            winner, tree[node] = play(winner, tree[node])
            node //= 2


#: A block of a run: its keys front-coded, how much of each is suffix, how often each occurs, and where: the entry of each
#: occurrence, its text and its anchor. What is merged reads no occurrences, so their number weighs on no range.
BLOCKS = "run bigint, block int, middle binary, shared array<int>, rest array<binary>, cut array<int>, n array<int>, entry array<int>, doc_id array<bigint>, text_hash array<bigint>, anchor array<int>"
BLOCK_TYPES = dict(run=pa.int64(), block=pa.int32(), middle=pa.binary(), shared=pa.list_(pa.int32()), rest=pa.list_(pa.binary()), cut=pa.list_(pa.int32()), n=pa.list_(pa.int32()), entry=pa.list_(pa.int32()), doc_id=pa.list_(pa.int64()), text_hash=pa.list_(pa.int64()), anchor=pa.list_(pa.int32()))
PIECES = "range int, run bigint, block int, first int, shared array<int>, rest array<binary>, cut array<int>, n array<int>"
PIECE_TYPES = dict(range=pa.int32(), run=pa.int64(), block=pa.int32(), first=pa.int32(), shared=pa.list_(pa.int32()), rest=pa.list_(pa.binary()), cut=pa.list_(pa.int32()), n=pa.list_(pa.int32()))
#: Strings of an entry that are repeated; with h, one that may be. A mark is one number: the entry in its block, the first and the last start, counted from the anchor.
MARKS = "run bigint, block int, mark bigint, h bigint"


def _mark(entry, low, high):
    return entry << 20 | low + 512 << 10 | high + 512


def _unmarked(mark):
    return mark >> 20, (mark >> 10 & 1023) - 512, (mark & 1023) - 512


def _rows(rows: list[dict], types: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], t) for c, t in types.items()], names=list(types))


def _runs(batches):
    """The stretches asked for, as sorted runs of blocks."""
    open_, number = zstandard.ZstdDecompressor(), TaskContext.get().partitionId() << 24
    held: dict[tuple[bytes, int], list[tuple]] = {}
    size = 0

    def flushed() -> Iterator[pa.RecordBatch]:
        keys = sorted(held)
        for block, at in enumerate(range(0, len(keys), BLOCK)):
            some = keys[at : at + BLOCK]
            places = [held[k] for k in some]
            shared, rest = front_code(k for k, _ in some)
            flat = [x for p in places for x in p]
            entry = [i for i, p in enumerate(places) for _ in p]
            yield _rows([dict(run=number, block=block, middle=some[len(some) // 2][0], shared=shared, rest=rest, cut=[c for _, c in some], n=[len(p) for p in places], entry=entry, doc_id=[x[0] for x in flat], text_hash=[x[1] for x in flat], anchor=[x[2] for x in flat])], BLOCK_TYPES)

    for batch in batches:
        asked, texts = batch.column("asked"), batch.column("packed").to_pylist()
        place, offsets = asked.flatten().to_numpy(), np.concatenate([[0], np.cumsum(asked.value_lengths().to_numpy(zero_copy_only=False))])
        first = place >> 16
        last = first + (place >> 8 & 255)
        first, last, anchor = first.tolist(), last.tolist(), (last + (place & 255)).tolist()
        for k, (doc, text_hash, packed) in enumerate(zip(batch.column("doc_id").to_pylist(), batch.column("text_hash").to_pylist(), texts)):
            text = open_.decompress(packed)
            for x in range(offsets[k], offsets[k + 1]):
                g, end = anchor[x], last[x] + LENGTH
                key = text[g:end] + text[first[x] : g][::-1]
                held.setdefault((key, end - g), []).append((doc, text_hash, g))
                size += 200 + len(key)
            if size > RUN_BYTES:
                yield from flushed()
                held, size, number = {}, 0, number + 1
    yield from flushed()


def _pieces(batches, splitters: list[bytes]):
    """Blocks cut at the splitters; a piece starts with a whole key."""
    for batch in batches:
        for row in batch.to_pylist():
            keys = [k for _, k in front_decode(row["shared"], row["rest"])]
            ends = sorted({*(bisect_left(keys, x) for x in splitters[bisect_right(splitters, keys[0]) : bisect_right(splitters, keys[-1])]), len(keys)} - {0})
            at, out = 0, []
            for end in ends:
                part = slice(at, end)
                out.append(dict(range=bisect_right(splitters, keys[at]), run=row["run"], block=row["block"], first=at, shared=[0, *row["shared"][at + 1 : end]], rest=[keys[at], *row["rest"][at + 1 : end]], cut=row["cut"][part], n=row["n"][part]))
                at = end
            yield _rows(out, PIECE_TYPES)


def _run_of(pieces: list[dict]) -> Iterator[tuple[int, bytes, tuple]]:
    """Pieces of a run as one run: prefix shared with the key before, key, (suffix bytes, count, run, block, entry)."""
    before = b""
    for p in sorted(pieces, key=lambda x: (x["block"], x["first"])):
        for k, ((shared, key), cut, n) in enumerate(zip(front_decode(p["shared"], p["rest"]), p["cut"], p["n"])):
            yield shared if k else common_prefix(before, key), key, (cut, n, p["run"], p["block"], p["first"] + k)
            before = key


class Entries:
    """Entries of whole anchors, in order, to be decided together; `beyond` is what each may share with other ranges."""

    def __init__(self):
        self.keys, self.shared, self.cut, self.n, self.places, self.beyond = [], [], [], [], [], []

    def add(self, shared: int, key: bytes, cut: int, n: int, place: tuple, beyond: int) -> None:
        if self.keys and shared == len(key) == len(self.keys[-1]):
            k = len(self.keys) - 1  # equal keys that are cut elsewhere are other entries, side by side
            while k >= 0 and self.cut[k] != cut and self.shared[k] == len(key):
                k -= 1
            if self.cut[k] == cut and self.keys[k] == key:
                self.n[k] += n
                self.places[k].append(place)
                return
        for to, x in zip((self.keys, self.shared, self.cut, self.n, self.places, self.beyond), (key, shared, cut, n, [place], beyond)):
            to.append(x)

    def decided(self) -> Iterator[pa.RecordBatch]:
        """Marks of the entries, a batch of rows of MARKS."""
        m = len(self.keys)
        if not m:
            return
        shared, cut, n = (np.array(x, np.int64) for x in (self.shared, self.cut, self.n))
        shared[0] = 0
        beyond = np.array(self.beyond, np.int64)
        lengths = np.array([len(k) for k in self.keys], np.int64)
        left = lengths - cut
        # the bytes before the anchors, in their own order
        tails = [k[c:] for k, c in zip(self.keys, self.cut)]
        order = np.array(sorted(range(m), key=tails.__getitem__), np.int64)
        left_shared = np.array([0, *(common_prefix(tails[a], tails[b]) for a, b in zip(order[:-1].tolist(), order[1:].tolist()))], np.int64)
        most = np.maximum(shared, np.append(shared[1:], 0))
        left_most = np.empty(m, np.int64)
        left_most[order] = np.maximum(left_shared, np.append(left_shared[1:], 0))
        span = LENGTH - GRAM
        marked = np.zeros((m, span + 2), bool)  # column span + s for start s; the last one stays empty
        low, high = -left, cut - LENGTH
        asked: list[tuple[np.ndarray, int]] = []
        for s in range(-span, 1):
            there = (low <= s) & (s <= high)
            able = there & (most >= s + LENGTH) & (left_most >= -s)
            at = np.flatnonzero(able)
            alone = there & (beyond >= s + LENGTH)
            if len(at) > 1:
                kind = np.cumsum(shared < s + LENGTH)[at] * (m + 1)
                of_left = np.empty(m, np.int64)
                of_left[order] = np.cumsum(left_shared < -s)
                kind += of_left[at]
                by = np.argsort(kind, kind="stable")
                same = kind[by[1:]] == kind[by[:-1]]
                marked[at[by[1:][same]], span + s] = True
                marked[at[by[:-1][same]], span + s] = True
                alone[at[by[1:][same]]] = False  # one of each kind asks in other ranges
            if alone.any():
                asked.append((np.flatnonzero(alone), s))
        whole = n > 1
        marked[whole] = False
        marked[whole] |= (np.arange(span + 2) - span >= low[whole][:, None]) & (np.arange(span + 2) - span <= high[whole][:, None])
        flat = np.zeros(m * (span + 2) + 1, np.int8)
        flat[1:] = marked.ravel()
        edge = np.diff(flat)
        starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) - 1
        owner, a, b = starts // (span + 2), starts % (span + 2) - span, ends % (span + 2) - span
        yield self._batch(owner, a, b, None)
        if asked:
            owner, s = np.concatenate([x for x, _ in asked]), np.concatenate([np.full(len(x), k) for x, k in asked])
            data = np.frombuffer(b"".join(t[::-1] + k[:c] for t, k, c in zip(tails, self.keys, self.cut)), np.uint8)
            at = (np.cumsum(lengths) - lengths + left)[owner] + s
            yield self._batch(owner, s, s, T.span_hashes(T.prefix_sums(data), at, at + LENGTH).view(np.int64))

    def _batch(self, owner, a, b, h) -> pa.RecordBatch:
        """A row for each place of an entry, or with h for one of them."""
        if h is None:
            times = np.array([len(self.places[o]) for o in owner.tolist()], np.int64)
            a, b, places = np.repeat(a, times), np.repeat(b, times), [p for o in owner.tolist() for p in self.places[o]]
        else:
            places = [self.places[o][0] for o in owner.tolist()]
        run, block, entry = np.array(places, np.int64).reshape(-1, 3).T
        return pa.RecordBatch.from_arrays([pa.array(run), pa.array(block.astype(np.int32)), pa.array(_mark(entry, a, b)), pa.nulls(len(places), pa.int64()) if h is None else pa.array(h)], names=["run", "block", "mark", "h"])


def _merged(batches, splitters: list[bytes]):
    """Merges the runs of each range and decides its entries."""
    by_range: dict[int, dict[int, list[dict]]] = {}
    for batch in batches:
        for row in batch.to_pylist():
            by_range.setdefault(row["range"], {}).setdefault(row["run"], []).append(row)
    for r, runs in by_range.items():
        below, above = splitters[r - 1] if r else b"", splitters[r] if r < len(splitters) else b""
        entries, chain = Entries(), None
        for shared, key, (cut, n, *place) in merge_runs([_run_of(p) for p in runs.values()]):
            chain = common_prefix(below, key) if chain is None else min(chain, shared)
            if shared < GRAM and len(entries.keys) >= BATCH:
                yield from entries.decided()
                entries = Entries()
            entries.add(shared, key, cut, n, tuple(place), max(chain, common_prefix(above, key)))
        yield from entries.decided()


def _strings(batches):
    """The bytes of strings asked for, from their blocks."""
    for batch in batches:
        rows = []
        for row in batch.to_pylist():
            keys = [k for _, k in front_decode(row["shared"], row["rest"])]
            for mark in row["asked"]:
                entry, s, _ = _unmarked(mark)
                key, cut = keys[entry], row["cut"][entry]
                rows.append(dict(string=key[cut : cut - s][::-1] + key[: s + LENGTH], run=row["run"], block=row["block"], mark=mark))
        yield _rows(rows, dict(string=pa.binary(), run=pa.int64(), block=pa.int32(), mark=pa.int64()))


def _placed(batches):
    """Marks of entries, brought to every occurrence of the entry."""
    for batch in batches:
        out = [[], [], []]
        for row in batch.to_pylist():
            marks: dict[int, list[tuple[int, int]]] = {}
            for mark in row["marks"]:
                entry, a, b = _unmarked(mark)
                marks.setdefault(entry, []).append((a, b))
            for e, doc, text_hash, g in zip(row["entry"], row["doc_id"], row["text_hash"], row["anchor"]):
                for a, b in marks.get(e, ()):
                    for o, v in zip(out, (doc, text_hash, g + a << 8 | b - a)):
                        o.append(v)
        yield pa.RecordBatch.from_arrays([pa.array(o, pa.int64()) for o in out], names=["doc_id", "text_hash", "span"])


def _remove(batches):
    open_ = zstandard.ZstdDecompressor()
    for batch in batches:
        out = []
        for packed, spans in zip(batch.column("packed").to_pylist(), batch.column("spans").to_pylist()):
            text = open_.decompress(packed)
            kept, at, n_spans, removed = [], 0, 0, 0
            reach = -1
            for span in sorted(spans or ()):
                a = span >> 8
                b = a + (span & 255) + LENGTH
                if a > reach:
                    n_spans += 1
                    kept.append(text[at:a])
                if b > at:
                    removed += b - max(a, at)
                    at = b
                reach = max(reach, b)
            kept.append(text[at:])
            out.append((len(text), removed, n_spans, b"".join(kept)))
        cols = list(zip(*out)) or [[]] * 4
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int64(), pa.binary())))], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])


def _with_digest(batches):
    for batch in _remove(batches):
        digest = pa.array([sha256(x).hexdigest() for x in batch.column("kept").to_pylist()], pa.string())
        yield pa.RecordBatch.from_arrays([*batch.columns[:4], digest], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def repeated_strings(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, spans: of texts that hold LENGTH-byte strings which also start elsewhere, runs of their starts, the first * 256 + their number - 1."""
    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_scan, "doc_id long, text_hash long, least long, first int, more short, ahead short")
    found = materialise(found, "stretches")
    # a table of its own, so that Spark can split the side of a string that occurs very often
    shared = materialise(found.groupBy("least").agg(F.count(F.lit(1)).alias("n_")).filter("n_ > 1").select("least"), "shared-anchors")
    # a stretch is one number from here on, which is much less to shuffle
    places = found.select("least", "doc_id", "text_hash", (F.shiftleft(F.col("first").cast("long"), 16) + F.shiftleft("more", 8) + F.col("ahead")).alias("place"))
    asked = places.join(shared, "least").groupBy(F.col("doc_id").alias("d_"), F.col("text_hash").alias("t_")).agg(F.collect_list("place").alias("asked"))
    # rows of one doc_id and text have one list between them, with all their occurrences in it
    held = packed(docs).dropDuplicates(["doc_id", "text_hash"]).join(asked, F.col("doc_id").eqNullSafe(F.col("d_")) & (F.col("text_hash") == F.col("t_"))).drop("d_", "t_")
    blocks = materialise(held.mapInArrow(_runs, BLOCKS), "suffix-runs", "zstd")
    release(found, shared)
    total, n_blocks = blocks.agg(F.coalesce(F.sum(F.size("cut")), F.lit(0)), F.count(F.lit(1))).first()
    ranges = max(1, min(SPLITTER_SAMPLE, total // RANGE))
    one_of = max(1, n_blocks // SPLITTER_SAMPLE)
    sample = sorted(bytes(r[0]) for r in blocks.filter(F.pmod(F.xxhash64("run", "block"), F.lit(one_of)) == 0).select("middle").limit(2 * SPLITTER_SAMPLE).collect()) if ranges > 1 else []
    splitters = sorted({sample[len(sample) * k // ranges] for k in range(1, ranges)}) if sample else []
    pieces = blocks.select("run", "block", "shared", "rest", "cut", "n").mapInArrow(lambda it: _pieces(it, splitters), PIECES)
    marks = materialise(pieces.repartitionById(len(splitters) + 1, F.col("range")).mapInArrow(lambda it: _merged(it, splitters), MARKS), "marks")
    asking = marks.filter("h is not null")
    twice = asking.groupBy("h").agg(F.count(F.lit(1)).alias("n_")).filter("n_ > 1").select("h")
    across = asking.join(materialise(twice, "hashes-across"), "h").groupBy("run", "block").agg(F.collect_list("mark").alias("asked"))
    strings = blocks.select("run", "block", "shared", "rest", "cut").join(across, ["run", "block"]).mapInArrow(_strings, "string binary, run bigint, block int, mark bigint")
    strings = materialise(strings, "strings-across", "zstd")
    again = materialise(strings.groupBy("string").agg(F.count(F.lit(1)).alias("n_")).filter("n_ > 1").select("string"), "repeats-across", "zstd")
    met = strings.join(again, "string").select("run", "block", "mark")
    every = marks.filter("h is null").drop("h").unionByName(met).groupBy("run", "block").agg(F.collect_list("mark").alias("marks"))
    spans = blocks.select("run", "block", "entry", "doc_id", "text_hash", "anchor").join(every, ["run", "block"]).mapInArrow(_placed, "doc_id long, text_hash long, span long")
    out = materialise(spans.groupBy("doc_id", "text_hash").agg(F.collect_list("span").alias("spans")), "spans")
    release(blocks, marks, strings, again)
    return out


def packed(docs: DataFrame) -> DataFrame:
    """doc_id (long), text_hash, packed: the texts' bytes, compressed."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_pack, "doc_id long, text_hash long, packed binary")


def remove_repeats(docs: DataFrame, digests: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (the remaining bytes; with digests their SHA-256 in hex): one row per row of docs.

    Of docs(doc_id integer, text): null text is empty. Texts below LENGTH bytes lose nothing. Rows that repeat are texts
    that repeat, so all of them lose what they share; rows of one doc_id are told apart by their text. A null doc_id is
    a doc_id. An empty table gives an empty table. Other columns are ignored. A doc_id that isn't an integer is an error.
    """
    kind = docs.schema["doc_id"].dataType
    if kind.typeName() not in ("byte", "short", "integer", "long", "void"):
        raise TypeError(f"doc_id must be an integer, not {kind.simpleString()}")
    spans = repeated_strings(docs).withColumnsRenamed({"doc_id": "d_", "text_hash": "t_"})
    rows = packed(docs).join(spans, F.col("doc_id").eqNullSafe(F.col("d_")) & (F.col("text_hash") == F.col("t_")), "left").select("doc_id", "packed", "spans")
    last = StructField("kept_sha256", StringType()) if digests else StructField("kept", BinaryType())
    schema = StructType([StructField("doc_id", LongType()), *(StructField(c, LongType()) for c in ("n_bytes", "n_removed", "n_spans")), last])
    return rows.mapInArrow(_with_digest if digests else _remove, schema).withColumn("doc_id", F.col("doc_id").cast(kind))


__all__ = ["front_code", "front_decode", "merge_runs", "remove_repeats", "stretches"]
