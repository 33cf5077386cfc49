import random
from collections import Counter
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pytest

from sparktree.llm import suffixes as S
from sparktree.llm import textkit as T

L = S.LENGTH


def brute(rows):
    texts = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(b[p : p + L] for _, b in texts for p in range(len(b) - L + 1))
    out = []
    for i, b in texts:
        gone, spans = np.zeros(len(b), bool), 0
        for p in range(len(b) - L + 1):
            if seen[b[p : p + L]] > 1:
                gone[p : p + L] = True
        spans = int(np.diff(np.concatenate([[0], gone.astype(int)])).clip(0).sum())
        out.append((i, len(b), int(gone.sum()), spans, sha256(bytes(np.frombuffer(b, np.uint8)[~gone])).hexdigest()))
    return out


def ran(spark, rows):
    d = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, spans int").repartition(5)
    return [tuple(r) for r in S.remove_repeats(d, digests=True).collect()]


def same(a, b):
    assert sorted(a, key=repr) == sorted(b, key=repr)


@pytest.fixture(scope="module")
def corpus():
    rnd = random.Random(5)
    pool = ["".join(rnd.choice("abcdefghé") for _ in range(rnd.randint(1, 6))) for _ in range(300)]
    words = lambda n: " ".join(rnd.choice(pool) for _ in range(n))
    passages = [words(rnd.randint(30, 120)) for _ in range(8)]
    rows = []
    for k in range(150):
        parts = [words(rnd.randint(0, 60))]
        for _ in range(rnd.randint(0, 3)):
            p = rnd.choice(passages)
            a = rnd.randint(0, len(p) // 2)
            q = p[a : rnd.randint(a, len(p))]
            if q and rnd.random() < 0.4:
                at = rnd.randrange(len(q))
                q = q[:at] + "X" + q[at + 1 :]
            parts += [q, words(rnd.randint(0, 40))]
        rows.append((k, "".join(parts)))
    return rows


def test_against_brute_force(spark, corpus):
    same(ran(spark, corpus), brute(corpus))


@pytest.fixture(scope="module")
def hot():
    """Passages that all texts hold, as long as a string or shorter, with few and with many contexts."""
    rnd = random.Random(8)
    words = lambda n: " ".join("".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(2, 7))) for _ in range(n))
    long, short, near = words(70), words(20), words(60)
    ends = [words(3) for _ in range(4)]
    rows = []
    for k in range(120):
        at = rnd.randrange(len(near))
        edited = near[:at] + "#" + near[at + 1 :] if k % 3 else near
        rows.append((k, words(5) + rnd.choice(ends) + long + rnd.choice(ends) + words(5) + short + words(4) + edited + words(2)))
    return rows


@pytest.mark.parametrize("sizes", [(1024, 20_000, 40_000), (4, 20, 10), (3, 7, 1), (1, 3, 1000)])
def test_hot_passages_over_ranges_of_any_size(spark, hot, corpus, sizes, monkeypatch):
    # the kernels read these sizes where they run, so blocks and batches are checked on their own below
    monkeypatch.setattr(S, "RANGE", sizes[1])
    same(ran(spark, hot), brute(hot))
    if sizes[1] == 20:
        same(ran(spark, corpus), brute(corpus))


def test_blocks_pieces_and_batches_of_any_size(hot, monkeypatch):
    from types import SimpleNamespace

    import zstandard

    texts = [t.encode() for _, t in hot[:40]]
    want = Counter(b[p : p + L] for b in texts for p in range(len(b) - L + 1))
    want = {(i, p) for i, b in enumerate(texts) for p in range(len(b) - L + 1) if want[b[p : p + L]] > 1}
    data = next(T.chunks(pa.array(texts, pa.binary()), 1 << 30))
    doc, first, last, anchor, _ = S.stretches(data)
    asked = [[int(a) << 16 | int(b - a) << 8 | int(g - b) for d, a, b, g in zip(doc, first, last, anchor) if d == i] for i in range(len(texts))]
    kind = pa.list_(pa.int64())
    pack = zstandard.ZstdCompressor(write_content_size=True).compress
    batch = lambda at: pa.RecordBatch.from_arrays([pa.array(at), pa.array([0] * len(at)), pa.array([pack(texts[i]) for i in at]), pa.array([asked[i] for i in at], kind)], names=["doc_id", "text_hash", "packed", "asked"])
    for block, size, run_bytes, cuts in ((1024, 10**6, 1 << 30, 0), (5, 1, 9000, 0), (3, 40, 30_000, 9), (1, 1, 1 << 30, 40)):
        monkeypatch.setattr(S, "BLOCK", block)
        monkeypatch.setattr(S, "BATCH", size)
        monkeypatch.setattr(S, "RUN_BYTES", run_bytes)
        blocks = []
        for task in range(3):
            monkeypatch.setattr(S, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: task)))
            blocks += [r for b in S._runs([batch(list(range(task, len(texts), 3)))]) for r in b.to_pylist()]
        keys = sorted(k for r in blocks for _, k in S.front_decode(r["shared"], r["rest"]))
        splitters = sorted({keys[len(keys) * k // (cuts + 1)] for k in range(1, cuts + 1)})
        pieces = [r for r in blocks for r in next(S._pieces([S._rows([r], S.BLOCK_TYPES)], splitters)).to_pylist()]
        assert sorted(k for r in pieces for _, k in S.front_decode(r["shared"], r["rest"])) == keys
        marks = [x for b in S._merged([S._rows(pieces, S.PIECE_TYPES)], splitters) for x in b.to_pylist()]
        by = {(r["run"], r["block"]): r for r in blocks}
        met: dict[bytes, list] = {}
        for x in [x for x in marks if x["h"] is not None]:
            row = S._strings([pa.RecordBatch.from_pylist([{**by[x["run"], x["block"]], "asked": [x["mark"]]}])])
            for y in next(row).to_pylist():
                met.setdefault(y["string"], []).append(x)
        marks = [x for x in marks if x["h"] is None] + [x for v in met.values() if len(v) > 1 for x in v]
        got = set()
        for x in marks:
            r, (entry, low, high) = by[x["run"], x["block"]], S._unmarked(x["mark"])
            for e, i, g in zip(r["entry"], r["doc_id"], r["anchor"]):
                if e == entry:
                    got |= {(i, p) for p in range(g + low, g + high + 1)}
        assert got == want, (block, size, run_bytes, cuts, len(got), len(want))


def test_an_integer_is_asked_for(spark):
    with pytest.raises(TypeError, match="integer"):
        S.remove_repeats(spark.createDataFrame([("a", "x")], "doc_id string, text string"))


def test_odd_rows(spark, corpus):
    t = corpus[3][1] + "tail" * 60
    rows = [(1, "ab" * 500), (2, "x" * 1000), (3, "x" * 199), (4, None), (5, ""), (6, t), (7, t), (8, t), (8, t[5:]), (None, t), (None, "q" + t), (9, "x" * 200), (10, "abc" * 70 + "-" * 10 + "abc" * 70), (11, "é" * 100 + "ü" * 3), (12, "é" * 100)]
    same(ran(spark, rows), brute(rows))
    assert ran(spark, []) == []


def test_front_coding_and_merging():
    rnd = random.Random(2)
    runs = [sorted(bytes(rnd.choice(b"ab") for _ in range(rnd.randint(0, 30))) for _ in range(n)) for n in (0, 1, 40, 13, 200)]
    coded = [S.front_code(r) for r in runs]
    assert [[s for _, s in S.front_decode(*c)] for c in coded] == runs
    merged = list(S.merge_runs([((k, s, n) for k, s in S.front_decode(*c)) for n, c in enumerate(coded)]))
    assert [s for _, s, _ in merged] == sorted(s for r in runs for s in r)
    before = b""
    for k, s, _ in merged:
        assert k == S.common_prefix(before, s) == next((i for i, (a, b) in enumerate(zip(before, s)) if a != b), min(len(before), len(s)))
        before = s


def test_stretches_cover_every_string():
    rnd = random.Random(4)
    texts = ["".join(rnd.choice("ab c") for _ in range(n)) for n in (0, 199, 200, 201, 1500, 0, 700)]
    for t in T.chunks(pa.array(texts), 10_000):
        doc, first, last, anchor, _ = S.stretches(t)
        assert (anchor >= last).all() and (anchor + S.GRAM <= first + L).all()
        for d, text in enumerate(texts):
            held = sorted(p for k in np.flatnonzero(doc == d) for p in range(first[k], last[k] + 1))
            assert held == list(range(max(0, len(text) - L + 1)))
