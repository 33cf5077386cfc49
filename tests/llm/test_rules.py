import random
import re
from collections import Counter

from pyspark.sql import functions as F

from sparktree.llm.quality_rules import BIT, MEASURES, POLICIES, ablation, kept_by, ledger, mask_of


def brute(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    n = Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4))
    repeated = {k + j for k in range(len(w) - 4) if n[tuple(w[k : k + 5])] > 1 for j in range(5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    shouted = sum(bool(re.search("[A-Z]", x)) and not re.search("[a-z]", x) for x in w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeated), len(lines), shouted


TEXTS = ["", None, "a", "\n\n", " \t", "x y z\nx y z\n\nx y z", "é É " * 9, "A#b $c\r\nA#b $c", "one two three four five " * 30, "tail\n", "\nhead", "WHY! OH! WHY!", "w" * 100000, "a b\n" * 5000]


def test_measures(spark):
    rnd = random.Random(6)
    texts = TEXTS + ["".join(rnd.choice("ab\n #É") for _ in range(rnd.randint(0, 80))) for _ in range(200)]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumns({"n_words": F.lit("x"), "failed": F.lit(1)})
    got = {r["doc_id"]: tuple(r[m] for m in MEASURES) for r in ledger(d).collect()}
    for k, t in enumerate(texts):
        assert got[k] == brute(t), (k, (t or "")[:60])
    assert ledger(d.limit(0)).count() == 0
    assert ledger(spark.createDataFrame([(None, None), (1, "a"), (1, "a")], "doc_id long, text string")).count() == 3


def test_policies_and_ablation(spark):
    d = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    rows = ledger(d).persist()
    kept = {r["doc_id"]: r["k"] for r in rows.select("doc_id", kept_by("v1").alias("k")).collect()}
    bits = {r["doc_id"]: r["failed"] for r in rows.collect()}
    assert kept == {k: not v & mask_of("v1") for k, v in bits.items()}
    got = {r["rule"]: (r["n_failed"], r["n_only"], r["n_kept_without"]) for r in ablation(rows).collect()}
    for name in POLICIES["v1"]:
        b, m = BIT[name], mask_of("v1")
        assert got[name] == (sum(bool(v & b) for v in bits.values()), sum(v & m == b for v in bits.values()), sum(not v & m & ~b for v in bits.values()))
    assert set(got) == set(POLICIES["v1"])
    assert {r["n_failed"] for r in ablation(rows.limit(0)).collect()} == {0}
