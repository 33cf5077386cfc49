import itertools
import random

from sparktree.llm import decontaminate as D


def brute(docs, items):
    out = {}
    cut = lambda t: [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", (t or "").lower()) if w]
    for (i, t), (j, b) in itertools.product(docs, items):
        t, b = cut(t), cut(b)
        if len(b) < D.MATCHED:
            continue
        best = 0
        for diagonal in range(-len(b), len(t)):
            equal = [0 <= diagonal + k < len(t) and t[diagonal + k] == w for k, w in enumerate(b)]
            best = max([best, *(sum(equal[k : k + D.STRETCH]) for k in range(len(b)))])
        if best >= D.MATCHED:
            out[i, j] = max(best, out.get((i, j), 0))
    return out


def ran(spark, docs, items, **how):
    d = spark.createDataFrame([(*r, 1) for r in docs], "doc_id long, text string, item_id int").repartition(3)
    b = spark.createDataFrame([(*r, 1) for r in items], "item_id long, text string, seed int")
    return {(r["doc_id"], r["item_id"]): r["matched"] for r in D.contaminated(d, b, **how).collect()}


def made():
    rnd = random.Random(8)
    pool = [f"v{k}" for k in range(60)]
    some = lambda n: [rnd.choice(pool) for _ in range(n)]
    items = [(k, some(rnd.randint(8, 40))) for k in range(10)]
    docs = []
    for k in range(60):
        t = some(rnd.randint(0, 50))
        if k % 2:
            part = list(rnd.choice(items)[1])
            a = rnd.randint(0, len(part) // 3)
            part = part[a : a + rnd.randint(9, 30)]
            for _ in range(rnd.randint(0, len(part) // 4)):
                part[rnd.randrange(len(part))] = "other"
            t[len(t) // 2 : len(t) // 2] = part
        docs.append((k, " ".join(t).title() if k % 3 else "  " + "\n".join(t)))
    return docs, [(k, " ".join(x)) for k, x in items]


def test_against_brute_force_both_ways(spark):
    docs, items = made()
    want = brute(docs, items)
    assert len(want) > 15
    assert ran(spark, docs, items) == want
    assert ran(spark, docs, items, few_seeds=0, few_items=0) == want


def test_masks_are_lossless():
    for wrong in itertools.combinations(range(D.STRETCH), D.STRETCH - D.MATCHED):
        assert any(all(s + o not in wrong for o in m) for m in D.MASKS for s in range(D.STRETCH - m[-1]))


def test_odd_rows(spark):
    item = " ".join(f"q{k}" for k in range(12))
    docs = [(1, None), (2, ""), (3, item), (3, item), (None, "x " + item.upper()), (4, item[:20]), (5, "z " * 30000 + item)]
    items = [(7, item), (7, item), (8, None), (9, ""), (None, item), (10, "too short an item")]
    assert ran(spark, docs, items) == {(i, j): 12 for i in (3, None, 5) for j in (7, None)}
    assert ran(spark, [], items) == {} and ran(spark, docs, []) == {}
    d = spark.createDataFrame(docs, "doc_id long, text string")
    assert sorted(r["doc_id"] for r in D.decontaminate(d, spark.createDataFrame(items, "item_id long, text string")).collect()) == [1, 2, 4]


def test_only_dataframe_functions(spark):
    docs, items = made()
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    plan = D.contaminated(d, b)._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
