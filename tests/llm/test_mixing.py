import pytest
from pyspark.sql import functions as F

from sparktree.llm.mixing import mix_sources, mixed_documents, source_targets

SCHEMA = "doc_id long, text string, source string, size int"


def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def words(n):
    return " ".join(f"w{k}" for k in range(n)) if n is not None else None


def level_targets(sizes, weights=(3.0, 1.0, 2.0), share=1.5, most=2.0):
    """Water filling by steps: cap whoever is above, share the excess among the others."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    w = {s: weights[k % 3] for k, s in enumerate(names)}
    budget, target, free = share * sum(sizes.values()), {}, set(names)
    while free:
        level = budget / sum(w[s] for s in free)
        over = {s for s in free if w[s] * level > most * sizes[s]}
        for s in over or free:
            target[s] = most * sizes[s] if over else w[s] * level
        budget -= sum(target[s] for s in over)
        if not over:
            break
        free -= over
    return target


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 1000, "c": 500}, {"a": 100, "b": 100, "c": 100, "d": 5, "e": 900, None: 40}, {"only": 12}, {"é": 10, "z": 20, "Z": 30}])
def test_targets(spark, sizes):
    rows = spark.createDataFrame([(k, v) for k, v in sizes.items()], "source string, size long")
    got = {r["source"]: r["target"] for r in source_targets(rows).collect()}
    assert got == pytest.approx(level_targets(sizes))


def test_sums_meet_targets_and_reruns_agree(spark):
    rows = [(k, words(1 + k * 7 % 53), f"s{k % 4}" if k % 9 else None, 0) for k in range(1200)]
    d = docs(spark, rows)
    got = mix_sources(d).toPandas()
    assert len(got) == 1200 and (got["taken"] <= 2 * got["size"]).all() and (got["taken"] == got["size"] * got["copies"]).all()
    by = got.groupby("source", dropna=False).agg(target=("target", "first"), taken=("taken", "sum"), size=("size", "sum"), total=("source_size", "first"))
    assert (by["size"] == by["total"]).all()
    assert ((by["taken"] - by["target"]).abs() <= 53 / 2 + 1e-6).all()
    again = mix_sources(d.repartition(7)).toPandas()
    assert sorted(map(tuple, got.astype(str).values)) == sorted(map(tuple, again.astype(str).values))


def test_expectation_is_the_fraction(spark):
    # weights 3, 1, 2 share 1.5 times 900 x 10 words: a stops at 2 copies, b and c share the rest
    d = docs(spark, [(k, words(10), "abc"[k % 3], 0) for k in range(900)])
    assert {r["source"]: r["target"] / r["source_size"] for r in source_targets(mix_sources(d)).collect()} == pytest.approx({"a": 2.0, "b": 5 / 6, "c": 5 / 3})
    runs = [mix_sources(d, seed=s).select("doc_id", "source", "copies").toPandas() for s in range(6)]
    for got in runs:
        assert got.groupby("source")["copies"].mean().to_dict() == pytest.approx({"a": 2.0, "b": 5 / 6, "c": 5 / 3}, abs=0.004)
    taken = sum(r[r["source"] == "b"].set_index("doc_id")["copies"].sort_index() for r in runs)
    # six coins for each document, not the same documents each time
    assert abs((taken == 6).mean() - (5 / 6) ** 6) < 0.1 and abs((taken == 5).mean() - (5 / 6) ** 5) < 0.1


def test_fractions_of_documents_of_any_size(spark):
    d = docs(spark, [(k, words(1 + k % 29), "ab"[k % 2], 0) for k in range(800)])
    seen = sum(mix_sources(d, share=0.8, seed=s).select("doc_id", "copies").toPandas().set_index("doc_id")["copies"].sort_index() for s in range(8)) / 8
    target = {r["source"]: r["target"] / r["source_size"] for r in mix_sources(d, share=0.8).select("source", "target", "source_size").distinct().collect()}
    assert any(0.05 < x % 1 < 0.95 for x in target.values())
    for k, x in enumerate(target[s] for s in "ab"):
        part = seen[seen.index % 2 == k]
        for size in (part[part.index % 29 < 10], part[part.index % 29 >= 10]):
            assert abs(size.mean() - x) < 0.06


def test_odd_rows(spark):
    rows = [(1, None, "a", 1), (2, "", "a", 2), (3, " \t\n", None, 3), (None, "x y", None, 4), (5, "x y", "a", 5), (5, "x y", "a", 5), (6, "é ö", "a", 6)]
    got = mix_sources(docs(spark, rows)).toPandas()
    assert len(got) == 7
    assert got.loc[got["doc_id"].isin([1, 2, 3]), ["size", "copies", "taken"]].eq(0).all().all()
    assert got.loc[got["doc_id"] == 6, "size"].tolist() == [1]
    assert mix_sources(docs(spark, [])).count() == 0
    assert mix_sources(docs(spark, [(1, None, "a", 1)])).collect()[0]["taken"] == 0


def test_mixed_documents(spark):
    d = docs(spark, [(k, words(5), "a" if k % 2 else "b", k) for k in range(40)])
    plan = {r["doc_id"]: r["copies"] for r in mix_sources(d).collect()}
    got = mixed_documents(d).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.max("copy").alias("last")).collect()
    assert {r["doc_id"]: r["n"] for r in got} == {k: v for k, v in plan.items() if v}
    assert all(r["last"] == r["n"] - 1 for r in got)


def test_rows_of_one_doc_id_are_mixed_as_planned(spark):
    rows = [(k // 7, words(1 + k % 11), "abc"[k % 3], k) for k in range(300)] + [(None, words(4), "a", 0)] * 20
    d = docs(spark, rows).withColumns({"id_": F.lit(1), "copies_": F.lit(2), "hash": F.lit(3), "again": F.lit(4), "row": F.lit(5), "name": F.lit(6), "copies": F.lit(7), "key": F.lit(8)})
    plan, got = mix_sources(d).toPandas(), mixed_documents(d)
    assert got.columns == [*d.columns, "copy"]
    got = got.withColumn("n", F.size(F.split("text", " "))).toPandas()
    assert len(got) == plan["copies"].sum() and (got["hash"] == 3).all() and (got["id_"] == 1).all()
    want = plan[plan["copies"] > 0].groupby(["doc_id", "source", "size"], dropna=False)["copies"].sum().sort_index()
    assert want.tolist() == got.groupby(["doc_id", "source", "n"], dropna=False).size().sort_index().tolist()
