from pyspark.sql import functions as F

import corpus_pipeline as P
from sparktree.llm.queries import ORACLES, queries


def test_stages_follow_each_other(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    ids = {r[0] for r in docs.select("doc_id").collect()}
    for name, stage in P.STAGES:
        docs = P.materialise(stage(spark, docs, sf), "test-stage")
        now = {r[0] for r in docs.select("doc_id").distinct().collect()}
        assert now and now <= ids, name
        ids = now
        assert tuple(docs.columns[:5]) == P.COLUMNS
        if name == "line dedup":
            assert docs.filter(F.col("n_chars") != F.char_length("text")).count() == 0
    assert docs.columns == [*P.COLUMNS, "copy"]
    assert P.run(spark, sf).count() == docs.count()


def test_each_stage_against_brute_force(spark, sf):
    """On 300 documents: what each stage does to its own input, which for all but the classifier plain Python can say."""
    import test_decontamination
    import test_lines
    import test_mixing
    import test_near

    docs = spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").limit(300)
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    good = {r[0] for r in spark.read.parquet(f"{sf}/labels.parquet").filter("quality = 1").select("doc_id").collect()}
    for name, stage in P.STAGES:
        before = [(r["doc_id"], r["text"]) for r in docs.collect()]
        sources = {r["doc_id"]: r["source"] for r in docs.collect()}
        docs = P.materialise(stage(spark, docs, sf), "test-stage")
        after = sorted((r["doc_id"], r["text"]) for r in docs.collect())
        if name == "quality classifier":
            assert set(after) <= set(before) and good & dict(before).keys() <= dict(after).keys()
        elif name == "line dedup":
            assert after == sorted((i, text) for i, _, _, text in test_lines.brute(before))
        elif name == "near-duplicates":
            classes = test_near.brute(before)
            assert after == sorted((i, t) for i, t in before if classes[i] == i)
        elif name == "decontamination":
            leaks = {i for i, _ in test_decontamination.brute([(i, t) for i, t in before if any(w in t for w in ("a", "e"))], items)}
            assert after == sorted((i, t) for i, t in before if i not in leaks)
        else:
            sizes: dict = {}
            for i, t in before:
                sizes[sources[i]] = sizes.get(sources[i], 0) + len(t.split())
            target, largest, taken = test_mixing.level_targets(sizes), max(len(t.split()) for _, t in before), {}
            for i, t in after:
                taken[sources[i]] = taken.get(sources[i], 0) + len(t.split())
            assert all(abs(taken.get(s, 0) - x) <= largest / 2 + 1e-6 for s, x in target.items())
            assert set(after) <= set(before) and max(sum(x == y for y in after) for x in set(after)) <= 2


def test_stages_on_nothing_and_on_odd_rows(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(30)
    odd = spark.createDataFrame([(None, None, None, None, None), (-1, "", None, None, 0), (-1, "", None, None, 0), (-2, "some words of a text", "en", None, 20)], docs.schema)
    for some in (docs.limit(0), docs.unionByName(odd)):
        for _, stage in P.STAGES:
            some = P.materialise(stage(spark, some.withColumn("kept", F.lit(1)), sf), "test-stage")
            some.count()


def test_one_query_for_each_operator():
    names = list(queries())
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 11))
    assert set(ORACLES) <= set(names)
