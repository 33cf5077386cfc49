import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparktree.llm.importance import calibrated, resample, top_k_key
from sparktree.llm.toxicity import classify, train_chain


@pytest.fixture(scope="module")
def corpus():
    rnd = random.Random(11)
    pool = [f"{a}{b}{c}" for a in ("st", "br", "th", "on") for b in ("a", "e", "o") for c in ("n", "r", "ld", "ks", "m")]
    rows = []
    for k in range(1200):
        words = [rnd.choice(pool) for _ in range(rnd.randint(8, 80))]
        junk, toxic = rnd.random() < 0.2, rnd.random() < 0.2
        if toxic:
            words[rnd.randrange(len(words))] = rnd.choice(("vile", "filth", "loathsome"))
        if junk:
            words = [w.upper() + "!!" for w in words]
        rows.append((k, " ".join(words), int(not junk), int(toxic)))
    return rows


@pytest.fixture(scope="module")
def tables(spark, corpus):
    d = spark.createDataFrame([r[:2] for r in corpus], "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(r[0], *r[2:]) for r in corpus if r[0] % 2], "doc_id long, quality int, toxic int")
    return d, labels


def test_resampling_keeps_target_like_text(corpus, tables):
    got = {r["doc_id"]: r["kept"] for r in resample(*tables).collect()}
    held_out = [r for r in corpus if r[0] % 2 == 0]
    assert all(got[r[0]] for r in held_out if r[2])
    assert sum(got[r[0]] for r in held_out if not r[2]) <= 2


def test_k_largest_keys(tables):
    d, labels = tables
    rows = resample(d, labels, k=300).toPandas()
    want = set(rows.sort_values("gumbel_key", ascending=False)["doc_id"][:300])
    assert set(rows.loc[rows["kept"], "doc_id"]) == want
    assert resample(d, labels, k=0).filter("kept").isEmpty() and resample(d, labels, k=5000).filter("kept").count() == 1200


def test_without_k_as_many_are_sampled_as_are_expected(tables):
    rows = resample(*tables).toPandas()
    expected = (1 / (1 + np.exp(-rows["log_odds"]))).sum()
    assert abs(rows["kept"].sum() - expected) <= 0.51
    assert set(rows.sort_values("gumbel_key", ascending=False).index[: rows["kept"].sum()]) == set(rows.index[rows["kept"]])


def test_samples_follow_the_weights(spark):
    # ten kinds of one-word text, half of whose copies are labelled in proportions 1 to 10 of 11: odds and so samples follow
    texts = [(k, f"kind{k % 10}") for k in range(20_000)]
    labels = spark.createDataFrame([(k, int((k // 20) % 11 <= k % 10)) for k, _ in texts if (k // 10) % 2], "doc_id long, quality int")
    rows = resample(spark.createDataFrame(texts, "doc_id long, text string"), labels).toPandas()
    share = rows.groupby("text")["kept"].mean().to_numpy()
    assert (np.diff(share) > 0).all() and 0.02 < share[0] < 0.3 and 0.7 < share[-1] < 0.99


def test_calibration():
    rnd = np.random.default_rng(2)
    x = rnd.normal(0, 0.1, 20_000)
    y = rnd.random(20_000) < 1 / (1 + np.exp(-(30 * x - 1)))
    a, b = calibrated(x, y.astype(float))
    assert abs(a - 30) < 2 and abs(b + 1) < 0.1
    a, b = calibrated(np.array([-2.0, -1, 1, 2]), np.array([0.0, 0, 1, 1]))
    assert np.isfinite([a, b]).all() and -a + b < -3 < 3 < a + b


def test_top_k_by_histograms(spark):
    d = spark.range(5000).select((F.pmod(F.xxhash64("id"), F.lit(1000)) / 7).alias("key"))
    keys = sorted((r["key"] for r in d.collect()), reverse=True)
    for k in (1, 17, 2500, 5000):
        assert top_k_key(d, "key", k, enough=50) == keys[k - 1]
    assert top_k_key(d, "key", 5001) is None and top_k_key(d.limit(0), "key", 1) is None


def test_resampling_odd_rows(spark, tables):
    d, labels = tables
    odd = spark.createDataFrame([(None, "text"), (-1, None), (-2, ""), (-2, ""), (-3, "word " * 60000)], "doc_id long, text string")
    rows = resample(d.unionByName(odd).withColumn("kept", F.lit("x")), labels).filter("doc_id < 0 or doc_id is null").collect()
    assert len(rows) == 5 and all(r["kept"] is not None for r in rows) and {r["n_grams"] for r in rows if r["doc_id"] in (-1, -2)} == {0}
    assert resample(d.limit(0), labels).count() == 0
    assert resample(odd, labels.limit(0)).filter("kept").count() == 5
    nulls = spark.createDataFrame([(None, 1, 0), (1, None, None)], "doc_id long, quality int, toxic int")
    assert resample(odd, nulls).count() == 5


def test_chain_on_held_out_documents(corpus, tables):
    d, labels = tables
    chain = train_chain(d, labels.withColumn("junk", 1 - F.col("quality")), ["junk", "toxic"])
    got = {r["doc_id"]: (r["is_junk"], r["is_toxic"]) for r in classify(d, chain).collect()}
    held_out = [r for r in corpus if r[0] % 2 == 0]
    toxic = [got[r[0]][1] for r in held_out if r[3]]
    clean = [got[r[0]][1] for r in held_out if not r[3]]
    assert sum(toxic) >= 0.95 * len(toxic) and sum(clean) <= 0.02 * len(clean)
    assert len(chain.models[1].earlier) == 1 and len(chain.models[0].earlier) == 0


def test_chain_odd_rows(spark, tables):
    d, labels = tables
    odd = spark.createDataFrame([(None, "vile"), (-1, None), (-2, ""), (-2, ""), (-3, "vile " * 60000)], "doc_id long, text string")
    rows = classify(odd.withColumn("p_toxic", F.lit("x")), train_chain(d, labels, ["toxic"])).collect()
    assert len(rows) == 5 and {r["doc_id"]: r["is_toxic"] for r in rows}[-3]
    none = train_chain(d, labels.limit(0), ["toxic"])
    assert classify(odd, none).filter("is_toxic").isEmpty() and classify(odd.limit(0), none).count() == 0
