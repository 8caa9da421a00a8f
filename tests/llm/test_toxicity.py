import random

import numpy as np
from cases import SMALL
from pyspark.sql import functions as F

from varigrove.llm import queries, toxicity
from varigrove.llm.common import table

NORMAL = "river stone table lamp window garden paper letter bread winter summer road".split()
RUDE = "grumbling snarlish vexful".split()


def made(n, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        rude, short = rng.random() < 0.3, rng.random() < 0.3
        ws = [rng.choice(NORMAL) for _ in range(30)] + ["zz"] * (short and rng.random() < 0.95)
        ws += [rng.choice(RUDE) + rng.choice(["", "a", "er"]) for _ in range(2)] if rude else []
        rng.shuffle(ws)
        rows.append((i, " ".join(ws), int(short), int(rude)))
    return rows


def test_held_out(spark):
    df = spark.createDataFrame(made(900), "doc_id long, text string, low_quality int, toxic int")
    docs, labels = df.select("doc_id", "text"), df.drop("text")
    chain = toxicity.train(docs, labels.where("doc_id < 600"), ["low_quality", "toxic"])
    scored, names = toxicity.score(docs.where("doc_id >= 600").join(labels, "doc_id"), chain)
    assert names == ["p_low_quality", "p_toxic"]
    rows = scored.collect()
    assert np.mean([(r.p_toxic >= chain.limits[1]) == bool(r.toxic) for r in rows]) > 0.97
    assert np.mean([(r.p_low_quality >= chain.limits[0]) == bool(r.low_quality) for r in rows]) > 0.9


def test_later_models_use_earlier_ones():
    """The second category is the first one plus noise, and no feature tells it."""
    rng = np.random.default_rng(2)
    first = rng.random(2000) < 0.5
    second = np.where(rng.random(2000) < 0.95, first, ~first)
    rows = [[int(not f)] for f in first]
    models, limits = toxicity.fit_chain(rows, np.column_stack((first, second)).astype(float), np.arange(2000) % 3, 2)
    assert models[1].of_earlier[0] > 0.5 and 0.1 <= min(limits) <= max(limits) <= 0.9
    ids, owner = np.array([r[0] for r in rows]), np.arange(2000)
    found = toxicity.chained(models, ids, owner, 2000)
    assert ((found[:, 1] > 0.5) == first).mean() > 0.99


def test_probabilities_match_the_plain_sum(spark):
    df = spark.createDataFrame(made(200), "doc_id long, text string, low_quality int, toxic int")
    chain = toxicity.train(df.select("doc_id", "text"), df.drop("text"), ["low_quality", "toxic"])
    for text in [made(1, 5)[0][1], "", None, "grumblinger zz"]:
        found = {chain.index[f] for f in toxicity.features(text) if f in chain.index}
        told = []
        for m in chain.models:
            told.append(1 / (1 + np.exp(-(m.bias + sum(m.of_feature[i] for i in found) + np.dot(told, m.of_earlier)))))
        assert np.allclose(chain.probabilities([text])[0], told)


def test_query(spark):
    got = {r.doc_id: r.toxic for r in queries.op10_toxicity(spark, SMALL).collect()}
    labels = table(spark, SMALL, "labels").collect()
    assert len(got) == table(spark, SMALL, "documents").count()
    assert np.mean([got[r.doc_id] == bool(r.toxic) for r in labels]) > 0.9


def test_rejecting(spark):
    df = spark.createDataFrame(made(600), "doc_id long, text string, low_quality int, toxic int")
    docs = df.select("doc_id", "text", F.lit("x").alias("p_toxic"))
    kept = toxicity.without_toxic(docs, df.drop("text"), ["low_quality", "toxic"], "toxic")
    assert kept.columns == docs.columns
    left = {r.doc_id for r in kept.collect()}
    assert np.mean([(r.doc_id in left) == (r.toxic == 0) for r in df.collect()]) > 0.97


def test_an_id_of_many_rows_counts_once(spark):
    rows = made(60)
    df = spark.createDataFrame(rows, "doc_id long, text string, low_quality int, toxic int")
    docs, labels = df.select("doc_id", "text"), df.drop("text")
    more = docs.unionByName(docs.where("doc_id = 7").crossJoin(spark.range(500)).select("doc_id", "text"))
    one, many = (toxicity.train(d, labels, ["low_quality", "toxic"], sample_rows=1000) for d in (docs, more))
    assert one.index == many.index and one.limits == many.limits
    assert all(np.array_equal(a.of_feature, b.of_feature) and a.bias == b.bias for a, b in zip(one.models, many.models))


def test_odd_rows(odd, none, spark):
    labels = spark.createDataFrame(
        [(1, 0, 1), (3, 1, 0), (3, 0, 0), (5, 0, 1), (7, 0, 0), (None, 1, 1), (8, None, 1), (99, 1, 1)], "doc_id long, low_quality int, toxic int"
    )
    for marks in (labels, labels.where("false"), labels.where("toxic = 0")):
        chain = toxicity.train(odd, marks, ["low_quality", "toxic"])
        scored, names = toxicity.score(odd, chain)
        assert names == ["p_low_quality", "_p_toxic"] and scored.count() == odd.count()
        assert all(0 <= r._p_toxic <= 1 for r in scored.collect())
        assert toxicity.score(none, chain)[0].collect() == []
    assert toxicity.without_toxic(odd, labels.where("false"), ["low_quality", "toxic"], "toxic").count() == odd.count()
