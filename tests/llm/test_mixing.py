import math
from collections import Counter

import numpy as np
import pytest
from cases import SMALL
from pyspark.sql import functions as F

from varigrove.llm import mixing, queries
from varigrove.llm.common import table


def brute_targets(sizes, weights=(3, 1, 2), share=1.5, most=2):
    """Targets by resharing the excess until none is left."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[n % len(weights)] for n, s in enumerate(names)}
    full, held = {}, share * sum(sizes.values())
    while True:
        left = [s for s in names if s not in full]
        rest = held - sum(full.values())
        over = [s for s in left if rest * w[s] / sum(w[x] for x in left) > most * sizes[s]]
        if not over:
            return full | {s: rest * w[s] / sum(w[x] for x in left) for s in left}
        full |= {s: most * sizes[s] for s in over}


def test_targets(spark):
    rng = np.random.default_rng(5)
    for _ in range(4):
        sizes = {f"s{n}é"[: rng.integers(2, 4)] + str(n): int(rng.integers(0, 1000) ** 2) for n in range(9)} | {None: 50}
        df = spark.createDataFrame([(s, k) for s, k in sizes.items()], "source string, size long")
        got = {r.source: r.target for r in mixing.targets(df).collect()}
        want = brute_targets(sizes)
        assert got.keys() == want.keys()
        for s in want:
            assert math.isclose(got[s], want[s], rel_tol=1e-9, abs_tol=1e-6)


def test_query(spark):
    got = queries.op7_source_mix(spark, SMALL).toPandas()
    docs = table(spark, SMALL, "documents").select("doc_id", "text", "source").toPandas().set_index("doc_id")
    assert sorted(got.doc_id) == sorted(docs.index)
    import re

    sizes = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t)) for i, t in docs.text.items()}
    assert dict(zip(got.doc_id, got["size"])) == sizes
    totals = Counter()
    for i, s in docs.source.items():
        totals[s] += sizes[i]
    want = brute_targets(dict(totals))
    got["source"] = docs.source.loc[got.doc_id].to_numpy()
    assert all(got.taken % got["size"].clip(lower=1) == 0) and all(got.taken <= 2 * got["size"])
    for s, part in got.groupby("source"):
        assert set(part.source_size) == {totals[s]} and math.isclose(part.target.iloc[0], want[s], rel_tol=1e-9)
        assert abs(part.taken.sum() - want[s]) <= max(part["size"]) / 2
    again = queries.op7_source_mix(spark, SMALL).toPandas().sort_values("doc_id")
    got = got.sort_values("doc_id")
    assert again.taken.tolist() == got.taken.tolist() and list(map(list, again.shards)) == list(map(list, got.shards))
    assert all(len(to) * size == taken for to, size, taken in zip(got.shards, got["size"], got.taken))
    dealt = {s for to in got.shards for s in to}
    assert len(dealt) > 1 and dealt <= set(range(mixing.LEAST_SHARDS))


def test_hypergeometric(spark):
    """Frequencies of draws against the distribution."""
    good, bad, draws, n = 12, 30, 15, 20_000
    df = spark.range(n).select(
        mixing.hypergeometric(F.lit(good).cast("long"), F.lit(bad).cast("long"), F.lit(draws).cast("long"), mixing._chance(F.col("id"))).alias("x")
    )
    seen = {r.x: r["count"] for r in df.groupBy("x").count().collect()}
    total = math.comb(good + bad, draws)
    for x in range(good + 1):
        p = math.comb(good, x) * math.comb(bad, draws - x) / total
        assert abs(seen.get(x, 0) - n * p) <= 5 * math.sqrt(n * p * (1 - p)) + 1
    edge = spark.range(1).select(*[mixing.hypergeometric(*[F.lit(v).cast("long") for v in k], F.lit(0.3)).alias(f"c{i}") for i, k in enumerate([(0, 5, 3), (5, 0, 3), (5, 5, 0), (5, 5, 10), (0, 0, 0), (10**6, 10**6, 10**6)])]).first()
    assert tuple(edge)[:5] == (0, 3, 0, 5, 0) and abs(edge.c5 - 500_000) < 5_000


@pytest.mark.parametrize("shards", [1, 2, 8, 128])
def test_quotas_add_up(spark, shards):
    own = {"a": 100, "b": 7, "c": 0, None: 30}
    df = spark.createDataFrame(list(own.items()), "source string, quota long")
    got = mixing.split_quotas(df, shards).toPandas()
    per_shard = got.groupby("shard").quota.sum()
    assert per_shard.max() - (per_shard.min() if len(per_shard) == shards else 0) <= 1
    for s, k in own.items():
        assert got[got.source.isna() if s is None else got.source == s].quota.sum() == k


def test_mix_repeats_what_is_drawn(spark):
    docs = table(spark, SMALL, "documents")
    drawn, (_, _, _, to), _ = mixing.draw(docs, shards=4, block_words=500)
    want = Counter({r.doc_id: r[to] and len(r[to]) for r in drawn.collect()})
    mixed = mixing.mix(docs, shards=4, block_words=500)
    assert mixed.schema == docs.schema
    got = Counter(r.doc_id for r in mixed.collect())
    assert got == Counter({k: v for k, v in want.items() if v})


@pytest.mark.parametrize("seed", range(2))
def test_long_documents_leave_no_gap(spark, seed):
    """One document is half of its source; small rows of other blocks fill what it leaves open."""
    rows = [(0, "w " * 100_000, "a"), *((n, "w " * (2 + n % 9), "a") for n in range(1, 17_000)), (17_000, "w " * 90_000, "b")]
    rows += [(20_000 + n, "w " * 50, None) for n in range(1000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(8)
    drawn, names, _ = mixing.draw(docs, keep=["doc_id", "source"], shards=4, block_words=5_000, share=0.9, seed=seed)
    got = drawn.selectExpr("*", f"size * size({names[3]}) as taken").toPandas()
    assert len(got) == len(rows) and all((got.taken / got["size"]).between(0, 2))
    for s, least in (("a", 2), (None, 50)):
        part = got[got.source.isna() if s is None else got.source == s]
        assert abs(part.taken.sum() - part.target.iloc[0]) <= least / 2 + 1e-6


def test_odd_rows(odd, none):
    drawn, names, _ = mixing.draw(odd)
    rows = drawn.collect()
    assert len(rows) == odd.count() and names == ["_size", "source_size", "target", "_shards"]
    assert all(len(r._shards) <= 2 for r in rows)
    assert {r.doc_id: r._size for r in rows}[7] == 30_000
    mixed = mixing.mix(odd)
    assert mixed.columns == odd.columns and mixed.count() == sum(len(r._shards) for r in rows)
    assert mixing.draw(none)[0].collect() == [] and mixing.mix(none).collect() == []


def test_native_plan(odd):
    plan = mixing.mix(odd)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
