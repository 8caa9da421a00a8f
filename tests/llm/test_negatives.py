import itertools
import math
import random

import numpy as np
import pytest
from cases import SMALL
from pyspark.sql import functions as F

from varigrove.llm import negatives, queries
from varigrove.llm.common import table

SCHEMA = "vec_id long, label int, embedding array<float>"


def brute(rows, every, positives=5, found=5):
    """Sorted rows of the result, comparing every anchor with every row."""
    clean = [
        (d, lab, [math.floor(256 * float(x)) for x in v])
        for d, lab, v in rows
        if lab is not None and v and all(x is not None and math.isfinite(x) for x in v)
    ]
    order = lambda s: (-s[0], s[1] is None, s[1] or 0)
    out = []
    for d, lab, v in clean:
        if d is None or d % every:
            continue
        scores = [(sum(a * b for a, b in zip(v, w)), e, m) for e, m, w in clean if len(w) == len(v)]
        mine = sorted((s for s in scores if s[2] == lab and s[1] != d), key=order)[:positives]
        for ps, pid, _ in mine:
            window = sorted((s for s in scores if s[2] != lab and 80 * ps <= 100 * s[0] <= 100 * ps), key=order)[:found]
            out += [(d, pid, r, nid, ps, ns) for r, (ns, nid, _) in enumerate(window, 1)]
    return sorted(out, key=str)


def result(df):
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted((tuple(r) for r in df.select(*names).collect()), key=str)


@pytest.fixture
def small_blocks(monkeypatch):
    for name, value in {"BLOCK_ROWS": 16, "GROUP_BITS": 1, "PACK_BITS": 1, "BATCHES_AT_ONCE": 2}.items():
        monkeypatch.setattr(negatives, name, value)


def test_whole_table(spark):
    rows = [tuple(r) for r in table(spark, SMALL, "embeddings").select("vec_id", "label", "embedding").collect()]
    moved = [(d, (m + 1) % 10 if d is not None and d % 7 == 0 and m is not None else m, v) for d, m, v in rows]
    found = queries.op12_hard_negatives(spark, SMALL)
    assert found.schema["rank"].dataType.simpleString() == "int"
    assert result(found) == brute(moved, 100)


def test_many_blocks_and_odd_rows(spark, small_blocks):
    draw = random.Random(5)
    rows = [(n, draw.choice([0, 0, 0, 1, 2]), [draw.gauss(m, 0.2) for m in (0.5, 0.2, 0.0, -0.1)]) for n in range(900)]
    rows += [(n, n % 3, [0.5, 0.5, 0.0, 0.0]) for n in range(1000, 1080)]  # copies and ties
    rows += [(n, 1, [draw.random(), draw.random()]) for n in range(2000, 2030)]  # other lengths
    rows += [(n, 2, [draw.random(), draw.random()]) for n in range(2030, 2060)]
    rows += [(3000, None, [1.0, 1.0]), (3010, 1, None), (3020, 1, [None, 1.0]), (3030, 1, [float("nan"), 1.0])]
    rows += [(3040, 1, [float("inf"), 1.0]), (3050, 1, []), (None, 1, [0.9, 0.9]), (None, 2, [0.8, 0.9])]
    rows += [(3060, 7, [0.0, 0.0, 0.0, 0.0]), (3070, 7, [-1.0, -1.0, 0.0, 0.0]), (3080, 7, [0.1, 0.0, 0.0, 0.0])]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("score", F.lit("mine")).withColumn("batch", F.lit(1)).repartition(4)
    assert result(negatives.hard_negatives(df, F.col("vec_id") % 10 == 0)) == brute(rows, 10)


def test_few_rows_and_empty_table(spark):
    rows = [(100, 1, [1.0, 0.0]), (1, 1, [1.0, 0.0]), (2, 2, [0.9, 0.0])]
    df = spark.createDataFrame(rows, SCHEMA)
    found = result(negatives.hard_negatives(df, F.col("vec_id") % 100 == 0))
    assert found == brute(rows, 100) and len(found) == 1
    assert negatives.hard_negatives(df.where("false"), F.col("vec_id") % 100 == 0).collect() == []


def test_bounds_hold():
    draw = np.random.default_rng(1)
    rows, anchors = draw.integers(-99, 99, (40, 5)), draw.integers(-99, 99, (6, 5))
    line = {"vectors": anchors.astype(np.int32).tobytes(), "dim": 5, "ids": list(range(6)), "labels": [0] * 6, "windows": []}
    least, most = negatives._Anchors(line).bounds(rows.min(axis=0)[None], rows.max(axis=0)[None])
    scores = anchors @ rows.T
    assert (least[:, 0] <= scores.min(axis=1)).all() and (most[:, 0] >= scores.max(axis=1)).all()


def test_curve_visits_neighbours():
    """In key order, each cell differs from the one before by one step in one dimension."""
    for dims, bits in ((2, 3), (3, 2)):
        cells = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
        keys = negatives.hilbert_keys(cells, bits)
        assert len(set(keys)) == len(cells)
        path = cells[sorted(range(len(cells)), key=keys.__getitem__)]
        assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_products_are_exact():
    a = np.array([[1 << 28, 3], [-(1 << 28), 1]])
    assert negatives._dot(a, a).tolist() == [[(1 << 56) + 9, 3 - (1 << 56)], [3 - (1 << 56), (1 << 56) + 1]]
