"""Every window of reads against every window of targets."""

from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest

from varigrove.operators import mapping, seeds
from varigrove.plans import queries

READS = "sample string, read_id string, mate int, seq string, qual string"
FLIP = str.maketrans("ACGT", "TGCA")


def made(rng, n):
    return "".join(rng.choice(list("ACGT"), n))


def test_queries_look_at_every_window(spark):
    """A read whose one window on a target begins at no multiple of 23 from either end, and one that has all windows."""
    rng = np.random.default_rng(5)
    target = made(rng, 128)
    odd = made(rng, 5) + target[40:71] + made(rng, 64)
    data = [("s", "odd", 1, odd, ""), ("s", "all", 2, target[3:103][::-1].translate(FLIP), ""), ("s", "none", 1, made(rng, 100), "")]
    x = SimpleNamespace(
        reads=lambda: spark.createDataFrame(data, READS),
        loci=lambda: spark.createDataFrame([(7, target)], "locus long, seq string"),
    )
    placed = {r.read_id: (r.locus, r.diag, r.strand, r.score, r.second_score) for r in queries.seed_assign(x).collect()}
    assert placed == {"odd": (7, 35, "+", 1, 0), "all": (7, 3, "-", 70, 0)}
    counted = queries.on_target_counts(x).first()
    assert (counted.reads, counted.on_target) == (3, 2)


def added(rows):
    out = {}
    for *key, score in rows:
        out[tuple(key)] = out.get(tuple(key), 0) + score
    return out


@pytest.mark.parametrize("k, step", [(11, 1), (31, 1), (9, 4), (3, 1)])
def test_placements_by_brute_force(spark, k, step, monkeypatch):
    """Both strands, repeats, nulls, letters that are no bases or no bytes; then a few rows at a time, in this process."""
    rng = np.random.default_rng(12)
    loci = [made(rng, 60) for _ in range(5)]
    loci += [loci[0][10:40] * 2, loci[1][:30] + "N" + loci[1][30:], "ACGTA", "A" * 40, None, loci[2]]
    data = [("s", "null", 1, None, "")]
    for n in range(120):
        text = loci[rng.integers(len(loci))] or "AT" * 20
        at, size = rng.integers(0, 25), rng.integers(5, 60)
        read = text[at : at + size]
        read = read[::-1].translate(FLIP) if rng.integers(2) else read
        data.append((("s", None)[n % 2], f"r{n % 100}", 1, read + ("", "N", "é" + text[:20], "acgt")[rng.integers(4)], ""))
    want = {}
    for sample, name, _, seq, _ in data:
        for strand, s in (("+", seq or ""), ("-", (seq or "")[::-1].translate(FLIP))):
            for off in range(0, len(s) - k + 1, step):
                window = s[off : off + k]
                if set(window) <= set("ACGT"):
                    for locus, t in enumerate(loci):
                        for t_off in range(len(t or "") - k + 1):
                            if t[t_off : t_off + k] == window:
                                key = (sample, name, locus, t_off - off, strand)
                                want[key] = want.get(key, 0) + 1
    targets = spark.createDataFrame(list(enumerate(loci)), "locus long, seq string")
    keys = ["sample", "read_id", "mate"]
    found = seeds.placements(spark.createDataFrame(data, READS), targets, keys, k, step)
    assert added(found.drop("mate").collect()) == want
    monkeypatch.setattr(seeds, "CHUNK", 64)
    monkeypatch.setattr(seeds, "HELD", 100)
    files, bases = seeds.write_index(targets, k)
    index = seeds._Index(files, bases, k)
    table = pa.table({c: pa.array([d[i] for d in data]) for i, c in enumerate([*keys, "seq"])})
    parts = [p for t in seeds._slices(table, "seq", 500) for p in seeds._placed(t, keys, index, k, seeds.anchor_size(k), step)]
    assert len(parts) > 2 and added(tuple(r.values()) for p in parts for r in p.drop_columns("mate").to_pylist()) == want


def test_every_window_moves_no_window(spark):
    """Reads stay where they are until they have their placements: one shuffle, by read."""
    reads = spark.createDataFrame([("s", "r", 1, "ACGTTGCA" * 12, "I" * 96)], READS)
    targets = spark.createDataFrame([(1, "ACGTTGCA" * 16)], "locus long, seq string")
    placed = mapping.seed_join(reads, targets, step=1)
    text = placed._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange") == 1 and "Join" not in text
    assert [(r.locus, r.diag, r.strand, r.score, r.second_score) for r in placed.collect()] == [(1, 0, "+", 66, 66)]
    none = mapping.seed_join(reads, targets.where("false"), step=1)
    assert none.collect() == []
    with pytest.raises(ValueError):
        mapping.seed_join(reads, targets, 12, step=1)
