import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from cases import SMALL

from varigrove.llm import bagminhash, queries
from varigrove.llm.common import table, words


def bag(text):
    line = words((text or "").lower())
    n = min(5, len(line))
    return Counter(tuple(line[i : i + n]) for i in range(len(line) - n + 1)) if line else Counter()


def similarity(a, b):
    both = sum((a & b).values())
    return both / (sum(a.values()) + sum(b.values()) - both)


def brute(rows, threshold=0.8):
    """Smallest id of each row's class, by comparing all texts that share a shingle."""
    bags = [bag(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    holders, bare = defaultdict(list), {}
    for n, b in enumerate(bags):
        for s in b:
            holders[s].append(n)
        if not b:
            parent[root(n)] = root(bare.setdefault(rows[n][1] or "", n))
    pairs = {(x, y) for h in holders.values() for x in h for y in h if x < y}
    for x, y in pairs:
        if similarity(bags[x], bags[y]) >= threshold:
            parent[root(x)] = root(y)
    ids = defaultdict(list)
    for n, (doc_id, _) in enumerate(rows):
        ids[root(n)].append((doc_id is None, doc_id))
    return [min(ids[root(n)], key=lambda x: (x[0], x[1] or 0))[1] for n in range(len(rows))]


def families(seed, n=40):
    """Texts, copies of them with few or many words changed, and chains of small changes."""
    rng = random.Random(seed)
    say = lambda k: [f"w{rng.randrange(400)}" for _ in range(k)]
    out = []
    for _ in range(n):
        line = say(rng.choice([3, 5, 30, 80]))
        if rng.random() < 0.3:
            line = line * rng.randint(2, 6)
        for _ in range(rng.randint(1, 6)):
            out.append(" ".join(line))
            for _ in range(rng.choice([0, 1, 1, 2, 4])):
                line[rng.randrange(len(line))] = rng.choice(say(1))
    rng.shuffle(out)
    return list(enumerate(out))


def classes(spark, rows):
    got = bagminhash.near_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    return Counter((r.id, r.class_id) for r in got)


def test_slots_agree_as_weighted_jaccard():
    rng = np.random.default_rng(1)
    off = []
    for _ in range(25):
        ids = rng.integers(0, 2**63, rng.integers(2, 150)).astype(np.uint64)
        one = rng.integers(0, 9, len(ids))
        two = np.where(rng.random(len(ids)) < 0.5, one, rng.integers(0, 9, len(ids)))
        if not (one.any() and two.any()):
            continue
        found = [bagminhash.signatures(ids[w > 0], w[w > 0], np.zeros((w > 0).sum(), int), 1, 2000)[0] for w in (one, two)]
        j = np.minimum(one, two).sum() / np.maximum(one, two).sum()
        off.append(((found[0] == found[1]).mean() - j) / np.sqrt(max(j * (1 - j), 1e-4) / 2000))
    assert abs(np.mean(off)) < 1 and np.abs(off).max() < 4.5


def test_signature_does_not_depend_on_its_batch():
    rng = np.random.default_rng(2)
    ids, weights = rng.integers(0, 2**63, 90).astype(np.uint64), rng.integers(1, 20, 90)
    owner = np.repeat(np.arange(3), [1, 9, 80])
    together = bagminhash.signatures(ids, weights, owner, 4)
    assert np.isinf(together[3]).all()
    for n in range(3):
        mine = owner == n
        alone = bagminhash.signatures(ids[mine], weights[mine], np.zeros(mine.sum(), int), 1)
        assert (alone[0] == together[n]).all()


@pytest.mark.parametrize("seed", [1, 2])
def test_families(spark, seed):
    rows = families(seed)
    assert classes(spark, rows) == Counter(zip([i for i, _ in rows], brute(rows)))


def test_loose_buckets(spark):
    """Many texts around one, each near to it or to another, so that leads leave much open."""
    rng = random.Random(9)
    core = [f"c{n}" for n in range(60)]
    rows = []
    for n in range(120):
        line = core[:]
        for k in range(rng.choice([1, 2, 3])):
            line[rng.randrange(60)] = f"x{n % 17}{k}"
        rows.append((n, " ".join(line)))
    assert classes(spark, rows) == Counter(zip(range(120), brute(rows)))


def test_query(spark):
    docs = [(r.doc_id, r.text) for r in table(spark, SMALL, "documents").collect()]
    got = queries.op1_near_dedup(spark, SMALL).collect()
    assert Counter((r.doc_id, r.class_id) for r in got) == Counter(zip([i for i, _ in docs], brute(docs)))
    sizes = Counter(r.class_id for r in got)
    assert all(r.class_rows == sizes[r.class_id] and r.kept == (r.doc_id == r.class_id) for r in got)


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(n, n + 1) for n in range(400, 460)] + [(500, n) for n in range(501, 540)]
    parent = {x: x for e in edges for x in e}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for u, v in edges:
        a, b = root(u), root(v)
        parent[max(a, b)] = min(a, b)
    got = {r.node: r.root for r in bagminhash.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {x: root(x) for e in edges if e[0] != e[1] for x in e}


def test_odd_rows(odd, none):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    got = bagminhash.near_classes(odd).collect()
    assert Counter((r.id, r.class_id) for r in got) == Counter(zip([i for i, _ in rows], brute(rows)))
    kept = bagminhash.without_near_duplicates(odd)
    assert kept.columns == odd.columns
    # One row of each class, the repeated row once.
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted(set(brute(rows)), key=str)
    assert bagminhash.near_classes(none).collect() == [] and bagminhash.without_near_duplicates(none).collect() == []
