import hashlib
import random
import re

import pytest
from cases import SMALL

from varigrove.llm import decontaminate, queries
from varigrove.llm.common import table, words

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(text, items, window=10):
    line = plain_words(text)
    hit, found = set(), set()
    for name, item in items:
        ws = plain_words(item)
        n = min(window, len(ws))
        for k in range(len(ws) - n + 1 if n else 0):
            for at in range(len(line) - n + 1):
                if line[at : at + n] == ws[k : k + n]:
                    hit.update(range(at, at + n))
                    found.add(name)
    return len(line), len(hit), sorted(found)


def test_query(spark):
    items = [(str(r.item_id), r.text) for r in table(spark, SMALL, "benchmark").collect()]
    got = {r.doc_id: r for r in queries.op3_benchmark_overlap(spark, SMALL).collect()}
    docs = table(spark, SMALL, "documents").collect()
    assert len(got) == len(docs)
    # Windows by a dictionary, for speed.
    windows = {}
    for name, item in items:
        ws = plain_words(item)
        n = min(10, len(ws))
        for k in range(len(ws) - n + 1 if n else 0):
            windows.setdefault(tuple(ws[k : k + n]), set()).add(name)
    sizes = {len(w) for w in windows}
    dirty = 0
    for d in docs:
        line, hit, found = plain_words(d.text), set(), set()
        for n in sizes:
            for at in range(len(line) - n + 1):
                of = windows.get(tuple(line[at : at + n]))
                if of:
                    hit.update(range(at, at + n))
                    found |= of
        r = got[d.doc_id]
        assert (r.n_words, r.n_hit, r.n_items) == (len(line), len(hit), len(found))
        assert r.items_sha256 == hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        assert r.contaminated == bool(hit)
        dirty += bool(hit)
    assert dirty


def test_words_are_the_patterns():
    rng = random.Random(1)
    for _ in range(300):
        text = "".join(rng.choice("aB9 _-Éé中😀\x00\x7f@[`{\n") for _ in range(30))
        assert [w.decode() for w in words(text)] == plain_words(text)


@pytest.mark.parametrize("block", [10**6, 12])
def test_against_brute_force(spark, block):
    """Repetitive texts over few words, items shorter than a window, one automaton or many."""
    rng = random.Random(7)
    say = lambda n: " ".join(rng.choice("ab") for _ in range(n))
    items = [(n, say(rng.choice([0, 1, 3, 4, 5, 9]) if n % 3 else 7)) for n in range(8)]
    items += [(8, None), (9, "B " * 30), (None, "a b a b c")]
    docs = [(n, say(rng.randint(0, 60)) + rng.choice(["", " c a b"])) for n in range(30)]
    found, names = decontaminate.find_overlaps(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(items, "item_id long, text string"),
        window=4,
        block_words=block,
    )
    named = [("" if i is None else str(i), t) for i, t in items]
    for r in found.collect():
        assert (r[names[0]], r[names[2]], r[names[3]]) == brute(r.text, named, 4)


def test_cutting_spans(spark):
    docs = spark.createDataFrame([(1, "Keep this. ONE two, three four! And this."), (2, "clean é text"), (3, None)], "doc_id long, text string")
    items = spark.createDataFrame([("q", "one two three four")], "item_id string, text string")
    got = {r.doc_id: r.text for r in decontaminate.decontaminate(docs, items, window=4, max_coverage=0.9).collect()}
    assert got == {1: "Keep this. ! And this.", 2: "clean é text", 3: None}
    assert {r.doc_id for r in decontaminate.decontaminate(docs, items, window=4).collect()} == {2, 3}
    assert {r.doc_id for r in decontaminate.decontaminate(docs, items, window=4, max_coverage=0.9, max_span=3).collect()} == {2, 3}


def test_odd_rows(odd, none, spark):
    items = spark.createDataFrame([(1, "six"), (2, None)], "item_id long, text string")
    found, names = decontaminate.find_overlaps(odd, items)
    assert names == ["_n_words", "_spans", "n_hit", "items"] and found.count() == odd.count()
    assert sum(r.n_hit for r in found.collect()) == 3
    clean = decontaminate.decontaminate(odd, items)
    assert clean.schema == odd.schema and clean.count() == odd.count() - 3
    nothing = items.where("false")
    assert decontaminate.decontaminate(odd, nothing).count() == odd.count()
    assert decontaminate.decontaminate(none, items).collect() == []
