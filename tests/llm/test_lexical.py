import math
import re
from collections import Counter

import pytest
from cases import SMALL

from varigrove.llm import lexical, queries
from varigrove.llm.common import table

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k=10):
    """Rows (item, rank, doc, score), scoring every document for every item."""
    bags = [(d, Counter(terms(t))) for d, t in docs]
    bags = [(d, b) for d, b in bags if b]
    count, length = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        scores = []
        for d, b in bags:
            m = 25 + 75 * sum(b.values()) * count // length
            s = 0
            for t in terms(text):
                if t in b:
                    w = math.floor(1000 * math.log((2 * count + 2) / (2 * df[t] + 1)))
                    s += w * (10**9 * b[t] // (1000 * b[t] + 8 * m))
            if s > 0:
                scores.append((-s, d is None, d or 0))
        best = sorted(scores)[:k]
        out += [(item, r, None if none else d, -s) for r, (s, none, d) in enumerate(best, 1)]
    return sorted(out, key=str)


def rows(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=str)


@pytest.fixture
def small_blocks(monkeypatch):
    monkeypatch.setattr(lexical, "BLOCK_WORDS", 2000)
    monkeypatch.setattr(lexical, "ITEM_BYTES", 2000)


def test_whole_tables(spark, small_blocks):
    docs, items = table(spark, SMALL, "documents"), table(spark, SMALL, "benchmark")
    found = queries.op11_lexical_search(spark, SMALL)
    assert found.schema["rank"].dataType.simpleString() == "int"
    assert rows(found) == brute(docs.select("doc_id", "text").collect(), items.select("item_id", "text").collect())


ITEMS = [(1, "one two"), (1, "one two"), (2, None), (3, ""), (None, "WORD word xyz"), (4, "中文 wörds, and; more"), (5, "absent")]


def test_odd_documents(spark, odd, small_blocks):
    items = spark.createDataFrame(ITEMS, "item_id int, text string")
    found = lexical.search(lexical.build(odd), items, k=3)
    assert rows(found) == brute([(r.doc_id, r.text) for r in odd.collect()], ITEMS, 3)


def test_a_length_that_most_documents_share(spark, monkeypatch):
    monkeypatch.setattr(lexical, "BLOCK_WORDS", 300)
    docs = [(n, f"alpha beta {'gamma' if n % 7 == 0 else 'delta'} w{n % 50}") for n in range(2000)] + [(5000, "alpha " * 400)]
    items = [(0, "alpha gamma w7"), (1, "gamma gamma delta"), (2, "w49")]
    index = lexical.build(spark.createDataFrame(docs, "doc_id long, text string"))
    assert index.blocks.groupBy("m").count().agg({"count": "max"}).first()[0] > 10
    assert rows(lexical.search(index, spark.createDataFrame(items, "item_id long, text string"))) == brute(docs, items)


def test_empty_tables(spark, none):
    items = spark.createDataFrame(ITEMS, "item_id int, text string")
    assert lexical.search(lexical.build(none), items).collect() == []
    docs = spark.createDataFrame([("a", "one"), (None, "two")], "name string, body string")
    index = lexical.build(docs, "name", "body")
    assert lexical.search(index, items.where("false")).collect() == []
    assert [tuple(r) for r in lexical.search(index, items.where("item_id = 1")).select("doc_id", "rank").collect()] == [
        ("a", 1), (None, 2), ("a", 1), (None, 2)
    ]
