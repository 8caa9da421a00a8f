import hashlib
import random

import pytest
from cases import SMALL
from pyspark.sql import functions as F

from varigrove.llm import fingerprints, queries
from varigrove.llm.common import table


def walk(text):
    """The embedding step by step: the character of every step."""
    waits, out = fingerprints._moves(), []
    for c in text:
        kind = ((ord(c) * 2654435761) & 0xFFFFFFFF) >> 27
        step = len(out)
        out += [c] * waits[kind][step % fingerprints._PERIOD]
    return out


def hamming(a, b):
    x, y = walk(a), walk(b)
    return sum(p == q for p, q in zip(x, y)) / max(len(x), len(y), 1)


def edits(text, n, draw):
    line = list(text)
    for _ in range(n):
        at = draw.randrange(len(line))
        draw.choice([lambda: line.insert(at, "q"), lambda: line.pop(at), lambda: line.__setitem__(at, "Z")])()
    return "".join(line)


def prose(n, draw):
    return " ".join("".join(draw.choices("etaoinshrdlu", k=draw.randint(1, 9))) for _ in range(n))


def test_a_fingerprint_samples_the_walk():
    draw = random.Random(2)
    for text in ("", "a", "ab" * 40, prose(300, draw), "中文 😀 " * 200):
        steps = walk(text)
        mark = fingerprints.fingerprint(text)
        n, digits = mark.split(":")
        held = fingerprints.places(len(steps))
        assert int(n) == len(steps) and len(digits) == len(held) == min(len(steps), fingerprints.PLACES)
        assert sorted(held) == sorted(sorted(range(len(steps)), key=lambda j: fingerprints._mix(fingerprints.np.array([j]))[0])[: fingerprints.PLACES])


def test_parts_and_stretches_change_nothing(monkeypatch):
    text = prose(2000, random.Random(3))
    whole = fingerprints.fingerprint(text)
    letters = fingerprints.letters_of(text)
    parts = fingerprints.Walk().feed(letters[:777]).feed(letters[777:777]).feed(letters[777:])
    assert parts.fingerprint() == whole
    monkeypatch.setattr(fingerprints, "STRETCH", 100)
    assert fingerprints.fingerprint(text) == whole


def test_likeness_estimates_the_walks():
    draw = random.Random(4)
    errors = []
    for n in (50, 200, 1000):
        text = prose(n, draw)
        for k in (0, 1, 5, 20):
            other = edits(text, k, draw)
            found = fingerprints.likeness(fingerprints.fingerprint(text), fingerprints.fingerprint(other))
            assert found == fingerprints.likeness(fingerprints.fingerprint(other), fingerprints.fingerprint(text))
            errors.append(abs(found - hamming(text, other)))
        assert fingerprints.likeness(fingerprints.fingerprint(text), fingerprints.fingerprint(prose(n, draw))) < 0.25
    assert max(errors) < 0.15 and sum(errors) / len(errors) < 0.05
    assert fingerprints.likeness("0:", "0:") == 1.0 and fingerprints.likeness("0:", fingerprints.fingerprint("abc")) == 0.0


def expected(rows):
    """The result row by row, from whole texts."""
    order = sorted(((d, t or "") for d, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0)))
    out = []
    for i, (d, t) in enumerate(order):
        after = order[(i + 1) % len(order)][1]
        half = len(t) // 2
        edited = t[: len(t) - half] + after[:half]
        a, b, c = (fingerprints.fingerprint(x) for x in (t, edited, after))
        digest = hashlib.sha256(edited.encode()).hexdigest()
        out.append((d, len(t), digest, a, b, fingerprints.likeness(a, b), fingerprints.likeness(a, c)))
    return sorted(out, key=str)


COLUMNS = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def test_whole_table(spark):
    docs = [tuple(r) for r in table(spark, SMALL, "documents").select("doc_id", "text").collect()]
    rows = queries.op13_document_fingerprints(spark, SMALL).select(*COLUMNS).collect()
    assert sorted(map(tuple, rows), key=str) == expected(docs)
    halves = [r for r in rows if r.n_chars > 400]
    assert sum(r.near_edited > 0.35 for r in halves) > 0.95 * len(halves)


def test_neighbours_across_tasks(spark):
    """With more tasks than rows to a task, every row still meets the next one."""
    rows = [(n, f"text number {n} " * (n % 5)) for n in range(300)] + [(None, "last")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("part", F.lit("mine")).repartition(7)
    kept = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = fingerprints.with_next(df, lambda a, b: (a, b), "here string, following string").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", kept)
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    want = [(d, t, order[(i + 1) % len(order)][1]) for i, (d, t) in enumerate(order)]
    assert sorted(map(tuple, found), key=str) == sorted(want, key=str)


def test_odd_documents(spark, odd, none):
    """Equal ids come in any order, so only what does not hang on the next row is compared."""
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    found = fingerprints.with_next(odd, queries.edited_likeness, queries.EDITED).collect()
    assert sorted((str(r.doc_id), r.n_chars, r.fingerprint) for r in found) == sorted(
        (str(d), len(t or ""), fingerprints.fingerprint(t)) for d, t in rows
    )
    marks = fingerprints.fingerprints(odd).collect()
    assert sorted((str(r.id), r.fingerprint) for r in marks) == sorted((str(d), fingerprints.fingerprint(t)) for d, t in rows)
    assert fingerprints.with_next(none, queries.edited_likeness, queries.EDITED).collect() == []
    assert fingerprints.fingerprints(none).collect() == []


def test_one_document_is_followed_by_itself(spark):
    df = spark.createDataFrame([(1, "abcd")], "doc_id long, text string")
    assert [tuple(r) for r in fingerprints.with_next(df, lambda a, b: (a + b,), "s string").collect()] == [(1, "abcdabcd")]


@pytest.mark.parametrize("least", [0.8])
def test_search_finds_what_is_alike(spark, least):
    draw = random.Random(6)
    texts = [prose(draw.randint(30, 300), draw) for _ in range(60)]
    rows = [(n, t) for n, t in enumerate(texts)]
    rows += [(1000 + n, edits(t, 2, draw)) for n, t in enumerate(texts)]
    rows += [(2000 + n, texts[0]) for n in range(50)] + [(None, texts[1]), (3000, None), (3001, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    asked = docs.where("doc_id % 20 = 0")
    marks = {d: fingerprints.fingerprint(t) for d, t in rows if t}
    want = {
        (a, b, round(fingerprints.likeness(marks[a], marks[b]), 9))
        for a in marks if a is not None and a % 20 == 0
        for b in marks if fingerprints.likeness(marks[a], marks[b]) >= least
    }
    found = {(r.asked_id, r.doc_id, round(r.likeness, 9)) for r in fingerprints.similar(asked, docs, least).collect()}
    assert found <= want and len(found) >= 0.97 * len(want) and (0, 2049, 1.0) in found and (20, 20, 1.0) in found
    assert fingerprints.similar(asked.where("false"), docs).collect() == []
