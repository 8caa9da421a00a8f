import hashlib
import re
from collections import defaultdict

import compare
import pytest
from cases import SMALL
from pyspark.sql import functions as F

import __spark_entry__ as entry
from varigrove.llm import exact, queries


def brute(rows):
    groups = defaultdict(list)
    for n, (doc_id, text) in enumerate(rows):
        groups[re.sub(r"[\x20\x09-\x0D]", "", text or "")].append((-len(text or ""), doc_id is None, doc_id or 0, n))
    out = []
    for norm, members in groups.items():
        members.sort()
        first = members[0]
        for m in members:
            keep = None if first[1] else first[2]
            out.append((None if m[1] else m[2], keep, len(members), m == first, hashlib.sha256(norm.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("name", list(queries.oracle()))
def test_oracle(spark, con, name):
    assert compare.differences(spark, con, SMALL, name) == []
    assert name in entry.oracle_sql() and name in entry.queries()


@pytest.mark.parametrize("digest", [exact.content_hash, lambda c: F.lit(b"same"), lambda c: F.substring(exact.content_hash(c), 1, 1)])
def test_odd_rows_and_collisions(odd, digest):
    got = exact.exact_groups(odd, digest=digest)
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert sorted([tuple(r) for r in got.collect()], key=str) == brute(rows)


def test_empty(none):
    assert exact.exact_groups(none).collect() == []


def test_native_plan(odd):
    plan = exact.exact_groups(odd)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
