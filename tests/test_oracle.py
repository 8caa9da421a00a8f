"""Every registered query against its oracle."""

import compare
import pytest

import __spark_entry__ as entry
from paths import SMALL
from varigrove.plans import oracle, queries

# Nothing to find in so few rows; tested on a larger folder and by hand elsewhere.
MAY_BE_EMPTY = {"paralog_warnings_depth"}


def test_every_query_has_an_oracle():
    assert set(queries.registered()) == set(oracle.oracle())
    assert set(queries.registered()) <= set(entry.queries()) and set(oracle.oracle()) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", list(queries.registered()))
def test_query(spark, con, name):
    found = compare.differences(spark, con, SMALL, name)
    if name in MAY_BE_EMPTY:
        found = [f for f in found if f != "no rows"]
    assert found == []


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert rows and sum(r.raw_snps for r in rows) > 0
