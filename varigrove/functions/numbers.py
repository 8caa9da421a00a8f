"""Percent rules and genome windows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MEGABASE = 1_000_000


def pct_trunc1(part: Column, total: Column) -> Column:
    """Percent with one decimal, cut off and not rounded; null over zero."""
    whole = F.when(total != 0, total)
    return F.floor(part.cast("long") * 1000 / whole) / 10.0


def pct_round2(part: Column, total: Column) -> Column:
    """Percent with two decimals, halves to even; null over zero."""
    return F.bround(part / F.when(total != 0, total) * 100.0, 2)


def window_number(pos: Column, width: int = MEGABASE) -> Column:
    return F.floor(pos / width).cast("long")


def safe_ratio(a: Column, b: Column) -> Column:
    return a / F.when(b != 0, b)
