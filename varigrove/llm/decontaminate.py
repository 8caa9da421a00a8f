"""Benchmark decontamination with a generalised suffix automaton over words.

The automaton holds every run of words of the test items. Read along a
document, it tells at each word the longest run that ends there and occurs in an
item, so all windows are found in one pass and no window is ever shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from itertools import pairwise

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from varigrove.llm.common import free_name, in_slices, quoted, saved, words

WINDOW = 10
#: Words in one automaton, which is broadcast: about 400 bytes a word. A larger
#: benchmark is cut into several, and the documents are read once for each.
BLOCK_WORDS = 100_000


class Automaton:
    """Generalised suffix automaton of word sequences, with the items each window belongs to."""

    def __init__(self, items: Sequence[tuple[str, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.words: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        lines = [(name, [self.words.setdefault(w, len(self.words)) for w in ws]) for name, ws in items if ws]
        for _, line in lines:
            last = 0
            for word in line:
                last = self._extend(last, word)
        #: Per state, items of its run of `window` words; per state, items that are its longest run as a whole.
        self.inside: dict[int, set[str]] = {}
        self.whole: dict[int, set[str]] = {}
        for name, line in lines:
            state = 0
            for n, word in enumerate(line, 1):
                state = self.next[state][word]
                if n >= window:
                    self.inside.setdefault(self._cut(state), set()).add(name)
            if len(line) < window:
                self.whole.setdefault(state, set()).add(name)
        self.least = min([window, *(len(line) for _, line in lines)])

    def _extend(self, last: int, word: int) -> int:
        """Append a word to the run that ends in `last`; states that exist are used again."""
        known = self.next[last].get(word)
        if known is not None and self.length[known] == self.length[last] + 1:
            return known
        if known is not None:
            return self._split(last, word, known)
        new = self._state({}, self.length[last] + 1)
        at = last
        while at != -1 and word not in self.next[at]:
            self.next[at][word] = new
            at = self.link[at]
        if at == -1:
            self.link[new] = 0
        else:
            target = self.next[at][word]
            exact = self.length[target] == self.length[at] + 1
            self.link[new] = target if exact else self._split(at, word, target)
        return new

    def _split(self, at: int, word: int, target: int) -> int:
        """A copy of `target` for its runs that continue those of `at`."""
        copy = self._state(dict(self.next[target]), self.length[at] + 1)
        self.link[copy], self.link[target] = self.link[target], copy
        while at != -1 and self.next[at].get(word) == target:
            self.next[at][word] = copy
            at = self.link[at]
        return copy

    def _state(self, after: dict[int, int], length: int) -> int:
        self.next.append(after)
        self.link.append(0)
        self.length.append(length)
        return len(self.next) - 1

    def _cut(self, state: int) -> int:
        """The state of the last `window` words of the runs of `state`."""
        while self.length[self.link[state]] >= self.window:
            state = self.link[state]
        return state

    def hits(self, line: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Word spans of the windows in `line`, merged and in order, and the items they are of."""
        get = self.words.get
        ids = np.fromiter((get(w, -1) for w in line), np.int32, len(line))
        # A window lies in a run of words that the items know, so only such runs are read.
        edge = np.flatnonzero(np.diff(np.concatenate(([False], ids >= 0, [False])).astype(np.int8)))
        spans: list[tuple[int, int]] = []
        items: set[str] = set()
        for begin, end in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
            if end - begin >= self.least:
                self._read(ids[begin:end].tolist(), begin, spans, items)
        return merged(spans), items

    def _read(self, ids: list[int], begin: int, spans: list[tuple[int, int]], items: set[str]) -> None:
        after, link, length, window = self.next, self.link, self.length, self.window
        state = matched = 0
        for at, word in enumerate(ids, begin + 1):
            step = after[state].get(word)
            while step is None and state:
                state = link[state]
                matched = length[state]
                step = after[state].get(word)
            if step is None:
                continue
            state, matched = step, matched + 1
            if matched >= window:
                spans.append((at - window, at))
                items |= self.inside[self._cut(state)]
            if self.whole:
                one = state
                while one:
                    if one in self.whole and (one != state or matched == length[one]):
                        spans.append((at - length[one], at))
                        items |= self.whole[one]
                    one = link[one]


def merged(spans: Sequence[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans that overlap or touch as one."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def item_blocks(items: DataFrame, window: int, block_words: int) -> Iterator[list[tuple[str, list[bytes]]]]:
    """Items in blocks of at most `block_words` words; the driver holds one block.

    An item longer than a block is cut into pieces that overlap by a window less one word.
    """
    block: list[tuple[str, list[bytes]]] = []
    held = 0
    for row in items.toLocalIterator():
        line = words(row.text)
        step = max(window, block_words)
        for start in range(0, max(1, len(line) - window + 1), step - window + 1):
            piece = line[start : start + step]
            if block and held + len(piece) > block_words:
                yield block
                block, held = [], 0
            block.append((row.item, piece))
            held += len(piece)
    if block:
        yield block


def find_overlaps(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    block_words: int = BLOCK_WORDS,
) -> tuple[DataFrame, list[str]]:
    """`docs` with the words of each document that occur in a window of an item.

    Four columns are added, whose names are returned: number of words, spans of
    words hit (start, end, in order, apart), number of words hit, and the ids of
    the items as sorted strings. A window is `window` words in a row of an item;
    a shorter item is one window as a whole. Null and empty texts have no words,
    items without words no windows; null item ids count as an item called ''.
    Rows stay as they are: repeated ones, nulls and other columns included.
    """
    names = [free_name(docs.columns, n) for n in ("n_words", "spans", "n_hit", "items")]
    schema = T.StructType(
        [
            *docs.schema.fields,
            T.StructField(names[0], T.LongType()),
            T.StructField(names[1], T.ArrayType(T.ArrayType(T.IntegerType()))),
            T.StructField(names[2], T.LongType()),
            T.StructField(names[3], T.ArrayType(T.StringType())),
        ]
    )
    own = docs.columns
    shown = benchmark.select(
        F.coalesce(quoted(item).cast("string"), F.lit("")).alias("item"), quoted(item_text).cast("string").alias("text")
    )
    blocks = item_blocks(shown, window, block_words)
    found = docs
    for n, block in enumerate(_at_least_one(blocks)):
        known = docs.sparkSession.sparkContext.broadcast(Automaton(block, window))
        if n:
            # The result so far is written, so that a task holds one automaton.
            found = saved(found, "overlaps")

        def convert(batch: pa.RecordBatch, known=known, n=n) -> pa.RecordBatch:
            automaton = known.value
            at = {name: i for i, name in enumerate(batch.schema.names)}
            count, spans, hit, items = [], [], [], []
            before = batch.column(at[names[1]]).to_pylist() if n else [[]] * batch.num_rows
            others = batch.column(at[names[3]]).to_pylist() if n else [[]] * batch.num_rows
            for whole, old, more in zip(batch.column(at[text]).to_pylist(), before, others, strict=True):
                line = words(whole)
                mine, of = automaton.hits(line)
                mine = merged([*map(tuple, old), *mine])
                count.append(len(line))
                spans.append(mine)
                hit.append(sum(e - s for s, e in mine))
                items.append(sorted(of.union(more)))
            return pa.RecordBatch.from_arrays(
                [
                    *[batch.column(at[c]) for c in own],
                    pa.array(count, pa.int64()),
                    pa.array(spans, pa.list_(pa.list_(pa.int32()))),
                    pa.array(hit, pa.int64()),
                    pa.array(items, pa.list_(pa.string())),
                ],
                names=[*own, *names],
            )

        found = found.mapInArrow(in_slices(convert), schema)
    return found, names


def _at_least_one(blocks: Iterator[list]) -> Iterator[list]:
    """The blocks, or one empty block if there is none."""
    first = next(blocks, [])
    yield first
    yield from blocks


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    max_span: int | None = None,
    max_coverage: float = 0.0,
    **options,
) -> DataFrame:
    """`docs` without test items.

    A document is dropped if a span of words hit is longer than `max_span`
    words, or if more than `max_coverage` of its words are hit; the default
    drops every document with a window. What stays loses its spans: their words
    go, from the first character of the first to the end of the last.
    """
    found, (n_words, spans, n_hit, items) = find_overlaps(docs, benchmark, text=text, **options)
    long = F.exists(quoted(spans), lambda s: s[1] - s[0] > F.lit(max_span)) if max_span is not None else F.lit(False)
    stays = found.where(~long & (quoted(n_hit) <= quoted(n_words) * F.lit(max_coverage)))
    if max_coverage > 0:  # else no row with a hit is left
        stays = stays.withColumn(text, _without(quoted(text), quoted(spans)))
    return stays.drop(n_words, spans, n_hit, items)


@F.pandas_udf(T.StringType())
def _without(texts: pd.Series, spans: pd.Series) -> pd.Series:
    return pd.Series([t if t is None else cut_words(t, s) for t, s in zip(texts, spans, strict=True)], dtype=object)


def cut_words(text: str, spans: Sequence[Sequence[int]]) -> str:
    """`text` without the words of the spans."""
    places = [m.span() for m in re.finditer(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text)]
    cuts = [0, *(x for s, e in spans for x in (places[s][0], places[e - 1][1])), len(text)]
    return "".join(text[a:b] for a, b in list(pairwise(cuts))[::2])
