"""Ranked lexical search over an index whose documents are grouped by their length normaliser.

The score of a term depends on a document only through its occurrences there, tf,
and the normaliser m of the document's length. Documents of equal m are a
stratum. A stratum lists, for each term, the documents by tf, so an impact is
computed once for each (term, tf) of it, and the largest tf of each term bounds
what any of its documents may reach. A search visits strata in the order of
their bounds and ends where none can enter the best any more.

Strata are cut into blocks of about `BLOCK_WORDS` words, so that a length which a
third of all documents share is many blocks. Every document is in the index and
every block is bounded for every item; nothing is sampled or capped.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from varigrove.llm.common import in_slices, quoted, saved, words

#: Words of a block of the index: what a task holds of it at once.
BLOCK_WORDS = 1 << 20
#: Bytes of item texts that are asked for at once; more items are more passes over the index.
ITEM_BYTES = 4 << 20

# Fixed values of the score: length share, its scale, saturation and weight scale.
SLOPE, SCALE, SATURATION, UNIT = 75, 100, 8, 1000


@dataclass(frozen=True)
class Index:
    """Blocks `m, docs, terms, holders, run_term, run_tf, run_len, places`, the documents with a term, and their words."""

    blocks: DataFrame
    documents: int
    length: int
    id_type: str


def _lengths(batch: pa.RecordBatch) -> pa.RecordBatch:
    n = [len(words(t)) for t in batch.column(0).to_pylist()]
    return pa.RecordBatch.from_arrays([pa.array(n, pa.int64())], ["n"])


def _described(documents: int, length: int):
    """Rows `id, m, terms, tfs` of the documents that have a term."""

    def convert(batch: pa.RecordBatch) -> pa.RecordBatch:
        kept, ms, flat, tfs, ends = [], [], [], [], [0]
        for at, text in enumerate(batch.column(1).to_pylist()):
            line = words(text)
            if line:
                counts = Counter(line)
                kept.append(at)
                ms.append(SCALE - SLOPE + SLOPE * len(line) * documents // length)
                flat.extend(counts)
                tfs.extend(counts.values())
                ends.append(len(flat))
        offsets = pa.array(ends, pa.int32())
        return pa.RecordBatch.from_arrays(
            [
                batch.column(0).take(pa.array(kept, pa.int64())),
                pa.array(ms, pa.int64()),
                pa.ListArray.from_arrays(offsets, pa.array(flat, pa.binary())),
                pa.ListArray.from_arrays(offsets, pa.array(tfs, pa.int32())),
            ],
            ["id", "m", "terms", "tfs"],
        )

    return in_slices(convert)


def _block(table: pa.Table) -> pa.Table:
    """One block of a stratum: its documents in order of id, its postings in order of term and tf."""
    ids = table["id"].combine_chunks()
    table = table.take(pc.array_sort_indices(ids, order="ascending", null_placement="at_end"))
    terms = table["terms"].combine_chunks()
    place = np.repeat(np.arange(len(terms), dtype=np.int32), np.asarray(pc.list_value_length(terms)))
    coded = terms.flatten().dictionary_encode()
    code = np.asarray(coded.indices).astype(np.int64)
    tf = np.asarray(table["tfs"].combine_chunks().flatten()).astype(np.int64)
    run = code * (int(tf.max()) + 1) + tf
    order = np.argsort(run, kind="stable")
    run, code, tf = run[order], code[order], tf[order]
    first = np.flatnonzero(np.r_[True, run[1:] != run[:-1]])
    lists = {
        "docs": table["id"].combine_chunks(),
        "terms": coded.dictionary,
        "holders": pa.array(np.bincount(code, minlength=len(coded.dictionary)), pa.int64()),
        "run_term": pa.array(code[first], pa.int32()),
        "run_tf": pa.array(tf[first], pa.int32()),
        "run_len": pa.array(np.diff(np.r_[first, len(run)]), pa.int32()),
        "places": pa.array(place[order], pa.int32()),
    }
    columns = {"m": table["m"].combine_chunks()[:1]}
    for name, values in lists.items():
        columns[name] = pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
    return pa.table(columns)


def build(docs: DataFrame, key: str = "doc_id", text: str = "text") -> Index:
    """The index of all rows of `docs`, written to the shared folder.

    Terms are runs of letters, digits and what lies beyond ASCII, with only A-Z
    lower-cased, in the whole text however long. A null or empty text, or one
    without terms, is in no stratum. Rows that repeat are documents of their own, ids may be null,
    and other columns are not read. No documents give an index without blocks.
    """
    shown = docs.select(quoted(key).alias("id"), quoted(text).cast("string").alias("text"))
    id_type = shown.schema["id"].dataType.simpleString()
    lengths = shown.select("text").mapInArrow(in_slices(_lengths), "n long").where("n > 0")
    by_length = saved(lengths.groupBy("n").agg(F.count(F.lit(1)).alias("docs")), "lexical-lengths")
    documents, length = by_length.agg(F.sum("docs"), F.sum(F.col("n") * F.col("docs"))).first()
    documents, length = documents or 0, length or 0

    rows = shown.mapInArrow(
        _described(documents, length), f"id {id_type}, m long, terms array<binary>, tfs array<int>"
    )
    # Decimals, as the product of a length and the number of documents may pass 64 bits.
    share = F.expr(f"cast({SLOPE} * cast(n as decimal(20, 0)) * {documents} as decimal(38, 0)) div {max(length, 1)}")
    strata = by_length.groupBy((share + (SCALE - SLOPE)).alias("m")).agg(F.sum(F.col("n") * F.col("docs")).alias("words"))
    crowded = saved(
        strata.where(F.col("words") > BLOCK_WORDS).select("m", F.ceil(F.col("words") / BLOCK_WORDS).alias("parts")),
        "lexical-strata",
    )
    part = F.pmod(F.xxhash64("id", "tfs"), F.coalesce("parts", F.lit(1)))
    schema = (
        f"m long, docs array<{id_type}>, terms array<binary>, holders array<long>, run_term array<int>, "
        "run_tf array<int>, run_len array<int>, places array<int>"
    )
    blocks = rows.join(crowded, "m", "left").withColumn("part", part).groupBy("m", "part").applyInArrow(_block, schema)
    return Index(saved(blocks, "lexical-index"), documents, length, id_type)


# -- search ------------------------------------------------------------------


@dataclass(frozen=True)
class _Ask:
    """Items as positions in a list of terms: item i has `terms[ends[i-1]:ends[i]]`, so often each."""

    numbers: list[int]
    vocabulary: pa.Array
    starts: np.ndarray
    terms: np.ndarray
    counts: np.ndarray


def _ask(rows: list[tuple[int, str | None]]) -> _Ask:
    bags = [(no, Counter(words(text))) for no, text in rows]
    bags = [(no, bag) for no, bag in bags if bag]
    vocabulary = sorted(set().union(*(bag for _, bag in bags)))
    at = {term: i for i, term in enumerate(vocabulary)}
    sizes = [len(bag) for _, bag in bags]
    return _Ask(
        [no for no, _ in bags],
        pa.array(vocabulary, pa.binary()),
        np.r_[0, np.cumsum(sizes)].astype(np.int64),
        np.array([at[t] for _, bag in bags for t in bag], np.int64),
        np.array([c for _, bag in bags for c in bag.values()], np.int64),
    )


def _holders(ask: _Ask):
    """Documents that hold each term of `ask`, summed in each batch of blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(ask.vocabulary), np.int64)
        for batch in batches:
            at = pc.index_in(batch.column("terms").flatten(), value_set=ask.vocabulary)
            known = np.asarray(at.is_valid())
            places = np.asarray(at.fill_null(0))[known]
            total += np.bincount(places, np.asarray(batch.column("holders").flatten())[known], len(total)).astype(np.int64)
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(met, pa.int64()), pa.array(total[met], pa.int64())], ["term", "df"])

    return run


class _Stratum:
    """The postings of a block that an ask needs, with their impacts."""

    def __init__(self, block: dict[str, np.ndarray], m: int, docs: pa.Array, at: np.ndarray, weights: np.ndarray):
        term = at[block["run_term"]]
        known = term >= 0
        tf, sizes = block["run_tf"].astype(np.int64), block["run_len"]
        term = term[known]
        # One impact for each (term, tf) of the stratum.
        impact = weights[term] * ((10**9 * tf[known]) // (UNIT * tf[known] + SATURATION * m))
        self.docs = docs
        self.places = block["places"][np.repeat(known, sizes)]
        self.impacts = np.repeat(impact, sizes[known])
        self.best = np.zeros(len(weights), np.int64)
        np.maximum.at(self.best, term, impact)
        ends = np.cumsum(sizes[known])
        first = np.flatnonzero(np.r_[True, term[1:] != term[:-1]]) if len(term) else np.zeros(0, np.int64)
        begins = np.r_[0, ends][first] if len(term) else first
        self.slices = dict(zip(term[first].tolist(), zip(begins.tolist(), np.r_[begins[1:], len(self.places)].tolist())))

    def scores(self, terms: np.ndarray, counts: np.ndarray) -> np.ndarray:
        total = np.zeros(len(self.docs), np.int64)
        for term, count in zip(terms.tolist(), counts.tolist()):
            if term in self.slices:
                begin, end = self.slices[term]
                total[self.places[begin:end]] += count * self.impacts[begin:end]
        return total


def _best(ask: _Ask, weights: np.ndarray, k: int, id_type: pa.DataType):
    """The k best documents of each item among the blocks of a task."""
    lists = ("run_term", "run_tf", "run_len", "places")

    def strata(batch: pa.RecordBatch) -> list[_Stratum]:
        terms = batch.column("terms")
        found = pc.index_in(terms.flatten(), value_set=ask.vocabulary)
        at = np.asarray(found.fill_null(-1)).astype(np.int64)
        ends = np.r_[0, np.cumsum(np.asarray(pc.list_value_length(terms)))]
        out = []
        for i, m in enumerate(batch.column("m").to_pylist()):
            block = {name: np.asarray(batch.column(name)[i].values) for name in lists}
            out.append(_Stratum(block, m, batch.column("docs")[i].values, at[ends[i] : ends[i + 1]], weights))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list[tuple]] = [[] for _ in ask.numbers]
        for batch in batches:
            if not batch.num_rows or not ask.numbers:
                continue
            blocks = strata(batch)
            bounds = np.stack([np.add.reduceat(b.best[ask.terms] * ask.counts, ask.starts[:-1]) for b in blocks])
            for i in range(len(ask.numbers)):
                mine = slice(ask.starts[i], ask.starts[i + 1])
                for n in np.argsort(-bounds[:, i], kind="stable"):
                    floor = -best[i][-1][0] if len(best[i]) == k else 1
                    # A document as good as the last one may still have a smaller id.
                    if bounds[n, i] < floor:
                        break
                    scores = blocks[n].scores(ask.terms[mine], ask.counts[mine])
                    if len(scores) > k:
                        floor = max(floor, int(np.partition(scores, -k)[-k]))
                    met = np.flatnonzero(scores >= floor)
                    met = met[np.argsort(-scores[met], kind="stable")][:k]
                    ids = blocks[n].docs.take(pa.array(met)).to_pylist()
                    found = [(-int(s), d is None, d) for s, d in zip(scores[met], ids)]
                    best[i] = sorted(best[i] + found, key=lambda f: (f[0], f[1], 0 if f[1] else f[2]))[:k]
        yield pa.RecordBatch.from_pylist(
            [{"no": no, "id": d, "score": -s} for no, line in zip(ask.numbers, best) for s, _, d in line],
            schema=pa.schema([("no", pa.int64()), ("id", id_type), ("score", pa.int64())]),
        )

    return run


def search(index: Index, items: DataFrame, key: str = "item_id", text: str = "text", k: int = 10) -> DataFrame:
    """The `k` documents of highest score above 0 for each row of `items`: item_id, rank, doc_id, score.

    Scores are integers: a term's weight times the saturated frequency, summed
    over the item's terms with repeats. Equal scores rank by ascending doc_id,
    null last. Each task keeps the best of its blocks; the ranks come from those.
    A null or empty item, or one without a term that the index knows, has no rows; an item that
    repeats is ranked as often. Items go out in passes of about `ITEM_BYTES` of text.
    """
    spark = items.sparkSession
    shown = items.select(
        quoted(key).alias("item_id"), quoted(text).cast("string").alias("text"), F.monotonically_increasing_id().alias("no")
    )
    listed = saved(shown, "lexical-items")
    size = listed.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    passes = max(1, -(-size // ITEM_BYTES))
    id_type = to_arrow_type(index.blocks.schema["docs"].dataType.elementType)
    schema = f"no long, id {index.id_type}, score long"
    found = spark.createDataFrame([], schema)
    for n in range(passes):
        mine = listed.where(F.pmod(F.xxhash64("no"), F.lit(passes)) == n).select("no", "text")
        ask = _ask([tuple(r) for r in mine.collect()])
        counted = index.blocks.select("terms", "holders").mapInArrow(_holders(ask), "term long, df long")
        weights = np.zeros(len(ask.vocabulary), np.int64)
        for term, df in counted.groupBy("term").agg(F.sum("df")).collect():
            weights[term] = math.floor(1000 * math.log((2 * index.documents + 2) / (2 * df + 1)))
        found = found.unionByName(index.blocks.drop("holders").mapInArrow(_best(ask, weights, k, id_type), schema))
    order = Window.partitionBy("no").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.join(listed.select("no", "item_id"), "no").select(
        "item_id", "rank", F.col("id").alias("doc_id"), "score"
    )
