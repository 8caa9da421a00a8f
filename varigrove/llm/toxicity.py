"""Toxicity by a classifier chain of linear models.

Categories are predicted one after another. The model of a category sees the
words of a document and the probabilities of the categories before it. In
training those probabilities are out of fold: a row's come from models that
have not seen the row, so a later model learns how far an earlier one can be
trusted, not how well it remembers.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from varigrove.llm.common import free_name, give_back, in_slices, quoted, saved, words

#: Labelled rows that the models are fitted on, drawn by a hash of the id. This
#: is the one bounded sample here; scoring reads every document.
SAMPLE_ROWS = 12_000
#: Words and beginnings of words that tell the categories apart best.
FEATURES = 2_000
FOLDS = 3
PREFIXES = (4, 5, 6)
LEAST_ROWS = 3


def features(text: str | None) -> set[bytes]:
    """Words of a text, and their first bytes marked with a `*`; each counts once."""
    out = set(words(text.lower())) if text else set()
    return out | {w[:n] + b"*" for w in out for n in PREFIXES if len(w) > n}


@dataclass
class Linear:
    """A logistic model over the features a row has and the categories before."""

    bias: float
    of_feature: np.ndarray
    of_earlier: np.ndarray


@dataclass
class Chain:
    """What scoring needs; it is broadcast and holds FEATURES features at most."""

    categories: list[str]
    index: dict[bytes, int]
    models: list[Linear]
    #: Probabilities from which on a row is said to be of the category.
    limits: list[float]

    def probabilities(self, texts: Sequence[str | None]) -> np.ndarray:
        """One row per text, one column per category."""
        rows = [self.row(t) for t in texts]
        sizes = np.fromiter(map(len, rows), np.int64, len(rows))
        ids = np.fromiter((i for r in rows for i in r), np.int64, int(sizes.sum()))
        return chained(self.models, ids, np.repeat(np.arange(len(rows)), sizes), len(rows))

    def row(self, text: str | None) -> list[int]:
        own = set(words(text.lower())) if text else set()
        found = {self.index.get(w) for w in own}
        for n in PREFIXES:
            starts = {w[:n] for w in own if len(w) > n}
            found.update(self.index.get(s + b"*") for s in starts)
        found.discard(None)
        return sorted(found)


def chained(models: Sequence[Linear], ids: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros((n, len(models)))
    for k, m in enumerate(models):
        out[:, k] = expit(m.bias + np.bincount(owner, m.of_feature[ids], n) + out[:, :k] @ m.of_earlier)
    return out


def expit(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit_linear(
    ids: np.ndarray, owner: np.ndarray, earlier: np.ndarray, goal: np.ndarray, size: int, ridge: float = 0.1, steps: int = 300
) -> Linear:
    """Ridge logistic regression by accelerated steps; without two classes, their share alone."""
    n, extra = earlier.shape
    if not 0 < goal.sum() < n:
        share = (goal.sum() + 0.5) / (n + 1)
        return Linear(float(np.log(share / (1 - share))), np.zeros(size), np.zeros(extra))
    # The curvature is at most a quarter of X'X, which its row sums bound entry by
    # entry; so a rare word takes long steps and a common one short ones.
    reach = np.bincount(owner, minlength=n) + earlier.sum(1) + 1
    step = 1 / (0.25 * np.concatenate((np.bincount(ids, reach[owner], size), earlier.T @ reach, [reach.sum()])) + ridge)
    w = np.zeros(size + extra + 1)
    w[-1] = np.log(goal.mean() / (1 - goal.mean()))
    ahead, pace = w.copy(), 1.0
    for _ in range(steps):
        miss = expit(np.bincount(owner, ahead[:size][ids], n) + earlier @ ahead[size:-1] + ahead[-1]) - goal
        slope = np.concatenate((np.bincount(ids, miss[owner], size), earlier.T @ miss, [miss.sum()]))
        slope[:-1] += ridge * ahead[:-1]
        new = ahead - step * slope
        if slope @ (new - w) > 0:  # the momentum leads uphill
            pace = 1.0
        grown = (1 + np.sqrt(1 + 4 * pace * pace)) / 2
        ahead, w, pace = new + (pace - 1) / grown * (new - w), new, grown
    return Linear(float(w[-1]), w[:size], w[size:-1])


def best_limit(found: np.ndarray, goal: np.ndarray) -> float:
    """The probability that parts the rows with the highest F1, half way to the next row below, within 0.1 and 0.9; 0.5 if classes lack."""
    if not 0 < goal.sum() < len(goal):
        return 0.5
    order = np.argsort(-found, kind="stable")
    hits = np.cumsum(goal[order])
    f1 = 2 * hits / (np.arange(1, len(goal) + 1) + goal.sum())
    at = int(np.argmax(f1))
    below = found[order[at + 1]] if at + 1 < len(goal) else 0.0
    return float(np.clip((found[order[at]] + below) / 2, 0.1, 0.9))


def fit_chain(
    rows: list[list[int]], goals: np.ndarray, fold: np.ndarray, size: int, folds: int = FOLDS
) -> tuple[list[Linear], list[float]]:
    """One model per column of `goals`, each after the first on out-of-fold probabilities of those before.

    The limits are those that part the out-of-fold probabilities best.
    """
    sizes = np.fromiter(map(len, rows), np.int64, len(rows))
    ids = np.fromiter((i for r in rows for i in r), np.int64, int(sizes.sum()))
    n = len(rows)
    owner = np.repeat(np.arange(n), sizes)
    held_out = np.zeros((n, 0))
    models: list[Linear] = []
    for k in range(goals.shape[1]):
        models.append(fit_linear(ids, owner, held_out, goals[:, k], size))
        fresh = np.zeros(n)
        for f in range(folds):
            seen, here = fold != f, fold == f
            renumbered = np.cumsum(seen) - 1
            use = seen[owner]
            one = fit_linear(ids[use], renumbered[owner[use]], held_out[seen], goals[seen, k], size)
            logit = one.bias + np.bincount(owner, one.of_feature[ids], n) + held_out @ one.of_earlier
            fresh[here] = expit(logit)[here]
        held_out = np.column_stack((held_out, fresh))
    return models, [best_limit(held_out[:, k], goals[:, k]) for k in range(goals.shape[1])]


def train(
    docs: DataFrame,
    labels: DataFrame,
    categories: Sequence[str],
    key: str = "doc_id",
    text: str = "text",
    sample_rows: int = SAMPLE_ROWS,
    size: int = FEATURES,
) -> Chain:
    """A chain for the 0/1 columns `categories` of `labels`, in their order.

    Of several labels of an id the largest counts; null labels, null ids and
    labels without a document are left out. Of several documents of an id one
    counts, the text with the smallest hash, so the sample has no more rows than
    ids were drawn. Texts of any length are read whole. Without labels every
    probability is one half and no row is rejected.
    """
    spark = docs.sparkSession
    once = (
        labels.where(quoted(key).isNotNull())
        .groupBy(quoted(key).alias("id"))
        .agg(*[F.max(quoted(c).cast("int")).alias(f"c{i}") for i, c in enumerate(categories)])
        .dropna()
        .withColumn("draw", F.pmod(F.xxhash64("id", F.lit("draw")), F.lit(1 << 30)))
    )
    share = min(1.0, sample_rows / max(1, once.count()))
    # At most about `sample_rows` short rows.
    drawn = F.broadcast(once.where(F.col("draw") < int(share * (1 << 30))))
    goals = [f"c{i}" for i in range(len(categories))]
    sample = saved(
        docs.select(quoted(key).alias("id"), quoted(text).cast("string").alias("text"))
        .join(drawn, "id")
        .withColumns({"hash": F.xxhash64("text"), "row": F.monotonically_increasing_id()}),
        "toxic-sample",
    )
    # One row per drawn id; texts are not shuffled.
    one = sample.groupBy("id").agg(F.min(F.struct("hash", "row"))["row"].alias("row")).select("row")
    sample = sample.join(F.broadcast(one), "row").select("text", "draw", *goals)

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows with each feature, in all and by category; summed in a task first."""
        for batch in batches:
            every: Counter[bytes] = Counter()
            by = [Counter() for _ in goals]
            told = [batch.column(2 + i).to_pylist() for i in range(len(goals))]
            for n, t in enumerate(batch.column(0).to_pylist()):
                found = features(t)
                every.update(found)
                for c, values in zip(by, told, strict=True):
                    if values[n]:
                        c.update(found)
            names = list(every)
            columns = [pa.array(names, pa.binary()), pa.array([every[x] for x in names], pa.int64())]
            columns += [pa.array([c[x] for x in names], pa.int64()) for c in by]
            yield pa.RecordBatch.from_arrays(columns, names=["feature", "n", *goals])
            batch = every = by = names = columns = None
        give_back()

    total = sample.agg(F.count(F.lit(1)).alias("n"), *[F.sum(g).alias(g) for g in goals]).first()
    if not total.n:
        return Chain(list(categories), {}, [Linear(0.0, np.zeros(0), np.zeros(k)) for k in range(len(goals))], [0.95] * len(goals))
    counts = (
        sample.mapInArrow(tally, ", ".join(["feature binary", "n long", *(f"{g} long" for g in goals)]))
        .groupBy("feature")
        .agg(F.sum("n").alias("n"), *[F.sum(g).alias(g) for g in goals])
        .where(F.col("n") >= LEAST_ROWS)
    )
    # How far a feature's share of a category is from the category's own, in standard deviations.
    scores = [
        F.abs(F.col(g) - F.col("n") * (total[g] / total.n)) / F.sqrt(F.col("n") * ((total[g] + 1) / (total.n + 2)) * (1 - total[g] / (total.n + 2)))
        for g in goals
    ]
    best = counts.withColumn("score", F.greatest(*scores) if len(scores) > 1 else scores[0]).orderBy(F.desc("score"), "feature").limit(size)
    index = {bytes(r.feature): i for i, r in enumerate(best.select("feature").collect())}
    known = spark.sparkContext.broadcast(Chain(list(categories), index, [], []))

    def rows_of(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [known.value.row(t) for t in batch.column(0).to_pylist()]
        return pa.RecordBatch.from_arrays(
            [pa.array(rows, pa.list_(pa.int32())), *[batch.column(i) for i in range(1, batch.num_columns)]], names=["row", "draw", *goals]
        )

    got = sample.mapInArrow(in_slices(rows_of), ", ".join(["row array<int>", "draw long", *(f"{g} int" for g in goals)])).collect()
    got.sort(key=lambda r: (r.draw, r.row))
    goal = np.array([[r[g] for g in goals] for r in got], float)
    models, limits = fit_chain([r.row for r in got], goal, np.array([r.draw % FOLDS for r in got]), len(index))
    return Chain(list(categories), index, models, limits)


def score(docs: DataFrame, chain: Chain, text: str = "text") -> tuple[DataFrame, list[str]]:
    """`docs` with the probability of each category in a column named p_<category>; their names are returned.

    Every row is scored by its whole text. A null or empty text has no words, so
    its probabilities are those the models give to no evidence. Repeated rows,
    null ids and other columns stay as they are.
    """
    names = [free_name(docs.columns, f"p_{c}") for c in chain.categories]
    schema = T.StructType([*docs.schema.fields, *[T.StructField(n, T.DoubleType()) for n in names]])
    known = docs.sparkSession.sparkContext.broadcast(chain)
    at = docs.columns.index(text)

    def convert(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = known.value.probabilities(batch.column(at).to_pylist())
        return pa.RecordBatch.from_arrays([*batch.columns, *[pa.array(found[:, k]) for k in range(len(names))]], names=schema.names)

    return docs.mapInArrow(in_slices(convert), schema), names


def without_toxic(
    docs: DataFrame, labels: DataFrame, categories: Sequence[str], reject: str, limit: float | None = None, text: str = "text"
) -> DataFrame:
    """The rows of `docs` whose probability of `reject` is under `limit`, the fitted one by default."""
    chain = train(docs, labels, categories, text=text)
    scored, names = score(docs, chain, text)
    at = list(categories).index(reject)
    return scored.where(quoted(names[at]) < (chain.limits[at] if limit is None else limit)).select(*[quoted(c) for c in docs.columns])
