"""Skew-safe building blocks against plain ones, with one key owning a third of the rows."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from varigrove.operators import joins


@pytest.fixture(scope="module")
def crowded(spark):
    """3,000 rows; key 7 owns a third, some keys are null."""
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") % 200)
    return spark.range(3000).select("id", key.cast("long").alias("k")).cache()


@pytest.fixture(scope="module")
def lookup(spark):
    """Keys 0..99, key 7 twice."""
    return spark.range(100).unionByName(spark.range(7, 8)).select(F.col("id").alias("k"), F.rand(1).alias("v"))


def content(df):
    return sorted(map(tuple, df.select(sorted(df.columns)).collect()), key=str)


def test_hot_keys_are_few(crowded):
    assert [r.k for r in joins.hot_keys(crowded, ["k"], 0.1).collect()] == [7]
    assert joins.hot_keys(crowded, ["id"], 0.01).count() == 0


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join(crowded, lookup, how):
    assert content(joins.salted_join(crowded, lookup, ["k"], how)) == content(crowded.join(lookup, "k", how))


def test_salts_spread_the_hot_key(crowded):
    hot = joins.hot_keys(crowded, ["k"])
    salt = F.pmod(F.xxhash64("id", "k"), F.lit(16))
    sizes = crowded.join(hot, "k").groupBy("k", salt).count().where("k = 7").toPandas()["count"]
    assert len(sizes) == 16 and sizes.max() < 2 * sizes.mean()


def test_salted_join_rejects_outer(crowded, lookup):
    with pytest.raises(ValueError):
        joins.salted_join(crowded, lookup, ["k"], "full")


@pytest.mark.parametrize(("finest", "coarsest"), [(0, 0), (0, 6), (0, 28), (3, 9), (10, 28)])
def test_interval_join(spark, finest, coarsest):
    rng = np.random.default_rng(1)
    start = rng.integers(0, 500, 300)
    stop = start + np.where(rng.random(300) < 0.1, 90_000, rng.integers(-2, 90, 300))
    intervals = pd.DataFrame({"c": rng.choice(["a", "b"], 300), "i": range(300), "start": start, "stop": stop})
    points = pd.DataFrame({"c": rng.choice(["a", "b"], 200), "p": np.r_[rng.integers(0, 600, 150), rng.integers(0, 99_999, 50)]}).drop_duplicates()
    if finest == coarsest == 0:
        intervals = intervals[intervals.stop - intervals.start < 100]
    got = joins.interval_join(spark.createDataFrame(intervals), spark.createDataFrame(points), "c", "start", "stop", "p", finest, coarsest)
    want = intervals.merge(points, on="c").query("start <= p <= stop")
    assert sorted((r.i, r.p) for r in got.collect()) == sorted(zip(want["i"], want["p"]))


def test_a_long_interval_is_in_few_bins(spark):
    """A block of 50 Mb is fewer than 20 rows before it meets points."""
    block = spark.createDataFrame([("c", 1, 50_000_000)], "c string, start long, stop long")
    points = spark.createDataFrame([("c", n * 1000) for n in range(1, 101)] + [("c", 50_000_001), ("d", 5)], "c string, p long")
    met = joins.interval_join(block, points, "c", "start", "stop", "p")
    assert met.count() == 100
    tree = met._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate explode" in tree
    bins = block.select(F.size(F.sequence(F.shiftright("start", 22), F.shiftright("stop", 22)))).first()[0]
    assert bins < 20


@pytest.mark.parametrize("passes", [(), (2, 5), (10, 26)])
@pytest.mark.parametrize("by", [[], ["g"]])
def test_exact_quantiles(spark, by, passes):
    rng = np.random.default_rng(2)
    pdf = pd.DataFrame({"g": rng.choice(["x", "y"], 4000, p=[0.9, 0.1]), "v": np.round(rng.lognormal(0, 2, 4000), 2)})
    pdf.loc[::3, "v"] = 1.5  # a third of the values are equal
    probs = {"a": 0.0, "b": 0.005, "c": 0.5, "d": 0.77, "e": 0.995, "f": 1.0}
    got = joins.exact_quantiles(spark.createDataFrame(pdf), "v", probs, by, passes).toPandas()
    groups = dict(list(pdf.groupby("g"))) if by else {None: pdf}
    assert len(got) == len(groups)
    for _, row in got.iterrows():
        want = np.quantile(groups[row["g"] if by else None]["v"], list(probs.values()))
        assert np.allclose([row[k] for k in probs], want, atol=1e-8)


def test_quantiles_of_all_kinds_of_numbers(spark):
    """Signs, zeros, neighbours in the last bit, the smallest and the largest doubles, infinity."""
    one = 1.0
    values = [-np.inf, -1e300, -2.5, -one, -np.nextafter(one, 0), -5e-324, 0.0, 5e-324, 1e-300, np.nextafter(one, 0), one, np.nextafter(one, 2)]
    values += [2.0 - 2**-52, 2.0, 3.0, 7.999999999999999, 8.0, 1e308, np.inf]
    df = spark.createDataFrame([(float(v),) for v in values for _ in range(3)], "v double")
    probs = {f"p{i}": i / (3 * len(values) - 1) for i in range(0, 3 * len(values), 2)}
    got = joins.exact_quantiles(df, "v", probs).first()
    ranked = sorted(v for v in values for _ in range(3))
    for i in range(0, 3 * len(values), 2):
        at = probs[f"p{i}"] * (3 * len(values) - 1)
        low, high = ranked[int(np.floor(at))], ranked[int(np.ceil(at))]
        assert got[f"p{i}"] == low if low == high else low <= got[f"p{i}"] <= high
    assert joins.exact_quantiles(df.where("false"), "v", probs).collect() == []


def test_quantiles_plan_without_jobs(spark):
    """Nothing runs while the plan is built, and all passes read the same counts."""
    df = spark.range(1000).selectExpr("cast(id as double) as v", "id % 3 as g")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("plan", "plan")
    joins.exact_quantiles(df, "v", {"a": 0.25, "b": 0.75}, ["g"])
    assert not tracker.getJobIdsForGroup("plan")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_quantiles_of_one_and_two_values(spark):
    for values, want in (([4.0], 4.0), ([1.0, 2.0], 1.25)):
        df = spark.createDataFrame([(v,) for v in values], "v double")
        assert joins.exact_quantiles(df, "v", {"q": 0.25}).first().q == want


def test_quantiles_keep_null_groups_and_every_digit(spark):
    values = [1 / 3, 2 / 3, 1.0, 4 / 3, 5 / 3]
    df = spark.createDataFrame([(g, v) for g in (None, "x") for v in values], "g string, v double")
    got = {r.g: (r.lo, r.hi) for r in joins.exact_quantiles(df, "v", {"lo": 0.0, "hi": 1.0}, ["g"]).collect()}
    assert got == {None: (1 / 3, 5 / 3), "x": (1 / 3, 5 / 3)}


def test_checkpoint_folder_of_the_session_is_used(spark):
    from varigrove import session

    session.ensure_checkpoint_dir(spark)
    before = spark.sparkContext.getCheckpointDir()
    session.ensure_checkpoint_dir(spark)
    assert spark.sparkContext.getCheckpointDir() == before
