"""Blocked operators give what a plain window over the whole series gives, whatever the block size."""

import numpy as np
import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from panelloom.functions.timeaxis import DAY
from panelloom.operators import blocks, quantiles, scale
from tests.helpers import by_series, panel, skewed


@pytest.mark.parametrize("size", [1, 3, 16, 1000])
@pytest.mark.parametrize("limits", [(None, 0), (2, 0), (0, 2), (3, 2), (None, None)])
def test_fill_matches_whole_series_windows(spark, size, limits):
    forward, backward = limits
    df = panel(spark, skewed())
    w = W.partitionBy("series").orderBy("idx")
    fwd = w.rowsBetween(W.unboundedPreceding if forward is None else -forward, 0)
    bwd = w.rowsBetween(0, W.unboundedFollowing if backward is None else backward)
    want = df.withColumn("y", F.last("y", True).over(fwd)).withColumn("y", F.first("y", True).over(bwd))
    got = blocks.fill(df, ["y"], forward=forward, backward=backward, block_rows=size)
    assert by_series(got, "y") == by_series(want, "y")


@pytest.mark.parametrize("days", [None, 1, 5, 366])
def test_position(spark, days):
    df = panel(spark, skewed()).drop("idx", "n").withColumn("y", F.rand(1)).filter("y < 0.7")
    w = W.partitionBy("series").orderBy("ts")
    want = df.withColumn("idx", F.row_number().over(w) - 1).withColumn("n", F.count("*").over(W.partitionBy("series")))
    got = blocks.position(df.cache(), total="n", width=days and days * DAY)
    key = lambda d: sorted(map(tuple, d.select("series", "ts", "idx", "n").collect()))
    assert key(got) == key(want)


@pytest.mark.parametrize("size", [1, 4, 1000])
@pytest.mark.parametrize("how", ["sum", "product", "min"])
def test_running(spark, size, how):
    data = skewed(1, gaps=0)
    got = by_series(blocks.running(panel(spark, data), value=F.col("y"), name="r", how=how, block_rows=size), "r")
    fold = {"sum": np.cumsum, "product": np.cumprod, "min": np.minimum.accumulate}[how]
    for s, vs in data.items():
        np.testing.assert_allclose(got[s], fold(np.array(vs)), rtol=1e-12)


@pytest.mark.parametrize("size", [2, 5, 1000])
def test_halo_windows(spark, size):
    df = panel(spark, skewed(2))
    exprs = {
        "lag3": lambda w: F.lag("y", 3).over(w),
        "lead2": lambda w: F.lead("y", 2).over(w),
        "mean": lambda w: F.round(F.avg("y").over(w.rowsBetween(-3, 2)), 9),
    }
    w = W.partitionBy("series").orderBy("idx")
    want = df.select("*", *[make(w).alias(n) for n, make in exprs.items()])
    got = blocks.over_halo(df, exprs, before=3, after=2, block_rows=size)
    assert got.count() == df.count()
    for name in exprs:
        assert by_series(got, name) == by_series(want, name)


def test_no_task_gets_a_whole_hot_series(spark):
    """Every window over rows partitions by block, none by series alone."""
    df = panel(spark, skewed())
    plan = blocks.fill(df, ["y"], forward=5, backward=5, block_rows=8)._jdf.queryExecution().optimizedPlan().toString()
    row_windows = [line for line in plan.splitlines() if "Window" in line and "idx" in line]
    assert row_windows and all("_blk" in line for line in row_windows)


def test_lookups_keep_every_row(spark):
    df = panel(spark, skewed())
    dim = df.groupBy("series").agg(F.count(F.lit(1)).alias("rows"), F.max("y").alias("top"))
    plain = sorted(map(tuple, df.join(dim.drop("rows"), "series").select("series", "idx", "top").collect()))
    salted = blocks.lookup(df, dim.drop("rows"), ["series"])
    weighted = blocks.lookup_weighted(df, dim, "series", weight="rows", spread_by="ts")
    assert sorted(map(tuple, salted.select("series", "idx", "top").collect())) == plain
    assert sorted(map(tuple, weighted.select("series", "idx", "top").collect())) == plain


@pytest.mark.parametrize("width", [None, DAY, 10 * DAY])
def test_time_rank_and_factorize(spark, width):
    df = panel(spark, skewed()).withColumn("label", F.when(F.col("y") > 8, F.round("y").cast("string")))
    ranks = {r.ts: r.t for r in scale.time_rank(df, "ts", name="t", ranks=scale.time_ranks(df, "ts", width=width)).collect()}
    assert [ranks[t] for t in sorted(ranks)] == list(range(1, len(ranks) + 1))
    codes = scale.value_codes(df, "label")
    coded = scale.factorize(df, "label", name="code", codes=codes).orderBy("series", "ts").collect()
    seen: dict = {}
    for r in coded:
        want = -1 if r.label is None else seen.setdefault(r.label, len(seen))
        assert r.code == want


@pytest.mark.parametrize("accuracy, margin", [(1000, 3), (10, 0)])
@pytest.mark.parametrize("n", [1, 2, 7, 30_000])
def test_exact_quantiles(spark, n, accuracy, margin, monkeypatch):
    # a coarse sketch whose brackets hold their ranks, and one whose brackets are single values that often do not
    monkeypatch.setattr(quantiles, "ACCURACY", accuracy)
    monkeypatch.setattr(quantiles, "MARGIN", margin)
    qs = [0.01, 0.25, 0.5, 0.9, 0.99]
    rng = np.random.default_rng(n)
    values = np.where(rng.random(n) < 0.4, 5.0, np.round(np.exp(rng.normal(0, 3, n)), 2))  # heavy tail, many ties
    df = spark.createDataFrame([("g", float(v)) for v in values], "series string, v double")
    got = {r.q: r.v for r in quantiles.exact_quantiles(df, qs, keys=["series"], value="v").collect()}
    np.testing.assert_allclose([got[q] for q in qs], np.quantile(values, qs), rtol=1e-12)


@pytest.mark.parametrize("brackets, way", [(100_000, "BroadcastHashJoin"), (0, "ShuffledHashJoin")])
def test_quantiles_do_not_sort_rows(spark, brackets, way, monkeypatch):
    """Where Spark's estimate of the sketch rules out a broadcast, the rows of a group were sorted in one task."""
    monkeypatch.setattr(quantiles, "BRACKETS", brackets, raising=False)
    plans, plain = [], quantiles.lookup

    def seen(*args):
        joined = plain(*args)
        plans.append(joined._jdf.queryExecution().executedPlan().toString())
        return joined

    monkeypatch.setattr(quantiles, "lookup", seen)
    df = spark.createDataFrame([(f"g{k % 3}", float(k)) for k in range(300)], "series string, v double")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = {(r.series, r.q): r.v for r in quantiles.exact_quantiles(df, [0.5], keys=["series"], value="v").collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert got == {("g0", 0.5): 148.5, ("g1", 0.5): 149.5, ("g2", 0.5): 150.5}
    assert plans and all(way in p and "SortMergeJoin" not in p for p in plans)
