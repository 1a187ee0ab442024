"""Exact quantiles of groups too large for one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from panelloom.operators.blocks import lookup
from panelloom.sources.sinks import stage

ACCURACY = 20_000  # ranks of the sketch are off by at most one part in this many
MARGIN = 3  # a bracket reaches so many times that far on both sides
BRACKETS = 100_000  # up to so many, all groups together, are copied to every task


def exact_quantiles(df: DataFrame, qs: Sequence[float], *, keys: Sequence[str], value: str) -> DataFrame:
    """(keys, q, value) by linear interpolation between order statistics, the same way for groups of any size.

    A sketch brackets every quantile by two values.  Values below the bracket are only counted; those inside are
    counted by value and ordered, some 2 * MARGIN / ACCURACY of a group and the copies of values.  The counts tell whether a bracket holds its ranks; if
    one does not, its quantile is found among all values on the side where the ranks must be, again counted by value.
    The rows are never sorted: they meet their brackets in a broadcast, or in hash tables of the groups if there are many.
    """
    keys, margin = list(keys), MARGIN / ACCURACY
    rows = df.filter(F.col(value).isNotNull()).select(*keys, F.col(value).cast("double").alias("v"))
    shares = F.array(*[F.lit(max(q - margin, 0.0)) for q in qs], *[F.lit(min(q + margin, 1.0)) for q in qs])
    sketch = rows.groupBy(*keys).agg(
        F.percentile_approx("v", shares, ACCURACY).alias("cuts"), F.count(F.lit(1)).alias("n"), F.min("v").alias("least"),
        F.max("v").alias("most"),
    )
    table = F.array(*[
        F.struct(
            F.lit(float(q)).alias("q"),
            (F.col("least") if q <= margin else F.col("cuts")[i]).alias("lo"),
            (F.col("most") if q >= 1 - margin else F.col("cuts")[len(qs) + i]).alias("hi"),
            (F.lit(float(q)) * (F.col("n") - 1)).alias("at"),
        ) for i, q in enumerate(qs)
    ])
    sketch = stage(sketch.select(*keys, "least", "most", table.alias("brackets")))
    way = "broadcast" if sketch.count() * len(qs) <= BRACKETS else "shuffle_hash"
    found = stage(_between(rows, sketch, keys, len(qs), way))  # a row for every group and quantile
    # at the ends of a group there is nothing beyond a bracket, so a rank that is not inside lies on one side
    missed = found.filter("v is null").select(*keys, F.struct(
        "q", F.when(F.col("side") < 0, F.col("least")).otherwise(F.col("lo")).alias("lo"),
        F.when(F.col("side") > 0, F.col("most")).otherwise(F.col("hi")).alias("hi"), "at").alias("b"), "least", "most")
    if missed.isEmpty():
        return found.select(*keys, "q", F.col("v").alias(value))
    wider = missed.groupBy(*keys).agg(F.first("least").alias("least"), F.first("most").alias("most"), F.collect_list("b").alias("brackets"))
    again = _between(rows, wider, keys, len(qs), way)
    return found.filter("v is not null").unionByName(again).select(*keys, "q", F.col("v").alias(value))


def _between(rows: DataFrame, brackets: DataFrame, keys: list[str], most: int, way: str) -> DataFrame:
    """(keys, least, most, q, lo, hi, at, v, side): order statistics at the ranks around `at`, from the values inside the brackets.

    `brackets` has (keys, least, most, brackets) with at most `most` brackets.  v is null where a rank is not inside; it is below the bracket
    for a negative `side`, above it for a positive one, on both sides for 0.  `way` is how rows are joined to brackets.
    """
    placed = lookup(rows, brackets.select(*keys, "brackets").hint(way), keys).filter(F.col("brackets").isNotNull())
    below = placed.groupBy(*keys).agg(*[F.count_if(F.col("v") < F.get("brackets", F.lit(i))["lo"]).alias(f"b{i}") for i in range(most)])
    each = brackets.select(*keys, "least", "most", F.posexplode("brackets").alias("_i", "_b")).select(*keys, "least", "most", "_i", "_b.*")
    each = each.join(below, keys).withColumn("below", F.element_at(F.array(*[F.col(f"b{i}") for i in range(most)]), F.col("_i") + 1))
    inside = placed.withColumn("b", F.explode(F.filter("brackets", lambda b: F.col("v").between(b["lo"], b["hi"]))))
    counted = inside.groupBy(*keys, "b.q", "v").agg(F.count(F.lit(1)).alias("c"))
    upto = F.col("below") + F.sum("c").over(W.partitionBy(*keys, "q").orderBy("v"))
    columns = [*keys, "least", "most", "q", "lo", "hi", "at"]
    ranked = counted.join(each.select(*columns, "below"), [*keys, "q"], "right").withColumn("upto", upto)

    def at_rank(r):
        # a value holds the ranks upto - c .. upto - 1
        return F.max(F.when((F.col("upto") - F.col("c") <= r) & (r < F.col("upto")), F.col("v")))

    low, high = F.floor("at"), F.ceil("at")
    found = ranked.groupBy(*columns).agg(at_rank(low).alias("a"), at_rank(high).alias("z"), F.min("below").alias("below"), F.max("upto").alias("upto"))
    under, over = F.col("below") > low, F.coalesce("upto", "below") <= high
    return found.select(*columns, (F.col("a") + (F.col("z") - F.col("a")) * (F.col("at") % 1)).alias("v"),
                        F.when(under & over, 0).when(under, -1).otherwise(1).alias("side"))
