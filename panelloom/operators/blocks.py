"""Ordered computations over series that may be too long for one task.

A plain `Window.partitionBy(series).orderBy(ts)` sends a whole series to one task.  Here a
series is cut into blocks, a block is the unit of shuffling, and what must cross a block border
travels in a small table with one row per block:

* `rank_in_order`  - positions: rows per block, prefix-summed over the block table;
* `fill`           - forward/backward fill: first and last known value of each block;
* `running`        - cumulative sum/product: block totals, exclusively accumulated;
* `over_halo`      - bounded frames (lag, moving average, samples): each block also receives
                     copies of the few rows just outside of it.

Only the block table (rows / block length) is ever ordered per series.  It is computed from the
same input as the rows, which Spark evaluates once for each: `stage` an expensive input first.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from panelloom.functions.timeaxis import epoch_seconds, time_block

BLOCK_ROWS = 65_536
TASK_ROWS = 1_000_000


def rank_in_order(
    df: DataFrame,
    *,
    keys: Sequence[str],
    blocks: Sequence[str],
    order: Sequence[str],
    name: str = "idx",
    total: str | None = None,
) -> DataFrame:
    """0-based position of each row in (`blocks`, `order`) order within `keys`.

    `blocks` are columns that coarsen the order, from coarse to fine; (`keys`, `blocks`, `order`)
    must be unique.  Offsets are summed level by level, so ordering the finest blocks happens
    inside one coarser block.  `total` adds the number of rows per key.
    """
    cell = [*keys, *blocks]
    table = df.groupBy(*cell).agg(F.count(F.lit(1)).alias("_cnt"))
    offset = F.lit(0).cast("bigint")
    for depth in range(len(blocks)):
        outer = [*keys, *blocks[:depth]]
        level = table.groupBy(*outer, blocks[depth]).agg(F.sum("_cnt").alias("_cnt")) if depth + 1 < len(blocks) else table
        w = W.partitionBy(*outer)
        before = w.orderBy(blocks[depth]).rowsBetween(W.unboundedPreceding, -1)
        cols = [F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias(f"_off{depth}")]
        if total and depth == 0:
            cols.append(F.sum("_cnt").over(w).alias(total))
        step = level.select(*outer, blocks[depth], *cols)
        offsets = step if depth == 0 else step.join(offsets, outer)
        offset = offset + F.col(f"_off{depth}")
    in_block = W.partitionBy(*cell).orderBy(*order)
    placed = offsets.select(*cell, offset.alias("_off"), *([total] if total else []))
    return (
        df.join(placed, cell)
        .withColumn(name, F.col("_off") + F.row_number().over(in_block) - 1)
        .drop("_off")
    )


def range_blocks(df: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """Number of the range of `order` that a row falls into, cut from samples of the data itself.

    Ranges hold about equally many rows whatever the values look like.  `stage` the result: the cuts are
    drawn when the plan runs.
    """
    return df.repartitionByRange(*order).withColumn(name, F.spark_partition_id())


def block_seconds(df: DataFrame, ts: str, series: str | None = None) -> Column:
    """Block length at which the longest series has about `TASK_ROWS` rows per block.

    A scalar subquery over two columns; it only balances the work, any length gives the same result.
    """
    sec = epoch_seconds(F.col(ts))
    per = df.groupBy(*([series] if series else [])).agg(F.count(F.lit(1)).alias("n"), F.min(sec).alias("lo"), F.max(sec).alias("hi"))
    span = F.max("hi") - F.min("lo") + 1
    return per.agg(F.greatest(F.ceil(span * TASK_ROWS / F.max("n")), F.lit(1)).cast("bigint")).scalar()


def position(
    df: DataFrame,
    *,
    series: str = "series",
    ts: str = "ts",
    name: str = "idx",
    total: str | None = None,
    width: int | None = None,
) -> DataFrame:
    """0-based position of a row in its series; `width` fixes the block length in seconds.

    Rows without a time or a series have no position: they are left out and do not count.
    """
    df = df.where(F.col(ts).isNotNull() & F.col(series).isNotNull())
    seconds = block_seconds(df, ts, series) if width is None else F.lit(width)
    cut = df.withColumn("_tb", time_block(F.col(ts), seconds))
    return rank_in_order(cut, keys=[series], blocks=["_tb"], order=[ts], name=name, total=total).drop("_tb")


def known_neighbours(
    df: DataFrame,
    cols: Sequence[str],
    *,
    series: str = "series",
    idx: str = "idx",
    back: bool = True,
    ahead: bool = False,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Add `_prev_<i>` / `_next_<i>`: struct (i, v) of the nearest known value before / after a row.

    The row itself does not count.  Within a block this is a running window; across blocks the
    first and last known value of each block are carried through the block table.
    """
    home = df.withColumn("_blk", F.expr(f"{idx} div {block_rows}"))
    known = [F.when(F.col(c).isNotNull(), F.struct(F.col(idx).alias("i"), F.col(c).alias("v"))) for c in cols]
    sides = [("_prev", F.max, "asc")] * back + [("_next", F.min, "desc")] * ahead

    # looking ahead is looking back in descending order: a frame that ends with the partition
    # would be evaluated anew for every row
    def earlier(by: str, direction: str, *keys: str) -> WindowSpec:
        order = getattr(F.col(by), direction)()
        return W.partitionBy(*keys).orderBy(order).rowsBetween(W.unboundedPreceding, -1)

    edges = home.groupBy(series, "_blk").agg(
        *[pick(k).alias(f"{side}_{i}") for side, pick, _ in sides for i, k in enumerate(known)]
    )
    carry = edges.select(
        series,
        "_blk",
        *[F.last(f"{side}_{i}", True).over(earlier("_blk", d, series)).alias(f"{side}_{i}")
          for side, _, d in sides for i in range(len(cols))],
    )
    nearest = {
        f"{side}_{i}": F.coalesce(F.last(k, True).over(earlier(idx, d, series, "_blk")), F.col(f"{side}_{i}"))
        for side, _, d in sides for i, k in enumerate(known)
    }
    return home.join(carry, [series, "_blk"]).select(*df.columns, *[c.alias(n) for n, c in nearest.items()])


def fill(
    df: DataFrame,
    cols: Sequence[str],
    *,
    series: str = "series",
    idx: str = "idx",
    forward: int | None = 0,
    backward: int | None = 0,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Carry the last known value forward, then the next one backward.

    `forward` / `backward` bound the distance in rows; None is unbounded, 0 is off.
    The filled rows of the forward pass sit behind an original value, so the backward pass
    reaches the same next original value whether or not the forward pass ran first; both use
    one block table and one shuffle.
    """
    near = known_neighbours(df, cols, series=series, idx=idx, back=forward != 0, ahead=backward != 0, block_rows=block_rows)
    filled = {}
    for i, c in enumerate(cols):
        options = [F.col(c)]
        if forward != 0:
            options.append(_within(F.col(f"_prev_{i}"), F.col(idx) - F.col(f"_prev_{i}.i"), forward))
        if backward != 0:
            options.append(_within(F.col(f"_next_{i}"), F.col(f"_next_{i}.i") - F.col(idx), backward))
        filled[c] = F.coalesce(*options)
    return near.select(*[filled[c].alias(c) if c in filled else F.col(c) for c in df.columns])


def _within(found: Column, distance: Column, limit: int | None) -> Column:
    return found["v"] if limit is None else F.when(distance <= limit, found["v"])


def running(
    df: DataFrame,
    *,
    value: Column,
    name: str,
    how: str = "sum",
    series: str = "series",
    idx: str = "idx",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Cumulative sum, product or min of `value` along a series, the current row included."""
    fold = {"sum": F.sum, "product": F.product, "min": F.min}[how]
    join2 = {
        "sum": lambda a, b: F.coalesce(a, F.lit(0)) + b,
        "product": lambda a, b: F.coalesce(a, F.lit(1.0)) * b,
        "min": F.least,
    }[how]
    home = df.withColumn("_blk", F.expr(f"{idx} div {block_rows}")).withColumn("_v", value)
    totals = home.groupBy(series, "_blk").agg(fold("_v").alias("_t"))
    earlier = W.partitionBy(series).orderBy("_blk").rowsBetween(W.unboundedPreceding, -1)
    carry = totals.select(series, "_blk", fold("_t").over(earlier).alias("_carry"))
    w = W.partitionBy(series, "_blk").orderBy(idx).rowsBetween(W.unboundedPreceding, 0)
    return (
        home.join(carry, [series, "_blk"])
        .withColumn(name, join2(F.col("_carry"), fold("_v").over(w)))
        .drop("_blk", "_v", "_carry")
    )


def over_halo(
    df: DataFrame,
    exprs: dict[str, Callable[[WindowSpec], Column]],
    *,
    before: int = 0,
    after: int = 0,
    keep: Callable[[Column], Column] | None = None,
    series: str | Sequence[str] = "series",
    idx: str = "idx",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Evaluate window expressions that look at most `before` rows back and `after` rows ahead.

    Each callable gets a WindowSpec ordered by position.  Rows near a block border are copied to
    the neighbour block, and the copies are dropped after the windows ran.
    """
    keys = [series] if isinstance(series, str) else list(series)
    size = max(block_rows, before, after)
    pos, blk = F.col(idx), F.expr(f"{idx} div {size}")
    offset = F.pmod(pos, F.lit(size))
    homes = [blk]
    if before:
        homes.append(F.when(offset >= size - before, blk + 1))
    if after:
        homes.append(F.when(offset < after, blk - 1))
    spread = df.withColumn("_home", blk).withColumn("_blk", F.explode(F.array_compact(F.array(*homes))))
    w = W.partitionBy(*keys, "_blk").orderBy(idx)
    out = spread.select("*", *[make(w).alias(name) for name, make in exprs.items()])
    return out.filter(F.col("_blk") == F.col("_home")).drop("_blk", "_home")


def lookup(fact: DataFrame, dim: DataFrame, on: Sequence[str], *, how: str = "inner") -> DataFrame:
    """Join per-series parameters (one row per key) to rows.

    Which keys are hot, and whether the small side may be broadcast, is decided by adaptive execution
    from the sizes that the shuffle has: it splits the rows of a large partition over tasks and copies
    only the parameters that these need, so a panel of many short series is not copied at all.
    """
    return fact.join(dim, list(on), how)


HOT_SHARE = 64


def lookup_weighted(fact: DataFrame, dim: DataFrame, on: str, *, weight: str, spread_by: str) -> DataFrame:
    """Left join to a dimension that may be about as large as the rows, with `weight` rows per key.

    Only keys with more than 1/64 of all rows are salted.  There are at most 64 of them by
    arithmetic, so marking them is a broadcast of a bounded table, and the dimension grows by at
    most 64 * 64 rows.
    """
    total = dim.agg(F.sum(weight)).scalar()
    is_hot = F.col(weight) * HOT_SHARE > F.col("_total")
    sized = dim.withColumn("_total", total)
    hot = sized.filter(is_hot).select(on, F.lit(True).alias("_hot"))
    salts = F.when(is_hot, F.sequence(F.lit(0), F.lit(HOT_SHARE - 1))).otherwise(F.array(F.lit(0)))
    copies = sized.withColumn("_salt", F.explode(salts)).drop(weight, "_total")
    salt = F.when(F.col("_hot"), F.pmod(F.xxhash64(spread_by), F.lit(HOT_SHARE)).cast("int")).otherwise(0)
    salted = fact.join(F.broadcast(hot), on, "left").withColumn("_salt", salt).drop("_hot")
    return salted.join(copies, [on, "_salt"], "left").drop("_salt")
