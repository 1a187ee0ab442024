"""Put sources on one time axis and one panel: grids, as-of fills, joins, unions (J*, U*, F18)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelloom.functions.timeaxis import DAY, epoch_seconds, floor_to, from_epoch, next_steps, time_block
from panelloom.operators import blocks


def time_grid(
    df: DataFrame,
    *,
    series: str = "series",
    ts: str = "ts",
    step: int = DAY,
    bounds: str = "global",
    block_rows: int = blocks.BLOCK_ROWS,
) -> DataFrame:
    """(series, ts, idx, n) on a regular grid from the first to the last timestamp.

    `bounds` is "global" (one range for all series) or "series".  A grid is unfolded in two
    steps, blocks then rows, so that one long series is generated by many tasks.
    """
    sec = epoch_seconds(F.col(ts))
    per_series = df.groupBy(series).agg(F.min(sec).alias("lo"), F.max(sec).alias("hi"))
    if bounds == "global":
        lo, hi = per_series.agg(F.min("lo")).scalar(), per_series.agg(F.max("hi")).scalar()
        per_series = per_series.select(series, lo.alias("lo"), hi.alias("hi"))
    elif bounds != "series":
        raise ValueError(f"unknown bounds {bounds!r}")
    start = F.col("lo") - F.pmod(F.col("lo"), F.lit(step))
    cells = per_series.select(series, start.alias("start"), F.floor((F.col("hi") - start) / step).alias("last"))
    cut = cells.withColumn("b", F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr(f"last div {block_rows}"))))
    cut = cut.repartition(series, "b")
    first = F.col("b") * block_rows
    rows = cut.withColumn("idx", F.explode(F.sequence(first, F.least(first + block_rows - 1, F.col("last")))))
    return rows.select(series, from_epoch(F.col("start") + F.col("idx") * step).alias(ts), "idx", (F.col("last") + 1).alias("n"))


def on_grid(df: DataFrame, *, series: str = "series", ts: str = "ts", step: int = DAY, bounds: str = "global") -> DataFrame:
    """Reindex to the grid; cells without a row hold nulls."""
    return time_grid(df, series=series, ts=ts, step=step, bounds=bounds).join(df, [series, ts], "left")


def resample_last(df: DataFrame, cols: Sequence[str], *, series: str = "series", ts: str = "ts", step: int) -> DataFrame:
    """F18 first half: the last known value of every `step`-second cell."""
    cell = floor_to(F.col(ts), step)
    return df.groupBy(series, cell.alias("_cell")).agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), F.col(ts))).alias(c) for c in cols]
    ).withColumnRenamed("_cell", ts)


def asof_grid(df: DataFrame, cols: Sequence[str], *, series: str = "series", ts: str = "ts", step: int = DAY,
              bounds: str = "global") -> DataFrame:
    """Reindex to the grid, each cell takes the last value at or before it.

    A value inside a cell counts from the next cell on, a value on the cell start counts at once, before 1970 too.
    """
    micros = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col(ts))
    size = step * 1_000_000
    # cells are numbered from 1970; a number is as good a key as a time, and less work to group by
    cells = df.withColumn("_cell", F.ceil(micros.cast("decimal(20,0)") / size).cast("bigint"))
    latest = cells.groupBy(series, "_cell").agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), F.col(ts))).alias(c) for c in cols]
    ).select(series, from_epoch(F.col("_cell") * step).alias(ts), *cols)
    grid = time_grid(df, series=series, ts=ts, step=step, bounds=bounds)
    return blocks.fill(grid.join(latest, [series, ts], "left"), cols, series=series, forward=None)


def resample_ffill(df: DataFrame, cols: Sequence[str], *, series: str = "series", ts: str = "ts", step: int,
                   bounds: str = "series") -> DataFrame:
    """last value per cell on a full grid, gaps filled forward."""
    cells = resample_last(df, cols, series=series, ts=ts, step=step)
    return blocks.fill(on_grid(cells, series=series, ts=ts, step=step, bounds=bounds), cols, series=series, forward=None)


def combine_complete(panels: dict[str, DataFrame], *, keys: Sequence[str]) -> DataFrame:
    """Datasets side by side on `keys`, complete rows only; value columns get the dataset's prefix."""
    named = [
        df.select(*keys, *[F.col(c).alias(f"{name}_{c}") for c in df.columns if c not in keys])
        for name, df in panels.items()
    ]
    return reduce(lambda a, b: a.join(b, list(keys), "full"), named).dropna("any")


def outer_join_named(long: DataFrame, names: Sequence[str] | None = None, *, ts: str = "ts", name: str = "name", value: str = "value") -> DataFrame:
    """Full outer join of many named series on time, as one grouping instead of a chain of joins.

    Every name becomes a column; without `names` they are taken from the data, in order.
    """
    return long.groupBy(ts).pivot(name, list(names) if names is not None else None).agg(F.max(value))


def merge_first(left: DataFrame, right: DataFrame, *, keys: Sequence[str]) -> DataFrame:
    """The left side's rows; shared columns take the first non-null, new columns are added."""
    shared = [c for c in left.columns if c in right.columns and c not in keys]
    added = [c for c in right.columns if c not in left.columns]
    l, r = left.alias("l"), right.alias("r")
    return l.join(r, list(keys), "left").select(
        *[F.coalesce(F.col(f"l.{c}"), F.col(f"r.{c}")).alias(c) if c in shared else F.col(c) for c in left.columns],
        *[F.col(f"r.{c}") for c in added],
    )


def join_calendar(panel: DataFrame, econ: DataFrame, *, series: str = "series", ts: str = "ts") -> DataFrame:
    """Outer join of every series with data that has no series of its own.

    Each series gets all times of `econ`, whatever their step.  A series is unfolded over the days of
    the range of `econ`, and a day is joined with its times, so that one long calendar is spread over
    many keys and nothing is paired that does not appear in the result.
    """
    times = econ.select(ts).where(F.col(ts).isNotNull()).distinct().withColumn("_day", time_block(F.col(ts), F.lit(DAY)))
    lo, hi = times.agg(F.min("_day")).scalar(), times.agg(F.max("_day")).scalar()
    days = panel.select(series).distinct().select(series, F.explode(F.sequence(lo, hi)).alias("_day"))
    dates = days.join(times, "_day").select(series, ts)
    every = panel.join(dates, [series, ts], "full")
    return every.join(econ, ts, "left").select(series, ts, *[c for c in panel.columns if c not in (series, ts)],
                                               *[c for c in econ.columns if c != ts])


def stack_columns(parts: Sequence[DataFrame], *, keys: Sequence[str]) -> DataFrame:
    """Put the components of several frames side by side on a shared time axis."""
    return reduce(lambda a, b: a.join(b, list(keys)), parts)


def align_forecast(actual: DataFrame, forecast: DataFrame, *, on: Sequence[str]) -> DataFrame:
    """Only times for which both an actual and a forecast exist."""
    return actual.join(forecast, list(on))


def union_panels(frames: Sequence[DataFrame]) -> DataFrame:
    """Rows of all frames; a column missing in one of them is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def extend_with_forecast(panel: DataFrame, forecast: DataFrame, *, target: str = "y", series: str = "series",
                         ts: str = "ts", freq: str = "D") -> DataFrame:
    """U4: history followed by forecast rows dated from the day after each series' last row.

    `forecast` holds (series, step, pred) on the original scale.
    """
    last = panel.groupBy(series).agg(F.max(ts).alias("_last"))
    future = blocks.lookup(forecast, last, [series]).select(
        series, next_steps(F.col("_last"), F.col("step"), freq).alias(ts), F.col("pred").alias(target)
    )
    return union_panels([panel.withColumn("is_forecast", F.lit(False)), future.withColumn("is_forecast", F.lit(True))])


def assert_unique(df: DataFrame, keys: Sequence[str]) -> None:
    """Joins on (series, ts) need unique keys; raises and names one offending key."""
    bad = df.groupBy(*keys).count().filter("count > 1").take(1)
    if bad:
        raise ValueError(f"duplicate key {tuple(bad[0][k] for k in keys)} in {list(keys)}")
