"""Train/validation splits, rolling windows and encoder/decoder samples.

All work on the position `idx` and the series length `n`, as columns.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from panelloom.functions.timeaxis import time_block
from panelloom.operators import blocks

YEAR_ROWS = 252


def train_rows(n: Column, split: float | int) -> Column:
    """A share takes the first int(n * share) rows, an int keeps the last rows for validation."""
    if isinstance(split, float):
        return F.floor(n * F.lit(split)).cast("bigint")
    return n - F.lit(split)


def mark_train(df: DataFrame, split: float | int = 0.75, *, idx: str = "idx", n: str = "n") -> DataFrame:
    return df.withColumn("is_train", F.col(idx) < train_rows(F.col(n), split))


def rolling_windows(df: DataFrame, n_splits: int = 5, *, min_rows: int = 2 * YEAR_ROWS, split: float | int = 0.75,
                    idx: str = "idx", n: str = "n") -> DataFrame:
    """Non-overlapping windows of each series, the incomplete tail dropped, each split again.

    Adds window_id, widx (position in the window), wn (window length) and is_train.
    """
    size = F.greatest(F.expr(f"{n} div {n_splits}"), F.lit(min_rows).cast("bigint"))
    sized = df.withColumn("wn", size)
    windows = sized.withColumn("window_id", F.expr(f"{idx} div wn")).filter(F.expr(f"window_id < {n} div wn"))
    return mark_train(windows.withColumn("widx", F.col(idx) % F.col("wn")), split, idx="widx", n="wn")


def window_rows(encoder: int, horizon: int, train_share: float) -> int:
    """Smallest window whose train and validation parts hold the encoder and the horizon."""
    val = encoder + 1
    return math.ceil((horizon + val) / train_share + val / (1 - train_share))


def overlapping_windows(df: DataFrame, size: int, sessions: int = 5, *, split: float | int = 0.75, idx: str = "idx",
                        n: str = "n") -> DataFrame:
    """Windows of `size` rows whose starts are evenly spread; a row belongs to several windows.

    The windows of a row are a range of numbers computed from its position, so no join is needed.
    """
    if sessions < 1:
        raise ValueError("at least one session")
    # a single session is the window at the start: the step then leads beyond the last start
    spread = F.expr(f"({n} - {size}) div {sessions - 1}") if sessions > 1 else F.expr(f"{n} - {size} + 1")
    step = F.greatest(spread, F.lit(1).cast("bigint"))
    fits = df.filter(F.col(n) >= size).withColumn("_step", step)
    last = F.expr(f"({n} - {size}) div _step")
    lo = F.greatest(F.lit(0).cast("bigint"), F.ceil((F.col(idx) - size + 1) / F.col("_step")))
    hi = F.least(last, F.expr(f"{idx} div _step"))
    rows = fits.withColumn("window_id", F.explode(F.when(lo <= hi, F.sequence(lo, hi)).otherwise(F.array().cast("array<bigint>"))))
    placed = rows.withColumn("widx", F.col(idx) - F.col("window_id") * F.col("_step")).withColumn(
        "wn", F.lit(size).cast("bigint")
    )
    return mark_train(placed.drop("_step"), split, idx="widx", n="wn")


def before_last(df: DataFrame, horizon: int, *, time_idx: str = "idx") -> DataFrame:
    """Rows up to `horizon` steps before the latest time of the whole panel."""
    cutoff = df.agg(F.max(time_idx) - horizon).scalar()
    return df.filter(F.col(time_idx) <= cutoff)


def cutoff_time(df: DataFrame, share: float, *, ts: str = "ts", width: int | None = None) -> DataFrame:
    """The timestamp at position int(n * share) of the time-sorted table, as a one-row frame.

    Rows are counted per timestamp; the time block that holds the position is found in the block
    table, and only that block is ordered.
    """
    counts = df.groupBy(ts).agg(F.count(F.lit(1)).alias("c"))
    seconds = blocks.block_seconds(counts, ts) if width is None else F.lit(width)
    per_ts = counts.withColumn("_tb", time_block(F.col(ts), seconds))
    w = W.orderBy("_tb").rowsBetween(W.unboundedPreceding, -1)
    table = per_ts.groupBy("_tb").agg(F.sum("c").alias("rows"))
    target = F.floor(F.sum("rows").over(W.partitionBy()) * F.lit(share))
    starts = table.select("_tb", "rows", F.coalesce(F.sum("rows").over(w), F.lit(0)).alias("start"), target.alias("at"))
    hit = starts.filter((F.col("start") <= F.col("at")) & (F.col("at") < F.col("start") + F.col("rows")))
    upto = F.col("start") + F.sum("c").over(W.partitionBy("_tb").orderBy(ts))
    return per_ts.join(hit, "_tb").withColumn("upto", upto).filter("upto > at").agg(F.min(ts).alias("cutoff"))


def samples(df: DataFrame, *, encoder: int, horizon: int, min_encoder: int | None = None, min_horizon: int = 1,
            value: str = "y", series: str = "series", idx: str = "idx", stride: int = 1) -> DataFrame:
    """One row per decoder start: the encoder rows before it, the decoder rows from it on.

    Arrays hold at most `encoder` and `horizon` structs (idx, y).  Rows multiply by their length,
    so keep the result lazy; `stride` thins the starts.
    """
    item = F.struct(F.col(idx).alias("idx"), F.col(value).alias("y"))
    out = blocks.over_halo(
        df.select(series, idx, value),
        {
            "enc": lambda w: F.collect_list(item).over(w.rowsBetween(-encoder, -1)),
            "dec": lambda w: F.collect_list(item).over(w.rowsBetween(0, horizon - 1)),
        },
        before=encoder, after=horizon - 1, series=series, idx=idx,
    )
    least = encoder // 2 if min_encoder is None else min_encoder
    enough = (F.size("enc") >= max(least, 1)) & (F.size("dec") >= min_horizon)
    return out.filter(enough & (F.col(idx) % stride == 0)).select(series, F.col(idx).alias("start_idx"), "enc", "dec")


def last_samples(df: DataFrame, *, encoder: int, horizon: int, value: str = "y", series: str = "series",
                 idx: str = "idx", n: str = "n") -> DataFrame:
    """Only the last window of each series, gathered from its last encoder + horizon rows."""
    start = F.col(n) - horizon
    tail = df.filter((F.col(idx) >= start - encoder) & (start >= 0))
    item = F.struct(F.col(idx).alias("idx"), F.col(value).alias("y"))
    part = lambda cond: F.array_sort(F.collect_list(F.when(cond, item)))
    return tail.groupBy(series, start.alias("start_idx")).agg(
        part(F.col(idx) < start).alias("enc"), part(F.col(idx) >= start).alias("dec")
    )


def relative_time(sample: DataFrame, *, encoder: int) -> DataFrame:
    """Time relative to the decoder start in units of the encoder length, for both parts."""
    def rel(c: str) -> Column:
        return F.transform(F.col(c), lambda e: (e["idx"] - F.col("start_idx")) / F.lit(float(encoder)))

    return sample.withColumn("enc_rel", rel("enc")).withColumn("dec_rel", rel("dec"))


def last_rows(df: DataFrame, rows: int, *, idx: str = "idx", n: str = "n") -> DataFrame:
    """The last `rows` rows of every series, from positions alone."""
    return df.filter(F.col(idx) >= F.col(n) - rows)


def forecast_view(actual: DataFrame, forecast: DataFrame, *, horizon: int, on: Sequence[str] = ("series", "ts"),
                  factor: int = 2) -> DataFrame:
    """The last factor * horizon validation rows beside the forecast, where both exist."""
    return last_rows(actual, factor * horizon).join(forecast, list(on))
