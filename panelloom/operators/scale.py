"""Scaling and encoding.

Tables of distinct values are staged: ranking them reads them once per level of blocks.

Scaler parameters are a table with one row per series and window, joined back to the rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelloom.functions.timeaxis import time_block
from panelloom.operators import blocks
from panelloom.operators.clean import numeric_columns
from panelloom.sources.sinks import stage

Scaler = tuple[Callable[[Column], Column], Callable[[Column], Column]]

# A scaler is a pair of aggregates (center, scale); add your own pair to extend (K4).
SCALERS: dict[str, Scaler] = {
    "zscore": (F.avg, F.stddev_pop),
    "minmax": (F.min, lambda c: F.max(c) - F.min(c)),
}


def fit_scaler(df: DataFrame, cols: Sequence[str], *, keys: Sequence[str] = ("series",),
               scaler: str | Scaler = "zscore", fit_on: Column | None = None) -> DataFrame:
    """parameters per key.  `fit_on` selects the rows that may be looked at; None takes all."""
    center, spread = SCALERS[scaler] if isinstance(scaler, str) else scaler
    aggs = []
    for c in cols:
        v = F.col(c) if fit_on is None else F.when(fit_on, F.col(c))
        # a constant column has scale 0 and must come out as 0, not fail
        aggs += [center(v).alias(f"{c}_center"), F.coalesce(F.nullif(spread(v), F.lit(0.0)), F.lit(1.0)).alias(f"{c}_scale")]
    return df.groupBy(*keys).agg(*aggs)


def scaler_rows(params: DataFrame, cols: Sequence[str], *, keys: Sequence[str] = ("series",)) -> DataFrame:
    """Parameter table in long form: (keys, column, center, scale), the form to store."""
    rows = F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"{c}_center").alias("center"), F.col(f"{c}_scale").alias("scale"))
        for c in cols
    ])
    return params.select(*keys, F.inline(rows))


def apply_scaler(df: DataFrame, params: DataFrame, cols: Sequence[str], *, keys: Sequence[str] = ("series",)) -> DataFrame:
    """Scale columns in place."""
    joined = blocks.lookup(df, params, list(keys))
    return joined.select(*[
        ((F.col(c) - F.col(f"{c}_center")) / F.col(f"{c}_scale")).alias(c) if c in cols else F.col(c) for c in df.columns
    ])


def invert_scaler(df: DataFrame, params: DataFrame, col: str, *, target: str, keys: Sequence[str] = ("series",)) -> DataFrame:
    """Bring `col` back to the scale of the column `target` was fitted on."""
    joined = blocks.lookup(df, params, list(keys))
    back = F.col(col) * F.col(f"{target}_scale") + F.col(f"{target}_center")
    return joined.select(*[back.alias(c) if c == col else F.col(c) for c in df.columns])


def zscore_all(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """one mean and population deviation per column over the whole panel (two numbers each)."""
    stats = df.agg(F.struct(*[
        F.struct(F.avg(c).alias("m"), F.coalesce(F.nullif(F.stddev_pop(c), F.lit(0.0)), F.lit(1.0)).alias("s")).alias(c)
        for c in cols
    ])).scalar()
    held = df.withColumn("_stats", stats)
    return held.select(*[
        ((F.col(c) - F.col(f"_stats.`{c}`.m")) / F.col(f"_stats.`{c}`.s")).alias(c) if c in cols else F.col(c)
        for c in df.columns
    ])


def log_all(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """F12."""
    return df.select(*[F.log1p(c).alias(c) if c in cols else F.col(c) for c in df.columns])


def time_ranks(df: DataFrame, col: str, *, width: int | None = None) -> DataFrame:
    """Dense rank 1..n of the distinct timestamps: (col, _rows, _code); `width` as in `blocks.position`."""
    times = stage(df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("_rows")))
    seconds = blocks.block_seconds(times, col) if width is None else F.lit(width)
    cut = times.withColumn("_tb", time_block(F.col(col), seconds))
    ranks = blocks.rank_in_order(cut, keys=[], blocks=["_tb"], order=[col], name="_code")
    return ranks.select(col, "_rows", (F.col("_code") + 1).alias("_code"))


def value_codes(df: DataFrame, col: str, *, order: tuple[str, str] = ("series", "ts")) -> DataFrame:
    """Code 0.. of the distinct values by first appearance in (series, ts) order: (col, _rows, _code).

    Only the distinct values are ordered, cut into ranges of their place of appearance.
    """
    series, ts = order
    first = df.filter(F.col(col).isNotNull()).groupBy(col).agg(
        F.min(F.struct(series, ts)).alias("_at"), F.count(F.lit(1)).alias("_rows")
    )
    place = ["_s", "_t", col]
    seen = first.select(col, "_rows", F.col(f"_at.{series}").alias("_s"), F.col(f"_at.{ts}").alias("_t"))
    ranges = stage(blocks.range_blocks(seen, place, "_range"))
    return blocks.rank_in_order(ranges, keys=[], blocks=["_range"], order=place, name="_code").select(col, "_rows", "_code")


def time_rank(df: DataFrame, col: str, *, name: str | None = None, spread_by: str = "series",
              ranks: DataFrame | None = None) -> DataFrame:
    """Dense rank of the timestamps, taken over the distinct ones only.  Null stays null."""
    dim = time_ranks(df, col) if ranks is None else ranks
    out = blocks.lookup_weighted(df, dim, col, weight="_rows", spread_by=spread_by)
    return out.withColumn(name or col, F.col("_code")).drop("_code")


def factorize(df: DataFrame, col: str, *, order: tuple[str, str] = ("series", "ts"), name: str | None = None,
              codes: DataFrame | None = None) -> DataFrame:
    """F16: 0-based code by first appearance, null is -1."""
    dim = value_codes(df, col, order=order) if codes is None else codes
    out = blocks.lookup_weighted(df, dim, col, weight="_rows", spread_by=order[1])
    return out.withColumn(name or col, F.coalesce("_code", F.lit(-1)).cast("int")).drop("_code")


def preprocess(df: DataFrame, *, target: str = "y", series: str = "series", ts: str = "ts", method: str = "zscore",
               percent: bool = False, corr_thresh: float = 0.0, protected: Sequence[str] = ()) -> DataFrame:
    """scale numbers, rank timestamps, encode strings; optionally percent mode and column selection.

    The plan is chosen from the schema; for string columns one aggregate tells whether any value
    reads as a date.
    """
    from panelloom.operators.features import drop_weak, percent_change

    if percent:
        df = percent_change(df, [target], series=series, ts=ts).drop(target).dropna("any")
        target = f"{target} (%)"
    numeric = [c for c in numeric_columns(df) if c not in protected]
    texts = [f.name for f in df.schema if isinstance(f.dataType, T.StringType) and f.name not in protected]
    times = [f.name for f in df.schema if isinstance(f.dataType, (T.TimestampNTZType, T.TimestampType, T.DateType))
             and f.name not in protected]
    if numeric:
        df = log_all(df, numeric) if method == "log" else zscore_all(df, numeric)
    dated = {}
    if texts:
        dated = df.agg(*[F.count_if(F.col(c).try_cast("timestamp_ntz").isNotNull()).alias(c) for c in texts]).first().asDict()
    # code tables come from the stored panel, so that encoding a column does not repeat the others
    base = stage(df.select("*", *[F.col(c).try_cast("timestamp_ntz").alias(f"_time_{c}") for c in texts if c != series and dated[c]]))
    out, done = base, {}
    for c in [*texts, *times]:
        new = done[c] = f"_enc_{c}"
        if c in times:
            out = time_rank(out, c, name=new, spread_by=series, ranks=time_ranks(base, c))
        elif f"_time_{c}" in base.columns:
            out = time_rank(out, f"_time_{c}", name=new, spread_by=ts, ranks=time_ranks(base, f"_time_{c}"))
        else:
            out = factorize(out, c, order=(series, ts), name=new, codes=value_codes(base, c, order=(series, ts)))
    out = out.select(*[F.col(done.get(c, c)).alias(c) for c in df.columns])
    return drop_weak(out, target=target, thresh=corr_thresh, protected=[series, ts, *protected]) if corr_thresh > 0 else out
