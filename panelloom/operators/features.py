"""Feature selection and derived features."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelloom.operators import blocks
from panelloom.operators.clean import AGG_CHUNK, numeric_columns, rows_after_last


def corr(x: Column, y: Column) -> Column:
    """Pearson correlation of pairwise complete rows; null when undefined instead of an error."""
    a, b = F.when(y.isNotNull(), x), F.when(x.isNotNull(), y)
    return F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b))


def corr_with_target(df: DataFrame, target: str, cols: Sequence[str] | None = None) -> DataFrame:
    """A2: (column, r) for every numeric column, one pass per `AGG_CHUNK` columns."""
    cols = [c for c in (cols or numeric_columns(df)) if c != target]
    parts = []
    for i in range(0, len(cols), AGG_CHUNK):
        rs = F.array(*[
            F.struct(F.lit(c).alias("column"), corr(F.col(c).cast("double"), F.col(target).cast("double")).alias("r"))
            for c in cols[i:i + AGG_CHUNK]
        ])
        parts.append(df.agg(rs.alias("rs")).select(F.inline("rs")))
    return reduce(DataFrame.unionByName, parts)


def corr_matrix(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """A3: all pairs in long form (a, b, r), both orders and the diagonal, pairwise complete.

    One pass for the means and one for the moments, however many columns: each task multiplies its
    batches as matrices and hands on one row per pair.
    """
    cols = list(cols or numeric_columns(df))
    means = df.agg(*[F.coalesce(F.avg(F.col(c).cast("double")), F.lit(0.0)).alias(f"m{i}") for i, c in enumerate(cols)]).first()
    # moments around the mean do not cancel
    centred = df.select(*[(F.col(c).cast("double") - F.lit(means[i])).alias(f"c{i}") for i, c in enumerate(cols)])
    i, j = np.triu_indices(len(cols))

    def moments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((6, len(i)))
        for pdf in batches:
            x = pdf.to_numpy(float)
            known = ~np.isnan(x)
            x, k = np.where(known, x, 0.0), known.astype(float)
            xk, x2k = x.T @ k, (x * x).T @ k
            total += [(k.T @ k)[i, j], xk[i, j], xk[j, i], x2k[i, j], x2k[j, i], (x.T @ x)[i, j]]
        yield pd.DataFrame(np.vstack([i, j, total]).T, columns=["i", "j", "n", "x", "y", "xx", "yy", "xy"])

    parts = centred.mapInPandas(moments, "i double, j double, n double, x double, y double, xx double, yy double, xy double")
    sums = parts.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in ("n", "x", "y", "xx", "yy", "xy")])
    n = F.nullif(F.col("n"), F.lit(0.0))
    var = [F.greatest(F.col(c + c) - F.col(c) * F.col(c) / n, F.lit(0.0)) for c in ("x", "y")]
    # what rounding leaves of the spread of a constant column is not a spread
    spread = [F.when(v > 1e-12 * F.col(c + c), v) for v, c in zip(var, ("x", "y"))]
    r = F.try_divide(F.col("xy") - F.col("x") * F.col("y") / n, F.sqrt(spread[0] * spread[1]))
    names = F.array(*map(F.lit, cols))
    upper = sums.select(F.get(names, F.col("i").cast("int")).alias("a"), F.get(names, F.col("j").cast("int")).alias("b"), r.alias("r"))
    mirrored = F.when(F.col("a") == F.col("b"), F.array(F.struct("a", "b"))).otherwise(
        F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))
    )
    return upper.select(F.explode(mirrored).alias("p"), "r").select("p.a", "p.b", "r")


def strength() -> Column:
    """|r| without the digits that depend on the order of summation, so that equal columns tie."""
    return F.round(F.abs("r"), 12)


def ranked(corrs: DataFrame) -> DataFrame:
    """O1: strongest first, ties by name."""
    return corrs.orderBy(strength().desc_nulls_last(), "column")


def strongest_and_weakest(corrs: DataFrame, k: int = 10) -> DataFrame:
    """O2: the k strongest and the k weakest columns; they overlap when there are fewer than 2k."""
    top = ranked(corrs).limit(k).withColumn("side", F.lit("top"))
    bottom = corrs.orderBy(strength().asc_nulls_first(), F.col("column").desc()).limit(k).withColumn("side", F.lit("bottom"))
    return top.unionByName(bottom)


def corr_histogram(corrs: DataFrame, bins: int = 20) -> DataFrame:
    """A4: counts of |r| in equal bins between its smallest and largest value."""
    v = F.abs("r")
    lo, hi = corrs.agg(F.min(v)).scalar(), corrs.agg(F.max(v)).scalar()
    at = F.floor(F.coalesce(F.try_divide(v - F.col("lo"), F.col("hi") - F.col("lo")), F.lit(0.0)) * bins)
    known = corrs.filter(F.col("r").isNotNull()).withColumn("lo", lo).withColumn("hi", hi)
    return known.groupBy(F.least(at, F.lit(bins - 1)).cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def weak_columns(df: DataFrame, *, target: str, thresh: float, protected: Sequence[str] = ()) -> list[str]:
    """Names with |r| strictly below the threshold; an undefined r keeps its column."""
    if not 0 < thresh < 1:
        return []
    rows = corr_with_target(df, target).filter(F.abs("r") < thresh).collect()  # at most one row per column
    weak = {r["column"] for r in rows} - set(protected)
    return [c for c in df.columns if c in weak]


def drop_weak(df: DataFrame, *, target: str, thresh: float, protected: Sequence[str] = ()) -> DataFrame:
    return df.drop(*weak_columns(df, target=target, thresh=thresh, protected=protected))


def percent_change(df: DataFrame, cols: Sequence[str], *, series: str = "series", ts: str = "ts") -> DataFrame:
    """Change to the previous row in percent, as column "<c> (%)"; gaps carry the last value.

    With gaps carried, the previous row holds the last known value before this row.
    """
    indexed = df if "idx" in df.columns else blocks.position(df, series=series, ts=ts)
    near = blocks.known_neighbours(indexed, cols, series=series)
    change = [
        ((F.try_divide(F.coalesce(F.col(c), F.col(f"_prev_{i}.v")), F.col(f"_prev_{i}.v")) - 1) * 100).alias(f"{c} (%)")
        for i, c in enumerate(cols)
    ]
    return near.select(*df.columns, *change)


def from_percent_change(changes: DataFrame, history: DataFrame, cols: Sequence[str], *, series: str = "series",
                        ts: str = "ts") -> DataFrame:
    """Turn percent changes after the last known row back to levels and append them.

    The level is the last known value times the running product of the changes; a null in the last row is no value.
    """
    new = rows_after_last(changes, history, series=series, ts=ts)
    if "idx" not in new.columns:
        new = blocks.position(new, series=series, ts=ts)
    for c in cols:
        new = blocks.running(new, value=1 + F.col(f"{c} (%)") / 100, name=f"_p_{c}", how="product", series=series)
    last = history.groupBy(series).agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), F.col(ts))).alias(f"_l_{c}") for c in cols])
    levels = blocks.lookup(new, last, [series])
    dropped = {*cols, *[f"{c} (%)" for c in cols], *[f"_p_{c}" for c in cols]} | ({"idx"} - set(history.columns))
    out = levels.select(
        *[c for c in new.columns if c not in dropped], *[(F.col(f"_l_{c}") * F.col(f"_p_{c}")).alias(c) for c in cols],
    )
    return history.unionByName(out, allowMissingColumns=True)


def lag_features(df: DataFrame, lags: dict[str, Sequence[int]], *, leads: dict[str, Sequence[int]] | None = None,
                 series: str | Sequence[str] = "series", idx: str = "idx",
                 block_rows: int = blocks.BLOCK_ROWS) -> DataFrame:
    """Columns `<c>_lag<k>` (k rows back) and `<c>_lead<k>` (k rows ahead, 0 is the row itself)."""
    leads = leads or {}
    exprs = {f"{c}_lag{k}": (lambda w, c=c, k=k: F.lag(c, k).over(w)) for c, ks in lags.items() for k in ks}
    exprs |= {f"{c}_lead{k}": (lambda w, c=c, k=k: F.lead(c, k).over(w)) for c, ks in leads.items() for k in ks}
    back = max((k for ks in lags.values() for k in ks), default=0)
    ahead = max((k for ks in leads.values() for k in ks), default=0)
    return blocks.over_halo(df, exprs, before=back, after=ahead, series=series, idx=idx, block_rows=block_rows)
