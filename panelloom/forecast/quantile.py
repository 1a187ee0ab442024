"""Fitted quantiles: linear pinball regression on lags, pooled over all series.

Slopes come from weighted normal equations that are solved again and again (each round lowers the loss), intercepts are exact order
statistics of what the slopes leave.  A task sends sums and counts of a fixed size, whatever its rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelloom.forecast.linear import lagged, solve, symmetric, tails
from panelloom.forecast.naive import KEYS
from panelloom.functions.timeaxis import next_steps
from panelloom.sources.sinks import stage

BINS = 64  # a pass over the rows narrows an order statistic down to one of so many bins


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _per_task(rows: DataFrame, width: int, steps: int, reduce: Callable, schema: str) -> DataFrame:
    """Rows that `reduce` makes of the (X, Y) batches of a task."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = ((_matrix(b.column(0), width), _matrix(b.column(1), steps)) for b in batches if b.num_rows)
        yield from reduce(parts)

    return rows.mapInArrow(run, schema)


def _round(rows: DataFrame, beta: np.ndarray | None, qs: np.ndarray, blur: np.ndarray, width: int, steps: int) -> tuple[np.ndarray, np.ndarray]:
    """Next coefficients (step, q, input) and the mean absolute residual of each; least squares where there are none yet."""
    upper = np.triu_indices(width)
    cells = len(upper[0]) + width + 2
    many = len(qs) if beta is not None else 1

    def reduce(parts):
        total = np.zeros((steps, many, cells))
        for x, y in parts:
            for h in range(steps):
                for i in range(many):
                    r = y[:, h] - (x @ beta[h, i] if beta is not None else 0.0)
                    w = 1.0 / (blur[h] + np.abs(r)) if beta is not None else np.ones(len(r))
                    xw = x * w[:, None]
                    tilt = (2 * qs[i] - 1) * x.sum(axis=0) if beta is not None else 0.0
                    total[h, i] += np.concatenate([(xw.T @ x)[upper], xw.T @ y[:, h] + tilt, [np.abs(r).sum(), len(r)]])
        yield pa.record_batch({"cell": pa.array(np.arange(total.size, dtype=np.int64)), "v": pa.array(total.ravel())})

    summed = _per_task(rows, width, steps, reduce, "cell bigint, v double").groupBy("cell").agg(F.sum("v").alias("v"))
    total = np.zeros(steps * many * cells)
    for cell, value in summed.collect():  # a fixed number of sums
        total[cell] = value
    total = total.reshape(steps, many, cells)
    out = np.array([[solve(symmetric(c[: len(upper[0])], width), c[len(upper[0]) : -2, None], 1e-10)[:, 0] for c in line] for line in total])
    size = total[:, :, -2] / np.maximum(total[:, :, -1], 1)
    return np.broadcast_to(out, (steps, len(qs), width)).copy(), np.broadcast_to(size, (steps, len(qs)))


def _order_statistics(rows: DataFrame, beta: np.ndarray, qs: np.ndarray, width: int, steps: int) -> np.ndarray:
    """For every step and q the least residual that has a share q of all at or below it; exact."""
    shape = (steps, len(qs))
    low, high, below = np.full(shape, -np.inf), np.full(shape, np.inf), np.zeros(shape)
    rank, bins = None, 1
    while True:
        edges = np.linspace(low, high, bins + 1, axis=-1) if bins > 1 else np.stack([low, high], -1)

        def reduce(parts, low=low, high=high, edges=edges, bins=bins):
            count, least, most = np.zeros((*shape, bins)), np.full((*shape, bins), np.inf), np.full((*shape, bins), -np.inf)
            for x, y in parts:
                for h in range(steps):
                    for i in range(shape[1]):
                        r = y[:, h] - x @ beta[h, i]
                        r = r[(r >= low[h, i]) & (r <= high[h, i])]
                        at = np.clip(np.searchsorted(edges[h, i], r, side="right") - 1, 0, bins - 1)
                        count[h, i] += np.bincount(at, minlength=bins)
                        np.minimum.at(least[h, i], at, r)
                        np.maximum.at(most[h, i], at, r)
            used = np.flatnonzero(count)
            yield pa.record_batch({"cell": pa.array(used.astype(np.int64)), "n": pa.array(count.ravel()[used]),
                                   "lo": pa.array(least.ravel()[used]), "hi": pa.array(most.ravel()[used])})

        found = _per_task(rows, width, steps, reduce, "cell bigint, n double, lo double, hi double")
        table = np.zeros((steps * shape[1] * bins, 3))
        for cell, *values in found.groupBy("cell").agg(F.sum("n"), F.min("lo"), F.max("hi")).collect():  # a fixed number of counts
            table[cell] = values
        table = table.reshape(*shape, bins, 3)
        if rank is None:
            total = table[:, :, 0, 0]
            if not total.all():
                return np.full(shape, np.nan)
            rank = np.maximum(1, total - np.floor(total - qs[None, :] * total))
        upto = below[..., None] + np.cumsum(table[..., 0], axis=-1)
        chosen = (upto < rank[..., None]).sum(axis=-1)
        pick = np.take_along_axis(table, chosen[..., None, None], axis=2)[:, :, 0]
        below = np.take_along_axis(upto, chosen[..., None], axis=2)[..., 0] - pick[..., 0]
        low, high, bins = pick[..., 1], pick[..., 2], BINS
        if (low == high).all():
            return low


def quantile_linear(train: DataFrame, qs: Sequence[float], *, horizon: int, input_len: int = 12, rounds: int = 25, keys: Sequence[str] = KEYS,
                    y: str = "y", freq: str = "D") -> DataFrame:
    """(keys, step, ts, q, pred): linear quantiles of the change from the last value, given the lags before it.

    Every step and q has its own coefficients, so sums of horizon * len(qs) * input_len ** 2 / 2 numbers leave each task: meant for the chunk
    of a model.  With one lag the quantiles are those of the change itself.  Rows with a null take no part; a series
    shorter than `input_len` or with a null there has null forecasts.  Quantiles that cross are put in order.
    """
    if input_len < 1 or not qs or not all(0 < q < 1 for q in qs):
        raise ValueError("quantiles lie between 0 and 1; the last value is needed")
    keys, shares = list(keys), np.array(sorted(qs), dtype=float)
    data = lagged(train, [y], input_len, keys, leads=horizon)
    last = F.col(f"{y}_lag1").cast("double")
    xs = [F.col(f"{y}_lag{i}").cast("double") - last for i in range(input_len, 1, -1)] + [F.lit(1.0)]
    rows = data.select(F.array(*xs).alias("x"), F.array(*[F.col(f"{y}_lead{i}").cast("double") - last for i in range(horizon)]).alias("t"))
    rows = stage(rows.filter(~F.exists("x", F.isnull) & ~F.exists("t", F.isnull)))
    beta, size = _round(rows, None, shares, np.zeros(horizon), input_len, horizon)
    if input_len > 1:
        blur = size[:, 0] * 0.1 + 1e-300
        for _ in range(rounds):
            beta, _ = _round(rows, beta, shares, blur, input_len, horizon)
            blur = np.maximum(blur * 0.6, size[:, 0] * 1e-6 + 1e-300)
    beta[:, :, -1] = 0.0
    beta[:, :, -1] = _order_statistics(rows, beta, shares, input_len, horizon)

    @F.pandas_udf("array<array<double>>")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for tail in batches:
            out = []
            for t in tail:
                known = np.array([np.nan if v is None else v for v in t], dtype=float)
                if len(known) < input_len or np.isnan(known).any() or np.isnan(beta).any():
                    out.append([[None] * len(shares)] * horizon)
                    continue
                x = np.append(known[:-1] - known[-1], 1.0)
                out.append(np.sort(beta @ x + known[-1], axis=1).tolist())
            yield pd.Series(out)

    fitted = tails(train, input_len, [y], keys).select(*keys, "last_ts", F.posexplode(predict(f"tail_{y}")).alias("_h", "_preds"))
    each = fitted.select(*keys, "last_ts", (F.col("_h") + 1).alias("step"), F.posexplode("_preds").alias("_q", "pred"))
    q = F.element_at(F.array(*[F.lit(float(s)) for s in shares]), F.col("_q") + 1)
    return each.select(*keys, "step", next_steps(F.col("last_ts"), F.col("step"), freq).alias("ts"), q.alias("q"), "pred")
