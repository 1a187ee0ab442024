"""Exponential smoothing with parameters chosen by one-step error (M7, grids of M8 and M9).

A smoothing recursion is affine in its state.  A block of rows therefore reduces to a map
x -> M x + c and a quadratic form of its squared errors in x.  Blocks are reduced in parallel,
composed in order, and only then started from the initial state, so a long series is split over
many tasks.  The blocks that reach a task together are reduced side by side: a loop over the rows of a block
handles one row of each.  Seasons are kept by phase, so a row changes one of them.  Multiplicative forms run on logarithms.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelloom.forecast.naive import KEYS, ends, unfold_array

GRID = (0.1, 0.3, 0.5, 0.7, 0.9)
REDUCE = 1024  # rows of a block
TOGETHER = 32  # rows whose squared errors are summed by one product
CELLS = 1 << 21  # numbers in the matrices of blocks that are reduced at once
COMPOSE = 1024  # blocks composed by one task


def candidates(kinds: Sequence[str] = ("simple",), *, alphas: Sequence[float] = GRID, betas: Sequence[float] = (0.1, 0.3),
               phis: Sequence[float] = (0.9,), gammas: Sequence[float] = (0.1, 0.3)) -> list[dict]:
    """Parameter grid: kinds simple, holt, damped, each optionally with "+season"."""
    out = []
    for kind in kinds:
        trend, _, season = kind.partition("+")
        bs = betas if trend in ("holt", "damped") else [0.0]
        ps = phis if trend == "damped" else [1.0 if trend == "holt" else 0.0]
        for a, b, p, g in product(alphas, bs, ps, gammas if season else [0.0]):
            # k counts the smoothing parameters and start values, for information criteria
            out.append({"kind": kind, "alpha": a, "beta": b, "phi": p, "gamma": g, "season": bool(season),
                        "k": 2 + 2 * (trend != "simple") + (trend == "damped") + (1 if season else 0)})
    return out


def reduce_blocks(y: np.ndarray, start: np.ndarray, cands: list[dict], period: int) -> tuple:
    """(M, c, Q, q, s) of many blocks at once: arrays over (block, candidate, ...).

    `y` holds a block in every row, `start` the position of its first value.  The state is (level, trend, seasons by phase), so a row
    of a block changes three rows of M, whatever the period.  A null value lets the state move on without a correction; blocks that
    are shorter than others end in values that are masked by infinity.
    """
    alpha, beta, phi, gamma = (np.array([c[n] for c in cands])[None, :, None] for n in ("alpha", "beta", "phi", "gamma"))
    season = np.array([float(c["season"]) for c in cands])[None, :, None]
    beta, gamma = alpha * beta, season * gamma * (1 - alpha)
    (b, length), m, d = y.shape, len(cands), 2 + period
    M = np.broadcast_to(np.eye(d), (b, m, d, d)).copy()
    c = np.zeros((b, m, d))
    Q, q, s = np.zeros((b, m, d, d)), np.zeros((b, m, d)), np.zeros((b, m))
    every = np.arange(b)
    errors, places, used = np.zeros((TOGETHER, b, m)), np.zeros((TOGETHER, b, m, d)), 0
    for t in range(length):
        known, there = np.isfinite(y[:, t])[:, None, None], ~np.isinf(y[:, t])
        value = np.where(known[:, 0, 0], y[:, t], 0.0)[:, None]
        at = 2 + (start + t) % period if period else None
        moved = np.where(there[:, None, None], phi, 1.0)
        on = np.where(there[:, None, None], phi, 0.0)
        level, trend = M[:, :, 0] + on * M[:, :, 1], moved * M[:, :, 1]
        c_level, c_trend = c[:, :, 0] + on[..., 0] * c[:, :, 1], moved[..., 0] * c[:, :, 1]
        u, seen = level, c_level
        if period:
            own, c_own = M[every, :, at], c[every, :, at]
            u, seen = u + season * own, seen + season[..., 0] * c_own
        u = np.where(known, u, 0.0)
        r = np.where(known[..., 0], value - seen, 0.0)
        M[:, :, 0], M[:, :, 1] = level - alpha * u, trend - beta * u
        c[:, :, 0], c[:, :, 1] = c_level + alpha[..., 0] * r, c_trend + beta[..., 0] * r
        if period:
            M[every, :, at], c[every, :, at] = own - gamma * u, c_own + gamma[..., 0] * r
        errors[used], places[used] = r, u
        used += 1
        if used == TOGETHER or t == length - 1:  # squared errors of some rows by one product
            U, R = np.moveaxis(places[:used], 0, 2), np.moveaxis(errors[:used], 0, 2)
            Q += U.swapaxes(-1, -2) @ U
            q -= 2 * (R[:, :, None] @ U)[:, :, 0]
            s += (R * R).sum(-1)
            used = 0
    return M, c, Q, q, s


def compose(a: tuple, b: tuple) -> tuple:
    """Summary of block a followed by block b."""
    (M1, c1, Q1, q1, s1), (M2, c2, Q2, q2, s2) = a, b
    Mt = M1.swapaxes(-1, -2)
    Qc = np.einsum("mde,me->md", Q2, c1)
    return (
        M2 @ M1,
        np.einsum("mde,me->md", M2, c1) + c2,
        Q1 + Mt @ Q2 @ M1,
        q1 + np.einsum("mde,me->md", Mt, q2 + 2 * Qc),
        s1 + s2 + (q2 * c1).sum(1) + (c1 * Qc).sum(1),
    )


def _pack(summary: tuple) -> bytes:
    return np.concatenate([np.ravel(p) for p in summary]).astype("<f8").tobytes()


def _unpack(raw: bytes, m: int, d: int) -> tuple:
    flat, out, at = np.frombuffer(raw, "<f8"), [], 0
    for shape in [(m, d, d), (m, d), (m, d, d), (m, d), (m,)]:
        size = int(np.prod(shape))
        out.append(flat[at:at + size].reshape(shape))
        at += size
    return tuple(out)


def initial_state(head: np.ndarray, c: dict, period: int) -> np.ndarray:
    """Start of level, trend and seasons from the first two cycles, without season the first two values."""
    x, trend = np.zeros(2 + period), c["phi"] > 0
    if c["season"] and len(head) >= 2 * period:
        one, two = head[:period], head[period:2 * period]
        x[0] = one.mean()
        x[1] = (two.mean() - one.mean()) / period if trend else 0.0
        x[2:] = one - one.mean()
    else:
        x[0] = head[0]
        if trend and len(head) > 1:
            x[1] = head[1] - head[0]
            x[0] = head[0] - x[1]
    return x


def fit(rows: DataFrame, cands: list[dict], *, period: int = 0, keys: Sequence[str] = KEYS, value: str = "v",
        block_rows: int = REDUCE) -> DataFrame:
    """Final state and squared error of every candidate: (keys, cand, sse, n, state array).

    `rows` hold (keys, idx, value) with dense positions from 0.  A null value corrects nothing and has no error; `n` counts
    the others.  Start values take the place of nulls from their neighbours; a series without a known value among the first has no state.
    """
    m, d = len(cands), 2 + period
    keys = list(keys)
    key_ddl = ", ".join(f"`{k}` {rows.schema[k].dataType.simpleString()}" for k in keys)
    ddl = f"{key_ddl}, blk bigint, n bigint, size bigint, summary binary, head array<double>"
    head_rows = max(2 * period, 2)
    block_rows = max(block_rows, head_rows)
    together = max(1, CELLS // (m * d * d))

    def reduce_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for whole in batches:
            for at in range(0, len(whole), together):
                pdf = whole.iloc[at : at + together]
                y = np.full((len(pdf), max(map(len, pdf["values"]))), np.inf)
                for k, own in enumerate(pdf["values"]):
                    y[k, : len(own)] = [v if v is not None and np.isfinite(v) else np.nan for v in own]
                parts = reduce_blocks(y, pdf["blk"].to_numpy() * block_rows, cands, period)
                out = pdf[[*keys, "blk"]].copy()
                out["n"], out["size"] = np.isfinite(y).sum(axis=1), [len(v) for v in pdf["values"]]
                out["summary"] = [_pack(tuple(p[k] for p in parts)) for k in range(len(pdf))]
                out["head"] = [y[k, : min(size, head_rows)].tolist() if blk == 0 else [] for k, (blk, size) in enumerate(zip(out["blk"], out["size"]))]
                yield out

    def merge(pdf: pd.DataFrame) -> tuple[tuple, int, int, list]:
        pdf = pdf.sort_values("blk")
        parts = [_unpack(raw, m, d) for raw in pdf["summary"]]
        whole = parts[0]
        for part in parts[1:]:
            whole = compose(whole, part)
        return whole, int(pdf["n"].sum()), int(pdf["size"].sum()), next((list(h) for h in pdf["head"] if len(h)), [])

    def compose_blocks(pdf: pd.DataFrame) -> pd.DataFrame:
        whole, n, size, head = merge(pdf)
        out = pdf[keys].iloc[:1].copy()
        out["blk"], out["n"], out["size"], out["summary"], out["head"] = pdf["blk"].min() // COMPOSE, n, size, [_pack(whole)], [head]
        return out

    def finish(pdf: pd.DataFrame) -> pd.DataFrame:
        (M, c, Q, q, s), n, size, head = merge(pdf)
        first = pdf[keys].iloc[0]
        records = []
        for i in range(m):
            x = initial_state(pd.Series(head, dtype=float).ffill().bfill().to_numpy(), cands[i], period)
            sse = float(s[i] + q[i] @ x + x @ Q[i] @ x)
            state = M[i] @ x + c[i]
            state[2:] = np.roll(state[2:], -(size % period)) if period else state[2:]  # the next season first
            records.append([*first, i, max(sse, 0.0), n, state.tolist()])
        return pd.DataFrame(records, columns=[*keys, "cand", "sse", "n", "state"])

    source = rows.select(*keys, F.expr(f"idx div {block_rows}").alias("blk"), "idx", F.col(value).cast("double").alias("v"))
    # a block has a bounded number of rows; positions are dense, so their order is all that is needed
    blocks = source.groupBy(*keys, "blk").agg(F.transform(F.array_sort(F.collect_list(F.struct("idx", "v"))), lambda x: x["v"]).alias("values"))
    reduced = blocks.mapInPandas(reduce_rows, ddl)
    composed = reduced.groupBy(*keys, F.expr(f"blk div {COMPOSE}")).applyInPandas(lambda pdf: compose_blocks(pdf), ddl)
    return composed.groupBy(*keys).applyInPandas(finish, f"{key_ddl}, cand int, sse double, n bigint, state array<double>")


def ses_on_grid(rows: DataFrame, alphas: Sequence[float], *, keys: Sequence[str] = KEYS) -> DataFrame:
    """Best simple smoothing per key by one-step squared error: (keys, alpha, sse, level)."""
    fitted = fit(rows, candidates(["simple"], alphas=alphas), keys=keys)
    alpha = F.element_at(F.array(*[F.lit(float(a)) for a in alphas]), F.col("best.cand") + 1)
    best = fitted.groupBy(*keys).agg(F.min(F.struct("sse", "cand", "state")).alias("best"))
    return best.select(*keys, alpha.alias("alpha"), F.col("best.sse").alias("sse"), F.col("best.state")[0].alias("level"))


def exponential_smoothing(train: DataFrame, *, horizon: int, kinds: Sequence[str] = ("simple", "holt", "damped"),
                          period: int = 0, multiplicative: bool = False, criterion: str = "aic",
                          keys: Sequence[str] = KEYS, y: str = "y", freq: str = "D", **grid) -> DataFrame:
    """M7 / automatic ETS: the candidate with the least information criterion, per series and window.

    Adds the columns kind, alpha and criterion to the forecast.
    """
    if any("+season" in k for k in kinds) and not period:
        raise ValueError("a seasonal kind needs a period")
    cands = candidates(kinds, **grid)
    value = F.log(y) if multiplicative else F.col(y)
    fitted = fit(train.withColumn("v", value), cands, period=period, keys=keys)
    table = F.array(*[F.struct(*[F.lit(c[n]).alias(n) for n in ("kind", "alpha", "phi", "k")]) for c in cands])
    scored = fitted.withColumn("c", F.element_at(table, F.col("cand") + 1))
    penalty = 2.0 * F.col("c.k") if criterion == "aic" else F.log("n") * F.col("c.k")
    ic = F.col("n") * F.log(F.greatest(F.col("sse"), F.lit(1e-300)) / F.col("n")) + penalty
    best = scored.groupBy(*keys).agg(F.min(F.struct(ic.alias("ic"), "cand", "c", "state")).alias("b"))
    placed = best.join(ends(train, keys), list(keys)).select("*", "b.*")
    state = F.col("state")

    def at(h):
        # sum of phi^1..phi^h
        phi = F.col("c.phi")
        steps = F.when(phi == 1, h.cast("double")).otherwise(
            F.coalesce(F.try_divide(phi * (1 - F.pow(phi, h)), 1 - phi), F.lit(0.0)))
        level = state[0] + state[1] * steps
        if period:
            level = level + F.element_at(state, F.pmod(h - 1, F.lit(period)) + 3)
        return F.exp(level) if multiplicative else level

    path = F.transform(F.sequence(F.lit(1), F.lit(horizon)), at)
    chosen = placed.select(*keys, F.col("c.kind").alias("kind"), F.col("c.alpha").alias("alpha"), F.col("ic").alias("criterion"))
    return unfold_array(placed, keys, path, freq=freq).join(chosen, list(keys))
