"""Least-squares forecasters from normal equations.

Sums of products are aggregated by Spark; what reaches Python is one small matrix per key (per
series and window, or a single one for pooled models) and the last few values of each series.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from panelloom.forecast.naive import KEYS, ends, unfold_array
from panelloom.functions.timeaxis import next_steps


def normal_equations(df: DataFrame, keys: Sequence[str], xs: Sequence[Column], ys: Sequence[Column]) -> DataFrame:
    """Per key: m (rows), xx (upper triangle of X'X), xy (X'Y, row by row), yy; incomplete rows are skipped."""
    k, x, t = len(xs), F.col("_x"), F.col("_t")
    # two array columns instead of one column per regressor keep the plan small
    rows = df.select(*keys, F.array(*[c.cast("double") for c in xs]).alias("_x"), F.array(*[c.cast("double") for c in ys]).alias("_t"))
    rows = rows.filter(~F.exists(x, F.isnull) & ~F.exists(t, F.isnull))
    xx = [F.sum(x[i] * x[j]) for i in range(k) for j in range(i, k)]
    xy = [F.sum(x[i] * t[j]) for i in range(k) for j in range(len(ys))]
    yy = [F.sum(t[j] * t[j]) for j in range(len(ys))]
    return rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("m"), F.array(*xx).alias("xx"), F.array(*xy).alias("xy"), F.array(*yy).alias("yy")
    )


def symmetric(upper: Sequence[float], k: int) -> np.ndarray:
    out = np.zeros((k, k))
    out[np.triu_indices(k)] = upper
    return out + np.triu(out, 1).T


def solve(xx: np.ndarray, xy: np.ndarray, ridge: float = 0.0, free: Sequence[int] = ()) -> np.ndarray:
    """Coefficients; `ridge` is scaled by the diagonal and does not apply to the `free` columns.

    Columns are scaled to unit length first, so that powers and counts of any size stay solvable;
    a singular system gets its minimum-norm solution.
    """
    scale = np.sqrt(np.clip(np.diag(xx), 1e-300, None))
    a = xx / np.outer(scale, scale)
    penalty = np.full(len(scale), ridge)
    penalty[list(free)] = 0.0
    beta = np.linalg.lstsq(a + np.diag(penalty), xy / scale[:, None], rcond=1e-12)[0]
    return beta / scale[:, None]


def coefficients(equations: DataFrame, k: int, outputs: int = 1, *, ridge: float = 0.0, free: Sequence[int] = ()) -> DataFrame:
    """Replace the sums by `beta`, the coefficients output by output."""

    @F.pandas_udf("array<double>")
    def beta(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for xx, xy in batches:
            yield pd.Series([
                solve(symmetric(u, k), np.reshape(v, (k, outputs)), ridge, free).T.ravel().tolist() for u, v in zip(xx, xy)
            ])

    return equations.withColumn("beta", beta("xx", "xy")).drop("xx", "xy", "yy")


def tails(train: DataFrame, rows: int, cols: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Last `rows` values of each column per key as arrays in time order, with nt and last_ts."""
    last = train.filter(F.col("idx") >= F.col("nt") - rows)
    item = F.struct("idx", *[F.col(c).cast("double").alias(f"v{i}") for i, c in enumerate(cols)])
    got = ends(last, keys, items=F.array_sort(F.collect_list(item)))
    # a field of an array of structs is the array of that field
    return got.select(*keys, "nt", "last_ts", *[F.col(f"items.v{i}").alias(f"tail_{c}") for i, c in enumerate(cols)])


def lagged(train: DataFrame, cols: Sequence[str], lags: int, keys: Sequence[str], leads: int = 0) -> DataFrame:
    """Columns <c>_lag1.. and, for `leads`, <c>_lead0.. within each key."""
    from panelloom.operators.features import lag_features

    steps = {c: range(leads) for c in cols} if leads else {}
    return lag_features(train, {c: range(1, lags + 1) for c in cols}, leads=steps, series=list(keys))


def polynomial(d: int, season: int = 0, D: int = 0) -> np.ndarray:
    """Coefficients of d differences and D seasonal ones, the newest value first."""
    out = np.ones(1)
    for lag in [1] * d + [season] * D:
        out = np.convolve(out, [1.0, *[0.0] * (lag - 1), -1.0])
    return out


def difference(col: str, d: int, lag: int, season: int = 0, D: int = 0) -> Column:
    """The d-th (and D-th seasonal) difference of a column, `lag` rows back, from its lags <col>_lag1.. in the same row."""
    terms = [float(c) * F.col(f"{col}_lag{lag + i}" if lag + i else col).cast("double") for i, c in enumerate(polynomial(d, season, D)) if c]
    return sum(terms[1:], terms[0])


def continued(tail: np.ndarray, beta: dict[int, float], differences: np.ndarray, horizon: int, line: tuple[float, float] = (0.0, 0.0)) -> np.ndarray:
    """Continue a series by an autoregression (coefficient by lag) on its differences, around a line (value at step 1, slope)."""
    w, levels, path = list(np.convolve(tail, differences, "valid")), list(tail), []
    for h in range(horizon):
        w.append(line[0] + h * line[1] + sum(b * w[-lag] for lag, b in beta.items()))
        levels.append(w[-1] - sum(c * levels[-j] for j, c in enumerate(differences) if j))
        path.append(levels[-1])
    return np.asarray(path)


def ar_path(tail: np.ndarray, beta: np.ndarray, d: int, horizon: int) -> np.ndarray:
    """Continue a series by an autoregression (beta = lag 1.., intercept last) on its d-th differences."""
    return continued(tail, dict(enumerate(beta[:-1], 1)), polynomial(d), horizon, (beta[-1], 0.0))


@dataclass(frozen=True)
class Order:
    """An autoregression: p lags and P lags of the season, on d differences and D of the season, with a trend n, c, t or ct.

    The trend is a constant (c) and a slope over positions (t) of the differenced series.
    """

    p: int = 12
    d: int = 1
    trend: str = "c"
    P: int = 0
    D: int = 0

    def lags(self, season: int) -> list[int]:
        return sorted({*range(1, self.p + 1), *(season * i for i in range(1, self.P + 1))})


def arima_fits(train: DataFrame, orders: Sequence[Order], *, horizon: int, season: int = 0, keys: Sequence[str] = KEYS, y: str = "y") -> DataFrame:
    """(keys, last_ts, order, aic, path): conditional least squares of every order; `order` is its place in `orders`.

    Orders with the same differences come from one set of sums: the equations of a smaller one are a part of those of all lags.  All
    are fitted on the same rows, so that criteria compare.  A series too short for all lags has null paths.
    """
    if any(o.trend not in ("n", "c", "t", "ct") or o.p < 0 or (o.P or o.D) and season < 2 for o in orders):
        raise ValueError("a trend is n, c, t or ct; lags and differences of a season need its length")
    keys = list(keys)
    lags = sorted({lag for o in orders for lag in o.lags(season)})
    kinds = sorted({(o.d, o.D) for o in orders})
    reach = max(lags, default=0) + max(d + season * D for d, D in kinds)
    # one halo of lags of the values; differences and their lags are arithmetic on it
    rows = lagged(train, [y], reach, keys) if reach else train
    rows = rows.filter(F.col("idx") >= reach)
    line = [F.lit(1.0), *([F.col("idx").cast("double")] if any("t" in o.trend for o in orders) else [])]
    k = len(lags) + len(line)
    parts = []
    for d, D in kinds:
        xs = [difference(y, d, i, season, D) for i in lags] + line
        parts.append(normal_equations(rows, keys, xs, [difference(y, d, 0, season, D)]).withColumn("_plain", F.lit(d)).withColumn("_seasonal", F.lit(D)))
    sums = parts[0]
    for part in parts[1:]:
        sums = sums.unionByName(part)

    @F.pandas_udf("array<struct<order: int, aic: double, path: array<double>>>")
    def fits(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for columns in batches:
            out = []
            for m, u, v, s, d, D, n, t in zip(*columns):
                own = [i for i, o in enumerate(orders) if pd.isna(d) or (o.d, o.D) == (d, D)]
                if u is None or len(t) <= reach:
                    out.append([(i, None, [None] * horizon) for i in own])
                    continue
                full, rhs = symmetric(u, k), np.asarray(v)
                found = []
                for i in own:
                    o = orders[i]
                    used = o.lags(season)
                    pick = [*(lags.index(x) for x in used), *([len(lags)] if "c" in o.trend else []), *([len(lags) + 1] if "t" in o.trend else [])]
                    beta = solve(full[np.ix_(pick, pick)], rhs[pick][:, None])[:, 0] if pick else np.zeros(0)
                    sse = max(s[0] - 2 * beta @ rhs[pick] + beta @ full[np.ix_(pick, pick)] @ beta, 1e-300) if pick else max(s[0], 1e-300)
                    slope = beta[-1] if "t" in o.trend else 0.0
                    start = (beta[len(used)] if "c" in o.trend else 0.0) + slope * n
                    path = continued(np.asarray(t), dict(zip(used, beta)), polynomial(o.d, season, o.D), horizon, (start, slope))
                    found.append((i, m * math.log(sse / m) + 2 * (len(pick) + o.d + o.D), path.tolist()))
                out.append(found)
            yield pd.Series(out)

    joined = tails(train, reach + 1, [y], keys).join(sums, keys, "left")
    fitted = joined.withColumn("f", F.explode(fits("m", "xx", "xy", "yy", "_plain", "_seasonal", "nt", f"tail_{y}")))
    return fitted.select(*keys, "last_ts", "f.order", "f.aic", "f.path")


def arima(train: DataFrame, *, horizon: int, p: int = 12, d: int = 1, orders: Sequence[int] | None = None,
          differences: Sequence[int] | None = None, trend: str = "c", trends: Sequence[str] | None = None, season: int = 0, P: int = 0, D: int = 0,
          keys: Sequence[str] = KEYS, y: str = "y", freq: str = "D") -> DataFrame:
    """ARIMA(p, d, 0)(P, D, 0) per series by conditional least squares; of several `orders`, `differences` and `trends` those of least AIC.

    Adds the chosen p, d and trend and the AIC.  A series too short for the lags has null forecasts.
    """
    keys = list(keys)
    tried = [Order(o, dd, t, P, D) for dd in sorted([d] if differences is None else differences)
             for o in sorted([p] if orders is None else orders) for t in ([trend] if trends is None else trends)]
    fitted = arima_fits(train, tried, horizon=horizon, season=season, keys=keys, y=y)
    # ties go to the first one tried; a series without a fit keeps its null path
    chosen = fitted.groupBy(*keys).agg(F.min(F.struct("aic", "order", "path", "last_ts")).alias("c")).select(*keys, "c.*")
    own = [F.array(*[F.lit(getattr(o, name)) for o in tried])[F.col("order")] for name in ("p", "d", "trend")]
    known = F.col("aic").isNotNull()
    described = chosen.select(*keys, *[F.when(known, c).alias(name) for name, c in zip(("p", "d", "trend"), own)], "aic")
    return unfold_array(chosen, keys, F.col("path"), freq=freq).join(described, keys)


def arima_candidates(train: DataFrame, candidates: Sequence[dict], *, horizon: int, keys: Sequence[str] = KEYS, y: str = "y", freq: str = "D") -> DataFrame | None:
    """Forecasts of many parameter sets from the sums of all lags: (keys, trial, step, ts, pred); None if their seasons differ.

    All are fitted on the rows that have the lags of the largest.
    """
    seasons = {c.get("season", 0) for c in candidates}
    if len(seasons) > 1 or any({"orders", "differences", "trends"} & c.keys() for c in candidates):
        return None
    tried = [Order(**{name: c[name] for name in ("p", "d", "trend", "P", "D") if name in c}) for c in candidates]
    fitted = arima_fits(train, tried, horizon=horizon, season=seasons.pop(), keys=keys, y=y).withColumnRenamed("order", "trial")
    return unfold_array(fitted, [*keys, "trial"], F.col("path"), freq=freq)


def levinson(autocovariance: np.ndarray, most: int) -> list[tuple[np.ndarray, float]]:
    """Coefficients and error variance of the autoregressions of order 0 to `most` from autocovariances, one order from the last."""
    phi, error = np.zeros(0), max(float(autocovariance[0]), 0.0)
    out = [(phi, error)]
    for p in range(1, most + 1):
        if error <= 1e-12 * autocovariance[0] or autocovariance[0] <= 0:
            break
        k = (autocovariance[p] - phi @ autocovariance[p - 1 : 0 : -1]) / error if p > 1 else autocovariance[1] / error
        phi = np.append(phi - k * phi[::-1], k)
        error *= 1 - k * k
        out.append((phi, max(error, 0.0)))
    return out


def stationarity(partial_squares: float, autocovariance: np.ndarray, n: float) -> float:
    """KPSS statistic of a level: squared partial sums against the long-run variance (Bartlett weights)."""
    width = int(4 * (n / 100) ** 0.25)
    long_run = autocovariance[0] + 2 * sum((1 - i / (width + 1)) * autocovariance[i] for i in range(1, width + 1))
    return partial_squares / (n * n * long_run) if long_run > 0 else 0.0


def auto_arima(train: DataFrame, *, horizon: int, max_p: int = 5, max_d: int = 2, season: int = 0, critical: float = 0.463,
               keys: Sequence[str] = KEYS, y: str = "y", freq: str = "D") -> DataFrame:
    """M10 automatic: the fewest differences whose KPSS statistic is below `critical` (5 %), then the order of least AIC.

    All orders up to max_p, and those of the season and the one after it, come from one set of autocovariances by the Levinson-Durbin recursion.  Partial sums
    are taken per block of rows and carried over, so no series is gathered.  Adds p, d, the statistic and the AIC.  A series with
    a null inside, or one with 10 rows at most beside its lags, has null forecasts.
    """
    from panelloom.operators import blocks

    keys = list(keys)
    longest = train.agg(F.max("nt")).first()[0] or 1
    width = int(4 * (longest / 100) ** 0.25)
    top = max(max_p, season + 1 if season else 0)
    most, degrees = max(top, width, 1), range(max_d + 1)
    idx, n = F.col("idx"), F.col("nt")

    def mean(d: int) -> Column:
        # a sum of differences is the last one of one degree less, minus the first
        if not d:
            return F.avg(y)
        terms = [float(c) * (F.when(idx == n - 1 - j, F.col(y)).when(idx == d - 1 - j, -F.col(y)).otherwise(0.0)) for j, c in enumerate(polynomial(d - 1))]
        return F.try_divide(F.sum(sum(terms[1:], terms[0])), F.max(n) - d)

    means = train.groupBy(*keys).agg((F.count(y) == F.max(n)).alias("whole"), *[mean(d).alias(f"mean{d}") for d in degrees])
    usable = means.filter("whole").drop("whole")
    rows = blocks.lookup(lagged(train, [y], most + max_d, keys), usable, keys)
    centred = {(d, i): F.when(idx >= d + i, difference(y, d, i) - F.col(f"mean{d}")) for d in degrees for i in range(most + 1)}
    gammas = [F.array(*[F.coalesce(F.sum(centred[d, 0] * centred[d, i]), F.lit(0.0)) for i in range(most + 1)]).alias(f"g{d}") for d in degrees]
    block = F.expr(f"idx div {blocks.BLOCK_ROWS}")
    inside = W.partitionBy(*keys, "_blk").orderBy("idx").rowsBetween(W.unboundedPreceding, 0)
    parts = rows.select(*keys, "idx", "nt", y, *[F.col(f"{y}_lag{i}") for i in range(1, most + max_d + 1)], *[f"mean{d}" for d in degrees], block.alias("_blk"))
    parts = parts.select("*", *[F.coalesce(centred[d, 0], F.lit(0.0)).alias(f"c{d}") for d in degrees])
    parts = parts.select("*", *[F.sum(f"c{d}").over(inside).alias(f"s{d}") for d in degrees])
    per_block = parts.groupBy(*keys, "_blk").agg(
        F.count(F.lit(1)).alias("b"), *gammas, *[F.sum(f"c{d}").alias(f"c{d}") for d in degrees], *[F.sum(f"s{d}").alias(f"s{d}") for d in degrees],
        *[F.sum(F.col(f"s{d}") * F.col(f"s{d}")).alias(f"q{d}") for d in degrees])
    earlier = W.partitionBy(*keys).orderBy("_blk").rowsBetween(W.unboundedPreceding, -1)
    carried = per_block.select("*", *[F.coalesce(F.sum(f"c{d}").over(earlier), F.lit(0.0)).alias(f"o{d}") for d in degrees])
    squares = [F.sum(F.col("b") * F.col(f"o{d}") ** 2 + 2 * F.col(f"o{d}") * F.col(f"s{d}") + F.col(f"q{d}")) for d in degrees]
    sums = carried.groupBy(*keys).agg(
        F.array(*squares).alias("squares"), *[F.array(*[F.sum(F.col(f"g{d}")[i]) for i in range(most + 1)]).alias(f"g{d}") for d in degrees])
    stats = sums.join(usable, keys).select(*keys, "squares", F.array(*[f"g{d}" for d in degrees]).alias("g"), F.array(*[f"mean{d}" for d in degrees]).alias("means"))
    orders = sorted({*range(max_p + 1), *((season, season + 1) if season else ())})

    @F.pandas_udf("struct<p: int, d: int, kpss: double, aic: double, path: array<double>>")
    def choose(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        for columns in batches:
            out = []
            for squares, g, mean, nt, tail in zip(*columns):
                if squares is None or nt <= top + max_d + 10:
                    out.append((None, None, None, None, [None] * horizon))
                    continue
                for d in degrees:
                    size = nt - d
                    gamma = np.asarray(g[d], dtype=float) / size
                    kpss = stationarity(squares[d], gamma, size)
                    if kpss <= critical:
                        break
                found = levinson(gamma, top)
                scored = [(size * math.log(max(found[p][1], 1e-300)) + 2 * (p + 1 + d), p) for p in orders if p < len(found)]
                aic, p = min(scored)
                phi = found[p][0]
                path = continued(np.asarray(tail), dict(enumerate(phi, 1)), polynomial(d), horizon, (mean[d] * (1 - phi.sum()), 0.0))
                out.append((p, d, kpss, aic, path.tolist()))
            yield pd.DataFrame(out, columns=["p", "d", "kpss", "aic", "path"])

    joined = tails(train, top + max_d + 1, [y], keys).join(stats, keys, "left")
    fitted = joined.withColumn("b", choose("squares", "g", "means", "nt", f"tail_{y}")).select(*keys, "last_ts", "b.*")
    return unfold_array(fitted, keys, F.col("path"), freq=freq).join(fitted.select(*keys, "p", "d", "kpss", "aic"), keys)


def varima(train: DataFrame, *, horizon: int, cols: Sequence[str] = (), p: int = 12, d: int = 1, keys: Sequence[str] = KEYS,
           y: str = "y", past: Sequence[str] = (), freq: str = "D") -> DataFrame:
    """VARIMA(p, d, 0): every component on the lags of all; `pred` is the first, `preds` all of them.

    The components are `cols`, or the target and the `past` columns.
    """
    cols = list(cols) or [y, *past]
    keys, m = list(keys), len(cols)
    # one halo of lags of all values; differences and their lags are arithmetic on it
    data = lagged(train, cols, p + d, keys)
    xs = [difference(c, d, i) for i in range(1, p + 1) for c in cols] + [F.lit(1.0)]
    fitted = coefficients(normal_equations(data, keys, xs, [difference(c, d, 0) for c in cols]), len(xs), m)

    @F.pandas_udf("array<array<double>>")
    def path(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for beta, *tail in batches:
            out = []
            for i, b in enumerate(beta):
                if b is None or len(tail[0].iloc[i]) < p + d:
                    out.append([[None] * m] * horizon)
                    continue
                B = np.reshape(b, (m, -1))
                level = np.stack([np.asarray(t.iloc[i]) for t in tail], 1)
                steps = [level]
                for _ in range(d):
                    steps.append(np.diff(steps[-1], axis=0))
                w, new = list(steps[-1][-p:]), []
                for _ in range(horizon):
                    nxt = B @ np.concatenate([*[w[-1 - j] for j in range(p)], [1.0]])
                    w.append(nxt)
                    new.append(nxt)
                res = np.asarray(new)
                for s in reversed(steps[:-1]):
                    res = s[-1] + np.cumsum(res, axis=0)
                out.append(res.tolist())
            yield pd.Series(out)

    joined = tails(train, p + d, cols, keys).join(fitted, keys, "left")
    preds = joined.withColumn("path", path("beta", *[f"tail_{c}" for c in cols]))
    rows = unfold_array(preds, keys, F.col("path"), freq=freq).withColumnRenamed("pred", "preds")
    return rows.withColumn("pred", F.col("preds")[0])


def moving_average_matrix(size: int, kernel: int) -> np.ndarray:
    """Centred moving average of a chunk whose ends are repeated, as a matrix."""
    half = (kernel - 1) // 2
    out = np.zeros((size, size))
    for i in range(size):
        for j in range(i - half, i - half + kernel):
            out[i, min(max(j, 0), size - 1)] += 1 / kernel
    return out


def known_ahead(ahead: DataFrame, cols: Sequence[str], rows: int, keys: Sequence[str]) -> DataFrame:
    """Columns known in advance, for the `rows` rows after the training part: (keys, ahead), an array per column; missing rows are null."""
    after = ahead.filter((F.col("idx") >= F.col("nt")) & (F.col("idx") < F.col("nt") + rows))
    entries = [F.map_from_entries(F.collect_list(F.struct((F.col("idx") - F.col("nt")).cast("int"), F.col(c).cast("double")))).alias(f"m{i}")
               for i, c in enumerate(cols)]
    steps = F.sequence(F.lit(0), F.lit(rows - 1))

    def along(i: int) -> Column:
        return F.transform(steps, lambda h: F.try_element_at(F.col(f"m{i}"), h))

    arrays = [along(i) for i in range(len(cols))]
    return after.groupBy(*keys).agg(*entries).select(*keys, F.array(*arrays).alias("ahead"))


def chunk_linear(train: DataFrame, *, horizon: int, kind: str = "nlinear", input_len: int = 12, output_len: int = 6,
                 kernel: int = 25, ridge: float = 1e-6, keys: Sequence[str] = KEYS, y: str = "y", freq: str = "D",
                 past: Sequence[str] = (), future: Sequence[str] = (), static: Sequence[str] = (), ahead: DataFrame | None = None) -> DataFrame:
    """One linear map from the last `input_len` values to the next `output_len`, pooled over all series.

    "linear" maps the values, "nlinear" the values minus the last one, "dlinear" their moving
    average and the remainder by two maps (moving average and remainder are linear in the chunk,
    so their equations follow from those of the chunk).  Longer horizons continue chunk by chunk.  A
    series shorter than `input_len` has null forecasts.

    Covariates add their own columns to the map: `past` the last `input_len` values, of which the newest is held beyond the
    training rows; `future` the values at the steps of the chunk itself, which `ahead` (rows with idx and nt, those after the
    training part included) gives over the horizon; `static` the value of the last row.  A chunk whose inputs hold a null
    has null forecasts, and so has what follows; in the last chunk a step beyond the horizon without a row takes the value before it.
    """
    keys, L, O = list(keys), input_len, output_len
    past, future, static = list(past), list(future), list(static)
    if future and ahead is None:
        raise ValueError("columns known in advance need the rows of the horizon")
    data = lagged(train, [y], L, keys, leads=O)
    if past or future:
        from panelloom.operators.features import lag_features

        data = lag_features(data, {c: range(1, L + 1) for c in past}, leads={c: range(O) for c in future}, series=keys)
    last = F.col(f"{y}_lag1")
    shift = last if kind == "nlinear" else F.lit(0.0)
    # x runs in time order: oldest first
    xs = [F.col(f"{y}_lag{i}") - shift for i in range(L, 0, -1)] + [F.col(f"{c}_lag{i}") for c in past for i in range(L, 0, -1)]
    xs += [F.col(f"{c}_lead{i}") for c in future for i in range(O)] + [F.col(c) for c in static] + [F.lit(1.0)]
    ys = [F.col(f"{y}_lead{i}") - shift for i in range(O)]
    sums = normal_equations(data, [], xs, ys)
    K = len(xs)
    T = np.eye(K)
    if kind == "dlinear":
        M = moving_average_matrix(L, kernel)
        T = np.zeros((L + K, K))
        T[:L, :L], T[L:2 * L, :L], T[2 * L:, L:] = M, np.eye(L) - M, np.eye(K - L)

    @F.pandas_udf("array<double>")
    def pooled(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for xx, xy in batches:
            out = []
            for u, v in zip(xx, xy):
                a, b = symmetric(u, K), np.reshape(v, (K, O))
                beta = solve(T @ a @ T.T, T @ b, ridge, free=[len(T) - 1])
                out.append((T.T @ beta).T.ravel().tolist())  # back to a map of the chunk itself
            yield pd.Series(out)

    chunks = -(-horizon // O)

    @F.pandas_udf("array<double>")
    def path(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for beta, tail, before, later, fixed in batches:
            out = []
            for b, t, pasts, futures, constant in zip(beta, tail, before, later, fixed):
                if len(t) < L:
                    out.append([None] * horizon)
                    continue
                B, w = np.reshape(b, (O, K)), [np.nan if x is None else x for x in t]
                held = [np.asarray(x, dtype=float) for x in pasts]
                known = [pd.Series(x, dtype=float) for x in futures] if futures is not None else [pd.Series([np.nan] * chunks * O)] * len(future)
                known = [x.where(x.index < horizon, x.ffill()).to_numpy() for x in known]
                own = np.asarray(constant, dtype=float)
                for k in range(chunks):
                    x = np.asarray(w[-L:])
                    base = x[-1] if kind == "nlinear" else 0.0
                    inputs = np.concatenate([x - base, *held, *[z[k * O : (k + 1) * O] for z in known], own, [1.0]])
                    w.extend((B @ inputs + base).tolist())
                    held = [np.concatenate([z, np.repeat(z[-1], O)])[-L:] for z in held]
                found = w[len(t):len(t) + horizon]
                out.append([None if np.isnan(v) else v for v in found])
            yield pd.Series(out)

    # the fitted map: output_len numbers for each input, whatever the size of the data
    beta = sums.select(pooled("xx", "xy").alias("beta")).first()["beta"]
    ready = tails(train, L, [y, *past], keys)
    none = F.array().cast("array<double>")
    if static:
        ends_of = train.filter(F.col("idx") == F.col("nt") - 1).select(*keys, F.array(*[F.col(c).cast("double") for c in static]).alias("static"))
        ready = ready.join(ends_of, keys)
    if future:
        ready = ready.join(known_ahead(ahead, future, chunks * O, keys), keys, "left")
    pasts = F.array(*[F.col(f"tail_{c}") for c in past]) if past else F.array().cast("array<array<double>>")
    fitted = ready.withColumn("path", path(F.array(*map(F.lit, beta)), f"tail_{y}", pasts,
                                           F.col("ahead") if future else F.array().cast("array<array<double>>"), F.col("static") if static else none))
    return unfold_array(fitted, keys, F.col("path"), freq=freq)


def regressed(base: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """A univariate forecaster that takes columns known in advance: it forecasts what a regression on them leaves.

    The regression is per key; a step whose columns hold a null or have no row in `ahead` has a null forecast.
    """

    def fit_predict(train: DataFrame, *, horizon: int, future: Sequence[str] = (), ahead: DataFrame | None = None,
                    keys: Sequence[str] = KEYS, y: str = "y", freq: str = "D", **params) -> DataFrame:
        if not future:
            return base(train, horizon=horizon, keys=keys, y=y, freq=freq, **params)
        if ahead is None:
            raise ValueError("columns known in advance need the rows of the horizon")
        from panelloom.operators import blocks

        keys = list(keys)
        xs = [F.col(c) for c in future]
        fitted = coefficients(normal_equations(train, keys, [*xs, F.lit(1.0)], [F.col(y)]), len(future) + 1).select(*keys, "beta")
        part = sum((F.col("beta")[i] * F.col(c).cast("double") for i, c in enumerate(future)), F.lit(0.0))
        rest = blocks.lookup(train, fitted, keys).withColumn(y, F.col(y) - part).drop("beta")
        pred = base(rest, horizon=horizon, keys=keys, y=y, freq=freq, **params)
        after = ahead.filter(F.col("idx") >= F.col("nt")).select(*keys, "ts", *future)
        later = blocks.lookup(after, fitted, keys).select(*keys, "ts", part.alias("_part"))
        return pred.join(later, [*keys, "ts"], "left").withColumn("pred", F.col("pred") + F.col("_part")).drop("_part")

    return fit_predict


def fourier_terms(t: Column, periods: dict[float, int]) -> list[Column]:
    """Sine and cosine pairs: `order` of them for each period."""
    out = []
    for period, order in periods.items():
        for k in range(1, order + 1):
            angle = t * F.lit(2 * math.pi * k / period)
            out += [F.sin(angle), F.cos(angle)]
    return out


LAMBDAS = (-1.0, -0.5, 0.0, 0.25, 0.5, 0.75, 1.0)  # powers of a Box-Cox transform; 0 is the logarithm


def box_cox(train: DataFrame, keys: Sequence[str], xs: Sequence[Column], y: str, lambdas: Sequence[float], *, ridge: float,
            free: Sequence[int]) -> DataFrame:
    """(keys, lambda, beta): the power of largest profile likelihood per series, and the coefficients for y ** lambda or ln y.

    One aggregation holds the sums of all powers, and one UDF compares them.  A series with a value at or below 0 is not transformed.
    """
    grid, k = sorted({0.0, 1.0, *map(float, lambdas)}), len(xs)
    able = [g in set(map(float, lambdas)) for g in grid]
    positive = F.col(y) > 0
    powers = [F.col(y).cast("double") if g == 1 else F.when(positive, F.log(y) if g == 0 else F.pow(F.col(y).cast("double"), F.lit(g))).when(~positive, 0.0) for g in grid]
    equations = normal_equations(train, keys, xs, [*powers, F.when(positive, 0.0).when(~positive, 1.0)])
    outputs, log, one = len(grid) + 1, grid.index(0.0), grid.index(1.0)

    @F.pandas_udf("struct<lambda double, beta array<double>>")
    def choose(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        for ms, uppers, crosses, squares in batches:
            out = []
            for m, upper, cross, yy in zip(ms, uppers, crosses, squares):
                xx, xy = symmetric(upper, k), np.reshape(cross, (k, outputs))
                beta = solve(xx, xy, ridge, free)
                if xy[0, -1] > 0:  # the first regressor is 1, so this counts values at or below 0
                    best = one
                else:
                    sse = np.array(yy) - 2 * (beta * xy).sum(axis=0) + (beta * (xx @ beta)).sum(axis=0)
                    likelihood = [-m / 2 * np.log(max(sse[i], 1e-300) / (g or 1.0) ** 2 / m) + (g - 1) * xy[0, log] if ok else -np.inf
                                  for i, (g, ok) in enumerate(zip(grid, able))]
                    best = int(np.argmax(likelihood))
                out.append((grid[best], beta[:, best].tolist()))
            yield pd.DataFrame(out, columns=["lambda", "beta"])

    return equations.withColumn("_c", choose("m", "xx", "xy", "yy")).select(*keys, "_c.*")


def structural(train: DataFrame, *, horizon: int, periods: dict[float, int] | None = None, holidays: bool = True,
               ridge: float = 1e-3, transform: str | None = None, lambdas: Sequence[float] = LAMBDAS, mode: str = "additive", cap: float | None = None,
               floor: float | None = None, keys: Sequence[str] = KEYS, y: str = "y", freq: str = "D") -> DataFrame:
    """Trend, seasonal Fourier terms and holidays by ridge regression per series.

    `transform="log"` or mode "multiplicative" fit the logarithm (log1p).  `transform="boxcox"` fits the power (0: the logarithm)
    among `lambdas` that is likeliest for each series; one with a value at or below 0 is not transformed, and a
    forecast that no value has as its power is 0, for negative powers null.  `cap` and `floor` bound the forecast.
    """
    from panelloom.functions.calendar import holiday_flag

    keys = list(keys)
    periods = {7.0: 3, 365.25: 5} if periods is None else periods
    logged = transform == "log" or mode == "multiplicative"

    def design(t: Column, ts: Column) -> list[Column]:
        out = [F.lit(1.0), t / 365.0, *fourier_terms(t, periods)]
        return [*out, holiday_flag(ts)] if holidays else out

    if transform not in (None, "log", "boxcox") or transform == "boxcox" and logged:
        raise ValueError(f"unknown transform {transform!r} for mode {mode!r}")
    target = F.log1p(y) if logged else F.col(y)
    xs = design(F.col("idx").cast("double"), F.col("ts"))
    if transform == "boxcox":
        fitted = box_cox(train, keys, xs, y, lambdas, ridge=ridge, free=[0, 1])
    else:
        fitted = coefficients(normal_equations(train, keys, xs, [target]), len(xs), ridge=ridge, free=[0, 1])
    future = fitted.join(ends(train, keys), keys).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(horizon))))
    future = future.withColumn("ts", next_steps(F.col("last_ts"), F.col("step"), freq))
    terms = design((F.col("nt") - 1 + F.col("step")).cast("double"), F.col("ts"))
    pred = sum((F.col("beta")[i] * x for i, x in enumerate(terms[1:], 1)), F.col("beta")[0])
    if logged:
        pred = F.expm1(pred)
    if transform == "boxcox":
        power = F.col("lambda")
        back = F.when(power == 0, F.exp(pred)).when(pred > 0, F.pow(pred, F.try_divide(F.lit(1.0), power)))
        pred = F.when(power == 1, pred).otherwise(back.when(power > 0, 0.0))
    if floor is not None:
        pred = F.greatest(pred, F.lit(floor))
    if cap is not None:
        pred = F.least(pred, F.lit(cap))
    return future.select(*keys, "step", "ts", pred.alias("pred"))
