"""Closed-form forecasters: each is one aggregation over the training rows (M1-M4 one lag, M8-M9, M16).

Training rows carry `idx` (position in the window), `nt` (number of training rows of the window),
`ts` and the target.  Results have (keys, step, ts, pred), step from 1.  A smoothed level is a
weighted sum whose weights depend on the position only, so it aggregates map-side and a long
series is never gathered.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelloom.functions.timeaxis import next_steps
from panelloom.operators import blocks

KEYS = ("series",)


def ends(train: DataFrame, keys: Sequence[str], **aggs: Column) -> DataFrame:
    """Per key: training length, last timestamp and further aggregates."""
    return train.groupBy(*keys).agg(
        F.max("nt").alias("nt"), F.max("ts").alias("last_ts"), *[a.alias(name) for name, a in aggs.items()]
    )


def unfold(fitted: DataFrame, keys: Sequence[str], horizon: int, pred: Column, *, freq: str = "D") -> DataFrame:
    """One row per forecast step; `pred` may use `step` and the fitted columns."""
    rows = fitted.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(horizon))))
    return rows.select(*keys, "step", next_steps(F.col("last_ts"), F.col("step"), freq).alias("ts"), pred.alias("pred"))


def unfold_array(fitted: DataFrame, keys: Sequence[str], path: Column, *, freq: str = "D") -> DataFrame:
    """Like `unfold` for a fitted column that already holds the whole path as an array."""
    rows = fitted.select(*keys, "last_ts", F.posexplode(path).alias("_p", "pred"))
    step = F.col("_p") + 1
    return rows.select(*keys, step.alias("step"), next_steps(F.col("last_ts"), step, freq).alias("ts"), "pred")


def last_value(train: DataFrame, *, horizon: int, keys: Sequence[str] = KEYS, y: str = "y", freq: str = "D") -> DataFrame:
    """M1: repeat the last value."""
    return unfold(ends(train, keys, last=F.max_by(y, "idx")), keys, horizon, F.col("last"), freq=freq)


def drift(train: DataFrame, *, horizon: int, keys: Sequence[str] = KEYS, y: str = "y", freq: str = "D") -> DataFrame:
    """M2: continue the line through the first and the last value."""
    fitted = ends(train, keys, first=F.min_by(y, "idx"), last=F.max_by(y, "idx"))
    slope = F.try_divide(F.col("last") - F.col("first"), F.col("nt") - 1)
    return unfold(fitted, keys, horizon, F.col("last") + F.col("step") * F.coalesce(slope, F.lit(0.0)), freq=freq)


def array_mean(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, v: a + v) / F.size(values)


def array_sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, v: a + v)


def window_aggregate(train: DataFrame, *, horizon: int, input_len: int = 12, output_len: int = 6, shift: int = 0,
                     agg_fn: Callable[[Column], Column] = array_mean, keys: Sequence[str] = KEYS, y: str = "y",
                     freq: str = "D") -> DataFrame:
    """M3/K2: an aggregate of the last `input_len` values, repeated chunk by chunk.

    `agg_fn` maps the array of inputs to one value.  Each chunk of `output_len` predictions is
    appended to the inputs of the next one.  With a `shift` the chunk starts that many steps
    later and the horizon cannot exceed one chunk.
    """
    if shift and horizon > output_len:
        raise ValueError("a shifted output cannot be continued beyond one chunk")
    tail = train.filter(F.col("idx") >= F.col("nt") - input_len)
    fitted = ends(tail, keys, tail=F.transform(
        F.array_sort(F.collect_list(F.struct("idx", F.col(y).cast("double").alias("v")))), lambda e: e["v"]
    ))
    chunks = -(-horizon // output_len)

    def grow(path: Column, _: Column) -> Column:
        value = agg_fn(F.slice(path, F.greatest(F.size(path) - input_len + 1, F.lit(1)), input_len))
        return F.concat(path, F.array_repeat(value, output_len))

    path = F.aggregate(F.sequence(F.lit(1), F.lit(chunks)), F.col("tail"), grow)
    pred = F.slice(path, F.size("tail") + 1, horizon)
    if shift:
        fitted = fitted.withColumn("last_ts", next_steps(F.col("last_ts"), F.lit(shift), freq))
    return unfold_array(fitted, keys, pred, freq=freq)


def one_lag(train: DataFrame, *, horizon: int, keys: Sequence[str] = KEYS, y: str = "y", freq: str = "D") -> DataFrame:
    """M4, one lag per series: least squares of y on its previous value, continued recursively."""
    lagged = blocks.over_halo(train, {"_x": lambda w: F.lag(y).over(w)}, before=1, series=list(keys))
    fitted = ends(lagged, keys, b=F.regr_slope(y, "_x"), a=F.regr_intercept(y, "_x"), last=F.max_by(y, "idx"))
    path = F.aggregate(F.sequence(F.lit(1), F.col("step")), F.col("last").cast("double"), lambda p, _: F.col("a") + F.col("b") * p)
    return unfold(fitted, keys, horizon, path, freq=freq)


def ses_weight(alpha: Column | float, idx: Column, n: Column) -> Column:
    """Weight of the value at `idx` in the smoothed level after n values; the first value starts it."""
    a = F.lit(alpha) if isinstance(alpha, float) else alpha
    return F.pow(1 - a, n - 1 - idx) * F.when(idx == 0, 1.0).otherwise(a)


def weighted_level(weight: Column, value: Column) -> Column:
    """Weighted sum of a series; where values are null, the weighted mean of those that are known."""
    known = F.sum(F.when(value.isNotNull(), weight))
    total = F.sum(weight * value)
    return F.when(F.count(value) == F.max("nt"), total).otherwise(F.try_divide(total, known))


def smoothed(train: DataFrame, *, horizon: int, alpha: Column | float = 0.3, keys: Sequence[str] = KEYS, y: str = "y",
             freq: str = "D") -> DataFrame:
    """M7 simple: exponentially smoothed level with a given alpha; null values leave the weights of the others in proportion."""
    level = weighted_level(ses_weight(alpha, F.col("idx"), F.col("nt")), F.col(y))
    return unfold(ends(train, keys, level=level), keys, horizon, F.col("level"), freq=freq)


def theta(train: DataFrame, *, horizon: int, theta_: Column | float = 2.0, alpha: Column | float = 0.2, season: int = 0,
          season_mode: str = "multiplicative", keys: Sequence[str] = KEYS, y: str = "y", freq: str = "D") -> DataFrame:
    """M9: linear trend combined with the smoothed theta line theta*y + (1 - theta)*trend.

    Smoothing is linear, so the level of the theta line follows from the smoothed y, the smoothed
    position and the regression, all in one aggregation.  With a `season`, values are adjusted by
    the index of their phase before, and the forecast is adjusted back.  Null values take no part.  A series with a phase
    whose mean is 0 has no multiplicative season and is forecast without one.
    """
    data, index = train, None
    if season > 1:
        index = seasonal_index(train, season, season_mode, keys=keys, y=y)
        data = blocks.lookup(train.withColumn("phase", F.col("idx") % season), index, [*keys, "phase"])
        data = data.withColumn(y, F.col(y) / F.col("s") if season_mode == "multiplicative" else F.col(y) - F.col("s"))
    w = ses_weight(alpha, F.col("idx"), F.col("nt"))
    fitted = ends(
        data, keys, b=F.regr_slope(y, "idx"), a=F.regr_intercept(y, "idx"),
        sy=weighted_level(w, F.col(y)), st=weighted_level(w, F.when(F.col(y).isNotNull(), F.col("idx"))),
    )
    trend = F.col("a") + F.col("b") * (F.col("nt") - 1 + F.col("step"))
    level = theta_ * F.col("sy") + (1 - theta_) * (F.col("a") + F.col("b") * F.col("st"))
    pred = (1 - 1 / theta_) * trend + level / theta_
    if index is None:
        return unfold(fitted, keys, horizon, pred, freq=freq)
    base = unfold(fitted, keys, horizon, pred, freq=freq)
    phased = blocks.lookup(base, fitted.select(*keys, "nt"), list(keys)).withColumn(
        "phase", (F.col("nt") - 1 + F.col("step")) % season
    )
    back = blocks.lookup(phased, index, [*keys, "phase"])
    value = F.col("pred") * F.col("s") if season_mode == "multiplicative" else F.col("pred") + F.col("s")
    return back.select(*keys, "step", "ts", value.alias("pred"))


def seasonal_index(train: DataFrame, period: int, mode: str = "multiplicative", *, keys: Sequence[str] = KEYS,
                   y: str = "y") -> DataFrame:
    """Mean of each phase relative to the mean of all phases: (keys, phase, s)."""
    from pyspark.sql import Window as W

    phases = train.groupBy(*keys, (F.col("idx") % period).alias("phase")).agg(F.avg(y).alias("m"))
    whole = W.partitionBy(*keys)  # `period` rows per key
    overall = F.avg("m").over(whole)
    if mode == "multiplicative":
        s = F.when(F.min(F.abs("m")).over(whole) > 0, F.try_divide(F.col("m"), overall))
        s = F.coalesce(s, F.lit(1.0))
    else:
        s = F.coalesce(F.col("m") - overall, F.lit(0.0))
    return phases.select(*keys, "phase", s.alias("s"))


def demand(train: DataFrame, *, keys: Sequence[str] = KEYS, y: str = "y",
           block_rows: int = blocks.BLOCK_ROWS) -> DataFrame:
    """Non-zero rows numbered k = 0..kn-1, with size z and the interval q since the previous one."""
    rows = train.filter(F.col(y) != 0).withColumn("_b", F.expr(f"idx div {block_rows}"))
    ranked = blocks.rank_in_order(rows, keys=list(keys), blocks=["_b"], order=["idx"], name="k", total="kn").drop("_b")
    return blocks.over_halo(
        ranked.withColumn("z", F.col(y).cast("double")),
        {"q": lambda w: (F.col("idx") - F.coalesce(F.lag("idx").over(w), F.lit(-1))).cast("double")},
        before=1, series=list(keys), idx="k",
    )


def as_rows(model: Callable[..., DataFrame], names: Sequence[str]) -> Callable[..., DataFrame | None]:
    """M19 for a model that is one aggregation: candidates are a column of its rows, so that one plan fits any number of them.

    The result is (keys, trial, step, ts, pred), or None if the candidates set other parameters than `names`.  A training row is multiplied by the candidates
    within its task; what is shuffled are the sums of each.
    """

    def many(train: DataFrame, candidates: Sequence[dict], *, horizon: int, keys: Sequence[str] = KEYS, y: str = "y", freq: str = "D") -> DataFrame | None:
        own = sorted(candidates[0])
        if any(sorted(c) != own for c in candidates) or set(own) - set(names):
            return None
        rows = train.select(*keys, "idx", "nt", "ts", F.col(y), F.inline(candidate_array(candidates, own)))
        return model(rows, horizon=horizon, keys=[*keys, "trial", *own], y=y, freq=freq, **{c: F.col(c) for c in own}).drop(*own)

    return many


def candidate_array(candidates: Sequence[dict], names: Sequence[str]) -> Column:
    return F.array(*[F.struct(F.lit(i).alias("trial"), *[F.lit(float(c[n])).alias(n) for n in names]) for i, c in enumerate(candidates)])


def croston(train: DataFrame, *, horizon: int, version: str = "classic", alpha: float = 0.1, alpha_d: float = 0.1,
            alpha_p: float = 0.1, grid: Sequence[float] = (0.1, 0.2, 0.3), keys: Sequence[str] = KEYS, y: str = "y",
            freq: str = "D") -> DataFrame:
    """M8: smoothed demand size over smoothed demand interval.

    Versions: classic, sba (bias-corrected), tsb (size times smoothed demand probability) and
    optimized (size and interval each take the alpha of `grid` with the least one-step error).
    A series without demand is forecast as 0.
    """
    base = ends(train, keys)
    rows = demand(train, keys=keys, y=y)
    if version == "optimized":
        from panelloom.forecast.smoothing import ses_on_grid

        z = ses_on_grid(rows.select(*keys, F.col("k").alias("idx"), F.col("z").alias("v")), grid, keys=keys).select(*keys, F.col("level").alias("z"))
        q = ses_on_grid(rows.select(*keys, F.col("k").alias("idx"), F.col("q").alias("v")), grid, keys=keys).select(*keys, F.col("level").alias("q"))
        fitted, value = z.join(q, list(keys)), F.try_divide(F.col("z"), F.col("q"))
    elif version == "tsb":
        size = rows.groupBy(*keys).agg(F.sum(ses_weight(alpha_d, F.col("k"), F.col("kn")) * F.col("z")).alias("z"))
        occurs = F.when(F.col(y) != 0, 1.0).otherwise(0.0)
        chance = train.groupBy(*keys).agg(F.sum(ses_weight(alpha_p, F.col("idx"), F.col("nt")) * occurs).alias("p"))
        fitted, value = size.join(chance, list(keys)), F.col("z") * F.col("p")
    elif version in ("classic", "sba"):
        w = ses_weight(alpha, F.col("k"), F.col("kn"))
        fitted = rows.groupBy(*keys).agg(F.sum(w * F.col("z")).alias("z"), F.sum(w * F.col("q")).alias("q"))
        factor = 1.0 if version == "classic" else 1 - alpha / 2
        value = factor * F.try_divide(F.col("z"), F.col("q"))
    else:
        raise ValueError(f"unknown version {version!r}")
    joined = base.join(fitted.select(*keys, value.alias("value")), list(keys), "left")
    return unfold(joined, keys, horizon, F.coalesce("value", F.lit(0.0)), freq=freq)


def croston_candidates(train: DataFrame, candidates: Sequence[dict], *, horizon: int, keys: Sequence[str] = KEYS, y: str = "y",
                       freq: str = "D") -> DataFrame | None:
    """M19 for the classic and bias-corrected versions: demand is numbered once, candidates are a column of its rows."""
    if any(c.get("version", "classic") not in ("classic", "sba") or c.keys() - {"version", "alpha"} for c in candidates):
        return None
    keys = list(keys)
    full = [{"alpha": c.get("alpha", 0.1), "biased": float(c.get("version", "classic") == "classic")} for c in candidates]
    table = candidate_array(full, ["alpha", "biased"])
    rows = demand(train, keys=keys, y=y).select(*keys, "k", "kn", "z", "q", F.inline(table))
    w = ses_weight(F.col("alpha"), F.col("k"), F.col("kn"))
    fitted = rows.groupBy(*keys, "trial", "alpha", "biased").agg(F.sum(w * F.col("z")).alias("z"), F.sum(w * F.col("q")).alias("q"))
    factor = F.when(F.col("biased") == 1, 1.0).otherwise(1 - F.col("alpha") / 2)
    values = fitted.select(*keys, "trial", (factor * F.try_divide(F.col("z"), F.col("q"))).alias("value"))
    base = ends(train, keys).select("*", F.inline(table)).drop("alpha", "biased")
    joined = base.join(values, [*keys, "trial"], "left")
    return unfold(joined, [*keys, "trial"], horizon, F.coalesce("value", F.lit(0.0)), freq=freq)


def local_level(train: DataFrame, *, horizon: int, q: Column | float = 0.1, r: Column | float = 1.0, p0: float = 1e6,
                keys: Sequence[str] = KEYS, y: str = "y", freq: str = "D") -> DataFrame:
    """Kalman filter with one random-walk state, started at 0 with variance p0.

    The gains depend on the position only, so the filtered state is a weighted sum.  The variance after i values is a ratio
    u / v of two numbers that the matrix [[r, qr], [1, q+r]] maps on; v is a sum of two powers of its eigenvalues, or
    a line times a power where q is 0, and gains and their products are ratios of v.  Null values leave the weights of
    the others in proportion.
    """
    if p0 <= 0 or any(isinstance(x, (int, float)) and x < low for x, low in ((q, 0), (r, 1e-300))):
        raise ValueError("the variances r and p0 must be above 0, q at least 0")
    idx, n = F.col("idx").cast("double"), F.col("nt").cast("double")
    q, r = (x if isinstance(x, Column) else F.lit(float(x)) for x in (q, r))
    u0, v0 = p0 * r, p0 + r
    root = F.sqrt(q * q + 4 * q * r)
    large = (q + 2 * r + root) / 2
    small = r * r / large
    first = F.try_divide(u0 + (q + r) * v0 - small * v0, root)

    def v(i: Column) -> Column:
        return F.when(root > 0, first + (v0 - first) * F.pow(small / large, i)).otherwise(v0 + i * (u0 / r))

    # v(i) is in units of large ** i
    gain = F.when(idx == 0, p0 / (p0 + r)).otherwise(1 - (r / large) * v(idx - 1) / v(idx))
    weight = gain * v(idx) / v(n - 1) * F.pow(r / large, n - 1 - idx)
    return unfold(ends(train, keys, level=weighted_level(weight, F.col(y))), keys, horizon, F.col("level"), freq=freq)
