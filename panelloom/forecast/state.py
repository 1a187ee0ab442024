"""Fitted state of closed-form forecasters as a table that new rows update.

One row per series holds what five models need: the first and last value, smoothed levels, and moments of the value with
its position and with the value before.  Each is an aggregate of the rows, and two of them, for a stretch of rows
and for the stretch that follows, merge into that of both: sums add, levels fade by the number of later rows, moments
about the mean add with a term for the distance of the means.  So rows are aggregated once, when they arrive;
predicting reads the state alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelloom.forecast.naive import ses_weight, unfold
from panelloom.operators import blocks

MODELS = ("LastValue", "NaiveDrift", "SimpleSmoothing", "Theta", "OneLag")
# Moments by prefix: of the value with its position, and with the value before it.
PAIRS = ("trend", "lag")


def _moments(prefix: str, y: Column, x: Column) -> list[Column]:
    found = {"m": F.regr_count(y, x).cast("double"), "x": F.regr_avgx(y, x), "y": F.regr_avgy(y, x), "xx": F.regr_sxx(y, x), "xy": F.regr_sxy(y, x)}
    return [F.coalesce(c, F.lit(0.0)).alias(f"{prefix}_{k}") for k, c in found.items()]


def _stretch(rows: DataFrame, series: str, alpha: float, theta_alpha: float) -> DataFrame:
    """State of the rows (series, ts, y, idx, _end, _x) alone; `idx` counts from the first row ever, `_end` ends at the last."""
    y, idx = F.col("y"), F.col("idx").cast("double")
    s, t = (F.when(y.isNotNull(), ses_weight(a, F.col("idx"), F.col("_end"))) for a in (alpha, theta_alpha))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0.0))
    return rows.groupBy(series).agg(
        F.count(F.lit(1)).alias("n"), F.count(y).alias("known"), F.max("ts").alias("last_ts"), F.min_by("y", "idx").alias("first"), F.max_by("y", "idx").alias("last"),
        total(s * y).alias("s_sum"), total(s).alias("s_weight"), total(t * y).alias("t_sum"), total(t * idx).alias("t_idx"), total(t).alias("t_weight"),
        *_moments("trend", y, idx), *_moments("lag", y, F.col("_x")),
    )


def _merged(series: str, alpha: float, theta_alpha: float) -> list[Column]:
    """Columns of the state of a stretch `a` followed by a stretch `b`; either may be missing."""

    def at(side: str, name: str) -> Column:
        return F.coalesce(F.col(f"{side}.{name}"), F.lit(0.0))

    out = [F.coalesce(f"a.{series}", f"b.{series}").alias(series)]
    out += [(F.coalesce(f"a.{c}", F.lit(0)) + F.coalesce(f"b.{c}", F.lit(0))).cast("bigint").alias(c) for c in ("n", "known")]
    out.append(F.coalesce("b.last_ts", "a.last_ts").alias("last_ts"))
    # a value may be null, so the presence of a stretch decides
    out.append(F.when(F.col("a.n").isNotNull(), F.col("a.first")).otherwise(F.col("b.first")).alias("first"))
    out.append(F.when(F.col("b.n").isNotNull(), F.col("b.last")).otherwise(F.col("a.last")).alias("last"))
    for c, a in (("s_sum", alpha), ("s_weight", alpha), ("t_sum", theta_alpha), ("t_idx", theta_alpha), ("t_weight", theta_alpha)):
        out.append((at("a", c) * F.pow(F.lit(1 - a), F.coalesce("b.n", F.lit(0))) + at("b", c)).alias(c))
    for p in PAIRS:
        m1, m2 = at("a", f"{p}_m"), at("b", f"{p}_m")
        share = F.coalesce(F.try_divide(m2, m1 + m2), F.lit(0.0))
        far = {k: at("b", f"{p}_{k}") - at("a", f"{p}_{k}") for k in "xy"}
        out.append((m1 + m2).alias(f"{p}_m"))
        out += [(at("a", f"{p}_{k}") + far[k] * share).alias(f"{p}_{k}") for k in "xy"]
        out += [(at("a", f"{p}_x{k}") + at("b", f"{p}_x{k}") + far["x"] * far[k] * share * m1).alias(f"{p}_x{k}") for k in "xy"]
    return out


def update_state(state: DataFrame | None, rows: DataFrame, *, alpha: float = 0.3, theta_alpha: float = 0.2, series: str = "series",
                 ts: str = "ts", y: str = "y") -> DataFrame:
    """`state` with the rows that follow; None starts a new state.

    Rows at or before the last time of a series are in the state already and are left out, so that an update which is
    repeated changes nothing.  Positions count rows, not days.  Rows without a time or a series are left out; null
    values count as rows and are skipped by sums.  Use the same smoothing parameters each time.
    """
    fresh = rows.select(F.col(series).alias(series), F.col(ts).alias("ts"), F.col(y).cast("double").alias("y"))
    if state is not None:
        stored = state.select(series, F.col("n").alias("_n"), F.col("last").alias("_last"), F.col("last_ts").alias("_until"))
        fresh = fresh.join(stored, series, "left").where(F.col("_until").isNull() | (F.col("ts") > F.col("_until")))
    else:
        fresh = fresh.withColumn("_n", F.lit(None).cast("bigint")).withColumn("_last", F.lit(None).cast("double"))
    placed = blocks.position(fresh, series=series, ts="ts", name="_at", total="_new")
    placed = blocks.over_halo(placed, {"_before": lambda w: F.lag("y").over(w)}, before=1, series=[series], idx="_at")
    done = F.coalesce("_n", F.lit(0))
    placed = placed.select(series, "ts", "y", (F.col("_at") + done).alias("idx"), (F.col("_new") + done).alias("_end"),
                           F.when(F.col("_at") == 0, F.col("_last")).otherwise(F.col("_before")).alias("_x"))
    part = _stretch(placed, series, alpha, theta_alpha)
    if state is None:
        return part
    return state.alias("a").join(part.alias("b"), F.col(f"a.{series}") == F.col(f"b.{series}"), "full").select(*_merged(series, alpha, theta_alpha))


def predict_state(state: DataFrame, model: str, *, horizon: int, theta_: float = 2.0, series: str = "series", freq: str = "D") -> DataFrame:
    """Forecasts (series, step, ts, pred) of one of MODELS from the state alone."""
    step = F.col("step")

    def level(prefix: str, name: str) -> Column:
        total = F.col(f"{prefix}_{name}")
        return F.when(F.col("known") == F.col("n"), total).otherwise(F.try_divide(total, F.col(f"{prefix}_weight")))

    def line(prefix: str) -> tuple[Column, Column]:
        slope = F.try_divide(F.col(f"{prefix}_xy"), F.col(f"{prefix}_xx"))
        return F.col(f"{prefix}_y") - slope * F.col(f"{prefix}_x"), slope

    if model == "LastValue":
        pred = F.col("last")
    elif model == "NaiveDrift":
        pred = F.col("last") + step * F.coalesce(F.try_divide(F.col("last") - F.col("first"), F.col("n") - 1), F.lit(0.0))
    elif model == "SimpleSmoothing":
        pred = level("s", "sum")
    elif model == "Theta":
        a, b = line("trend")
        smooth = theta_ * level("t", "sum") + (1 - theta_) * (a + b * level("t", "idx"))
        pred = (1 - 1 / theta_) * (a + b * (F.col("n") - 1 + step)) + smooth / theta_
    elif model == "OneLag":
        a, b = line("lag")
        fitted = state.withColumn("_a", a).withColumn("_b", b)
        path = F.aggregate(F.sequence(F.lit(1), step), F.col("last"), lambda p, _: F.col("_a") + F.col("_b") * p)
        return unfold(fitted, [series], horizon, path, freq=freq)
    else:
        raise ValueError(f"no state for the model {model!r}, expected one of {list(MODELS)}")
    return unfold(state, [series], horizon, pred, freq=freq)
