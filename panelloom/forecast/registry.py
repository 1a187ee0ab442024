"""Model catalogue, fit driver and parameter search."""

from __future__ import annotations

import math
import random
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelloom.forecast import linear, naive, smoothing, spectral
from panelloom.functions import metrics
from panelloom.operators import splits
from panelloom.operators.quantiles import exact_quantiles

# Forecast quantiles.
QUANTILES = [0.01, 0.05, 0.1, 0.15, 0.2, 0.25, 0.3, 0.4, 0.5, 0.6, 0.7, 0.75, 0.8, 0.85, 0.9, 0.95, 0.99]
SEARCH_SEED = 10


@dataclass(frozen=True)
class Forecaster:
    """K5: a function (train, horizon=, keys=, y=, **params) -> (keys, step, ts, pred) and what it can use.

    A multivariate model takes the kinds of covariates that it names as `past`, `future` (with `ahead`) and `static`.
    `many` (train, candidates, horizon=, keys=, y=) forecasts all candidates of a search by one plan, (keys, trial, step, ts, pred), or gives None.
    """

    fit_predict: Callable[..., DataFrame]
    params: dict = field(default_factory=dict)
    space: dict = field(default_factory=dict)
    multivariate: bool = False
    past: bool = False
    future: bool = False
    static: bool = False
    many: Callable[..., DataFrame | None] | None = None


MODELS: dict[str, Forecaster] = {
    "LastValue": Forecaster(naive.last_value),
    "NaiveDrift": Forecaster(naive.drift),
    "GlobalNaiveAggregate": Forecaster(
        naive.window_aggregate, {"input_len": 12, "output_len": 6},
        {"input_len": [12, 24, 36], "output_len": [6, 12, 18]},
    ),
    "LinearRegression": Forecaster(linear.chunk_linear, {"kind": "linear"}, {"input_len": [3, 6, 12]}, multivariate=True, past=True, future=True, static=True),
    "ExponentialSmoothing": Forecaster(smoothing.exponential_smoothing, {"kinds": ("simple", "holt", "damped")}),
    "SimpleSmoothing": Forecaster(naive.smoothed, {"alpha": 0.3}, {"alpha": [0.05, 0.9]}, many=naive.as_rows(naive.smoothed, ["alpha"])),
    "Croston": Forecaster(
        naive.croston, {"version": "classic"}, {"version": ["classic", "optimized", "sba"], "alpha": [0.05, 0.5]}, many=naive.croston_candidates,
    ),
    "Theta": Forecaster(naive.theta, {"theta_": 2.0}, {"theta_": [1.0, 3.0], "alpha": [0.05, 0.5]}, many=naive.as_rows(naive.theta, ["theta_", "alpha"])),
    "ARIMA": Forecaster(linear.regressed(linear.arima), {"p": 12, "d": 1}, {"p": [0, 10], "d": [0, 2], "trend": ["n", "c", "t", "ct"]}, multivariate=True, future=True,
                        many=linear.arima_candidates),
    "AutoARIMA": Forecaster(linear.regressed(linear.auto_arima), {"max_p": 5, "max_d": 2, "season": 12}, {"max_p": [3, 7]}, multivariate=True, future=True),
    "VARIMA": Forecaster(linear.varima, {"p": 12, "d": 1}, {"p": [1, 10], "d": [0, 2]}, multivariate=True, past=True),
    "FFT": Forecaster(spectral.fft, {"keep": 10}, {"keep": [5, 20], "trend": ["poly", "exp"]}),
    "Prophet": Forecaster(linear.structural, {}, {"mode": ["additive", "multiplicative"]}, future=True),
    "TBATS": Forecaster(linear.structural, {"periods": {12.0: 3, 52.0: 5}, "holidays": False, "transform": "log"}),
    "NLinear": Forecaster(linear.chunk_linear, {"kind": "nlinear", "input_len": 12, "output_len": 6},
                          {"input_len": [12, 24, 36], "output_len": [6, 12, 18]}, multivariate=True, past=True, future=True, static=True),
    "DLinear": Forecaster(linear.chunk_linear, {"kind": "dlinear", "input_len": 12, "output_len": 6, "kernel": 25},
                          {"kernel": [15, 25, 35]}, multivariate=True, past=True, future=True, static=True),
    "Kalman": Forecaster(linear.regressed(naive.local_level), {"q": 0.1, "r": 1.0}, {"q": [0.01, 1.0]}, multivariate=True, future=True,
                         many=naive.as_rows(naive.local_level, ["q", "r"])),
}


def usable_inputs(model: Forecaster, *, past: Sequence[str], future: Sequence[str], static: Sequence[str]) -> dict[str, list[str]]:
    """Covariate columns that a model can take; a univariate model takes none."""
    if not model.multivariate:
        return {"past": [], "future": [], "static": []}
    return {
        "past": list(past) if model.past else [],
        "future": list(future) if model.future else [],
        "static": list(static) if model.static else [],
    }


def prepare(panel: DataFrame, *, validation: str | None = None, n_splits: int = 5, split: float | int = 0.75,
            min_rows: int = 2 * splits.YEAR_ROWS) -> DataFrame:
    """Windows and splits of a panel with idx and n: adds window_id, nt and is_train.

    `idx` and `n` then refer to the window.
    """
    if validation == "rolling":
        rows = splits.rolling_windows(panel, n_splits, min_rows=min_rows, split=split)
        rows = rows.withColumn("idx", F.col("widx")).withColumn("n", F.col("wn")).drop("widx", "wn")
    else:
        rows = splits.mark_train(panel.withColumn("window_id", F.lit(0).cast("bigint")), split)
    return rows.withColumn("nt", splits.train_rows(F.col("n"), split))


def score(prepared: DataFrame, forecast: DataFrame, *, keys: Sequence[str] = ("series", "window_id"), y: str = "y") -> DataFrame:
    """Validation rows beside the forecast for the same time."""
    actual = prepared.filter(~F.col("is_train")).select(*keys, "ts", F.col(y).alias("y"))
    return actual.join(forecast, [*keys, "ts"])


def run_models(prepared: DataFrame, names: Iterable[str], *, horizon: int, y: str = "y",
               overrides: dict[str, dict] | None = None, past: Sequence[str] = (), future: Sequence[str] = (),
               static: Sequence[str] = ()) -> DataFrame:
    """Forecasts of several models for all series and windows: (model, series, window_id, step, ts, pred).

    The loop is over model names; each adds one branch to the plan.  Every model gets the covariates that it can take
    (P15): `past` columns are known on training rows, `future` ones on the rows of the horizon as well, `static` ones are
    the same on all rows of a series.  No model sees a target or a past column after the training part.
    """
    keys = ["series", "window_id"]
    train = prepared.filter("is_train")
    parts = []
    for name in names:
        model = MODELS[name]
        params = {**model.params, **(overrides or {}).get(name, {})}
        inputs = {kind: cols for kind, cols in usable_inputs(model, past=past, future=future, static=static).items() if cols}
        if "future" in inputs:
            inputs["ahead"] = prepared.select(*keys, "idx", "nt", "ts", *future)
        pred = model.fit_predict(train, horizon=horizon, keys=keys, y=y, **params, **inputs)
        parts.append(pred.select(F.lit(name).alias("model"), *keys, "step", "ts", "pred"))
    return reduce(DataFrame.unionByName, parts)


def draw(space: dict, trials: int, seed: int = SEARCH_SEED) -> list[dict]:
    """Parameter sets from a search space.

    Bools and strings are choices, integers a range from the first to the last, any float a
    log-uniform range (a uniform one where it reaches 0, which has no logarithm), a leading None
    counts as 0, scalars are fixed, other lists are skipped; an empty list is an error.
    """
    rng = random.Random(seed)
    out = []
    for _ in range(trials):
        params = {}
        for name, spec in space.items():
            if not isinstance(spec, list):
                params[name] = spec
                continue
            if not spec:
                raise ValueError(f"parameter {name!r} has no values to choose from")
            values = [0 if spec[0] is None else spec[0], *spec[1:]]
            if all(isinstance(v, bool) for v in values) or all(isinstance(v, str) for v in values):
                params[name] = rng.choice(values)
            elif all(isinstance(v, int) and not isinstance(v, bool) for v in values):
                params[name] = rng.randint(values[0], values[-1])
            elif any(isinstance(v, float) for v in values):
                low, high = values[0], values[-1]
                params[name] = math.exp(rng.uniform(math.log(low), math.log(high))) if low > 0 and high > 0 else rng.uniform(low, high)
        out.append(params)
    return out


def search(prepared: DataFrame, name: str, trials: list[dict], *, horizon: int, loss: str = "MAPE", y: str = "y") -> DataFrame:
    """Loss of every parameter set, the mean over series and windows: (trial, params, loss).

    All trials run in one job.  Where the model can, they are rows of one plan, whatever their number; otherwise they are branches over
    the same prepared rows.
    """
    model, keys = MODELS[name], ["series", "window_id"]
    train = prepared.filter("is_train")
    candidates = [{**model.params, **t} for t in trials]
    pred = model.many(train, candidates, horizon=horizon, keys=keys, y=y) if model.many else None
    if pred is None:
        pred = reduce(DataFrame.unionByName, [
            model.fit_predict(train, horizon=horizon, keys=keys, y=y, **c).select(F.lit(i).alias("trial"), *keys, "step", "ts", "pred") for i, c in enumerate(candidates)
        ])
    aligned = score(prepared, pred.select("trial", *keys, "step", "ts", "pred"), keys=keys, y=y)
    chosen = metrics.loss_name(loss)
    per_series = metrics.evaluate(aligned, ["trial", *keys], metrics={chosen: metrics.loss(loss)})
    labels = F.create_map(*[c for i, t in enumerate(trials) for c in (F.lit(i), F.lit(repr(sorted(t.items()))))])
    return per_series.groupBy("trial").agg(F.avg(chosen).alias("loss")).withColumn("params", labels[F.col("trial")])


def halving(prepared: DataFrame, name: str, trials: list[dict], *, horizon: int, loss: str = "MAPE", y: str = "y") -> DataFrame:
    """M19 in rounds: all parameter sets on the first window, then the better half of them on twice as many windows, until all windows are used.

    (trial, params, loss, windows): every trial with its loss in the last round that it reached and the windows used there.  The trials' losses pass
    through the driver; ties go to the earlier trial.
    """
    count = prepared.agg(F.max("window_id")).first()[0] + 1
    alive, windows, done = list(range(len(trials))), 1, []
    while alive:
        windows = min(windows, count)
        scored = search(prepared.filter(F.col("window_id") < windows), name, [trials[i] for i in alive], horizon=horizon, loss=loss, y=y).collect()
        order = sorted(scored, key=lambda r: (r.loss is None, r.loss or 0.0, r.trial))
        keep = 0 if windows == count else -(-len(order) // 2)
        done += [(alive[r.trial], r.params, r.loss, windows) for r in order[keep:]]
        alive, windows = sorted(alive[r.trial] for r in order[:keep]), 2 * windows
    return prepared.sparkSession.createDataFrame(sorted(done), "trial int, params string, loss double, windows int")


def search_smoothing(prepared: DataFrame, alphas: Sequence[float], *, horizon: int, y: str = "y") -> DataFrame:
    """M19 for simple smoothing: all candidates are sums of one aggregation, (alpha, MAPE)."""
    keys = ["series", "window_id"]
    levels = F.array(*[F.sum(naive.ses_weight(float(a), F.col("idx"), F.col("nt")) * F.col(y)) for a in alphas])
    fitted = naive.ends(prepared.filter("is_train"), keys, levels=levels)
    each = fitted.select(*keys, "last_ts", F.posexplode("levels").alias("i", "level"))
    pred = naive.unfold(each, [*keys, "i"], horizon, F.col("level"))
    scores = metrics.evaluate(score(prepared, pred, keys=keys, y=y), ["i", *keys], metrics={"MAPE": metrics.mape})
    alpha = F.element_at(F.array(*[F.lit(float(a)) for a in alphas]), F.col("i") + 1)
    return scores.groupBy("i").agg(F.avg("MAPE").alias("MAPE")).select(alpha.alias("alpha"), "MAPE")


def quantile_forecast(forecast: DataFrame, errors: DataFrame, qs: Sequence[float] = QUANTILES, *,
                      by: Sequence[str] = ("series", "step")) -> DataFrame:
    """Point forecast plus the quantiles of past errors at the same step: (…, q, pred).

    `errors` holds backtest errors (by, err) = actual - forecast.
    """
    spread = exact_quantiles(errors, qs, keys=by, value="err")
    return forecast.join(spread, list(by)).withColumn("pred", F.col("pred") + F.col("err")).drop("err")

