"""Forecasters that train a pyspark.ml regressor on lags."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Estimator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelloom.forecast.naive import KEYS
from panelloom.functions.timeaxis import next_steps
from panelloom.operators.blocks import BLOCK_ROWS, over_halo
from panelloom.sources.sinks import stage

SEED = 42


def regressor(name: str, **params) -> Estimator:
    """linear, random_forest or boosted_trees; `params` override the defaults."""
    if name == "linear":
        return LinearRegression(**{"solver": "normal", **params})
    if name == "random_forest":
        return RandomForestRegressor(**{"numTrees": 100, "maxDepth": 20, "seed": SEED, **params})
    if name == "boosted_trees":
        return GBTRegressor(**{"maxIter": 100, "maxDepth": 6, "stepSize": 0.1, "seed": SEED, **params})
    raise ValueError(f"unknown regressor {name!r}")


def lag_table(panel: DataFrame, *, lags: int, past: dict[str, int] | None = None,
              future: dict[str, tuple[int, int]] | None = None, output_len: int = 1, shift: int = 0, y: str = "y",
              keys: Sequence[str] = KEYS) -> tuple[DataFrame, list[str]]:
    """Features known at the last training row (`lead0` is the row itself) and targets target0..

    `past` gives lags of other columns; `future` the (first, last) steps ahead of columns that
    are known in advance.
    """
    past, future = past or {}, future or {}
    names = {f"f_{y}_{i}": (y, -i) for i in range(lags)}
    names |= {f"f_{c}_{i}": (c, -i) for c, k in past.items() for i in range(k)}
    names |= {f"f_{c}_p{i}": (c, i) for c, (a, b) in future.items() for i in range(a, b + 1)}
    targets = {f"target{h}": (y, 1 + shift + h) for h in range(output_len)}
    moves = {**names, **targets}

    def at(c: str, k: int):
        return lambda w: F.lead(c, k).over(w) if k > 0 else F.lag(c, -k).over(w)

    back = max((-k for _, k in moves.values() if k < 0), default=0)
    ahead = max((k for _, k in moves.values() if k > 0), default=0)
    exprs = {n: at(c, k) for n, (c, k) in moves.items()}
    return over_halo(panel, exprs, before=back, after=ahead, series=list(keys)), list(names)


def direct(panel: DataFrame, estimator: Estimator, *, lags: int = 12, past: dict[str, int] | None = None,
           future: dict[str, tuple[int, int]] | None = None, output_len: int = 3, shift: int = 0, y: str = "y",
           keys: Sequence[str] = KEYS, freq: str = "D") -> tuple[DataFrame, list]:
    """M4-M6/K3: one model per step, pooled over all series; (forecast, fitted models).

    `panel` holds all rows with idx, nt and ts; models are fitted where every target lies in the
    training part, and predict from the last training row of each series.
    """
    keys = list(keys)
    table, features = lag_table(panel, lags=lags, past=past, future=future, output_len=output_len, shift=shift, y=y, keys=keys)
    known = table.filter(F.col("idx") < F.col("nt")).dropna("any", subset=features)
    targets = [f"target{h}" for h in range(output_len)]
    rows = VectorAssembler(inputCols=features, outputCol="features").transform(known).select(*keys, "idx", "nt", "ts", "features", *targets)
    # every step reads the table again; a fixed order of rows makes bagging repeatable
    ready = stage(rows.repartition(*keys, F.expr(f"idx div {BLOCK_ROWS}")).sortWithinPartitions(*keys, "idx"))
    origin = ready.filter(F.col("idx") == F.col("nt") - 1)
    models, parts = [], []
    for h in range(output_len):
        step = 1 + shift + h
        fit_on = ready.filter(F.col("idx") + step < F.col("nt")).select("features", F.col(f"target{h}").cast("double").alias("label"))
        model = estimator.fit(fit_on)
        models.append(model)
        parts.append(model.transform(origin).select(
            *keys, F.lit(step).alias("step"), next_steps(F.col("ts"), F.lit(step), freq).alias("ts"), F.col("prediction").alias("pred")
        ))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out, models


def importance(models: Sequence, features: Sequence[str], spark) -> DataFrame:
    """Importance (trees) or coefficient (linear) of every feature, per step."""
    rows = []
    for step, model in enumerate(models, 1):
        weights = model.featureImportances if hasattr(model, "featureImportances") else model.coefficients
        rows += [(step, f, float(w)) for f, w in zip(features, weights.toArray())]
    return spark.createDataFrame(rows, "step int, feature string, weight double")
