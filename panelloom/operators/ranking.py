"""Comparing models and series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from panelloom.functions.metrics import better_first, loss_name


def mean_metrics(evaluations: DataFrame, metrics: Sequence[str], *, by: Sequence[str] = ("model",)) -> DataFrame:
    """Metrics averaged over series and windows."""
    return evaluations.groupBy(*by).agg(*[F.avg(m).alias(f"mean_{m}") for m in metrics])


def forecast_change(forecast: DataFrame, *, by: Sequence[str] = ("series",), ts: str = "ts", pred: str = "pred") -> DataFrame:
    """First and last predicted value and the relative change between them."""
    ends = forecast.groupBy(*by).agg(F.min_by(pred, ts).alias("first_pred"), F.max_by(pred, ts).alias("last_pred"))
    return ends.withColumn("change", F.try_divide(F.col("last_pred") - F.col("first_pred"), F.col("first_pred")))


def top_changes(changes: DataFrame, k: int, direction: int = 0, *, series: str = "series") -> DataFrame:
    """O3: the k series with the largest rise (1), fall (-1) or move either way (0)."""
    key = {1: F.col("change").desc_nulls_last(), -1: F.col("change").asc_nulls_last()}.get(
        direction, F.abs("change").desc_nulls_last()
    )
    return changes.orderBy(key, series).limit(k)


def compare_models(evaluations: DataFrame, loss: str = "MAPE") -> DataFrame:
    """All evaluations, best first; ties by model and series."""
    name = loss_name(loss)
    return evaluations.orderBy(better_first(name, name), "model", "series")


def best_model(evaluations: DataFrame, loss: str = "MAPE", *, by: str = "row") -> DataFrame:
    """The model of the single best evaluation, or with by="mean" the best on average."""
    name = loss_name(loss)
    table = evaluations if by == "row" else evaluations.groupBy("model").agg(F.avg(name).alias(name))
    return table.orderBy(better_first(name, name), "model").limit(1).select("model", F.col(name).alias("loss"))


def best_checkpoint(leaderboard: DataFrame, loss: str = "val_MAPE", *, path: str = "ckpt_path") -> DataFrame:
    """Path of the row with the least loss among rows that have one."""
    key = F.when(F.col(path).isNotNull(), F.struct(F.col(loss), F.col(path)))
    return leaderboard.agg(F.min(key).alias("k")).select(F.col(f"k.{path}").alias(path), F.col(f"k.{loss}").alias("loss"))


def latest_version(registry: DataFrame, *, by: Sequence[str], version: str = "version") -> DataFrame:
    """The last version per model by name."""
    return registry.groupBy(*by).agg(F.max(version).alias(version))


def best_loss(leaderboard: DataFrame, loss: str) -> float | None:
    """Least loss recorded so far."""
    return leaderboard.agg(F.min(loss)).first()[0]


def trial_history(trials: DataFrame, *, trial: str = "trial", loss: str = "loss") -> DataFrame:
    """Every trial with the best loss so far; the table has one row per trial."""
    w = W.orderBy(trial).rowsBetween(W.unboundedPreceding, 0)
    return trials.withColumn("best_so_far", F.min(loss).over(w))
