"""Forecast error metrics as aggregate expressions over aligned actuals and forecasts.

MAPE and the other relative metrics are in percent.  Aggregates are all decomposable, so a
grouping by (model, window, series) combines map-side and a hot series costs one partial row
per task.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Metric = Callable[[Column, Column], Column]


def mape(y: Column, yhat: Column) -> Column:
    """Null when an actual is zero, where the ratio is undefined."""
    return F.when(F.min(F.abs(y)) > 0, 100 * F.avg(F.try_divide(F.abs(y - yhat), F.abs(y))))


def rmse(y: Column, yhat: Column) -> Column:
    return F.sqrt(mse(y, yhat))


def mae(y: Column, yhat: Column) -> Column:
    return F.avg(F.abs(y - yhat))


def smape(y: Column, yhat: Column) -> Column:
    return 200 * F.avg(F.try_divide(F.abs(y - yhat), F.abs(y) + F.abs(yhat)))


def mse(y: Column, yhat: Column) -> Column:
    return F.avg((y - yhat) * (y - yhat))


def rmsle(y: Column, yhat: Column) -> Column:
    """Null when a value is -1 or less, where the logarithm is undefined."""
    d = F.log1p(y) - F.log1p(yhat)
    return F.when(F.min(F.least(y, yhat)) > -1, F.sqrt(F.avg(d * d)))


def r2(y: Column, yhat: Column) -> Column:
    return 1 - F.try_divide(F.avg((y - yhat) * (y - yhat)), F.var_pop(y))


def cov(y: Column, yhat: Column) -> Column:
    """Coefficient of variation: RMSE relative to the mean actual."""
    return F.try_divide(100 * rmse(y, yhat), F.avg(y))


def ope(y: Column, yhat: Column) -> Column:
    """Overall percentage error of the sums."""
    return F.try_divide(100 * F.abs(F.sum(y) - F.sum(yhat)), F.abs(F.sum(y)))


def quantile_loss(q: float) -> Metric:
    def loss(y: Column, yhat: Column) -> Column:
        e = y - yhat
        return F.avg(F.greatest(q * e, (q - 1) * e))

    return loss


METRICS: dict[str, Metric] = {
    "MAPE": mape, "RMSE": rmse, "MAE": mae, "SMAPE": smape, "MSE": mse, "RMSLE": rmsle, "R2": r2, "COV": cov,
}
LOSSES: dict[str, Metric] = {**METRICS, "OPE": ope, "QUANTILE": quantile_loss(0.5)}
MAXIMISED = {"R2"}


def loss_name(name: str | None) -> str:
    """Normalise a loss name: with or without `val_`, any case; unknown or None gives the quantile loss."""
    key = (name or "").upper().removeprefix("VAL_")
    return key if key in LOSSES else "QUANTILE"


def loss(name: str | None) -> Metric:
    return LOSSES[loss_name(name)]


def better_first(name: str, column: str) -> Column:
    """Sort key that puts the best value of a metric first."""
    c = F.col(column)
    return c.desc_nulls_last() if loss_name(name) in MAXIMISED else c.asc_nulls_last()


def evaluate(aligned: DataFrame, by: Sequence[str], *, y: str = "y", pred: str = "pred",
             metrics: dict[str, Metric] | None = None) -> DataFrame:
    """Metrics of all models, windows and series in one grouping."""
    chosen = metrics or METRICS
    return aligned.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), *[m(F.col(y), F.col(pred)).alias(name) for name, m in chosen.items()]
    )


def step_errors(aligned: DataFrame, by: Sequence[str], *, horizon: int, step: str = "step", y: str = "y",
                pred: str = "pred") -> DataFrame:
    """Error over all steps beside the error at the last step of the horizon."""
    e = F.abs(F.col(y) - F.col(pred))
    ratio = F.try_divide(e, F.abs(F.col(y)))
    last = F.col(step) == horizon
    return aligned.groupBy(*by).agg(
        (100 * F.avg(ratio)).alias("mean_mape"), F.sqrt(F.avg(e * e)).alias("mean_rmse"),
        (100 * F.avg(F.when(last, ratio))).alias("last_mape"), F.sqrt(F.avg(F.when(last, e * e))).alias("last_rmse"),
    )
