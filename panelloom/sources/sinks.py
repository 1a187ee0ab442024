"""Writing panels, results, leaderboards, models and settings."""

from __future__ import annotations

import json
import re
import tempfile
import uuid
from collections.abc import Sequence
from urllib.parse import quote

from pyspark.errors import AnalysisException
from pyspark.ml.util import DefaultParamsReader
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelloom.functions.metrics import better_first
from panelloom.sources import commits


def scratch_dir(spark: SparkSession) -> str:
    """A fresh folder below the shared folder that the session names in spark.checkpoint.dir.

    A session on a single machine may have none; a temporary folder is used there.  On a cluster that
    would be a folder which the executors do not share, so it is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("name a folder that driver and executors share in spark.checkpoint.dir")
        return tempfile.mkdtemp(prefix="panelloom-")
    return f"{base.rstrip('/')}/panelloom-{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"


def stage(df: DataFrame) -> DataFrame:
    """Write an intermediate panel to the shared folder and read it back.

    For inputs that several branches of a plan use: they are computed once, later branches read
    only the columns they need, and a lost executor costs a read instead of the whole past.
    """
    path = scratch_dir(df.sparkSession) + "/stage"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unstage(df: DataFrame) -> None:
    """Delete the files of a table that `stage` gave, once no later plan reads it."""
    files = df.inputFiles()
    if files:
        folder = df.sparkSession._jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
        folder.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(folder, True)


def write_by(df: DataFrame, path: str, by: Sequence[str], *, mode: str = "append") -> None:
    """Parquet partitioned by columns.

    Rows are first gathered per partition value; the rebalancing exchange splits a large symbol
    over several tasks and merges small ones.
    """
    df.hint("rebalance", *by).write.mode(mode).partitionBy(*by).parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """S10."""
    df.write.mode("overwrite").csv(path, header=True)


def prediction_rows(forecast: DataFrame, model: str, *, series: str = "series", ts: str = "ts") -> DataFrame:
    """Forecasts in the stored layout; series_id numbers the series by name from 0."""
    from panelloom.operators.blocks import lookup, range_blocks, rank_in_order

    names = stage(range_blocks(forecast.select(series).distinct(), [series], "_p"))
    ids = rank_in_order(names, keys=[], blocks=["_p"], order=[series], name="series_id").drop("_p")
    return lookup(forecast, ids, [series]).select(
        F.col(ts).alias("timestamp"), "pred", F.lit(model).alias("model"), "series_id", F.col(series).alias("stock_name")
    )


def append_results(df: DataFrame, path: str) -> None:
    """Append evaluations or predictions, one folder per model."""
    write_by(df, path, ["model"])


def read_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def merge_leaderboard(old: DataFrame | None, new: DataFrame, first: Sequence[str]) -> DataFrame:
    """Old and new rows without full duplicates, loss columns first, best loss on top."""
    both = new if old is None else old.unionByName(new, allowMissingColumns=True)
    ordered = both.dropDuplicates().select(*first, *[c for c in both.columns if c not in first])
    return ordered.orderBy(better_first(first[0], first[0]), *[c for c in ordered.columns if c != first[0]])


def update_leaderboard(new: DataFrame, path: str, first: Sequence[str]) -> int:
    """Write the merged table as a new version beside the old ones; returns the version.

    A table cannot be overwritten while it is read, and a reader of the old version stays whole.  Of two writers one comes second
    and merges with what the first one wrote.
    """
    spark = new.sparkSession

    def write(old: str | None, folder: str) -> None:
        merge_leaderboard(old and spark.read.parquet(old), new, first).write.parquet(folder)

    return commits.commit_table(spark, path, write)


def read_leaderboard(spark: SparkSession, path: str) -> DataFrame:
    """Latest version of a leaderboard."""
    version, name = commits.latest(spark, path)
    if not version:
        raise ValueError(f"no leaderboard below {path}")
    return spark.read.parquet(f"{path}/data/{name}")


def trial_columns(trials: DataFrame, prefix: str = "user_attrs_") -> DataFrame:
    """Strip a prefix from column names."""
    return trials.toDF(*[c.replace(prefix, "") for c in trials.columns])


def update_trials(trials: DataFrame, path: str, first: Sequence[str]) -> int:
    """Trial history kept like a leaderboard."""
    return update_leaderboard(trial_columns(trials), path, first)


def save_if_better(spark: SparkSession, path: str, settings: dict, loss: float, best: float | None) -> bool:
    """Keep the settings only when the new loss beats the recorded one, in `best` and below `path`.

    The record is committed before its row is appended to the table; a writer that another one overtook compares again.
    """
    saved = json.dumps(settings, sort_keys=True)
    while True:
        version, last = commits.latest(spark, path)
        known = [x for x in (best, last and json.loads(last)["loss"]) if x is not None]
        if not all(loss < x for x in known):
            return False
        if commits.commit(spark, path, version + 1, json.dumps({"loss": float(loss), "settings": saved})):
            break
    spark.createDataFrame([(saved, float(loss))], "settings string, loss double").write.mode("append").parquet(path)
    return True


def best_settings(spark: SparkSession, path: str) -> dict:
    _, last = commits.latest(spark, path)
    if last is None:
        raise ValueError(f"no settings below {path}")
    return json.loads(json.loads(last)["settings"])


def save_params(params: DataFrame, path: str) -> None:
    """Fitted parameters of a formula model, one row per series and window."""
    params.write.mode("overwrite").parquet(path)


def save_fitted(model, path: str) -> None:
    """A fitted pyspark.ml model."""
    model.write().overwrite().save(path)


def load_fitted(spark: SparkSession, path: str):
    """The model that `save_fitted` stored, whatever its class."""
    return DefaultParamsReader.loadParamsInstance(path, spark)


def register_model(spark: SparkSession, path: str, dataset: str, model: str, model_path: str, settings_path: str,
                   version: str) -> None:
    """Append a row to the model registry.

    A version of a model is claimed by a file first, so two writers cannot register the same one; the second gets an error.
    """
    claim = f"{path}/_commits/" + "/".join(quote(x, safe="") for x in (dataset, model, version))
    if not commits.create_once(spark, claim, model_path):
        raise ValueError(f"version {version!r} of {model!r} on {dataset!r} is registered already")
    row = [(dataset, model, model_path, settings_path, version)]
    spark.createDataFrame(
        row, "dataset string, model string, model_path string, settings_path string, version string"
    ).write.mode("append").parquet(path)
