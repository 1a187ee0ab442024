"""Incremental ingest of landed API responses."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelloom.sources.payloads import long_values, parse_payloads, with_shape
from panelloom.sources.readers import folder_of
from panelloom.sources.sinks import read_or_none


PARTS = 256  # folders per batch that stored values are spread over


def raw_stream(spark: SparkSession, path: str, *, files_per_batch: int = 1000) -> DataFrame:
    """(file_path, landed, payload) of files as they land, one row per file.

    A file source ignores files much older than the newest one unless told otherwise; here none is too
    old, so the source remembers the names of all files that it has read.
    """
    return (
        spark.readStream.format("text").option("wholetext", True).option("maxFilesPerTrigger", files_per_batch)
        .option("maxFileAge", "36500d").load(path)
        .select(F.col("_metadata.file_path"), F.col("_metadata.file_modification_time").alias("landed"),
                F.col("value").alias("payload"))
    )


def payload_stream(spark: SparkSession, path: str, *, files_per_batch: int = 1000) -> DataFrame:
    """Parsed rows (file_path, landed, shape, ts, name, value) of files as they land."""
    return long_values(parse_payloads(raw_stream(spark, path, files_per_batch=files_per_batch)))


def sorted_out(batch: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Values with a time, and what else the payloads of a batch hold: (..., reason, payload, name, value).

    Reasons are "unknown shape" and "no values", with the payload, and "no time", with the name and value.
    """
    keep = [c for c in batch.columns if c != "payload"]
    values = long_values(parse_payloads(batch))
    shaped = with_shape(batch)
    none = F.lit(None).cast("string")
    empty = shaped.where("shape is not null").join(values.select("file_path").distinct(), "file_path", "left_anti")
    rejects = shaped.where("shape is null").select(*keep, F.lit("unknown shape").alias("reason"), "payload", none.alias("name"), none.alias("value"))
    rejects = rejects.unionByName(empty.select(*keep, F.lit("no values").alias("reason"), "payload", none.alias("name"), none.alias("value")))
    rejects = rejects.unionByName(values.where("ts is null").select(*keep, F.lit("no time").alias("reason"), none.alias("payload"), "name", "value"))
    return values.where("ts is not null"), rejects


def ingest_once(spark: SparkSession, source: str, target: str, checkpoint: str, *, series: str = "series",
                files_per_batch: int = 1000, rejects: str | None = None) -> None:
    """Append new values of all files landed since the last run, then stop.

    The series is the name of the file's folder.  A response fetched again repeats old dates: a value
    whose (series, ts, name) is stored already is dropped, however long ago that was, and of repeats in
    one batch the first landed stays.  Nothing depends on file times, so a file that arrives with an old
    one is read like any other.  Stored values lie in folders by a hash of the series, and only folders
    that a batch touches are compared with it.  A batch that is replayed after a failure replaces its own
    folder.  One writer per target.

    Payloads of unknown shape or without a value, and values without a time, are written with the reason to `rejects`, by
    default `<target>-rejects`; nothing that lands is lost without a row.
    """
    keys = [series, "ts", "name"]
    rows = raw_stream(spark, source, files_per_batch=files_per_batch).withColumn(series, folder_of("file_path"))
    refused = rejects or f"{target.rstrip('/')}-rejects"

    def append(batch: DataFrame, epoch: int) -> None:
        batch = batch.persist()
        values, rest = sorted_out(batch)
        rest.write.mode("overwrite").parquet(f"{refused}/epoch={epoch}")
        own = values.groupBy(*keys).agg(F.min_by("value", F.struct("landed", "file_path")).alias("value"))
        own = own.withColumn("part", F.pmod(F.xxhash64(series), F.lit(PARTS)).cast("int")).persist()
        stored = read_or_none(batch.sparkSession, target)
        if stored is not None:
            before = stored.where(F.col("epoch") < epoch)
            touched = before.join(own.select("part").distinct(), "part", "left_semi").select(*keys)
            seen = [F.col(f"new.{c}").eqNullSafe(F.col(f"old.{c}")) for c in keys]
            fresh = own.alias("new").join(touched.alias("old"), seen, "left_anti")
        else:
            fresh = own
        fresh.select(*keys, "value", "part").write.mode("overwrite").partitionBy("part").parquet(f"{target}/epoch={epoch}")
        own.unpersist()
        batch.unpersist()

    query = rows.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
