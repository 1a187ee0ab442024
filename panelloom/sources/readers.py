"""Reading panels, symbol lists and folder trees."""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from panelloom.operators.clean import nan_to_null

FORMATS = {".csv": "csv", ".parquet": "parquet"}


def read_panel(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """The format follows the file extension.  Give a schema for CSV to avoid a second pass.

    Floats that are not a number are read as null, so that fills and aggregates treat them as missing.
    """
    ext = os.path.splitext(path.rstrip("/"))[1].lower()
    if ext not in FORMATS:
        raise ValueError(f"unsupported file type {ext!r}, expected one of {sorted(FORMATS)}")
    reader = spark.read.format(FORMATS[ext])
    if schema is not None:
        reader = reader.schema(schema)
    if ext == ".csv":
        reader = reader.option("header", True).option("inferSchema", schema is None).option("preferDate", False)
    return nan_to_null(reader.load(path))


def read_symbols(spark: SparkSession, path: str, k: int | None = 5, *, column: str = "Symbol") -> DataFrame:
    """The first k symbols of a CSV list, in file order; None takes all."""
    symbols = spark.read.csv(path, header=True).select(column)
    return symbols if k is None else symbols.limit(k)


def restrict_to(panel: DataFrame, symbols: DataFrame, *, series: str = "series", column: str = "Symbol") -> DataFrame:
    """Keep the series of a symbol list."""
    return panel.join(symbols.select(F.col(column).alias(series)), series, "left_semi")


def read_tree(spark: SparkSession, base: str, schema: StructType | str, *, series: str = "series") -> DataFrame:
    """All parquet and CSV files of a tree `<series>/<file>`, the folder name as series column.

    Adds `dataset`, the file name without extension.
    """
    parts = []
    for ext, fmt in FORMATS.items():
        reader = spark.read.format(fmt).schema(schema).option("recursiveFileLookup", True).option("pathGlobFilter", f"*{ext}")
        parts.append(reader.options(**({"header": True} if fmt == "csv" else {})).load(base).select("*", "_metadata.file_path"))
    both = parts[0].unionByName(parts[1])
    return both.select(
        folder_of("file_path").alias(series),
        F.regexp_extract("file_path", r"([^/]+?)\.[^/]+$", 1).alias("dataset"),
        *[c for c in both.columns if c != "file_path"],
    )


def folder_of(path: str) -> Column:
    """Name of the folder a file lies in; of a partition folder `key=value` the value."""
    return F.url_decode(F.regexp_extract(path, r"([^/=]+)/[^/]+$", 1))


def read_payload_files(spark: SparkSession, path: str) -> DataFrame:
    """Landed API responses, one JSON object per file: (file_path, payload)."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path"), F.col("value").alias("payload"))


def columns_of(fields: str, names: Sequence[str]) -> list:
    """Pick named entries of a map column as columns."""
    return [F.col(fields)[n].alias(n) for n in names]
