"""Parsing API responses.

Three shapes occur: A, dates as keys of the second top-level object; B, an array of records with a
fiscal date; C, a named series of {date, value}.  All give rows (…, shape, ts, fields), `fields`
being a map from column name to text, so one plan handles a mix of shapes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def payload_shape(payload: Column) -> Column:
    """"A", "B", "C", or null for anything else."""
    keys = F.json_object_keys(payload)
    first = F.get_json_object(payload, "$.data[0]")
    only_date_value = F.forall(F.json_object_keys(first), lambda k: k.isin("date", "value"))
    return (
        F.when(F.array_contains(keys, "Meta Data"), "A")
        .when(F.exists(keys, lambda k: k.startswith("quarterly")) | F.array_contains(keys, "annualEarnings"), "B")
        .when(F.array_contains(keys, "data") & only_date_value, "C")
    )


def clean_name(name: Column) -> Column:
    """"1. Open" becomes "open"."""
    return F.lower(F.regexp_replace(name, r"^\d+\.\s+", ""))


def with_shape(df: DataFrame, payload: str = "payload") -> DataFrame:
    return df.withColumn("shape", payload_shape(F.col(payload)))


def rejected(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Rows whose payload has none of the known shapes."""
    return with_shape(df, payload).filter("shape is null").drop("shape")


def _entries(payload: str) -> Column:
    """Array of (date, fields) for every shape."""
    p = F.col(payload)
    top = F.from_json(p, "map<string,string>")
    second = F.element_at(F.json_object_keys(p), 2)
    a = F.transform(
        F.map_entries(F.from_json(top[second], "map<string,map<string,string>>")),
        lambda e: F.struct(e["key"].alias("date"), F.transform_keys(e["value"], lambda k, _: clean_name(k)).alias("fields")),
    )
    quarterly = F.filter(F.json_object_keys(p), lambda k: k.startswith("quarterly"))
    key = F.coalesce(F.get(quarterly, F.lit(0)), F.lit("annualEarnings"))
    b = F.transform(
        F.from_json(top[key], "array<map<string,string>>"),
        lambda r: F.struct(
            r["fiscalDateEnding"].alias("date"), F.map_filter(r, lambda k, _: k != "fiscalDateEnding").alias("fields")
        ),
    )
    name = F.get_json_object(p, "$.name")
    c = F.transform(
        F.from_json(top["data"], "array<struct<date:string,value:string>>"),
        lambda r: F.struct(
            r["date"].alias("date"),
            F.create_map(name, F.when(r["value"].try_cast("double").isNotNull(), r["value"])).alias("fields"),
        ),
    )
    return F.when(F.col("shape") == "A", a).when(F.col("shape") == "B", b).when(F.col("shape") == "C", c)


def parse_payloads(df: DataFrame, payload: str = "payload", *, strict: bool = False) -> DataFrame:
    """One row per date of every payload.

    Unknown shapes are left out (see `rejected`), or fail the job when `strict`.
    """
    shaped = with_shape(df, payload)
    if strict:
        shaped = shaped.withColumn(
            "shape", F.coalesce("shape", F.raise_error(F.lit("unknown data structure in JSON response")))
        )
    else:
        shaped = shaped.filter("shape is not null")
    rest = [c for c in df.columns if c != payload]
    rows = shaped.select(*rest, "shape", F.inline(_entries(payload)))
    return rows.select(*rest, "shape", F.col("date").try_cast("timestamp_ntz").alias("ts"), "fields")


def long_values(parsed: DataFrame) -> DataFrame:
    """Entries of `fields` as rows (…, ts, name, value); the name stays data until a pivot."""
    rest = [c for c in parsed.columns if c != "fields"]
    return parsed.select(*rest, F.explode("fields").alias("name", "value"))
