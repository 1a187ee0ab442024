"""Queries of sources, sinks and payload parsing (S*, X1, F1)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelloom.plans import views as v
from panelloom.plans.catalog import query
from panelloom.sources import payloads, readers, sinks
from panelloom.streaming.ingest import ingest_once

MONEY = "CAST(CAST(y AS DECIMAL(18,2)) AS VARCHAR)"


def _money() -> F.Column:
    return F.col("y").cast("decimal(18,2)").cast("string")


def _day() -> F.Column:
    return F.date_format("ts", "yyyy-MM-dd")


def keyed_payloads(spark: SparkSession, sf: str) -> DataFrame:
    """Shape A from daily_orders, one payload per series and year."""
    entry = F.struct(_day().alias("k"), F.create_map(
        F.lit("1. Total"), _money(), F.lit("2. Orders"), F.col("n_orders").cast("string")).alias("v"))
    per_year = v.daily_orders(spark, sf).groupBy("series", F.year("ts").alias("y")).agg(
        F.map_from_entries(F.collect_list(entry)).alias("days"))
    body = F.struct(F.create_map(F.lit("Symbol"), F.col("series")).alias("Meta Data"), F.col("days").alias("Time Series (Daily)"))
    return per_year.select("series", F.to_json(body).alias("payload"))


def quarterly_payloads(spark: SparkSession, sf: str) -> DataFrame:
    """Shape B: quarterly totals, one payload per series."""
    quarters = v.daily_orders(spark, sf).groupBy(
        "series", F.last_day(F.add_months(F.trunc("ts", "quarter"), 2)).cast("string").alias("d")
    ).agg(F.sum("y").cast("decimal(18,2)").cast("string").alias("total"))
    record = F.struct(F.col("d").alias("fiscalDateEnding"), F.col("total").alias("reportedTotal"))
    return quarters.groupBy("series").agg(F.collect_list(record).alias("quarterlyTotals")).select(
        "series", F.to_json(F.struct(F.col("series").alias("symbol"), "quarterlyTotals")).alias("payload"))


def named_payloads(spark: SparkSession, sf: str) -> DataFrame:
    """Shape C: one named series per payload and year; days with a single order carry no number."""
    value = F.when(F.col("n_orders") == 1, ".").otherwise(_money())
    record = F.struct(_day().alias("date"), value.alias("value"))
    return v.daily_orders(spark, sf).groupBy("series", F.year("ts").alias("y")).agg(F.collect_list(record).alias("data")).select(
        "series", F.to_json(F.struct(F.col("series").alias("name"), F.lit("daily").alias("interval"), "data")).alias("payload"))


@query("s1_read_by_extension", """
SELECT o_orderstatus AS status, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY ALL""")
def s1(spark, sf):
    df = readers.read_panel(spark, f"{sf}/orders.parquet")
    return df.groupBy(F.col("o_orderstatus").alias("status")).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("s2_csv_round_trip", f"WITH {v.DAILY} SELECT series, ts, y, n_orders FROM daily")
def s2(spark, sf):
    path = sinks.scratch_dir(spark) + "/panel.csv"
    sinks.write_csv(v.daily_orders(spark, sf), path)  # S10
    return readers.read_panel(spark, path, "series string, ts timestamp_ntz, y double, n_orders bigint")


@query("s3_payload_keyed_dates", f"""
WITH {v.DAILY} SELECT series, ts, {MONEY} AS total, CAST(n_orders AS VARCHAR) AS orders FROM daily""")
def s3(spark, sf):
    parsed = payloads.parse_payloads(keyed_payloads(spark, sf), strict=True)
    return parsed.select("series", "ts", *readers.columns_of("fields", ["total", "orders"]))


@query("s4_payload_records", f"""
WITH {v.DAILY} SELECT series, CAST(last_day(date_trunc('quarter', ts) + INTERVAL 2 MONTH) AS TIMESTAMP) AS ts,
  CAST(CAST(sum(y) AS DECIMAL(18,2)) AS VARCHAR) AS "reportedTotal"
FROM daily GROUP BY ALL""")
def s4(spark, sf):
    parsed = payloads.parse_payloads(quarterly_payloads(spark, sf))
    return parsed.select("series", "ts", *readers.columns_of("fields", ["reportedTotal"]))


@query("s5_payload_named_series", f"""
WITH {v.DAILY} SELECT series AS name, ts, CASE WHEN n_orders > 1 THEN y END AS value FROM daily""")
def s5(spark, sf):
    long = payloads.long_values(payloads.parse_payloads(named_payloads(spark, sf)))
    return long.select("name", "ts", F.col("value").try_cast("double").alias("value"))


@query("s6_shape_dispatch", f"""
WITH {v.DAILY},
q AS (SELECT DISTINCT series, date_trunc('quarter', ts) AS t FROM daily)
SELECT 'A' AS shape, (SELECT count(*) FROM daily) AS n_rows UNION ALL
SELECT 'B', (SELECT count(*) FROM q) UNION ALL
SELECT 'C', (SELECT count(*) FROM daily) UNION ALL
SELECT 'rejected', (SELECT count(*) FROM customer)""")
def s6(spark, sf):
    odd = v.table(spark, sf, "customer").select(
        F.col("c_mktsegment").alias("series"), F.to_json(F.struct(F.col("c_name").alias("error"))).alias("payload"))
    mixed = keyed_payloads(spark, sf).unionByName(quarterly_payloads(spark, sf)).unionByName(named_payloads(spark, sf)).unionByName(odd)
    good = payloads.parse_payloads(mixed).groupBy("shape").agg(F.count(F.lit(1)).alias("n_rows"))
    bad = payloads.rejected(mixed).agg(F.lit("rejected").alias("shape"), F.count(F.lit(1)).alias("n_rows"))
    return good.unionByName(bad)


@query("s7_first_symbols", f"""
WITH {v.SUPPLIER}, picked AS (SELECT s_suppkey FROM supplier ORDER BY s_suppkey LIMIT 5)
SELECT series, count(*) AS n, round(sum(y), 2) AS total FROM supplier_days
WHERE series IN (SELECT CAST(s_suppkey AS VARCHAR) FROM picked) GROUP BY series""")
def s7(spark, sf):
    path = sinks.scratch_dir(spark) + "/symbols.csv"
    symbols = v.table(spark, sf, "supplier").select(F.col("s_suppkey").cast("string").alias("Symbol"), F.col("s_name").alias("Name"))
    sinks.write_csv(symbols.orderBy(F.col("Symbol").cast("bigint")).coalesce(1), path)
    kept = readers.restrict_to(v.supplier_days(spark, sf), readers.read_symbols(spark, path, 5))
    return kept.groupBy("series").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("y"), 2).alias("total"))


@query("s8_folder_tree", f"""
WITH {v.DAILY} SELECT series, count(*) AS n, round(sum(y), 2) AS total, min(ts) AS first_ts, max(ts) AS last_ts FROM daily GROUP BY series""")
def s8(spark, sf):
    base = sinks.scratch_dir(spark) + "/tree"
    daily = v.daily_orders(spark, sf).withColumn("ticker", F.col("series")).drop("series")
    even = F.year("ts") % 2 == 0
    sinks.write_by(daily.filter(even), base, ["ticker"])
    daily.filter(~even).write.mode("append").partitionBy("ticker").csv(base, header=True)
    tree = readers.read_tree(spark, base, "ts timestamp_ntz, y double, n_orders bigint")
    return tree.groupBy("series").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("y"), 2).alias("total"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))


@query("s9_partitioned_parquet", f"WITH {v.DAILY} SELECT series, ts, y, n_orders FROM daily")
def s9(spark, sf):
    path = sinks.scratch_dir(spark) + "/panel"
    sinks.write_by(v.daily_orders(spark, sf), path, ["series"])
    return spark.read.parquet(path).select("series", "ts", "y", "n_orders")


@query("x1_incremental_ingest", f"""
WITH {v.DAILY} SELECT series, ts, 'total' AS name, {MONEY} AS value FROM daily
UNION ALL SELECT series, ts, 'orders', CAST(n_orders AS VARCHAR) FROM daily""")
def x1(spark, sf):
    base = sinks.scratch_dir(spark)
    feed = keyed_payloads(spark, sf).withColumnRenamed("payload", "value")
    land = lambda: feed.write.mode("append").option("maxRecordsPerFile", 1).partitionBy("series").text(f"{base}/in")
    land()
    ingest_once(spark, f"{base}/in/*", f"{base}/out", f"{base}/state", files_per_batch=20)
    land()  # every payload is fetched again; nothing new may be stored
    ingest_once(spark, f"{base}/in/*", f"{base}/out", f"{base}/state", files_per_batch=50)
    return spark.read.parquet(f"{base}/out").select("series", "ts", "name", "value")
