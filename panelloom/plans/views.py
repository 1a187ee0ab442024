"""Panels derived from the driver's tables, and the same as DuckDB CTEs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelloom.functions.timeaxis import HOUR, floor_to
from panelloom.operators import align, blocks
from panelloom.sources.sinks import stage


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _mean(c: str) -> F.Column:
    """Mean of a column in cents; the exact sum makes it the same whatever the order of rows."""
    return F.round(F.sum(c), 2) / F.count(F.lit(1))


def daily_orders(spark: SparkSession, sf: str) -> DataFrame:
    """(series, ts, y, n_orders): order value per priority and day; days without orders are missing."""
    return table(spark, sf, "orders").groupBy(F.col("o_orderpriority").alias("series"), F.col("o_orderdate").alias("ts")).agg(
        F.round(F.sum("o_totalprice"), 2).alias("y"), F.count(F.lit(1)).alias("n_orders")
    )


def orders_grid(spark: SparkSession, sf: str) -> DataFrame:
    """daily_orders on the full daily grid with gaps as nulls: (series, ts, idx, n, y, n_orders)."""
    return align.on_grid(stage(daily_orders(spark, sf)))


def orders_panel(spark: SparkSession, sf: str) -> DataFrame:
    """The grid with gaps filled forward, then backward, by at most 91 rows; `n` is the series length."""
    return stage(blocks.fill(orders_grid(spark, sf), ["y", "n_orders"], forward=91, backward=91, block_rows=512))


def hourly_events(spark: SparkSession, sf: str) -> DataFrame:
    """(series, ts, y, n_events): mean event value per type and hour."""
    return table(spark, sf, "events").groupBy(F.col("event_type").alias("series"), floor_to(F.col("ts"), HOUR).alias("ts")).agg(
        _mean("value").alias("y"), F.count(F.lit(1)).alias("n_events")
    )


def supplier_days(spark: SparkSession, sf: str) -> DataFrame:
    """(series, ts, y, qty): shipped value per supplier and day; the number of series grows with the data."""
    return table(spark, sf, "lineitem").groupBy(F.col("l_suppkey").cast("string").alias("series"), F.col("l_shipdate").alias("ts")).agg(
        F.round(F.sum("l_extendedprice"), 2).alias("y"), F.sum("l_quantity").alias("qty")
    )


def supplier_panel(spark: SparkSession, sf: str) -> DataFrame:
    """supplier_days as a stored table, for operators that use their input more than once."""
    return stage(supplier_days(spark, sf))


def ship_features(spark: SparkSession, sf: str) -> DataFrame:
    """Wide numeric panel by return flag and ship date."""
    return table(spark, sf, "lineitem").groupBy(F.col("l_returnflag").alias("series"), F.col("l_shipdate").alias("ts")).agg(
        F.round(F.sum("l_extendedprice"), 2).alias("price_sum"),
        _mean("l_extendedprice").alias("price_avg"),
        F.max("l_extendedprice").alias("price_max"),
        F.sum("l_quantity").alias("qty_sum"),
        _mean("l_quantity").alias("qty_avg"),
        _mean("l_discount").alias("disc_avg"),
        _mean("l_tax").alias("tax_avg"),
        F.round(F.sum("l_tax"), 2).alias("tax_sum"),
        F.count(F.lit(1)).alias("n_lines"),
        F.sum("l_linenumber").alias("line_sum"),
        F.max("l_suppkey").alias("supp_max"),
        F.lit(1).alias("constant"),
        F.sum("l_quantity").cast("bigint").alias("qty_copy"),
    )


def static_dim(spark: SparkSession, sf: str) -> DataFrame:
    """Customers with nation and region."""
    nation = table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return table(spark, sf, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))


# The same views for DuckDB.  Each is a list of CTEs without the leading WITH.
DAILY = """daily AS (
  SELECT o_orderpriority AS series, o_orderdate AS ts, round(sum(o_totalprice), 2) AS y, count(*) AS n_orders
  FROM orders GROUP BY ALL)"""

GRID = DAILY + """,
grid AS (
  SELECT s.series, CAST(r.ts AS TIMESTAMP) AS ts, date_diff('day', e.lo, CAST(r.ts AS TIMESTAMP)) AS idx, d.y, d.n_orders
  FROM (SELECT DISTINCT series FROM daily) s
  CROSS JOIN (SELECT min(ts) AS lo, max(ts) AS hi FROM daily) e
  CROSS JOIN (SELECT unnest(generate_series((SELECT min(ts) FROM daily), (SELECT max(ts) FROM daily), INTERVAL 1 DAY)) AS ts) r
  LEFT JOIN daily d ON d.series = s.series AND d.ts = r.ts)"""

FULL = GRID + """,
fwd AS (
  SELECT series, ts, idx,
    last_value(y IGNORE NULLS) OVER w AS y, last_value(n_orders IGNORE NULLS) OVER w AS n_orders
  FROM grid WINDOW w AS (PARTITION BY series ORDER BY ts ROWS BETWEEN 91 PRECEDING AND CURRENT ROW)),
full_days AS (
  SELECT series, ts, idx,
    first_value(y IGNORE NULLS) OVER w AS y, first_value(n_orders IGNORE NULLS) OVER w AS n_orders
  FROM fwd WINDOW w AS (PARTITION BY series ORDER BY ts ROWS BETWEEN CURRENT ROW AND 91 FOLLOWING))"""

PANEL = FULL + """,
panel AS (SELECT *, count(*) OVER (PARTITION BY series) AS n FROM full_days)"""

PREP = PANEL + """,
prep AS (SELECT *, CAST(floor(n * 0.75) AS BIGINT) AS nt, idx < floor(n * 0.75) AS is_train FROM panel)"""

ROLLING = PANEL + """,
sized AS (SELECT *, greatest(n // 5, 504) AS wn FROM panel),
prep AS (
  SELECT series, ts, y, n_orders, idx // wn AS window_id, idx % wn AS idx, wn AS n,
    CAST(floor(wn * 0.75) AS BIGINT) AS nt, idx % wn < floor(wn * 0.75) AS is_train
  FROM sized WHERE idx // wn < n // wn)"""

HOURLY = """hourly AS (
  SELECT event_type AS series, date_trunc('hour', ts) AS ts, round(sum(value), 2) / count(*) AS y, count(*) AS n_events
  FROM events GROUP BY ALL)"""

SUPPLIER = """supplier_days AS (
  SELECT CAST(l_suppkey AS VARCHAR) AS series, l_shipdate AS ts, round(sum(l_extendedprice), 2) AS y, sum(l_quantity) AS qty
  FROM lineitem GROUP BY ALL)"""

SHIP = """ship AS (
  SELECT l_returnflag AS series, l_shipdate AS ts,
    round(sum(l_extendedprice), 2) AS price_sum, round(sum(l_extendedprice), 2) / count(*) AS price_avg, max(l_extendedprice) AS price_max,
    sum(l_quantity) AS qty_sum, round(sum(l_quantity), 2) / count(*) AS qty_avg, round(sum(l_discount), 2) / count(*) AS disc_avg,
    round(sum(l_tax), 2) / count(*) AS tax_avg, round(sum(l_tax), 2) AS tax_sum, count(*) AS n_lines, CAST(sum(l_linenumber) AS BIGINT) AS line_sum,
    max(l_suppkey) AS supp_max, 1 AS constant, CAST(sum(l_quantity) AS BIGINT) AS qty_copy
  FROM lineitem GROUP BY ALL)"""
