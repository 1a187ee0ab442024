"""Queries of projections, filters, cleaning and profiles (P*, A1, A5, A6, A10, A12, A13)."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelloom.operators import clean, features, splits
from panelloom.plans import views as v
from panelloom.plans.catalog import query, rounded

SHIP_COLS = ["price_sum", "price_avg", "price_max", "qty_sum", "qty_avg", "disc_avg", "tax_avg", "tax_sum", "n_lines",
             "line_sum", "supp_max", "constant", "qty_copy"]


@query("p1_time_range", """
SELECT o_orderstatus AS status, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders
WHERE o_orderdate > TIMESTAMP '1996-12-31' AND o_orderdate < TIMESTAMP '1999-12-31' GROUP BY ALL""")
def p1(spark, sf):
    rows = clean.time_between(v.table(spark, sf, "orders"), "1996-12-31", "1999-12-31", ts="o_orderdate")
    return rows.groupBy(F.col("o_orderstatus").alias("status")).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("p2_before_last_horizon", f"WITH {v.FULL} SELECT series, ts, y FROM full_days WHERE idx <= (SELECT max(idx) FROM full_days) - 90")
def p2(spark, sf):
    return splits.before_last(v.orders_panel(spark, sf), 90, time_idx="idx").select("series", "ts", "y")


@query("p3_cutoff_at_share", """
SELECT o_orderdate AS cutoff FROM (
  SELECT o_orderdate, row_number() OVER (ORDER BY o_orderdate) - 1 AS pos, count(*) OVER () AS n FROM orders)
WHERE pos = CAST(floor(n * 0.75) AS BIGINT)""")
def p3(spark, sf):
    return splits.cutoff_time(v.table(spark, sf, "orders"), 0.75, ts="o_orderdate")


@query("p4_p5_drop_and_reorder", f"WITH {v.SHIP} SELECT series, ts, * EXCLUDE (series, ts, line_sum, tax_sum) FROM ship")
def p4(spark, sf):
    return clean.leading(v.ship_features(spark, sf).drop("line_sum", "tax_sum", "not_there"), ["series", "ts"])


@query("p6_drop_constant_columns", f"WITH {v.SHIP} SELECT * EXCLUDE (constant) FROM ship")
def p6(spark, sf):
    return clean.drop_constant(v.ship_features(spark, sf), ["series", "ts"])


@query("p7_column_kinds", f"WITH {v.SHIP}, per_series AS (SELECT series, " + ", ".join(
    f"min({c}) IS NOT DISTINCT FROM max({c}) AS {c}" for c in SHIP_COLS) + " FROM ship GROUP BY series) " + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", (SELECT count(DISTINCT {c}) FROM ship) AS n_distinct, "
    f"(SELECT bool_and({c}) FROM per_series) AS static_in_series, (SELECT count(DISTINCT {c}) FROM ship) = 1 AS static_global"
    for c in SHIP_COLS))
def p7(spark, sf):
    return clean.column_kinds(v.ship_features(spark, sf))


@query("p9_p8_numeric_value_columns", f"WITH {v.SHIP} SELECT {', '.join(SHIP_COLS)} FROM ship")
def p9(spark, sf):
    df = v.ship_features(spark, sf)
    wanted = [c for c in clean.value_columns(df, ["series", "ts"]) if c in clean.numeric_columns(df)]
    return df.select(*wanted)


@query("p10_drop_duplicate_columns", f"WITH {v.SHIP} SELECT * EXCLUDE (qty_copy) FROM ship")
def p10(spark, sf):
    return clean.drop_duplicate_columns(v.ship_features(spark, sf), ["series", "ts"])


@query("p11_complete_rows", f"WITH {v.GRID} SELECT series, ts, y, n_orders FROM grid WHERE y IS NOT NULL AND n_orders IS NOT NULL")
def p11(spark, sf):
    return v.orders_grid(spark, sf).select("series", "ts", "y", "n_orders").dropna("any")


@query("p12_f2_parse_time", "SELECT event_id, ts AS seen FROM events WHERE event_id % 7 <> 0")
def p12(spark, sf):
    text = F.when(F.col("event_id") % 7 == 0, "n/a").otherwise(F.col("ts").cast("string"))
    return clean.parse_time(v.table(spark, sf, "events").select("event_id", text.alias("seen")), "seen")


@query("p13_replace_sentinels", f"""
WITH {v.GRID} SELECT series, ts, coalesce(y, 0) AS y, coalesce(n_orders, 0) AS n_orders,
  CASE WHEN n_orders IS NULL OR n_orders <= 2 THEN '0' ELSE CAST(n_orders AS VARCHAR) END AS label FROM grid""")
def p13(spark, sf):
    label = F.when(F.col("n_orders") == 1, "None").when(F.col("n_orders") == 2, "").otherwise(F.col("n_orders").cast("string"))
    grid = v.orders_grid(spark, sf).select("series", "ts", "y", "n_orders", label.alias("label"))
    return clean.replace_sentinels(grid, ["series", "ts"])


@query("p14_rows_after_last", f"""
WITH {v.SUPPLIER}, last AS (SELECT series, max(ts) AS t FROM supplier_days WHERE ts < TIMESTAMP '2000-06-01' GROUP BY series)
SELECT d.series, d.ts, d.y, d.qty FROM supplier_days d LEFT JOIN last USING (series) WHERE t IS NULL OR d.ts > t""")
def p14(spark, sf):
    days = v.supplier_days(spark, sf)
    return clean.rows_after_last(days, days.filter(F.col("ts") < F.lit("2000-06-01").cast("timestamp_ntz"))).select("series", "ts", "y", "qty")


def _corr_sql(c: str) -> str:
    # a constant column has no correlation
    return f"CASE WHEN stddev_pop({c}) > 0 THEN corr({c}, price_sum) END"


@query("p16_weak_columns", f"WITH {v.SHIP} " + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\" FROM (SELECT {_corr_sql(c)} AS r FROM ship) WHERE r IS NULL OR abs(r) >= 0.2"
    for c in SHIP_COLS if c != "price_sum"))
def p16(spark, sf):
    df = v.ship_features(spark, sf)
    kept = features.drop_weak(df, target="price_sum", thresh=0.2, protected=["series", "ts"])
    names = [(c,) for c in kept.columns if c not in ("series", "ts", "price_sum")]
    return spark.createDataFrame(names, "column string")


@query("a1_distinct_rows", "SELECT DISTINCT l_returnflag, l_linestatus, l_shipdate, l_quantity FROM lineitem")
def a1(spark, sf):
    return v.table(spark, sf, "lineitem").select("l_returnflag", "l_linestatus", "l_shipdate", "l_quantity").dropDuplicates()


# The numeric columns of the table.
LINE_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("a5_a6_column_profile", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS n_distinct, CAST(min({c}) AS DOUBLE) AS lo, CAST(max({c}) AS DOUBLE) AS hi, "
    f"count(*) - count({c}) AS n_null, bool_and({c} = round({c})) AS whole FROM lineitem"
    for c in LINE_COLS))
def a5(spark, sf):
    return clean.column_profile(v.table(spark, sf, "lineitem"), LINE_COLS)


@query("a6_narrow_types", "SELECT l_orderkey, l_linenumber, CAST(l_quantity AS SMALLINT) AS l_quantity, l_discount FROM lineitem")
def a6(spark, sf):
    df = v.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_discount")
    return clean.narrow_types(df, ["l_quantity", "l_discount"])


@query("a10_shape", "SELECT count(*) AS n_rows, 11 AS n_cols FROM lineitem")
def a10(spark, sf):
    return clean.shape(v.table(spark, sf, "lineitem"))


@query("a12_a13_series_dimension", f"""
WITH {v.SUPPLIER} SELECT d.series, count(*) AS n, min(d.ts) AS first_ts, max(d.ts) AS last_ts, min(s.s_name) AS s_name, min(s.s_nationkey) AS s_nationkey
FROM supplier_days d JOIN supplier s ON CAST(s.s_suppkey AS VARCHAR) = d.series GROUP BY d.series""")
def a13(spark, sf):
    static = v.table(spark, sf, "supplier").select(F.col("s_suppkey").cast("string").alias("series"), "s_name", "s_nationkey")
    return clean.series_dimension(v.supplier_days(spark, sf).join(static, "series"), ["s_name", "s_nationkey"])


@query("a13_static_covariates", """
SELECT c.c_mktsegment AS series, count(*) AS n_customers, count(DISTINCT n.n_name) AS n_nations, round(sum(c.c_acctbal), 2) AS balance, min(r.r_name) AS first_region
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey GROUP BY ALL""")
def a13_static(spark, sf):
    dim = v.static_dim(spark, sf)
    return rounded(dim.groupBy(F.col("c_mktsegment").alias("series")).agg(
        F.count(F.lit(1)).alias("n_customers"), F.count_distinct("n_name").alias("n_nations"),
        F.sum("c_acctbal").alias("balance"), F.min("r_name").alias("first_region")), balance=2)
