"""Queries of joins, unions and resampling (J*, U*, F18)."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelloom.functions import calendar
from panelloom.functions.timeaxis import HOUR, floor_to, plus_seconds
from panelloom.operators import align
from panelloom.plans import views as v
from panelloom.plans.catalog import query

# The order priorities, used as column names.
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@query("j1_outer_join_on_time", f"WITH {v.DAILY} SELECT ts, " + ", ".join(
    f"max(CASE WHEN series = '{p}' THEN y END) AS \"{p}\"" for p in PRIORITIES) + " FROM daily GROUP BY ts")
def j1(spark, sf):
    return align.outer_join_named(v.daily_orders(spark, sf), name="series", value="y")


@query("j2_merge_onto_first", f"""
WITH {v.DAILY},
other AS (SELECT o_orderpriority AS series, o_orderdate AS ts, max(o_totalprice) AS y, count(DISTINCT o_custkey) AS customers
          FROM orders GROUP BY ALL)
SELECT d.series, d.ts, coalesce(CASE WHEN d.n_orders > 1 THEN d.y END, o.y) AS y, d.n_orders, o.customers
FROM daily d LEFT JOIN other o ON o.series = d.series AND o.ts = d.ts""")
def j2(spark, sf):
    left = v.daily_orders(spark, sf).withColumn("y", F.when(F.col("n_orders") > 1, F.col("y")))
    right = v.table(spark, sf, "orders").groupBy(
        F.col("o_orderpriority").alias("series"), F.col("o_orderdate").alias("ts")
    ).agg(F.max("o_totalprice").alias("y"), F.count_distinct("o_custkey").alias("customers"))
    return align.merge_first(left, right, keys=["series", "ts"])


@query("j3_join_shared_calendar", f"""
WITH {v.DAILY},
econ AS (SELECT l_shipdate + CASE WHEN l_returnflag = 'R' THEN INTERVAL 12 HOUR ELSE INTERVAL 0 HOUR END AS ts, round(sum(l_discount), 2) / count(*) AS rate FROM lineitem GROUP BY ALL),
every AS (SELECT series, ts FROM daily UNION SELECT s.series, e.ts FROM (SELECT DISTINCT series FROM daily) s CROSS JOIN econ e)
SELECT series, ts, d.y, d.n_orders, e.rate FROM every LEFT JOIN daily d USING (series, ts) LEFT JOIN econ e USING (ts)""")
def j3(spark, sf):
    # two values a day: the calendar's step is its own
    ts = plus_seconds(F.col("l_shipdate"), F.when(F.col("l_returnflag") == "R", 12 * HOUR).otherwise(0))
    econ = v.table(spark, sf, "lineitem").groupBy(ts.alias("ts")).agg(
        (F.round(F.sum("l_discount"), 2) / F.count(F.lit(1))).alias("rate"))
    return align.join_calendar(v.daily_orders(spark, sf), econ)


@query("j4_stack_columns", f"""
WITH {v.DAILY},
hi AS (SELECT o_orderpriority AS series, o_orderdate AS ts, max(o_totalprice) AS largest FROM orders GROUP BY ALL)
SELECT series, ts, y, n_orders, largest FROM daily JOIN hi USING (series, ts)""")
def j4(spark, sf):
    largest = v.table(spark, sf, "orders").groupBy(F.col("o_orderpriority").alias("series"), F.col("o_orderdate").alias("ts")).agg(
        F.max("o_totalprice").alias("largest"))
    return align.stack_columns([v.daily_orders(spark, sf), largest], keys=["series", "ts"])


@query("j7_holiday_membership", f"""
WITH {v.DAILY},
days AS (SELECT unnest(generate_series(TIMESTAMP '1994-01-01', TIMESTAMP '2003-12-31', INTERVAL 1 DAY)) AS d),
nominal AS (
  SELECT d, month(d) AS m, day(d) AS dd, isodow(d) AS wd, (day(d) + 6) // 7 AS nth, month(d + INTERVAL 7 DAY) <> month(d) AS last_week FROM days),
fixed AS (SELECT CASE wd WHEN 6 THEN d - INTERVAL 1 DAY WHEN 7 THEN d + INTERVAL 1 DAY ELSE d END AS h FROM nominal
          WHERE (m, dd) IN ((1, 1), (7, 4), (11, 11), (12, 25))),
moving AS (SELECT d AS h FROM nominal WHERE (wd = 1 AND ((m = 1 AND nth = 3) OR (m = 2 AND nth = 3) OR (m = 5 AND last_week)
          OR (m = 9 AND nth = 1) OR (m = 10 AND nth = 2))) OR (wd = 4 AND m = 11 AND nth = 4)),
holidays AS (SELECT h FROM fixed UNION SELECT h FROM moving)
SELECT series, ts, y, CASE WHEN ts IN (SELECT h FROM holidays) THEN 1.0 ELSE 0.0 END::DOUBLE AS holiday FROM daily""")
def j7(spark, sf):
    daily = v.daily_orders(spark, sf).select("series", "ts", "y")
    return calendar.join_holidays(daily, calendar.holidays_of(daily))


@query("j8_asof_hourly_grid", """
WITH moved AS (SELECT event_type, CASE WHEN event_id % 3 = 0 THEN date_trunc('hour', ts) + to_microseconds(event_id + 1) ELSE ts END AS ts, value FROM events),
cells AS (
  SELECT s.event_type AS series, c.ts FROM (SELECT DISTINCT event_type FROM events) s
  CROSS JOIN (SELECT unnest(generate_series((SELECT date_trunc('hour', min(ts)) FROM moved), (SELECT max(ts) FROM moved), INTERVAL 1 HOUR)) AS ts) c)
SELECT c.series, c.ts, e.value FROM cells c ASOF LEFT JOIN moved e ON c.series = e.event_type AND c.ts >= e.ts""")
def j8(spark, sf):
    # a third of the events lies within a fraction of a second after a grid cell
    late = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), ((F.col("event_id") + 1) / 1_000_000).cast("decimal(18,6)"))
    ts = F.when(F.col("event_id") % 3 == 0, floor_to(F.col("ts"), HOUR) + late).otherwise(F.col("ts"))
    events = v.table(spark, sf, "events").select(F.col("event_type").alias("series"), ts.alias("ts"), "value")
    return align.asof_grid(events, ["value"], step=HOUR).select("series", "ts", "value")


@query("j9_combine_complete", f"""
WITH {v.HOURLY},
users AS (SELECT event_type AS series, date_trunc('hour', ts) AS ts, count(DISTINCT user_id) AS n FROM events GROUP BY ALL)
SELECT h.series, h.ts, h.y AS mean_y, h.n_events AS mean_n_events, u.n AS users_n FROM hourly h JOIN users u ON u.series = h.series AND u.ts = h.ts""")
def j9(spark, sf):
    users = v.table(spark, sf, "events").groupBy(
        F.col("event_type").alias("series"), floor_to(F.col("ts"), HOUR).alias("ts")).agg(F.count_distinct("user_id").alias("n"))
    return align.combine_complete({"mean": v.hourly_events(spark, sf), "users": users}, keys=["series", "ts"])


@query("u1_union_differing_columns", f"""
WITH {v.DAILY}, {v.HOURLY} SELECT series, ts, y, n_orders, NULL::BIGINT AS n_events FROM daily
UNION ALL SELECT series, ts, y, NULL, n_events FROM hourly""")
def u1(spark, sf):
    return align.union_panels([v.daily_orders(spark, sf), v.hourly_events(spark, sf)])


@query("u2_append_history", f"""
WITH {v.SUPPLIER} SELECT series, count(*) AS n, round(sum(y), 2) AS total FROM supplier_days GROUP BY series""")
def u2(spark, sf):
    days = v.supplier_days(spark, sf)
    cut = F.lit("1999-01-01").cast("timestamp_ntz")
    both = align.union_panels([days.filter(F.col("ts") < cut), days.filter(F.col("ts") >= cut)])
    return both.groupBy("series").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("y"), 2).alias("total"))


@query("u4_extend_with_forecast", f"""
WITH {v.PANEL},
fit AS (SELECT series, max(ts) AS last_ts, arg_max(y, idx) AS last, (arg_max(y, idx) - arg_min(y, idx)) / (count(*) - 1) AS slope FROM panel GROUP BY series)
SELECT series, ts, round(y, 2) AS y, false AS is_forecast FROM panel
UNION ALL SELECT series, last_ts + to_days(CAST(step AS INTEGER)), round(last + step * slope, 2), true
FROM fit CROSS JOIN range(1, 91) t(step)""")
def u4(spark, sf):
    from panelloom.forecast.naive import drift

    panel = v.orders_panel(spark, sf)
    forecast = drift(panel.withColumn("nt", F.col("n")), horizon=90)
    out = align.extend_with_forecast(panel.select("series", "ts", "y"), forecast.select("series", "step", "pred"))
    return out.withColumn("y", F.round("y", 2))


@query("f18_resample_forward_fill", f"""
WITH lasts AS (
  SELECT user_id AS series, time_bucket(INTERVAL '6 hours', ts) AS ts, arg_max(value, ts) AS value FROM events GROUP BY ALL),
cells AS (SELECT series, unnest(generate_series(lo, hi, INTERVAL 6 HOUR)) AS ts FROM (SELECT series, min(ts) AS lo, max(ts) AS hi FROM lasts GROUP BY series))
SELECT c.series, c.ts, last_value(l.value IGNORE NULLS) OVER (PARTITION BY c.series ORDER BY c.ts) AS value
FROM cells c LEFT JOIN lasts l ON l.series = c.series AND l.ts = c.ts""")
def f18(spark, sf):
    events = v.table(spark, sf, "events").select(F.col("user_id").alias("series"), "ts", "value")
    return align.resample_ffill(events, ["value"], step=6 * HOUR).select("series", "ts", "value")
