"""Queries of correlation, windows, splits, samples, encoders and scaling (A2-A4, O1-O2, W*, F*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelloom.functions import calendar
from panelloom.functions.options import option_chain
from panelloom.operators import blocks, features, scale, splits
from panelloom.plans import views as v
from panelloom.plans.catalog import query, rounded
from panelloom.plans.q_clean import SHIP_COLS, _corr_sql
from panelloom.sources.sinks import stage

TARGET = "price_sum"
FEATURES = [c for c in SHIP_COLS if c != TARGET]

CORRS = f"WITH {v.SHIP}, corrs AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", {_corr_sql(c)} AS r FROM ship" for c in FEATURES) + ")"


@query("a2_corr_with_target", f"{CORRS} SELECT \"column\", round(r, 8) AS r FROM corrs")
def a2(spark, sf):
    return rounded(features.corr_with_target(v.ship_features(spark, sf), TARGET), r=8)


MATRIX_COLS = [c for c in SHIP_COLS if c != "constant"]  # a constant has no correlation


@query("a3_corr_matrix", f"WITH {v.SHIP} " + " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 8) AS r FROM ship" for a in MATRIX_COLS for b in MATRIX_COLS))
def a3(spark, sf):
    return rounded(features.corr_matrix(v.ship_features(spark, sf), MATRIX_COLS), r=8)


@query("a4_corr_histogram", f"""{CORRS},
b AS (SELECT abs(r) AS v, min(abs(r)) OVER () AS lo, max(abs(r)) OVER () AS hi FROM corrs WHERE r IS NOT NULL)
SELECT least(CAST(floor((v - lo) / (hi - lo) * 20) AS INTEGER), 19) AS bin, count(*) AS n FROM b GROUP BY ALL""")
def a4(spark, sf):
    return features.corr_histogram(features.corr_with_target(v.ship_features(spark, sf), TARGET))


@query("o1_ranked_by_corr", f"""{CORRS}
SELECT row_number() OVER (ORDER BY round(abs(r), 12) DESC NULLS LAST, "column") AS place, "column", round(r, 8) AS r FROM corrs""")
def o1(spark, sf):
    from pyspark.sql import Window as W

    corrs = features.corr_with_target(v.ship_features(spark, sf), TARGET)  # one row per column
    w = W.orderBy(features.strength().desc_nulls_last(), "column")
    return rounded(features.ranked(corrs).select(F.row_number().over(w).alias("place"), "column", "r"), r=8)


@query("o2_strongest_and_weakest", f"""{CORRS},
p AS (SELECT *, row_number() OVER (ORDER BY round(abs(r), 12) DESC NULLS LAST, "column") AS a,
  row_number() OVER (ORDER BY round(abs(r), 12) ASC NULLS FIRST, "column" DESC) AS b FROM corrs)
SELECT "column", round(r, 8) AS r, 'top' AS side FROM p WHERE a <= 10 UNION ALL SELECT "column", round(r, 8), 'bottom' FROM p WHERE b <= 10""")
def o2(spark, sf):
    return rounded(features.strongest_and_weakest(features.corr_with_target(v.ship_features(spark, sf), TARGET)), r=8)


@query("w1_ffill_limited", f"""
WITH {v.GRID} SELECT series, ts, last_value(y IGNORE NULLS) OVER (PARTITION BY series ORDER BY ts ROWS BETWEEN 1 PRECEDING AND CURRENT ROW) AS y FROM grid""")
def w1(spark, sf):
    return blocks.fill(v.orders_grid(spark, sf), ["y"], forward=1).select("series", "ts", "y")


@query("w1_w2_fill_both_ways", f"WITH {v.FULL} SELECT series, ts, y, n_orders FROM full_days")
def w1w2(spark, sf):
    return v.orders_panel(spark, sf).select("series", "ts", "y", "n_orders")


@query("w2_bfill_limited", f"""
WITH {v.GRID} SELECT series, ts, first_value(y IGNORE NULLS) OVER (PARTITION BY series ORDER BY ts ROWS BETWEEN CURRENT ROW AND 1 FOLLOWING) AS y FROM grid""")
def w2(spark, sf):
    return blocks.fill(v.orders_grid(spark, sf), ["y"], backward=1).select("series", "ts", "y")


CHANGES = """
filled AS (SELECT series, ts, y, last_value(y IGNORE NULLS) OVER (PARTITION BY series ORDER BY ts) AS f FROM grid),
changes AS (SELECT series, ts, y, (f / lag(f) OVER (PARTITION BY series ORDER BY ts) - 1) * 100 AS c FROM filled)"""


@query("w3_percent_change", f"WITH {v.GRID}, {CHANGES} SELECT series, ts, y, round(c, 6) AS \"y (%)\" FROM changes")
def w3(spark, sf):
    out = features.percent_change(v.orders_grid(spark, sf).select("series", "ts", "idx", "y"), ["y"]).drop("idx")
    return rounded(out, **{"y (%)": 6})


@query("w4_percent_mode", f"WITH {v.GRID}, {CHANGES} SELECT series, ts, round(c, 6) AS \"y (%)\" FROM changes WHERE c IS NOT NULL")
def w4(spark, sf):
    out = features.percent_change(v.orders_grid(spark, sf).select("series", "ts", "idx", "y"), ["y"]).drop("idx", "y")
    return rounded(out.dropna("any"), **{"y (%)": 6})


@query("w5_back_from_percent_change", f"""
WITH {v.SUPPLIER},
c AS (SELECT series, ts, y, y / lag(y) OVER (PARTITION BY series ORDER BY ts) AS ratio FROM supplier_days),
hist AS (SELECT series, max(ts) AS t, arg_max(y, ts) AS last FROM supplier_days WHERE ts < TIMESTAMP '2000-01-01' GROUP BY series)
SELECT series, ts, y FROM supplier_days WHERE ts < TIMESTAMP '2000-01-01'
UNION ALL
SELECT c.series, c.ts, round(h.last * product(ratio) OVER (PARTITION BY c.series ORDER BY c.ts), 2)
FROM c JOIN hist h ON h.series = c.series AND c.ts > h.t""")
def w5(spark, sf):
    days = stage(blocks.position(v.supplier_panel(spark, sf).select("series", "ts", "y")))
    history = days.filter(F.col("ts") < F.lit("2000-01-01").cast("timestamp_ntz")).drop("idx")
    out = features.from_percent_change(stage(features.percent_change(days, ["y"])), history, ["y"])
    return rounded(out.select("series", "ts", "y"), y=2)


@query("w6_dense_time_rank", f"WITH {v.SUPPLIER} SELECT series, ts, dense_rank() OVER (ORDER BY ts) AS time_idx FROM supplier_days")
def w6(spark, sf):
    return scale.time_rank(v.supplier_panel(spark, sf).select("series", "ts"), "ts", name="time_idx")


@query("w7_position", f"""
WITH {v.SUPPLIER} SELECT series, ts, row_number() OVER (PARTITION BY series ORDER BY ts) - 1 AS idx, count(*) OVER (PARTITION BY series) AS n FROM supplier_days""")
def w7(spark, sf):
    return blocks.position(v.supplier_panel(spark, sf), total="n").select("series", "ts", "idx", "n")


@query("w8_train_split", f"WITH {v.PREP} SELECT series, is_train, count(*) AS n, min(ts) AS lo, max(ts) AS hi FROM prep GROUP BY ALL")
def w8(spark, sf):
    return splits.mark_train(v.orders_panel(spark, sf), 0.75).groupBy("series", "is_train").agg(
        F.count(F.lit(1)).alias("n"), F.min("ts").alias("lo"), F.max("ts").alias("hi"))


@query("w8_last_rows_validate", f"WITH {v.PANEL} SELECT series, ts, idx < n - 90 AS is_train FROM panel")
def w8b(spark, sf):
    return splits.mark_train(v.orders_panel(spark, sf), 90).select("series", "ts", "is_train")


@query("w9_rolling_windows", f"WITH {v.ROLLING} SELECT series, window_id, ts, idx, is_train FROM prep")
def w9(spark, sf):
    rows = splits.rolling_windows(v.orders_panel(spark, sf), 5)
    return rows.select("series", "window_id", "ts", F.col("widx").alias("idx"), "is_train")


@query("w10_overlapping_windows", f"""
WITH {v.PANEL},
plan AS (SELECT DISTINCT series, n, (n - 595) // 4 AS step FROM panel),
starts AS (SELECT series, step, unnest(range(0, n - 595 + 1, step)) AS lo FROM plan)
SELECT s.series, s.lo // s.step AS window_id, count(*) AS n_rows, min(p.ts) AS first_ts, max(p.ts) AS last_ts,
  count(*) FILTER (p.idx - s.lo < 446) AS n_train, round(sum(p.y), 2) AS total
FROM starts s JOIN panel p ON p.series = s.series AND p.idx BETWEEN s.lo AND s.lo + 594 GROUP BY ALL""")
def w10(spark, sf):
    size = splits.window_rows(encoder=88, horizon=90, train_share=0.75)
    rows = splits.overlapping_windows(v.orders_panel(spark, sf), size, 5)
    return rounded(rows.groupBy("series", "window_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"),
        F.count_if("is_train").alias("n_train"), F.sum("y").alias("total")), total=2)


SAMPLES = """
s AS (SELECT series, idx AS start_idx,
  count(*) OVER e AS n_enc, sum(y) OVER e AS s_enc, min(idx) OVER e AS first_enc, count(*) OVER d AS n_dec, sum(y) OVER d AS s_dec
FROM panel WINDOW e AS (PARTITION BY series ORDER BY idx ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING),
  d AS (PARTITION BY series ORDER BY idx ROWS BETWEEN CURRENT ROW AND 6 FOLLOWING))"""


@query("w11_encoder_decoder_samples", f"""
WITH {v.PANEL}, {SAMPLES}
SELECT series, start_idx, CAST(n_enc AS INTEGER) AS n_enc, round(s_enc, 2) AS s_enc, first_enc, CAST(n_dec AS INTEGER) AS n_dec, round(s_dec, 2) AS s_dec
FROM s WHERE n_enc >= 14 AND n_dec >= 1""")
def w11(spark, sf):
    rows = splits.samples(v.orders_panel(spark, sf), encoder=28, horizon=7)
    return rows.select("series", "start_idx", *_sizes())


def _total(c: str):
    return F.round(F.aggregate(c, F.lit(0.0), lambda a, e: a + e["y"]), 2)


def _sizes():
    return [F.size("enc").alias("n_enc"), _total("enc").alias("s_enc"), F.col("enc")[0]["idx"].alias("first_enc"),
            F.size("dec").alias("n_dec"), _total("dec").alias("s_dec")]


@query("w12_last_samples", f"""
WITH {v.PANEL}, {SAMPLES}
SELECT s.series, start_idx, CAST(n_enc AS INTEGER) AS n_enc, round(s_enc, 2) AS s_enc, first_enc, CAST(n_dec AS INTEGER) AS n_dec, round(s_dec, 2) AS s_dec
FROM s JOIN (SELECT DISTINCT series, n FROM panel) p USING (series) WHERE start_idx = n - 7""")
def w12(spark, sf):
    return splits.last_samples(v.orders_panel(spark, sf), encoder=28, horizon=7).select("series", "start_idx", *_sizes())


@query("w13_relative_time", f"""
WITH {v.PANEL}, ends AS (SELECT DISTINCT series, n - 7 AS start_idx FROM panel)
SELECT p.series, p.idx, round((p.idx - e.start_idx) / 28.0::DOUBLE, 8) AS rel FROM panel p JOIN ends e USING (series) WHERE p.idx >= e.start_idx - 28""")
def w13(spark, sf):
    rows = splits.relative_time(splits.last_samples(v.orders_panel(spark, sf), encoder=28, horizon=7), encoder=28)
    both = F.arrays_zip(F.concat("enc.idx", "dec.idx").alias("idx"), F.concat("enc_rel", "dec_rel").alias("rel"))
    return rounded(rows.select("series", F.inline(both)).toDF("series", "idx", "rel"), rel=8)


@query("w14_w15_lags_and_targets", f"""
WITH {v.PANEL} SELECT series, ts, lag(y, 1) OVER w AS y_lag1, lag(y, 7) OVER w AS y_lag7, lag(n_orders, 2) OVER w AS n_orders_lag2,
  y AS y_lead0, lead(y, 1) OVER w AS y_lead1, lead(y, 2) OVER w AS y_lead2 FROM panel WINDOW w AS (PARTITION BY series ORDER BY ts)""")
def w14(spark, sf):
    out = features.lag_features(v.orders_panel(spark, sf), {"y": [1, 7], "n_orders": [2]}, leads={"y": [0, 1, 2]})
    return out.select("series", "ts", "y_lag1", "y_lag7", "n_orders_lag2", "y_lead0", "y_lead1", "y_lead2")


@query("w16_actual_beside_forecast", f"""
WITH {v.PREP},
fit AS (SELECT series, max(ts) AS last_ts, arg_max(y, idx) AS pred FROM prep WHERE is_train GROUP BY series)
SELECT p.series, p.ts, p.y, f.pred FROM prep p JOIN fit f USING (series)
WHERE p.idx >= p.n - 1300 AND p.ts > f.last_ts AND p.ts <= f.last_ts + INTERVAL 650 DAY""")
def w16(spark, sf):
    from panelloom.forecast import naive, registry

    prepared = registry.prepare(v.orders_panel(spark, sf))
    pred = naive.last_value(prepared.filter("is_train"), horizon=650)
    return splits.forecast_view(prepared.select("series", "ts", "y", "idx", "n"), pred, horizon=650).select("series", "ts", "y", "pred")


@query("f1_clean_names", "SELECT c_custkey, lower(regexp_replace(c_custkey || '. ' || c_name, '^\\d+\\.\\s+', '')) AS name FROM customer")
def f1(spark, sf):
    from panelloom.sources.payloads import clean_name

    raw = F.concat(F.col("c_custkey").cast("string"), F.lit(". "), F.col("c_name"))
    return v.table(spark, sf, "customer").select("c_custkey", clean_name(raw).alias("name"))


@query("f3_numeric_coercion", "SELECT event_id, TRY_CAST(CASE WHEN event_type = 'error' THEN '.' ELSE CAST(value AS VARCHAR) END AS DOUBLE) AS value FROM events")
def f3(spark, sf):
    from panelloom.operators.clean import to_number

    text = F.when(F.col("event_type") == "error", ".").otherwise(F.col("value").cast("string"))
    return v.table(spark, sf, "events").select("event_id", to_number(text).alias("value"))


@query("f4_date_parts", f"""
WITH {v.DAILY} SELECT series, ts, CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month, CAST(day(ts) AS INTEGER) AS day,
  CAST(isodow(ts) - 1 AS INTEGER) AS dayofweek, CAST(dayofyear(ts) AS INTEGER) AS dayofyear, CAST(weekofyear(ts) AS INTEGER) AS week FROM daily""")
def f4(spark, sf):
    return v.daily_orders(spark, sf).select("series", "ts", *calendar.date_parts(F.col("ts"), "D"))


@query("f4_hourly_parts", f"""
WITH {v.HOURLY} SELECT series, ts, CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month, CAST(hour(ts) AS INTEGER) AS hour FROM hourly""")
def f4h(spark, sf):
    return v.hourly_events(spark, sf).select("series", "ts", *calendar.date_parts(F.col("ts"), "H"))


@query("f5_infer_frequency", f"""
WITH {v.FULL}, {v.HOURLY},
axes AS (SELECT 'orders' AS axis, ts FROM full_days UNION SELECT 'events', ts FROM hourly),
steps AS (SELECT axis, ts, epoch(ts) - epoch(lag(ts) OVER (PARTITION BY axis ORDER BY ts)) AS s FROM axes)
SELECT axis, CASE WHEN min(s) = 86400 AND max(s) = 86400 THEN 'D' WHEN min(s) = 3600 AND max(s) = 3600 THEN 'H' END AS freq,
  count(*) AS n_times, CAST(min(s) AS BIGINT) AS min_step, CAST(max(s) AS BIGINT) AS max_step FROM steps GROUP BY axis""")
def f5(spark, sf):
    orders = calendar.infer_frequency(v.orders_panel(spark, sf)).withColumn("axis", F.lit("orders"))
    return orders.unionByName(calendar.infer_frequency(v.hourly_events(spark, sf)).withColumn("axis", F.lit("events")))


@query("f6_calendar_covariates", f"""
WITH {v.FULL}, e AS (SELECT series, ts FROM full_days UNION ALL
  SELECT series, max(ts) + to_days(CAST(h AS INTEGER)) FROM full_days CROSS JOIN range(1, 91) t(h) GROUP BY series, h)
SELECT series, ts, CAST(weekofyear(ts) AS FLOAT) AS week, CAST(month(ts) AS FLOAT) AS month, CAST(quarter(ts) AS FLOAT) AS quarter FROM e""")
def f6(spark, sf):
    from panelloom.functions.timeaxis import next_steps

    times = v.orders_panel(spark, sf).select("series", "ts")
    ahead = times.groupBy("series").agg(F.max("ts").alias("last")).withColumn("h", F.explode(F.sequence(F.lit(1), F.lit(90))))
    longer = times.unionByName(ahead.select("series", next_steps(F.col("last"), F.col("h")).alias("ts")))
    return longer.select("series", "ts", *calendar.calendar_covariates(F.col("ts")))


@query("f7_cyclic_encoding", f"WITH {v.DAILY} SELECT series, ts, " + ", ".join(
    f"round({f}(2 * pi() * {a}(ts) / {p}), 8) AS {n}_{f}" for n, a, p in (("week", "weekofyear", 52), ("month", "month", 12), ("quarter", "quarter", 4))
    for f in ("sin", "cos")) + " FROM daily")
def f7(spark, sf):
    out = v.daily_orders(spark, sf).select("series", "ts", *calendar.cyclic_parts(F.col("ts")))
    return rounded(out, **{c: 8 for c in out.columns if c.endswith(("_sin", "_cos"))})


@query("f8_zoned_calendar", f"""
WITH {v.HOURLY} SELECT series, ts, CAST(hour(ts + INTERVAL 1 HOUR) AS INTEGER) AS hour, CAST(isodow(ts + INTERVAL 1 HOUR) - 1 AS INTEGER) AS dayofweek FROM hourly""")
def f8(spark, sf):
    # January: one hour ahead of UTC
    local = calendar.in_zone(F.col("ts"))
    return v.hourly_events(spark, sf).select("series", "ts", calendar.date_part(local, "hour").alias("hour"),
                                            calendar.date_part(local, "dayofweek").alias("dayofweek"))


@query("f9_position_encoders", f"WITH {v.PREP} SELECT series, ts, idx AS absolute, idx - nt AS relative FROM prep")
def f9(spark, sf):
    rows = v.orders_panel(spark, sf)
    return rows.select("series", "ts", F.col("idx").alias("absolute"),
                       (F.col("idx") - splits.train_rows(F.col("n"), 0.75)).alias("relative"))


@query("f10_us_holidays", """
WITH days AS (SELECT unnest(generate_series((SELECT min(o_orderdate) - INTERVAL 14 DAY FROM orders), (SELECT max(l_shipdate) + INTERVAL 14 DAY FROM lineitem), INTERVAL 1 DAY)) AS d),
nominal AS (SELECT d, month(d) AS m, day(d) AS dd, isodow(d) AS wd, (day(d) + 6) // 7 AS nth, month(d + INTERVAL 7 DAY) <> month(d) AS last_week FROM days),
holidays AS (
  SELECT CASE wd WHEN 6 THEN d - INTERVAL 1 DAY WHEN 7 THEN d + INTERVAL 1 DAY ELSE d END AS h FROM nominal
  WHERE (m, dd) IN ((1, 1), (7, 4), (11, 11), (12, 25))
  UNION SELECT d FROM nominal WHERE (wd = 1 AND ((m IN (1, 2) AND nth = 3) OR (m = 5 AND last_week) OR (m = 9 AND nth = 1) OR (m = 10 AND nth = 2)))
    OR (wd = 4 AND m = 11 AND nth = 4))
SELECT l_shipdate AS ts, count(*) AS n_lines, CASE WHEN l_shipdate IN (SELECT h FROM holidays) THEN 1.0 ELSE 0.0 END::DOUBLE AS holiday
FROM lineitem GROUP BY l_shipdate""")
def f10(spark, sf):
    days = v.table(spark, sf, "lineitem").groupBy(F.col("l_shipdate").alias("ts")).agg(F.count(F.lit(1)).alias("n_lines"))
    return days.withColumn("holiday", calendar.holiday_flag(F.col("ts")))


@query("f11_zscore", f"""
WITH {v.SHIP}, s AS (SELECT {", ".join(f"avg({c}) AS {c}_m, stddev_pop({c}) AS {c}_d" for c in MATRIX_COLS)} FROM ship)
SELECT series, ts, {", ".join(f"round(({c} - {c}_m) / {c}_d, 7) AS {c}" for c in MATRIX_COLS)}, 0.0::DOUBLE AS constant FROM ship CROSS JOIN s""")
def f11(spark, sf):
    return rounded(scale.zscore_all(v.ship_features(spark, sf), [*MATRIX_COLS, "constant"]), **{c: 7 for c in MATRIX_COLS})


@query("f12_log_scaling", f"WITH {v.SHIP} SELECT series, ts, round(ln(1 + qty_sum), 8) AS qty_sum, round(ln(1 + price_sum), 8) AS price_sum FROM ship")
def f12(spark, sf):
    df = v.ship_features(spark, sf).select("series", "ts", "qty_sum", "price_sum")
    return rounded(scale.log_all(df, ["qty_sum", "price_sum"]), qty_sum=8, price_sum=8)


@query("f13_train_only_scaling", f"""
WITH {v.ROLLING},
fit AS (SELECT series, window_id, avg(y) AS m, stddev_pop(y) AS d, min(n_orders) AS lo, coalesce(nullif(max(n_orders) - min(n_orders), 0), 1) AS span FROM prep WHERE is_train GROUP BY ALL)
SELECT series, window_id, ts, round((y - m) / d, 7) AS y, round((n_orders - lo) / span, 7) AS n_orders FROM prep JOIN fit USING (series, window_id)""")
def f13(spark, sf):
    from panelloom.forecast.registry import prepare

    keys = ["series", "window_id"]
    rows = prepare(v.orders_panel(spark, sf), validation="rolling").withColumn("n_orders", F.col("n_orders").cast("double"))
    z = scale.fit_scaler(rows, ["y"], keys=keys, fit_on=F.col("is_train"))
    mm = scale.fit_scaler(rows, ["n_orders"], keys=keys, scaler="minmax", fit_on=F.col("is_train"))
    out = scale.apply_scaler(scale.apply_scaler(rows, z, ["y"], keys=keys), mm, ["n_orders"], keys=keys)
    return rounded(out.select(*keys, "ts", "y", "n_orders"), y=7, n_orders=7)


@query("f13_scaler_table", f"""
WITH {v.PREP},
f AS (SELECT series, avg(y) AS my, stddev_pop(y) AS sy, avg(n_orders) AS mn, stddev_pop(n_orders) AS sn FROM prep WHERE is_train GROUP BY series)
SELECT series, 'y' AS "column", round(my, 4) AS center, round(sy, 4) AS scale FROM f UNION ALL SELECT series, 'n_orders', round(mn, 4), round(sn, 4) FROM f""")
def f13_table(spark, sf):
    rows = splits.mark_train(v.orders_panel(spark, sf), 0.75)
    params = scale.fit_scaler(rows, ["y", "n_orders"], fit_on=F.col("is_train"))
    return rounded(scale.scaler_rows(params, ["y", "n_orders"]), center=4, scale=4)


@query("f14_scaling_on_everything", f"""
WITH {v.PANEL}, a AS (SELECT series, ts, CAST(weekofyear(ts) AS DOUBLE) AS week FROM panel),
fit AS (SELECT series, min(week) AS lo, max(week) - min(week) AS span FROM a GROUP BY series)
SELECT series, ts, round((week - lo) / span, 7) AS week FROM a JOIN fit USING (series)""")
def f14(spark, sf):
    rows = v.orders_panel(spark, sf).select("series", "ts", calendar.date_part(F.col("ts"), "week").cast("double").alias("week"))
    return rounded(scale.apply_scaler(rows, scale.fit_scaler(rows, ["week"], scaler="minmax"), ["week"]), week=7)


@query("f15_inverse_scaling", f"WITH {v.PANEL} SELECT series, ts, round(y, 2) AS y FROM panel")
def f15(spark, sf):
    rows = splits.mark_train(v.orders_panel(spark, sf), 0.75)
    params = scale.fit_scaler(rows, ["y"], fit_on=F.col("is_train"))
    scaled = scale.apply_scaler(rows.select("series", "ts", "y"), params, ["y"])
    return rounded(scale.invert_scaler(scaled, params, "y", target="y"), y=2)


@query("f16_factorize", """
WITH e AS (SELECT user_id AS series, ts, CASE WHEN value > 1 THEN event_type || '-' || CAST(user_id % 50 AS VARCHAR) END AS label FROM events),
first AS (SELECT label, min((series, ts)) AS seen FROM e WHERE label IS NOT NULL GROUP BY label),
codes AS (SELECT label, row_number() OVER (ORDER BY seen) - 1 AS code FROM first)
SELECT series, ts, CAST(coalesce(code, -1) AS INTEGER) AS label FROM e LEFT JOIN codes USING (label)""")
def f16(spark, sf):
    label = F.concat_ws("-", "event_type", (F.col("user_id") % 50).cast("string"))
    rows = v.table(spark, sf, "events").select(F.col("user_id").alias("series"), "ts", F.when(F.col("value") > 1, label).alias("label"))
    return scale.factorize(rows, "label")


@query("f17_preprocess", """
WITH e AS (SELECT user_id, event_id, ts, event_type, CAST(CAST(ts AS DATE) AS VARCHAR) AS day, value FROM events),
first AS (SELECT event_type, min((user_id, ts)) AS seen FROM e GROUP BY event_type),
codes AS (SELECT event_type, row_number() OVER (ORDER BY seen) - 1 AS code FROM first),
s AS (SELECT avg(value) AS m, stddev_pop(value) AS d FROM e)
SELECT user_id, event_id, dense_rank() OVER (ORDER BY ts) AS ts, CAST(code AS INTEGER) AS event_type, dense_rank() OVER (ORDER BY day) AS day,
  round((value - m) / d, 7) AS value FROM e JOIN codes USING (event_type) CROSS JOIN s""")
def f17(spark, sf):
    rows = v.table(spark, sf, "events").select(
        "user_id", "event_id", "ts", "event_type", F.to_date("ts").cast("string").alias("day"), "value")
    out = scale.preprocess(rows, target="value", series="user_id", ts="ts", protected=["user_id", "event_id"])
    return rounded(out, value=7)


# DuckDB has no erf: the power series is exact to 1e-13 for the arguments that occur
PHI = "(0.5 + 0.5 * 2 / sqrt(pi()) * list_sum([(-1)**i * (({x}) / sqrt(2))**(2 * i + 1) / (gamma(i + 1) * (2 * i + 1)) for i in range(0, 70)]))"
PHI_S1, PHI_S2 = PHI.format(x="sign * d1"), PHI.format(x="sign * (d1 - sd)")


@query("f20_option_chain", f"""
WITH chain AS (
  SELECT p_partkey AS series, p_retailprice AS spot, p_retailprice * m AS strike, years, kind, CASE kind WHEN 'C' THEN 1.0::DOUBLE ELSE -1.0::DOUBLE END AS sign
  FROM part, (VALUES (0.8::DOUBLE), (0.9::DOUBLE), (1.0::DOUBLE), (1.1::DOUBLE), (1.2::DOUBLE)) a(m),
    (VALUES (0.25::DOUBLE), (0.5::DOUBLE), (1.0::DOUBLE), (2.0::DOUBLE)) b(years), (VALUES ('C'), ('P')) c(kind)),
d AS (SELECT *, 0.35::DOUBLE * sqrt(years) AS sd, (ln(spot / strike) + (0.0472::DOUBLE + 0.35::DOUBLE * 0.35::DOUBLE / 2) * years) / (0.35::DOUBLE * sqrt(years)) AS d1 FROM chain)
SELECT series, kind, count(*) AS n, round(sum(round(sign * (spot * {PHI_S1} - strike * exp(-0.0472::DOUBLE * years) * {PHI_S2}), 3)), 3) AS value
FROM d GROUP BY ALL""")
def f20(spark, sf):
    spots = v.table(spark, sf, "part").select(F.col("p_partkey").alias("series"), F.col("p_retailprice").alias("spot"))
    chain = option_chain(spots, rate=0.0472, vol=0.35, moneyness=[0.8, 0.9, 1.0, 1.1, 1.2], years=[0.25, 0.5, 1.0, 2.0])
    return rounded(chain.groupBy("series", "kind").agg(F.count(F.lit(1)).alias("n"), F.sum("price").alias("value")), value=3)


@query("k1_custom_encoder", f"WITH {v.DAILY} SELECT series, ts, (CAST(year(ts) AS DOUBLE) - 1950) / 50 AS decade, CAST(day(ts) > 24 AS INTEGER)::DOUBLE AS month_end FROM daily")
def k1(spark, sf):
    encoders = {"decade": lambda t: (F.year(t) - 1950) / 50, "month_end": lambda t: (F.dayofmonth(t) > 24).cast("int")}
    return calendar.encode_times(v.daily_orders(spark, sf).select("series", "ts"), encoders)


@query("k4_custom_scaler", f"""
WITH {v.PREP}, fit AS (SELECT series, max(y) AS top FROM prep WHERE is_train GROUP BY series)
SELECT series, ts, round(y / top, 8) AS y FROM prep JOIN fit USING (series)""")
def k4(spark, sf):
    rows = splits.mark_train(v.orders_panel(spark, sf), 0.75).select("series", "ts", "y", "is_train")
    by_max = (lambda c: F.min(c) * 0, F.max)
    params = scale.fit_scaler(rows, ["y"], scaler=by_max, fit_on=F.col("is_train"))
    return rounded(scale.apply_scaler(rows, params, ["y"]).drop("is_train"), y=8)
