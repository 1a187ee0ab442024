"""Queries of metrics, model comparison, forecasters, search and leaderboards (E*, A7-A11, O3-O9, M*, K*, S11-S17)."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelloom.forecast import learned, linear, naive, quantile, registry, smoothing, spectral, state
from panelloom.functions import metrics
from panelloom.functions.timeaxis import next_steps
from panelloom.operators import ranking
from panelloom.plans import views as v
from panelloom.plans.catalog import query, rounded
from panelloom.sources import sinks

H = 90
KEYS = ["series", "window_id"]
BASIC = ["LastValue", "NaiveDrift", "SimpleSmoothing"]
# digits that are stable whatever the order of summation
DIGITS = {"MAPE": 5, "RMSE": 3, "MAE": 3, "SMAPE": 6, "MSE": -3, "RMSLE": 7, "R2": 7, "COV": 5}


def prepared(spark: SparkSession, sf: str, rolling: bool = False) -> DataFrame:
    return registry.prepare(v.orders_panel(spark, sf), validation="rolling" if rolling else None)


def demand_panel(spark: SparkSession, sf: str) -> DataFrame:
    """Intermittent demand: the daily grid, days without orders are 0."""
    return sinks.stage(registry.prepare(v.orders_grid(spark, sf).withColumn("y", F.coalesce("y", F.lit(0.0)))))


def evaluations(spark: SparkSession, sf: str, names: list[str] = BASIC, rolling: bool = True) -> DataFrame:
    p = prepared(spark, sf, rolling)
    return metrics.evaluate(registry.score(p, registry.run_models(p, names, horizon=H)), ["model", *KEYS])


METRIC_SQL = """count(*) AS n,
  CASE WHEN min(abs(y)) > 0 THEN 100 * avg(abs(y - pred) / abs(y)) END AS "MAPE",
  sqrt(avg((y - pred) ** 2)) AS "RMSE", avg(abs(y - pred)) AS "MAE",
  200 * avg(abs(y - pred) / (abs(y) + abs(pred))) AS "SMAPE", avg((y - pred) ** 2) AS "MSE",
  CASE WHEN min(least(y, pred)) > -1 THEN sqrt(avg(CASE WHEN least(y, pred) > -1 THEN (ln(1 + y) - ln(1 + pred)) ** 2 END)) END AS "RMSLE",
  1 - sum((y - pred) ** 2) / (var_pop(y) * count(*)) AS "R2", 100 * sqrt(avg((y - pred) ** 2)) / avg(y) AS "COV\""""
ROUNDED_SQL = ", ".join(f'round("{m}", {d}) AS "{m}"' for m, d in DIGITS.items())

# forecasts of the three basic models; the smoothed level is a plain recursion
BASIC_SQL = f"""WITH RECURSIVE {v.ROLLING},
tr AS MATERIALIZED (SELECT * FROM prep WHERE is_train),
ends AS (SELECT series, window_id, max(nt) AS nt, max(ts) AS last_ts, arg_max(y, idx) AS last, arg_min(y, idx) AS first FROM tr GROUP BY ALL),
ses AS (SELECT series, window_id, idx, y AS level FROM tr WHERE idx = 0
  UNION ALL SELECT t.series, t.window_id, t.idx, 0.3 * t.y + 0.7 * s.level FROM ses s JOIN tr t ON t.series = s.series AND t.window_id = s.window_id AND t.idx = s.idx + 1),
level AS (SELECT series, window_id, arg_max(level, idx) AS level FROM ses GROUP BY ALL),
preds AS (
  SELECT 'LastValue' AS model, series, window_id, step, last AS pred, last_ts FROM ends CROSS JOIN range(1, {H + 1}) t(step)
  UNION ALL SELECT 'NaiveDrift', series, window_id, step, last + step * (last - first) / (nt - 1), last_ts FROM ends CROSS JOIN range(1, {H + 1}) t(step)
  UNION ALL SELECT 'SimpleSmoothing', series, window_id, step, level, last_ts FROM level JOIN ends USING (series, window_id) CROSS JOIN range(1, {H + 1}) t(step)),
aligned AS (SELECT p.model, p.series, p.window_id, p.step, p.pred, a.y, a.ts FROM preds p JOIN prep a
  ON a.series = p.series AND a.window_id = p.window_id AND NOT a.is_train AND a.ts = p.last_ts + to_days(CAST(p.step AS INTEGER))),
evals AS (SELECT model, series, window_id, {METRIC_SQL} FROM aligned GROUP BY ALL)"""


@query("e_metrics_naive_drift", f"""
WITH {v.PREP},
fit AS (SELECT series, max(nt) AS nt, max(ts) AS last_ts, arg_max(y, idx) AS last, arg_min(y, idx) AS first FROM prep WHERE is_train GROUP BY series),
aligned AS (SELECT p.series, p.y, last + date_diff('day', last_ts, p.ts) * (last - first) / (f.nt - 1) AS pred
  FROM prep p JOIN fit f USING (series) WHERE NOT p.is_train AND date_diff('day', last_ts, p.ts) <= {H}),
e AS (SELECT series, {METRIC_SQL} FROM aligned GROUP BY series)
SELECT series, n, {ROUNDED_SQL} FROM e""")
def e_naive_drift(spark, sf):
    from panelloom.operators import scale

    p = prepared(spark, sf)
    params = scale.fit_scaler(p, ["y"], keys=KEYS, fit_on=F.col("is_train"))
    train = scale.apply_scaler(p.filter("is_train"), params, ["y"], keys=KEYS)
    pred = scale.invert_scaler(naive.drift(train, horizon=H, keys=KEYS), params, "pred", target="y", keys=KEYS)
    return rounded(metrics.evaluate(registry.score(p, pred), ["series"]), **DIGITS)


@query("e_metrics_all_models_windows", f"{BASIC_SQL} SELECT model, series, window_id, n, {ROUNDED_SQL} FROM evals")
def e_all(spark, sf):
    return rounded(evaluations(spark, sf), **DIGITS)


@query("e9_quantile_loss", f"{BASIC_SQL} SELECT model, series, " + ", ".join(
    f"round(avg(greatest({q} * (y - pred), ({q} - 1) * (y - pred))), 3) AS q{int(q * 100)}" for q in (0.1, 0.5, 0.9)) + " FROM aligned GROUP BY ALL")
def e9(spark, sf):
    p = prepared(spark, sf, True)
    losses = {f"q{int(q * 100)}": metrics.quantile_loss(q) for q in (0.1, 0.5, 0.9)}
    out = metrics.evaluate(registry.score(p, registry.run_models(p, BASIC, horizon=H)), ["model", "series"], metrics=losses)
    return rounded(out.drop("n"), **{q: 3 for q in losses})


@query("e10_e13_loss_by_name", f"""{BASIC_SQL} SELECT model, round(100 * abs(sum(y) - sum(pred)) / abs(sum(y)), 6) AS "OPE",
  round(200 * avg(abs(y - pred) / (abs(y) + abs(pred))), 6) AS "SMAPE" FROM aligned GROUP BY model""")
def e10(spark, sf):
    p = prepared(spark, sf, True)
    chosen = {metrics.loss_name(n): metrics.loss(n) for n in ("val_OPE", "val_SMAPE")}
    out = metrics.evaluate(registry.score(p, registry.run_models(p, BASIC, horizon=H)), ["model"], metrics=chosen)
    return rounded(out.drop("n"), OPE=6, SMAPE=6)


@query("a7_mean_metrics", f"""{BASIC_SQL} SELECT model, round(avg("MAPE"), 5) AS "mean_MAPE", round(avg("RMSE"), 3) AS "mean_RMSE" FROM evals GROUP BY model""")
def a7(spark, sf):
    return rounded(ranking.mean_metrics(evaluations(spark, sf), ["MAPE", "RMSE"]), mean_MAPE=5, mean_RMSE=3)


@query("a8_last_step_errors", f"""{BASIC_SQL} SELECT model, round(100 * avg(abs(y - pred) / abs(y)), 5) AS mean_mape, round(sqrt(avg((y - pred) ** 2)), 3) AS mean_rmse,
  round(100 * avg(abs(y - pred) / abs(y)) FILTER (step = {H}), 5) AS last_mape, round(sqrt(avg((y - pred) ** 2) FILTER (step = {H})), 3) AS last_rmse
FROM aligned GROUP BY model""")
def a8(spark, sf):
    p = prepared(spark, sf, True)
    out = metrics.step_errors(registry.score(p, registry.run_models(p, BASIC, horizon=H)), ["model"], horizon=H)
    return rounded(out, mean_mape=5, mean_rmse=3, last_mape=5, last_rmse=3)


@query("a11_forecast_change", f"""{BASIC_SQL} SELECT series, window_id, round(arg_min(pred, step), 2) AS first_pred, round(arg_max(pred, step), 2) AS last_pred,
  round((arg_max(pred, step) - arg_min(pred, step)) / arg_min(pred, step), 7) AS change FROM preds WHERE model = 'NaiveDrift' GROUP BY ALL""")
def a11(spark, sf):
    pred = naive.drift(prepared(spark, sf, True).filter("is_train"), horizon=H, keys=KEYS)
    return rounded(ranking.forecast_change(pred, by=KEYS), first_pred=2, last_pred=2, change=7)


def _top_sql(order: str) -> str:
    return f"""
WITH {v.SUPPLIER}, ends AS (SELECT series, arg_min(y, ts) AS first_pred, arg_max(y, ts) AS last_pred FROM supplier_days GROUP BY series),
c AS (SELECT *, (last_pred - first_pred) / first_pred AS change FROM ends)
SELECT series, first_pred, last_pred, round(change, 8) AS change FROM c ORDER BY {order}, series LIMIT 7"""


def _top(direction: int):
    def run(spark, sf):
        changes = ranking.forecast_change(v.supplier_days(spark, sf), pred="y")
        return rounded(ranking.top_changes(changes, 7, direction), change=8)

    return run


query("o3_top_rises", _top_sql("change DESC"))(_top(1))
query("o3_top_falls", _top_sql("change"))(_top(-1))
query("o3_top_moves", _top_sql("abs(change) DESC"))(_top(0))


@query("o6_compare_models", f"""{BASIC_SQL} SELECT row_number() OVER (ORDER BY "SMAPE", model, series, window_id) AS place, model, series, window_id, round("SMAPE", 6) AS "SMAPE" FROM evals""")
def o6(spark, sf):
    from panelloom.operators.blocks import rank_in_order

    table = ranking.compare_models(evaluations(spark, sf), "val_SMAPE").select("model", *KEYS, "SMAPE")
    # places are counted within ranges of the loss (whole percent, unknown last), so no task sorts all evaluations
    ranges = sinks.stage(table).withColumn("_range", F.coalesce(F.floor("SMAPE"), F.lit(1 << 40)))
    placed = rank_in_order(ranges, keys=[], blocks=["_range"], order=["SMAPE", "model", "series", "window_id"], name="place")
    return rounded(placed.select((F.col("place") + 1).cast("int").alias("place"), "model", *KEYS, "SMAPE"), SMAPE=6)


@query("o7_best_model", f"""{BASIC_SQL},
a AS (SELECT 'row' AS rule, model, "SMAPE" AS loss FROM evals ORDER BY "SMAPE", model LIMIT 1),
b AS (SELECT 'mean' AS rule, model, avg("SMAPE") AS loss FROM evals GROUP BY model ORDER BY loss, model LIMIT 1),
c AS (SELECT 'r2' AS rule, model, "R2" AS loss FROM evals ORDER BY "R2" DESC, model LIMIT 1)
SELECT rule, model, round(loss, 6) AS loss FROM (FROM a UNION ALL FROM b UNION ALL FROM c)""")
def o7(spark, sf):
    ev = sinks.stage(evaluations(spark, sf))
    parts = [("row", ranking.best_model(ev, "SMAPE")), ("mean", ranking.best_model(ev, "SMAPE", by="mean")), ("r2", ranking.best_model(ev, "R2"))]
    rows = [df.select(F.lit(name).alias("rule"), "model", "loss") for name, df in parts]
    return rounded(rows[0].unionByName(rows[1]).unionByName(rows[2]), loss=6)


@query("s11_s12_stored_predictions", f"""{BASIC_SQL}
SELECT last_ts + to_days(CAST(step AS INTEGER)) AS timestamp, round(pred, 2) AS pred, model, dense_rank() OVER (ORDER BY series) - 1 AS series_id, series AS stock_name
FROM preds WHERE model <> 'SimpleSmoothing'""")
def s11(spark, sf):
    path = sinks.scratch_dir(spark) + "/predictions"
    train = prepared(spark, sf, True).filter("is_train")
    for name in ("LastValue", "NaiveDrift"):
        forecast = registry.MODELS[name].fit_predict(train, horizon=H, keys=KEYS)
        sinks.append_results(sinks.prediction_rows(forecast, name), path)
    stored = spark.read.parquet(path)
    return rounded(stored.select("timestamp", "pred", "model", "series_id", "stock_name"), pred=2)


@query("s13_stored_parameters", f"""
WITH {v.PREP}, f AS (SELECT series, max(ts) AS last_ts, max(nt) AS nt, arg_max(y, idx) AS last, arg_min(y, idx) AS first FROM prep WHERE is_train GROUP BY series)
SELECT series, CAST(step AS INTEGER) AS step, round(last + step * (last - first) / (nt - 1), 2) AS pred FROM f CROSS JOIN range(1, {H + 1}) t(step)""")
def s13(spark, sf):
    path = sinks.scratch_dir(spark) + "/drift"
    train = prepared(spark, sf).filter("is_train")
    sinks.save_params(naive.ends(train, ["series"], first=F.min_by("y", "idx"), last=F.max_by("y", "idx")), path)
    slope = (F.col("last") - F.col("first")) / (F.col("nt") - 1)
    out = naive.unfold(spark.read.parquet(path), ["series"], H, F.col("last") + F.col("step") * slope)
    return rounded(out.select("series", "step", "pred"), pred=2)


@query("s13_state_update", f"""
WITH RECURSIVE {v.PANEL}, tr AS MATERIALIZED (SELECT series, ts, idx, n, y, lag(y) OVER (PARTITION BY series ORDER BY idx) AS x FROM panel),
f AS MATERIALIZED (SELECT series, max(ts) AS last_ts, max(n) AS n, arg_max(y, idx) AS last, arg_min(y, idx) AS first, regr_slope(y, idx) AS b, regr_intercept(y, idx) AS a,
  regr_slope(y, x) AS lb, regr_intercept(y, x) AS la FROM tr GROUP BY series),
s AS (SELECT t.series, t.idx, t.y AS level, 2 * t.y - (a + b * t.idx) AS z FROM tr t JOIN f USING (series) WHERE t.idx = 0
  UNION ALL SELECT t.series, t.idx, 0.3 * t.y + 0.7 * s.level, 0.2 * (2 * t.y - (f.a + f.b * t.idx)) + 0.8 * s.z FROM s JOIN tr t ON t.series = s.series AND t.idx = s.idx + 1 JOIN f ON f.series = t.series),
e AS (SELECT series, arg_max(level, idx) AS level, arg_max(z, idx) AS z FROM s GROUP BY series),
r AS (SELECT series, 1 AS step, la + lb * last AS pred FROM f UNION ALL SELECT r.series, step + 1, la + lb * pred FROM r JOIN f USING (series) WHERE step < {H}),
h AS (SELECT * FROM f JOIN e USING (series) CROSS JOIN range(1, {H + 1}) t(step)),
preds AS (
  SELECT 'LastValue' AS model, series, step, last AS pred FROM h
  UNION ALL SELECT 'NaiveDrift', series, step, last + step * (last - first) / (n - 1) FROM h
  UNION ALL SELECT 'SimpleSmoothing', series, step, level FROM h
  UNION ALL SELECT 'Theta', series, step, (a + b * (n - 1 + step)) / 2 + z / 2 FROM h
  UNION ALL SELECT 'OneLag', series, step, pred FROM r)
SELECT model, series, CAST(step AS INTEGER) AS step, last_ts + to_days(CAST(step AS INTEGER)) AS ts, round(pred, 2) AS pred FROM preds JOIN f USING (series)""")
def s13_state(spark, sf):
    """The state of the first rows is stored and updated twice, by rows that overlap; forecasts are those of a fit on all rows."""
    rows, path = v.orders_panel(spark, sf), sinks.scratch_dir(spark)
    known = None
    for k, (lo, hi) in enumerate(((0.0, 0.6), (0.5, 0.8), (0.8, 1.0))):
        known = state.update_state(known, rows.where((F.col("idx") >= lo * F.col("n")) & (F.col("idx") < hi * F.col("n"))))
        sinks.save_params(known, f"{path}/state{k}")
        known = spark.read.parquet(f"{path}/state{k}")
    parts = [state.predict_state(known, m, horizon=H).select(F.lit(m).alias("model"), "series", "step", "ts", "pred") for m in state.MODELS]
    return rounded(reduce(DataFrame.unionByName, parts), pred=2)


BOARD_SQL = f"""{BASIC_SQL}, board AS (
  SELECT round(avg("MAPE"), 5) AS "val_MAPE", round(avg("RMSE"), 3) AS "val_RMSE", model AS name, window_id, 'models/' || model AS ckpt_path FROM evals GROUP BY model, window_id)"""


def _board(spark, sf) -> DataFrame:
    rows = evaluations(spark, sf).groupBy("model", "window_id").agg(F.avg("MAPE").alias("val_MAPE"), F.avg("RMSE").alias("val_RMSE"))
    return rounded(rows, val_MAPE=5, val_RMSE=3).select(
        F.col("model").alias("name"), "window_id", "val_MAPE", "val_RMSE", F.concat(F.lit("models/"), F.col("model")).alias("ckpt_path"))


@query("s15_leaderboard", f"""{BOARD_SQL} SELECT "val_MAPE", "val_RMSE", name, window_id, ckpt_path, NULL::VARCHAR AS note FROM board
UNION ALL SELECT "val_MAPE", "val_RMSE", name || '-again', window_id, ckpt_path, 'second' FROM board""")
def s15(spark, sf):
    path = sinks.scratch_dir(spark) + "/leaderboard"
    board = sinks.stage(_board(spark, sf))
    first = ["val_MAPE", "val_RMSE"]
    sinks.update_leaderboard(board, path, first)
    again = board.withColumn("name", F.concat("name", F.lit("-again"))).withColumn("note", F.lit("second"))
    sinks.update_leaderboard(board.unionByName(again, allowMissingColumns=True), path, first)
    return sinks.read_leaderboard(spark, path)


@query("s16_trial_history", f"""{BOARD_SQL} SELECT "val_MAPE", "val_RMSE", name, window_id FROM board""")
def s16(spark, sf):
    path = sinks.scratch_dir(spark) + "/trials"
    trials = _board(spark, sf).drop("ckpt_path").toDF("name", "user_attrs_window_id", "user_attrs_val_MAPE", "user_attrs_val_RMSE")
    sinks.update_trials(trials, path, ["val_MAPE", "val_RMSE"])
    return sinks.read_leaderboard(spark, path)


@query("s17_a9_best_settings", f"""{BOARD_SQL} SELECT min("val_MAPE") AS loss, 1 AS n_saved FROM board""")
def s17(spark, sf):
    path = sinks.scratch_dir(spark) + "/best"
    board = sinks.stage(_board(spark, sf))
    best = ranking.best_loss(board, "val_MAPE")
    sinks.save_if_better(spark, path, {"loss_name": "val_MAPE"}, best, None)
    sinks.save_if_better(spark, path, {"loss_name": "worse"}, best + 1, best)
    return spark.read.parquet(path).agg(F.min("loss").alias("loss"), F.count(F.lit(1)).cast("int").alias("n_saved"))


@query("o8_best_checkpoint", f"""{BOARD_SQL} SELECT ckpt_path, "val_MAPE" AS loss FROM board ORDER BY "val_MAPE", ckpt_path LIMIT 1""")
def o8(spark, sf):
    return ranking.best_checkpoint(_board(spark, sf), "val_MAPE")


@query("s14_o9_latest_version", f"WITH {v.DAILY} SELECT series AS model, strftime(max(ts), '%Y%m%d') AS version FROM daily GROUP BY series")
def o9(spark, sf):
    registry_table = v.daily_orders(spark, sf).select(F.col("series").alias("model"), F.date_format("ts", "yyyyMMdd").alias("version"))
    return ranking.latest_version(registry_table, by=["model"])


def _forecast_sql(fit: str, pred: str, horizon: int = H, extra: str = "", prep: str = v.PREP) -> str:
    return f"""WITH {prep}, tr AS (SELECT * FROM prep WHERE is_train), {extra} fit AS ({fit})
SELECT series, CAST(step AS INTEGER) AS step, last_ts + to_days(CAST(step AS INTEGER)) AS ts, round({pred}, 2) AS pred FROM fit CROSS JOIN range(1, {horizon + 1}) t(step)"""


def _out(df: DataFrame, digits: int = 2) -> DataFrame:
    return rounded(df.select("series", "step", "ts", "pred"), pred=digits)


@query("m1_last_value", _forecast_sql("SELECT series, max(ts) AS last_ts, arg_max(y, idx) AS last FROM tr GROUP BY series", "last"))
def m1(spark, sf):
    return _out(naive.last_value(prepared(spark, sf).filter("is_train"), horizon=H))


@query("m2_naive_drift", _forecast_sql(
    "SELECT series, max(ts) AS last_ts, max(nt) AS nt, arg_max(y, idx) AS last, arg_min(y, idx) AS first FROM tr GROUP BY series",
    "last + step * (last - first) / (nt - 1)"))
def m2(spark, sf):
    return _out(naive.drift(prepared(spark, sf).filter("is_train"), horizon=H))


CHUNKS_SQL = f"""WITH RECURSIVE {v.PREP}, tr AS (SELECT * FROM prep WHERE is_train AND idx >= nt - 12),
c AS (SELECT series, max(ts) AS last_ts, list(y ORDER BY idx) AS path FROM tr GROUP BY series
  UNION ALL SELECT series, last_ts, path || list_resize([]::DOUBLE[], 6, {{agg}}(path[-12:])) FROM c WHERE len(path) < 12 + {{h}})
SELECT series, CAST(step AS INTEGER) AS step, last_ts + to_days(CAST(step AS INTEGER)) AS ts, round(path[12 + step], {{digits}}) AS pred
FROM c CROSS JOIN range(1, {{h}} + 1) t(step) WHERE len(path) = 12 + {{h}}"""


@query("m3_window_mean", CHUNKS_SQL.format(agg="list_avg", h=H, digits=5))
def m3(spark, sf):
    return _out(naive.window_aggregate(prepared(spark, sf).filter("is_train"), horizon=H), 5)


@query("m3_k2_custom_aggregate", CHUNKS_SQL.format(agg="list_max", h=H, digits=2))
def k2(spark, sf):
    return _out(naive.window_aggregate(prepared(spark, sf).filter("is_train"), horizon=H, agg_fn=F.array_max))


@query("m4_one_lag_regression", f"""
WITH RECURSIVE {v.PREP},
x AS (SELECT *, lag(y) OVER (PARTITION BY series ORDER BY idx) AS x FROM prep WHERE is_train),
fit AS (SELECT series, max(ts) AS last_ts, regr_slope(y, x) AS b, regr_intercept(y, x) AS a, arg_max(y, idx) AS last FROM x GROUP BY series),
r AS (SELECT series, 1 AS step, a + b * last AS pred FROM fit UNION ALL SELECT r.series, step + 1, a + b * pred FROM r JOIN fit USING (series) WHERE step < {H})
SELECT r.series, step, last_ts + to_days(step) AS ts, round(pred, 2) AS pred FROM r JOIN fit USING (series)""")
def m4_one_lag(spark, sf):
    return _out(naive.one_lag(prepared(spark, sf).filter("is_train"), horizon=H))


@query("m7_simple_smoothing", f"""
WITH RECURSIVE {v.PREP}, tr AS MATERIALIZED (SELECT * FROM prep WHERE is_train),
s AS (SELECT series, idx, y AS level FROM tr WHERE idx = 0
  UNION ALL SELECT t.series, t.idx, 0.3 * t.y + 0.7 * s.level FROM s JOIN tr t ON t.series = s.series AND t.idx = s.idx + 1),
fit AS (SELECT series, arg_max(level, idx) AS level FROM s GROUP BY series),
e AS (SELECT series, max(ts) AS last_ts FROM tr GROUP BY series)
SELECT series, CAST(step AS INTEGER) AS step, last_ts + to_days(CAST(step AS INTEGER)) AS ts, round(level, 2) AS pred FROM fit JOIN e USING (series) CROSS JOIN range(1, {H + 1}) t(step)""")
def m7(spark, sf):
    return _out(naive.smoothed(prepared(spark, sf).filter("is_train"), horizon=H, alpha=0.3))


@query("m7_smoothing_grid", f"""
WITH RECURSIVE {v.PREP}, tr AS MATERIALIZED (SELECT * FROM prep WHERE is_train),
g AS (SELECT unnest([0.1, 0.3, 0.5, 0.7, 0.9]::DOUBLE[]) AS alpha),
s AS (SELECT series, alpha, idx, y AS level, 0.0::DOUBLE AS err FROM tr CROSS JOIN g WHERE idx = 0
  UNION ALL SELECT t.series, s.alpha, t.idx, s.alpha * t.y + (1 - s.alpha) * s.level, t.y - s.level FROM s JOIN tr t ON t.series = s.series AND t.idx = s.idx + 1),
f AS (SELECT series, alpha, arg_max(level, idx) AS level, sum(err * err) AS sse FROM s GROUP BY ALL)
SELECT series, arg_min(alpha, sse) AS alpha, round(min(sse) / 1e9, 4) AS sse, round(arg_min(level, sse), 2) AS level FROM f GROUP BY series""")
def m7_grid(spark, sf):
    train = prepared(spark, sf).filter("is_train").withColumn("v", F.col("y"))
    best = smoothing.ses_on_grid(train, [0.1, 0.3, 0.5, 0.7, 0.9], keys=["series"])
    return rounded(best.withColumn("sse", F.col("sse") / 1e9), sse=4, level=2)


@query("m7_holt", f"""
WITH RECURSIVE {v.PREP}, tr AS MATERIALIZED (SELECT * FROM prep WHERE is_train),
y12 AS (SELECT series, max(y) FILTER (idx = 0) AS y1, max(y) FILTER (idx = 1) AS y2 FROM tr GROUP BY series),
s AS (SELECT series, 0::BIGINT AS idx, y1 AS l, y2 - y1 AS b FROM y12
  UNION ALL SELECT t.series, t.idx, 0.3 * t.y + 0.7 * (s.l + s.b), s.b + 0.3 * 0.1 * (t.y - s.l - s.b) FROM s JOIN tr t ON t.series = s.series AND t.idx = s.idx + 1),
f AS (SELECT series, arg_max(l, idx) AS l, arg_max(b, idx) AS b FROM s GROUP BY series),
e AS (SELECT series, max(ts) AS last_ts FROM tr GROUP BY series)
SELECT series, CAST(step AS INTEGER) AS step, last_ts + to_days(CAST(step AS INTEGER)) AS ts, round(l + step * b, 2) AS pred FROM f JOIN e USING (series) CROSS JOIN range(1, {H + 1}) t(step)""")
def m7_holt(spark, sf):
    train = prepared(spark, sf).filter("is_train")
    return _out(smoothing.exponential_smoothing(train, horizon=H, kinds=["holt"], alphas=[0.3], betas=[0.1], keys=["series"]))


KINDS = ["simple", "holt", "damped", "simple+season", "holt+season"]
CANDIDATES = ", ".join(
    f"({i}, '{c['kind']}', {c['alpha']}::DOUBLE, {c['beta']}::DOUBLE, {c['phi']}::DOUBLE, {c['gamma']}::DOUBLE, {c['k']}, {7 if '+' in c['kind'] else 1})"
    for i, c in enumerate(smoothing.candidates(KINDS)))


@query("m7_automatic_smoothing", f"""
WITH RECURSIVE {v.PREP}, tr AS MATERIALIZED (SELECT * FROM prep WHERE is_train),
cand(id, kind, alpha, beta, phi, gamma, k, per) AS (VALUES {CANDIDATES}),
head AS (SELECT series, list(y ORDER BY idx) AS h FROM tr WHERE idx < 14 GROUP BY series),
start AS (SELECT series, cand.*,
  CASE WHEN per = 7 THEN list_avg(h[1:7]) WHEN phi > 0 THEN 2 * h[1] - h[2] ELSE h[1] END AS l,
  CASE WHEN phi = 0 THEN 0.0 WHEN per = 7 THEN (list_avg(h[8:14]) - list_avg(h[1:7])) / 7 ELSE h[2] - h[1] END AS b,
  CASE WHEN per = 7 THEN [x - list_avg(h[1:7]) FOR x IN h[1:7]] ELSE [0.0::DOUBLE] END AS s FROM head CROSS JOIN cand),
r AS (SELECT series, id, alpha, beta, phi, gamma, -1::BIGINT AS idx, l, b, s, 0.0::DOUBLE AS e FROM start
  UNION ALL SELECT n.series, id, alpha, beta, phi, gamma, n.idx, l + phi * b + alpha * err, phi * b + alpha * beta * err,
    s[2:] || [s[1] + gamma * (1 - alpha) * err], err
  FROM (SELECT r.series, id, alpha, beta, phi, gamma, t.idx, l, b, s, t.y - l - phi * b - s[1] AS err FROM r JOIN tr t ON t.series = r.series AND t.idx = r.idx + 1) n),
sums AS (SELECT series, id, sum(e * e) AS sse, max(idx) + 1 AS n FROM r GROUP BY ALL),
ic AS (SELECT series, id, n, kind, alpha, phi, per, n * ln(sse / n) + 2 * k AS criterion FROM sums JOIN cand USING (id)),
best AS (SELECT * FROM ic QUALIFY row_number() OVER (PARTITION BY series ORDER BY criterion, id) = 1),
fin AS (SELECT best.*, r.l, r.b, r.s FROM best JOIN r ON r.series = best.series AND r.id = best.id AND r.idx = best.n - 1),
e AS (SELECT series, max(ts) AS last_ts FROM tr GROUP BY series)
SELECT series, 0::BIGINT AS window_id, CAST(step AS INTEGER) AS step, last_ts + to_days(CAST(step AS INTEGER)) AS ts,
  round(l + b * CASE WHEN phi = 1 THEN step WHEN phi = 0 THEN 0 ELSE phi * (1 - phi ** step) / (1 - phi) END + s[(step - 1) % per + 1], 2) AS pred,
  kind, alpha, round(criterion, 4) AS criterion
FROM fin JOIN e USING (series) CROSS JOIN range(1, {H + 1}) t(step)""")
def m7_auto(spark, sf):
    train = prepared(spark, sf).filter("is_train")
    return rounded(smoothing.exponential_smoothing(train, horizon=H, kinds=KINDS, period=7, keys=KEYS), pred=2, criterion=4)


DEMAND = v.GRID + """,
prep AS (SELECT series, ts, idx, coalesce(y, 0) AS y, CAST(floor(n * 0.75) AS BIGINT) AS nt, idx < floor(n * 0.75) AS is_train
  FROM (SELECT *, count(*) OVER (PARTITION BY series) AS n FROM grid)),
tr AS MATERIALIZED (SELECT * FROM prep WHERE is_train),
dem AS MATERIALIZED (SELECT series, y AS z, idx - coalesce(lag(idx) OVER w, -1) AS q, row_number() OVER w - 1 AS k FROM tr WHERE y <> 0 WINDOW w AS (PARTITION BY series ORDER BY idx))"""
CROSTON = f"""WITH RECURSIVE {DEMAND},
s AS (SELECT series, k, z, q::DOUBLE AS q FROM dem WHERE k = 0
  UNION ALL SELECT d.series, d.k, 0.1 * d.z + 0.9 * s.z, 0.1 * d.q + 0.9 * s.q FROM s JOIN dem d ON d.series = s.series AND d.k = s.k + 1),
f AS (SELECT series, arg_max(z, k) AS z, arg_max(q, k) AS q FROM s GROUP BY series),
p AS (SELECT series, idx, (y <> 0)::INTEGER::DOUBLE AS p FROM tr WHERE idx = 0
  UNION ALL SELECT t.series, t.idx, 0.1 * (t.y <> 0)::INTEGER + 0.9 * p.p FROM p JOIN tr t ON t.series = p.series AND t.idx = p.idx + 1),
pf AS (SELECT series, arg_max(p, idx) AS p FROM p GROUP BY series)"""


@query("m8_croston", f"""{CROSTON}
SELECT 'classic' AS version, series, round(z / q, 2) AS pred FROM f UNION ALL SELECT 'sba', series, round(0.95 * z / q, 2) FROM f
UNION ALL SELECT 'tsb', series, round(z * p, 2) FROM f JOIN pf USING (series)""")
def m8(spark, sf):
    train = demand_panel(spark, sf).filter("is_train")
    parts = [naive.croston(train, horizon=1, version=ver).select(F.lit(ver).alias("version"), "series", "pred") for ver in ("classic", "sba", "tsb")]
    return rounded(parts[0].unionByName(parts[1]).unionByName(parts[2]), pred=2)


@query("m8_croston_optimized", f"""WITH RECURSIVE {DEMAND}, g AS (SELECT unnest([0.1, 0.2, 0.3]::DOUBLE[]) AS a),
s AS (SELECT series, a, k, z, q::DOUBLE AS q, 0.0::DOUBLE AS ez, 0.0::DOUBLE AS eq FROM dem CROSS JOIN g WHERE k = 0
  UNION ALL SELECT d.series, a, d.k, a * d.z + (1 - a) * s.z, a * d.q + (1 - a) * s.q, d.z - s.z, d.q - s.q FROM s JOIN dem d ON d.series = s.series AND d.k = s.k + 1),
f AS (SELECT series, a, arg_max(z, k) AS z, arg_max(q, k) AS q, sum(ez * ez) AS sz, sum(eq * eq) AS sq FROM s GROUP BY ALL),
b AS (SELECT series, arg_min(z, sz) / arg_min(q, sq) AS pred FROM f GROUP BY series),
e AS (SELECT series, max(ts) AS last_ts FROM tr GROUP BY series)
SELECT series, CAST(step AS INTEGER) AS step, last_ts + to_days(CAST(step AS INTEGER)) AS ts, round(pred, 2) AS pred FROM b JOIN e USING (series) CROSS JOIN range(1, {H + 1}) t(step)""")
def m8_opt(spark, sf):
    return _out(naive.croston(demand_panel(spark, sf).filter("is_train"), horizon=H, version="optimized"))


@query("m9_theta", f"""
WITH RECURSIVE {v.PREP}, tr AS MATERIALIZED (SELECT * FROM prep WHERE is_train),
r AS (SELECT series, regr_slope(y, idx) AS b, regr_intercept(y, idx) AS a, max(nt) AS nt, max(ts) AS last_ts FROM tr GROUP BY series),
z AS MATERIALIZED (SELECT series, idx, 2 * y - (a + b * idx) AS z FROM tr JOIN r USING (series)),
s AS (SELECT series, idx, z AS level FROM z WHERE idx = 0
  UNION ALL SELECT z.series, z.idx, 0.2 * z.z + 0.8 * s.level FROM s JOIN z ON z.series = s.series AND z.idx = s.idx + 1),
f AS (SELECT series, arg_max(level, idx) AS level FROM s GROUP BY series)
SELECT series, CAST(step AS INTEGER) AS step, last_ts + to_days(CAST(step AS INTEGER)) AS ts, round((a + b * (nt - 1 + step)) / 2 + level / 2, 2) AS pred
FROM f JOIN r USING (series) CROSS JOIN range(1, {H + 1}) t(step)""")
def m9(spark, sf):
    return _out(naive.theta(prepared(spark, sf).filter("is_train"), horizon=H))


@query("m9_theta_seasonal", f"""
WITH RECURSIVE {v.PREP}, raw AS MATERIALIZED (SELECT * FROM prep WHERE is_train),
ph AS (SELECT series, idx % 7 AS phase, avg(y) AS m FROM raw GROUP BY ALL),
si AS MATERIALIZED (SELECT series, phase, m / avg(m) OVER (PARTITION BY series) AS s FROM ph),
tr AS MATERIALIZED (SELECT r.series, r.ts, r.idx, r.nt, r.y / si.s AS y FROM raw r JOIN si ON si.series = r.series AND si.phase = r.idx % 7),
r AS (SELECT series, regr_slope(y, idx) AS b, regr_intercept(y, idx) AS a, max(nt) AS nt, max(ts) AS last_ts FROM tr GROUP BY series),
z AS MATERIALIZED (SELECT series, idx, 2 * y - (a + b * idx) AS z FROM tr JOIN r USING (series)),
s AS (SELECT series, idx, z AS level FROM z WHERE idx = 0
  UNION ALL SELECT z.series, z.idx, 0.2 * z.z + 0.8 * s.level FROM s JOIN z ON z.series = s.series AND z.idx = s.idx + 1),
f AS (SELECT series, arg_max(level, idx) AS level FROM s GROUP BY series)
SELECT f.series, CAST(step AS INTEGER) AS step, last_ts + to_days(CAST(step AS INTEGER)) AS ts, round(((a + b * (nt - 1 + step)) / 2 + level / 2) * si.s, 2) AS pred
FROM f JOIN r USING (series) CROSS JOIN range(1, {H + 1}) t(step) JOIN si ON si.series = f.series AND si.phase = (r.nt - 1 + step) % 7""")
def m9_season(spark, sf):
    return _out(naive.theta(prepared(spark, sf).filter("is_train"), horizon=H, season=7))


ONE_DIFFERENCED_LAG = f"""
WITH RECURSIVE {v.PREP},
d AS (SELECT series, ts, idx, y, y - lag(y) OVER w AS w FROM prep WHERE is_train WINDOW w AS (PARTITION BY series ORDER BY idx)),
x AS (SELECT *, lag(w) OVER (PARTITION BY series ORDER BY idx) AS x FROM d),
fit AS (SELECT series, max(ts) AS last_ts, regr_slope(w, x) AS b, regr_intercept(w, x) AS a, arg_max(y, idx) AS last, arg_max(w, idx) AS lw FROM x GROUP BY series),
r AS (SELECT series, 1 AS step, a + b * lw AS w, last + a + b * lw AS pred FROM fit
  UNION ALL SELECT r.series, step + 1, a + b * r.w, pred + a + b * r.w FROM r JOIN fit USING (series) WHERE step < {H})
SELECT r.series, step, last_ts + to_days(step) AS ts, round(pred, 2) AS pred FROM r JOIN fit USING (series)"""


@query("m10_arima_one_lag", ONE_DIFFERENCED_LAG)
def m10_one(spark, sf):
    return _out(linear.arima(prepared(spark, sf).filter("is_train"), horizon=H, p=1, d=1))


@query("m10_arima_auto")
def m10(spark, sf):
    train = prepared(spark, sf, True).filter("is_train")
    return rounded(linear.arima(train, horizon=H, orders=[0, 1, 2, 4, 6, 8, 10, 12], differences=[0, 1], keys=KEYS), pred=2, aic=3)


@query("m10_arima_trends", f"""
WITH RECURSIVE {v.PREP},
d AS (SELECT series, ts, idx, nt, y, y - lag(y) OVER w AS w1, y - 2 * lag(y) OVER w + lag(y, 2) OVER w AS w2 FROM prep WHERE is_train WINDOW w AS (PARTITION BY series ORDER BY idx)),
x AS (SELECT *, lag(w2) OVER (PARTITION BY series ORDER BY idx) AS x2 FROM d),
f AS MATERIALIZED (SELECT series, max(ts) AS last_ts, max(nt) AS nt, arg_max(y, idx) AS last, arg_max(w1, idx) AS l1, arg_max(w2, idx) AS l2,
  sum(w2 * x2) / sum(x2 * x2) FILTER (w2 IS NOT NULL) AS b2, sum(idx * w1) / sum(idx * idx) FILTER (w1 IS NOT NULL) AS bt, regr_slope(w1, idx) AS b, regr_intercept(w1, idx) AS a FROM x GROUP BY series),
r AS (SELECT series, 0 AS step, l2 AS w, l1 AS rise, last AS n, last AS t, last AS ct FROM f
  UNION ALL SELECT r.series, step + 1, b2 * w, rise + b2 * w, n + rise + b2 * w, t + bt * (nt + step), ct + a + b * (nt + step) FROM r JOIN f USING (series) WHERE step < {H}),
u AS (UNPIVOT (SELECT series, step, n, t, ct FROM r WHERE step > 0) ON n, t, ct INTO NAME trend VALUE pred)
SELECT trend, u.series, step, last_ts + to_days(step) AS ts, round(pred, 2) AS pred FROM u JOIN f USING (series)""")
def m10_trends(spark, sf):
    """No constant on second differences, a slope, a constant and a slope."""
    train, parts = prepared(spark, sf).filter("is_train"), []
    for trend, p, d in (("n", 1, 2), ("t", 0, 1), ("ct", 0, 1)):
        parts.append(_out(linear.arima(train, horizon=H, p=p, d=d, trend=trend)).withColumn("trend", F.lit(trend)))
    return reduce(DataFrame.unionByName, parts)


@query("m10_arima_season", f"""
WITH RECURSIVE {v.PREP},
d AS (SELECT series, ts, idx, nt, y, y - lag(y) OVER (PARTITION BY series ORDER BY idx) AS w FROM prep WHERE is_train),
x AS (SELECT *, lag(w, 12) OVER (PARTITION BY series ORDER BY idx) AS x FROM d),
f AS (SELECT series, max(ts) AS last_ts, max(nt) AS nt, arg_max(y, idx) AS last, regr_slope(w, x) AS b, regr_intercept(w, x) AS a FROM x GROUP BY series),
r AS (SELECT series, idx, w FROM d WHERE idx >= nt - 12
  UNION ALL SELECT r.series, r.idx + 12, a + b * r.w FROM r JOIN f USING (series) WHERE r.idx + 12 < nt + {H})
SELECT f.series, CAST(r.idx - nt + 1 AS INTEGER) AS step, last_ts + to_days(CAST(r.idx - nt + 1 AS INTEGER)) AS ts,
  round(last + sum(r.w) OVER (PARTITION BY f.series ORDER BY r.idx), 2) AS pred FROM r JOIN f ON f.series = r.series AND r.idx >= f.nt""")
def m10_season(spark, sf):
    return _out(linear.arima(prepared(spark, sf).filter("is_train"), horizon=H, p=0, d=1, season=12, P=1))


@query("m10_auto_arima", f"""
WITH RECURSIVE {v.PREP}, tr AS (SELECT series, idx, nt, ts, y, y - lag(y) OVER w AS w1, y - 2 * lag(y) OVER w + lag(y, 2) OVER w AS w2 FROM prep WHERE is_train WINDOW w AS (PARTITION BY series ORDER BY idx)),
w AS (SELECT series, 0 AS d, idx, y AS w FROM tr UNION ALL SELECT series, 1, idx, w1 FROM tr WHERE w1 IS NOT NULL UNION ALL SELECT series, 2, idx, w2 FROM tr WHERE w2 IS NOT NULL),
c AS MATERIALIZED (SELECT *, w - avg(w) OVER (PARTITION BY series, d) AS c FROM w),
s AS (SELECT series, d, c, w, idx, sum(c) OVER (PARTITION BY series, d ORDER BY idx) AS s FROM c),
k AS (SELECT series, d, count(*) AS n, avg(w) AS m, sum(s * s) AS ss, floor(4 * (count(*) / 100) ** 0.25) AS width, arg_max(w, idx) AS lw, max_by(w, idx, 2)[2] AS lw2 FROM s GROUP BY ALL),
g AS MATERIALIZED (SELECT a.series, a.d, i, sum(a.c * b.c) AS g FROM c a CROSS JOIN range(0, 20) t(i) JOIN c b ON b.series = a.series AND b.d = a.d AND b.idx = a.idx - i GROUP BY ALL),
st AS (SELECT k.series, k.d, any_value(k.n) AS n, any_value(m) AS m, any_value(lw) AS lw, any_value(lw2) AS lw2,
  any_value(ss) / (any_value(k.n) ** 2 * sum(CASE WHEN i = 0 THEN 1 WHEN i <= width THEN 2 * (1 - i / (width + 1)) ELSE 0 END * g / n)) AS kpss,
  sum(g / n) FILTER (i = 0) AS g0, sum(g / n) FILTER (i = 1) AS g1, sum(g / n) FILTER (i = 2) AS g2 FROM k JOIN g USING (series, d) GROUP BY k.series, k.d),
ch AS (SELECT * FROM st WHERE kpss <= 0.463 OR d = 2 QUALIFY row_number() OVER (PARTITION BY series ORDER BY d) = 1),
l AS (SELECT *, g1 / g0 AS k1, (g2 - g1 / g0 * g1) / (g0 * (1 - (g1 / g0) ** 2)) AS k2 FROM ch),
a AS (SELECT *, n * ln(g0) + 2 * (1 + d) AS a0, n * ln(g0 * (1 - k1 ** 2)) + 2 * (2 + d) AS a1, n * ln(g0 * (1 - k1 ** 2) * (1 - k2 ** 2)) + 2 * (3 + d) AS a2 FROM l),
o AS MATERIALIZED (SELECT *, CASE WHEN a0 <= a1 AND a0 <= a2 THEN 0 WHEN a1 <= a2 THEN 1 ELSE 2 END AS p FROM a),
f AS MATERIALIZED (SELECT *, CASE p WHEN 0 THEN 0 WHEN 1 THEN k1 ELSE k1 - k2 * k1 END AS f1, CASE p WHEN 2 THEN k2 ELSE 0 END AS f2 FROM o),
e AS (SELECT series, max(ts) AS last_ts, arg_max(y, idx) AS last, arg_max(w1, idx) AS rise FROM tr GROUP BY series),
r AS (SELECT f.series, 0 AS step, lw, lw2, last AS pred, rise FROM f JOIN e USING (series)
  UNION ALL SELECT series, step + 1, nw, lw, pred + CASE d WHEN 0 THEN nw - pred WHEN 1 THEN nw ELSE rise + nw END, CASE d WHEN 0 THEN nw - pred WHEN 1 THEN nw ELSE rise + nw END
    FROM (SELECT r.*, f.d, f.m + f.f1 * (r.lw - f.m) + f.f2 * (r.lw2 - f.m) AS nw FROM r JOIN f USING (series) WHERE r.step < {H}))
SELECT r.series, step, last_ts + to_days(step) AS ts, round(pred, 2) AS pred, p, d, round(kpss, 8) AS kpss, round(CASE p WHEN 0 THEN a0 WHEN 1 THEN a1 ELSE a2 END, 4) AS aic
FROM r JOIN f USING (series) JOIN e USING (series) WHERE step > 0""")
def m10_automatic(spark, sf):
    """Differences by the KPSS statistic, orders up to two by the recursion over orders."""
    return rounded(linear.auto_arima(prepared(spark, sf).filter("is_train"), horizon=H, max_p=2), pred=2, kpss=8, aic=4)


@query("m10_auto_arima_season")
def m10_automatic_season(spark, sf):
    return rounded(linear.auto_arima(prepared(spark, sf, True).filter("is_train"), horizon=H, season=12, keys=KEYS), pred=2, kpss=8, aic=4)


@query("m11_varima_one_component", ONE_DIFFERENCED_LAG)
def m11_one(spark, sf):
    return _out(linear.varima(prepared(spark, sf).filter("is_train"), horizon=H, cols=["y"], p=1, d=1))


@query("m11_varima")
def m11(spark, sf):
    train = prepared(spark, sf).filter("is_train")
    return _out(linear.varima(train, horizon=H, cols=["y", "n_orders"], p=6, d=1))


@query("m12_strongest_frequencies", f"""
WITH {v.PREP}, tr AS (SELECT * FROM prep WHERE is_train),
s AS (SELECT series, k, max(nt) AS nt, max(ts) AS last_ts, sum(y * cos(2 * pi() * ((k * idx) % nt) / nt)) AS re, sum(y * sin(2 * pi() * ((k * idx) % nt) / nt)) AS im
  FROM tr JOIN range(0, 100000) f(k) ON k <= nt // 2 GROUP BY series, k),
top AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY series ORDER BY sqrt(re * re + im * im) DESC, k) <= 10)
SELECT series, CAST(step AS INTEGER) AS step, last_ts + to_days(CAST(step AS INTEGER)) AS ts,
  round(sum(CASE WHEN k = 0 OR 2 * k = nt THEN 1 ELSE 2 END * (re * cos(2 * pi() * ((k * (nt - 1 + step)) % nt) / nt) + im * sin(2 * pi() * ((k * (nt - 1 + step)) % nt) / nt)) / nt), 2) AS pred
FROM top CROSS JOIN range(1, {H + 1}) t(step) GROUP BY series, step, last_ts""")
def m12(spark, sf):
    return _out(spectral.fft(prepared(spark, sf).filter("is_train"), horizon=H))


@query("m12_fft_with_trend", f"""
WITH {v.PREP}, raw AS (SELECT * FROM prep WHERE is_train),
line AS (SELECT series, regr_slope(y, idx) AS b, regr_intercept(y, idx) AS a FROM raw GROUP BY series),
tr AS (SELECT raw.series, ts, idx, nt, y - a - b * idx AS y FROM raw JOIN line USING (series)),
s AS (SELECT series, k, max(nt) AS nt, max(ts) AS last_ts, sum(y * cos(2 * pi() * ((k * idx) % nt) / nt)) AS re, sum(y * sin(2 * pi() * ((k * idx) % nt) / nt)) AS im
  FROM tr JOIN range(0, 100000) f(k) ON k <= nt // 2 GROUP BY series, k),
top AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY series ORDER BY sqrt(re * re + im * im) DESC, k) <= 10)
SELECT series, CAST(step AS INTEGER) AS step, last_ts + to_days(CAST(step AS INTEGER)) AS ts,
  round(max(a + b * (nt - 1 + step)) + sum(CASE WHEN k = 0 OR 2 * k = nt THEN 1 ELSE 2 END * (re * cos(2 * pi() * ((k * (nt - 1 + step)) % nt) / nt) + im * sin(2 * pi() * ((k * (nt - 1 + step)) % nt) / nt)) / nt), 2) AS pred
FROM top JOIN line USING (series) CROSS JOIN range(1, {H + 1}) t(step) GROUP BY series, step, last_ts""")
def m12_trend(spark, sf):
    return _out(spectral.fft(prepared(spark, sf).filter("is_train"), horizon=H, trend="poly", degree=1))


@query("m13_trend_seasons_holidays")
def m13(spark, sf):
    return _out(linear.structural(prepared(spark, sf).filter("is_train"), horizon=H))


@query("m13_log_seasons")
def m13_log(spark, sf):
    train = prepared(spark, sf).filter("is_train")
    return _out(linear.structural(train, horizon=H, periods={12.0: 3, 52.0: 3}, holidays=False, transform="log", floor=0.0))


@query("m13_box_cox_trend", f"""
WITH {v.PREP}, tr AS (SELECT *, idx / 365.0 AS x FROM prep WHERE is_train),
powers AS (SELECT unnest([{", ".join(map(str, linear.LAMBDAS))}]) AS lam),
z AS (SELECT series, lam, x, y, CASE WHEN lam = 0 THEN ln(y) ELSE CAST(y AS DOUBLE) ** lam END AS z FROM tr CROSS JOIN powers),
fit AS (SELECT series, CAST(lam AS DOUBLE) AS lam, regr_intercept(z, x) AS a, regr_slope(z, x) AS b, count(*) AS m, sum(ln(y)) AS logs,
  (regr_syy(z, x) - regr_slope(z, x) ** 2 * regr_sxx(z, x)) / CASE WHEN lam = 0 THEN 1 ELSE lam ** 2 END AS sse FROM z GROUP BY series, lam),
best AS (SELECT * FROM fit QUALIFY row_number() OVER (PARTITION BY series ORDER BY -m / 2.0 * ln(sse / m) + (lam - 1) * logs DESC) = 1),
e AS (SELECT series, max(nt) AS nt, max(ts) AS last_ts FROM tr GROUP BY series),
p AS (SELECT *, a + b * (nt - 1 + step) / 365.0 AS p FROM best JOIN e USING (series) CROSS JOIN range(1, {H + 1}) t(step))
SELECT series, CAST(step AS INTEGER) AS step, last_ts + to_days(CAST(step AS INTEGER)) AS ts, round(CASE WHEN lam = 0 THEN exp(p) ELSE p ** (1 / lam) END, 2) AS pred FROM p""")
def m13_box_cox(spark, sf):
    """Trend of the likeliest power of each series; with a constant and a slope only, SQL has the same regressions."""
    train = prepared(spark, sf).filter("is_train")
    return _out(linear.structural(train, horizon=H, periods={}, holidays=False, ridge=0.0, transform="boxcox"))


@query("m13_box_cox_seasons")
def m13_box_cox_seasons(spark, sf):
    train = prepared(spark, sf).filter("is_train")
    return _out(linear.structural(train, horizon=H, periods={7.0: 3, 365.25: 5}, transform="boxcox", floor=0.0))


@query("m14_nlinear_one_input", f"""
WITH {v.PREP}, tr AS (SELECT * FROM prep WHERE is_train),
x AS (SELECT series, idx, lag(y) OVER (PARTITION BY series ORDER BY idx) AS base FROM tr QUALIFY idx >= 1 AND idx <= nt - 6),
m AS (SELECT step, avg(t.y - x.base) AS rise FROM x CROSS JOIN range(1, 7) s(step) JOIN tr t ON t.series = x.series AND t.idx = x.idx + step - 1 GROUP BY step),
e AS (SELECT series, max(ts) AS last_ts, arg_max(y, idx) AS last FROM tr GROUP BY series)
SELECT series, CAST(step AS INTEGER) AS step, last_ts + to_days(CAST(step AS INTEGER)) AS ts, round(last + rise, 2) AS pred FROM e CROSS JOIN m""")
def m14_one(spark, sf):
    train = prepared(spark, sf).filter("is_train")
    return _out(linear.chunk_linear(train, horizon=6, kind="nlinear", input_len=1, output_len=6))


@query("m14_nlinear")
def m14(spark, sf):
    return _out(linear.chunk_linear(prepared(spark, sf).filter("is_train"), horizon=H, kind="nlinear"))


@query("m15_dlinear")
def m15(spark, sf):
    return _out(linear.chunk_linear(prepared(spark, sf).filter("is_train"), horizon=H, kind="dlinear"))


@query("m16_local_level", f"""
WITH RECURSIVE {v.PREP}, tr AS MATERIALIZED (SELECT * FROM prep WHERE is_train),
s AS (SELECT series, idx, y * (1e6 / (1e6 + 1)) AS m, (1 - 1e6 / (1e6 + 1)) * 1e6 AS p FROM tr WHERE idx = 0
  UNION ALL SELECT t.series, t.idx, s.m + (s.p + 0.1) / (s.p + 1.1) * (t.y - s.m), (1 - (s.p + 0.1) / (s.p + 1.1)) * (s.p + 0.1) FROM s JOIN tr t ON t.series = s.series AND t.idx = s.idx + 1),
f AS (SELECT series, arg_max(m, idx) AS m FROM s GROUP BY series), e AS (SELECT series, max(ts) AS last_ts FROM tr GROUP BY series)
SELECT series, CAST(step AS INTEGER) AS step, last_ts + to_days(CAST(step AS INTEGER)) AS ts, round(m, 2) AS pred FROM f JOIN e USING (series) CROSS JOIN range(1, {H + 1}) t(step)""")
def m16(spark, sf):
    return _out(naive.local_level(prepared(spark, sf).filter("is_train"), horizon=H))


QS = [0.1, 0.25, 0.5, 0.75, 0.9]


@query("m17_quantile_forecast", f"""{BASIC_SQL},
err AS (SELECT series, step, y - pred AS e FROM aligned WHERE model = 'LastValue'),
q AS (SELECT series, step, unnest([0.1, 0.25, 0.5, 0.75, 0.9]::DOUBLE[]) AS q, unnest(quantile_cont(e, [0.1, 0.25, 0.5, 0.75, 0.9]::DOUBLE[])) AS off FROM err GROUP BY series, step),
last AS (SELECT series, arg_max(y, idx) AS last FROM panel GROUP BY series)
SELECT series, CAST(step AS INTEGER) AS step, q, round(last + off, 4) AS pred FROM q JOIN last USING (series)""")
def m17(spark, sf):
    p = prepared(spark, sf, True)
    aligned = registry.score(p, naive.last_value(p.filter("is_train"), horizon=H, keys=KEYS))
    errors = sinks.stage(aligned.select("series", "step", (F.col("y") - F.col("pred")).alias("err")))
    point = naive.last_value(v.orders_panel(spark, sf).withColumn("nt", F.col("n")), horizon=H)
    return rounded(registry.quantile_forecast(point, errors, QS).select("series", "step", "q", "pred"), pred=4)


@query("m17_exact_quantiles", """
SELECT l_returnflag AS series, unnest([0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99]::DOUBLE[]) AS q,
  round(unnest(quantile_cont(l_extendedprice, [0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99]::DOUBLE[])), 4) AS price FROM lineitem GROUP BY l_returnflag""")
def m17_exact(spark, sf):
    from panelloom.operators.quantiles import exact_quantiles

    rows = v.table(spark, sf, "lineitem").select(F.col("l_returnflag").alias("series"), F.col("l_extendedprice").alias("price"))
    return rounded(exact_quantiles(rows, [0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99], keys=["series"], value="price"), price=4)


CHANGE_QUANTILES = ", ".join(map(repr, registry.QUANTILES))


@query("m17_fitted_intercepts", f"""
WITH {v.PREP}, tr AS (SELECT * FROM prep WHERE is_train),
x AS (SELECT a.series, CAST(step AS INTEGER) AS step, b.y - a.y AS rise FROM tr a CROSS JOIN range(1, 7) t(step) JOIN tr b ON b.series = a.series AND b.idx = a.idx + step WHERE a.idx + 6 < a.nt),
s AS (SELECT step, q, rise, row_number() OVER (PARTITION BY step, q ORDER BY rise) AS r, count(*) OVER (PARTITION BY step, q) AS n FROM x CROSS JOIN (SELECT unnest([{CHANGE_QUANTILES}]::DOUBLE[]) AS q)),
c AS (SELECT step, q, rise FROM s WHERE r = greatest(1, n - floor(n - q * n))),
e AS (SELECT series, max(ts) AS last_ts, arg_max(y, idx) AS last FROM tr GROUP BY series)
SELECT series, step, last_ts + to_days(step) AS ts, q, round(last + rise, 2) AS pred FROM e CROSS JOIN c""")
def m17_intercepts(spark, sf):
    """With the last value as the only input, fitted quantiles are exact order statistics of the changes."""
    return rounded(quantile.quantile_linear(prepared(spark, sf).filter("is_train"), registry.QUANTILES, horizon=6, input_len=1), pred=2)


@query("m17_fitted_quantiles")
def m17_fitted(spark, sf):
    return rounded(quantile.quantile_linear(prepared(spark, sf).filter("is_train"), registry.QUANTILES, horizon=6, input_len=12), pred=2)


@query("p15_capability_filter", f"""
WITH RECURSIVE {v.PREP}, tr AS MATERIALIZED (SELECT * FROM prep WHERE is_train),
ends AS MATERIALIZED (SELECT series, max(nt) AS nt, max(ts) AS last_ts, arg_max(y, idx) AS last, arg_min(y, idx) AS first FROM tr GROUP BY series),
lagged AS (SELECT y, n_orders AS x2, lag(y) OVER (PARTITION BY series ORDER BY idx) AS x1 FROM tr),
s AS (SELECT covar_pop(x1, x1) AS s11, covar_pop(x2, x2) AS s22, covar_pop(x1, x2) AS s12, covar_pop(x1, y) AS s1y, covar_pop(x2, y) AS s2y,
  avg(x1) AS m1, avg(x2) AS m2, avg(y) AS my FROM lagged WHERE x1 IS NOT NULL),
b AS MATERIALIZED (SELECT b1, b2, my - b1 * m1 - b2 * m2 AS a FROM (SELECT *, (s22 * s1y - s12 * s2y) / (s11 * s22 - s12 * s12) AS b1, (s11 * s2y - s12 * s1y) / (s11 * s22 - s12 * s12) AS b2 FROM s)),
rec AS (SELECT series, 0 AS step, last AS pred FROM ends
  UNION ALL SELECT r.series, r.step + 1, b.a + b.b1 * r.pred + b.b2 * p.n_orders FROM rec r JOIN ends e USING (series) JOIN prep p ON p.series = r.series AND p.idx = e.nt + r.step CROSS JOIN b WHERE r.step < {H}),
preds AS (SELECT 'LinearRegression' AS model, series, step, pred FROM rec WHERE step > 0
  UNION ALL SELECT 'NaiveDrift', series, step, last + step * (last - first) / (nt - 1) FROM ends CROSS JOIN range(1, {H + 1}) t(step))
SELECT model, series, CAST(step AS INTEGER) AS step, last_ts + to_days(CAST(step AS INTEGER)) AS ts, round(pred, 2) AS pred FROM preds JOIN ends USING (series)""")
def p15(spark, sf):
    """The number of orders is planned, so it is known ahead: a univariate model does without, a linear one takes it."""
    exact = {"LinearRegression": {"input_len": 1, "output_len": 1, "ridge": 0.0}}
    pred = registry.run_models(prepared(spark, sf), ["NaiveDrift", "LinearRegression"], horizon=H, overrides=exact, future=["n_orders"])
    return rounded(pred.select("model", "series", "step", "ts", "pred"), pred=2)


@query("m18_kalman_with_known_ahead", f"""
WITH RECURSIVE {v.PREP}, tr AS MATERIALIZED (SELECT * FROM prep WHERE is_train),
b AS MATERIALIZED (SELECT series, regr_slope(y, n_orders) AS b FROM tr GROUP BY series),
r AS MATERIALIZED (SELECT tr.series, idx, y - b * n_orders AS e FROM tr JOIN b USING (series)),
s AS (SELECT series, idx, e * (1e6 / (1e6 + 1)) AS m, (1 - 1e6 / (1e6 + 1)) * 1e6 AS p FROM r WHERE idx = 0
  UNION ALL SELECT t.series, t.idx, s.m + (s.p + 0.1) / (s.p + 1.1) * (t.e - s.m), (1 - (s.p + 0.1) / (s.p + 1.1)) * (s.p + 0.1) FROM s JOIN r t ON t.series = s.series AND t.idx = s.idx + 1),
f AS (SELECT series, arg_max(m, idx) AS m FROM s GROUP BY series), e AS (SELECT series, max(ts) AS last_ts, max(nt) AS nt FROM tr GROUP BY series)
SELECT series, CAST(p.idx - e.nt + 1 AS INTEGER) AS step, p.ts, round(m + b * p.n_orders, 2) AS pred FROM f JOIN e USING (series) JOIN b USING (series) JOIN prep p USING (series) WHERE p.idx >= e.nt AND p.idx < e.nt + {H}""")
def m18_kalman(spark, sf):
    pred = registry.run_models(prepared(spark, sf), ["Kalman"], horizon=H, future=["n_orders"])
    return rounded(pred.select("series", "step", "ts", "pred"), pred=2)


@query("m18_all_formula_models")
def m18(spark, sf):
    p = prepared(spark, sf)
    ev = metrics.evaluate(registry.score(p, registry.run_models(p, list(registry.MODELS), horizon=H)), ["model", "series"])
    return rounded(ev, **DIGITS)


@query("m19_smoothing_search", f"""
WITH RECURSIVE {v.ROLLING}, tr AS MATERIALIZED (SELECT * FROM prep WHERE is_train),
g AS (SELECT unnest([0.05, 0.1, 0.2, 0.4, 0.8]::DOUBLE[]) AS alpha),
s AS (SELECT series, window_id, alpha, idx, y AS level FROM tr CROSS JOIN g WHERE idx = 0
  UNION ALL SELECT t.series, t.window_id, s.alpha, t.idx, s.alpha * t.y + (1 - s.alpha) * s.level FROM s JOIN tr t ON t.series = s.series AND t.window_id = s.window_id AND t.idx = s.idx + 1),
f AS (SELECT series, window_id, alpha, arg_max(level, idx) AS level FROM s GROUP BY ALL),
m AS (SELECT f.alpha, f.series, f.window_id, 100 * avg(abs(p.y - f.level) / abs(p.y)) AS mape FROM f JOIN prep p
  ON p.series = f.series AND p.window_id = f.window_id AND p.idx >= p.nt AND p.idx < p.nt + {H} GROUP BY ALL)
SELECT alpha, round(avg(mape), 5) AS "MAPE" FROM m GROUP BY alpha""")
def m19(spark, sf):
    return rounded(registry.search_smoothing(prepared(spark, sf, True), [0.05, 0.1, 0.2, 0.4, 0.8], horizon=H), MAPE=5)


TRIALS = registry.draw({"theta_": [1.5, 3.0], "alpha": [0.05, 0.5]}, 4)


def _theta_search_sql(trials: list[dict]) -> str:
    """Losses of Theta parameter sets, the smoothed line as a plain recursion."""
    return f"""
WITH RECURSIVE {v.ROLLING}, tr AS MATERIALIZED (SELECT * FROM prep WHERE is_train),
p(trial, alpha, theta) AS (VALUES {", ".join(f"({i}, {t['alpha']!r}::DOUBLE, {t['theta_']!r}::DOUBLE)" for i, t in enumerate(trials))}),
r AS (SELECT series, window_id, regr_slope(y, idx) AS b, regr_intercept(y, idx) AS a, max(nt) AS nt FROM tr GROUP BY ALL),
z AS MATERIALIZED (SELECT trial, series, window_id, idx, alpha, theta * y + (1 - theta) * (a + b * idx) AS z FROM tr JOIN r USING (series, window_id) CROSS JOIN p),
s AS (SELECT trial, series, window_id, idx, z AS level FROM z WHERE idx = 0
  UNION ALL SELECT z.trial, z.series, z.window_id, z.idx, alpha * z.z + (1 - alpha) * s.level FROM s
  JOIN z ON z.trial = s.trial AND z.series = s.series AND z.window_id = s.window_id AND z.idx = s.idx + 1),
f AS (SELECT trial, series, window_id, arg_max(level, idx) AS level FROM s GROUP BY ALL),
m AS (SELECT trial, f.series, f.window_id, 100 * avg(abs(x.y - ((1 - 1 / theta) * (a + b * x.idx) + level / theta)) / abs(x.y)) AS mape
  FROM f JOIN r USING (series, window_id) JOIN p USING (trial) JOIN prep x
  ON x.series = f.series AND x.window_id = f.window_id AND x.idx >= r.nt AND x.idx < r.nt + {H} GROUP BY ALL),
l AS (SELECT trial, avg(mape) AS loss FROM m GROUP BY trial)
SELECT trial, round(loss, 5) AS loss, round(min(loss) OVER (ORDER BY trial), 5) AS best_so_far FROM l"""


@query("m19_m20_m21_trials", _theta_search_sql(TRIALS))
def m21(spark, sf):
    scored = registry.search(prepared(spark, sf, True), "Theta", TRIALS, horizon=H)
    return rounded(ranking.trial_history(scored).drop("params"), loss=5, best_so_far=5)


MANY_TRIALS = registry.draw({"theta_": [1.5, 3.0], "alpha": [0.05, 0.5]}, 50)


@query("m19_fifty_trials", _theta_search_sql(MANY_TRIALS))
def m19_fifty(spark, sf):
    """Fifty parameter sets as rows of one plan."""
    scored = registry.search(prepared(spark, sf, True), "Theta", MANY_TRIALS, horizon=H)
    return rounded(ranking.trial_history(scored).drop("params"), loss=5, best_so_far=5)


@query("m19_halving")
def m19_halving(spark, sf):
    return rounded(registry.halving(prepared(spark, sf, True), "Theta", MANY_TRIALS, horizon=H), loss=5)


def _learned(estimator_name: str, **params):
    def run(spark, sf):
        p = prepared(spark, sf).withColumn("month", F.month("ts").cast("double"))
        est = learned.regressor(estimator_name, **params)
        out, _ = learned.direct(p, est, lags=6, past={"n_orders": 3}, future={"month": (0, 1)}, output_len=2)
        return _out(out)

    return run


def _one_lag(estimator):
    def run(spark, sf):
        out, _ = learned.direct(prepared(spark, sf), estimator(), lags=1, output_len=1)
        return _out(out)

    return run


def _pooled_sql(pred: str) -> str:
    """One step ahead from one lag, fitted over all series together."""
    return f"""
WITH {v.PREP}, x AS (SELECT series, ts, idx, y, lead(y) OVER (PARTITION BY series ORDER BY idx) AS target FROM prep WHERE is_train),
fit AS (SELECT regr_slope(target, y) AS b, regr_intercept(target, y) AS a, avg(target) AS m FROM x),
e AS (SELECT series, max(ts) AS last_ts, arg_max(y, idx) AS last FROM x GROUP BY series)
SELECT series, 1 AS step, last_ts + INTERVAL 1 DAY AS ts, round({pred}, 2) AS pred FROM e CROSS JOIN fit"""


def _gaussian():
    from pyspark.ml.regression import GeneralizedLinearRegression

    return GeneralizedLinearRegression(family="gaussian", link="identity")


@query("s13_s14_stored_model", _pooled_sql("a + b * last"))
def s13_s14(spark, sf):
    """Two versions are fitted, stored and registered; the latest is loaded again and predicts."""
    p, base = prepared(spark, sf), sinks.scratch_dir(spark)
    for version, estimator in (("20240102", learned.regressor("boosted_trees", maxIter=1, maxDepth=0)), ("20240301", learned.regressor("linear"))):
        _, models = learned.direct(p, estimator, lags=1, output_len=1)
        sinks.save_fitted(models[0], f"{base}/model/{version}")
        sinks.register_model(spark, f"{base}/registry", "orders", "one_lag", f"{base}/model/{version}", f"{base}/settings", version)
    entries, keys = spark.read.parquet(f"{base}/registry"), ["dataset", "model"]
    latest = entries.join(ranking.latest_version(entries, by=keys), [*keys, "version"]).first()
    table, features = learned.lag_table(p, lags=1)
    origin = VectorAssembler(inputCols=features, outputCol="features").transform(table.filter(F.col("idx") == F.col("nt") - 1))
    pred = sinks.load_fitted(spark, latest.model_path).transform(origin)
    return _out(pred.select("series", F.lit(1).alias("step"), next_steps(F.col("ts"), F.lit(1)).alias("ts"), F.col("prediction").alias("pred")))


query("m4_linear_on_one_lag", _pooled_sql("a + b * last"))(_one_lag(lambda: learned.regressor("linear")))
query("k3_custom_estimator_on_one_lag", _pooled_sql("a + b * last"))(_one_lag(_gaussian))
query("m6_boosted_trees_without_splits", _pooled_sql("m"))(_one_lag(lambda: learned.regressor("boosted_trees", maxIter=1, maxDepth=0)))
query("m4_linear_on_lags")(_learned("linear"))
query("m5_random_forest_on_lags")(_learned("random_forest", numTrees=20, maxDepth=5))
query("m6_boosted_trees_on_lags")(_learned("boosted_trees", maxIter=5, maxDepth=3))


@query("m22_feature_importance")
def m22(spark, sf):
    p = prepared(spark, sf)
    est = learned.regressor("random_forest", numTrees=10, maxDepth=5)
    _, models = learned.direct(p, est, lags=6, output_len=1)
    names = [f"f_y_{i}" for i in range(6)]
    return rounded(learned.importance(models, names, spark), weight=6)


@query("k3_custom_estimator")
def k3(spark, sf):
    from pyspark.ml.regression import GeneralizedLinearRegression

    out, _ = learned.direct(prepared(spark, sf), GeneralizedLinearRegression(family="gaussian", link="identity"), lags=4, output_len=1)
    return _out(out)


@query("k5_registered_model", f"""
WITH {v.PREP}, m AS (SELECT series, max(ts) AS last_ts, median(y) AS pred FROM prep WHERE is_train GROUP BY series)
SELECT 'Median' AS model, m.series, round(200 * avg(abs(p.y - m.pred) / (abs(p.y) + abs(m.pred))), 6) AS "SMAPE"
FROM prep p JOIN m USING (series) WHERE p.ts > m.last_ts AND p.ts <= m.last_ts + INTERVAL {H} DAY GROUP BY m.series""")
def k5(spark, sf):
    from panelloom.operators.quantiles import exact_quantiles

    def median(train, *, horizon, keys, y="y", freq="D"):
        mid = exact_quantiles(train, [0.5], keys=keys, value=y).select(*keys, F.col(y).alias("mid"))
        return naive.unfold(naive.ends(train, keys).join(mid, keys), keys, horizon, F.col("mid"), freq=freq)

    registry.MODELS["Median"] = registry.Forecaster(median)
    try:
        p = prepared(spark, sf)
        ev = metrics.evaluate(registry.score(p, registry.run_models(p, ["Median"], horizon=H)), ["model", "series"], metrics={"SMAPE": metrics.smape})
    finally:
        del registry.MODELS["Median"]
    return rounded(ev.drop("n"), SMAPE=6)
