"""Small cases worked out by hand."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from panelloom.forecast import naive
from panelloom.functions import calendar, metrics, options
from panelloom.functions.timeaxis import HOUR, epoch_seconds, floor_to, next_steps
from panelloom.operators import align, blocks, clean, features, ranking, scale, splits
from tests.helpers import START, by_series, panel


def values(df, col="y"):
    return by_series(df, col)["s"]


def test_fill_demo(spark):
    data = {"A": [2, None, 3, None], "B": [None, 4, None, 3], "C": [None] * 4, "D": [0, 1, None, 4]}
    got = by_series(blocks.fill(panel(spark, data), ["y"], forward=None), "y")
    assert got == {"A": [2, 2, 3, 3], "B": [None, 4, 4, 3], "C": [None] * 4, "D": [0, 1, 1, 4]}


def test_fill_limits(spark):
    df = panel(spark, {"s": [1, None, None, 4]})
    assert values(blocks.fill(df, ["y"], forward=1)) == [1, 1, None, 4]
    assert values(blocks.fill(df, ["y"], backward=1)) == [1, None, 4, 4]


def test_percent_change(spark):
    assert values(features.percent_change(panel(spark, {"s": [1, None, 2]}), ["y"]), "y (%)") == [None, 0, 100]


def test_back_from_percent_change(spark):
    history = panel(spark, {"s": [90, 100]}).select("series", "ts", "y")
    changes = panel(spark, {"s": [0, 0, 10, -50]}).select("series", "ts", F.col("y").alias("y (%)"))
    out = features.from_percent_change(changes, history, ["y"])
    assert by_series(out, "y", "ts")["s"] == pytest.approx([90, 100, 110, 55])


def test_percent_round_trip(spark):
    data = {"s": [10, 12, 9, 9.5, 11, 30], "t": [3, 2, 1, 4, 4, 8]}
    df = panel(spark, data).select("series", "ts", "y")
    history = df.filter(F.col("ts") <= F.lit(START + dt.timedelta(days=1)))
    out = features.from_percent_change(features.percent_change(df, ["y"]), history, ["y"])
    for s, got in by_series(out, "y", "ts").items():
        assert got == pytest.approx(data[s])


def test_split_rows(spark):
    df = panel(spark, {"s": range(10)})
    assert splits.mark_train(df, 0.75).filter("is_train").count() == 7
    assert splits.mark_train(df, 3).filter("is_train").count() == 7


@pytest.mark.parametrize("n, size, windows", [(2405, 504, 4), (600, 504, 1)])
def test_rolling_windows(spark, n, size, windows):
    rows = splits.rolling_windows(panel(spark, {"s": range(n)}), 5).collect()
    assert len(rows) == size * windows
    assert {r.window_id for r in rows} == set(range(windows)) and {r.wn for r in rows} == {size}
    assert sorted(r.idx for r in rows) == list(range(size * windows))  # disjoint and without holes


def test_window_size():
    assert splits.window_rows(365, 90, 0.75) == 2072


def test_overlapping_windows(spark):
    rows = splits.overlapping_windows(panel(spark, {"s": range(25), "short": range(5)}), 10, 4).collect()
    starts = sorted({(r.window_id, r.idx - r.widx) for r in rows})
    assert starts == [(0, 0), (1, 5), (2, 10), (3, 15)]
    assert len(rows) == 40 and {r.series for r in rows} == {"s"}


def test_cutoff_time(spark):
    df = panel(spark, {"s": range(10), "t": range(10)})
    # 20 rows, two per day: position 15 lies on day 7
    assert splits.cutoff_time(df, 0.75, width=86400 * 3).first()[0] == START + dt.timedelta(days=7)


def test_samples_cover_starts(spark):
    rows = splits.samples(panel(spark, {"s": range(30)}), encoder=6, horizon=3, min_horizon=3).collect()
    assert {r.start_idx for r in rows} == set(range(3, 28))
    for r in rows:
        assert [e.idx for e in r.enc] == list(range(max(r.start_idx - 6, 0), r.start_idx))
        assert [e.idx for e in r.dec] == list(range(r.start_idx, r.start_idx + 3))
    thin = splits.samples(panel(spark, {"s": range(30)}), encoder=6, horizon=3, min_horizon=3, stride=4)
    assert {r.start_idx for r in thin.collect()} == {4, 8, 12, 16, 20, 24}


def test_corr_of_constant_is_null(spark):
    df = spark.createDataFrame([(1.0, 5.0), (4.0, 5.0), (2.0, 5.0), (0.5, 5.0)], "x double, y double")
    assert features.corr_with_target(df, "y").first().r is None
    assert features.weak_columns(df, target="y", thresh=0.5) == []


def test_corr_is_pairwise_complete(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 4.0), (None, 100.0), (3.0, 6.0), (9.0, None)], "x double, y double")
    assert features.corr_with_target(df, "y").first().r == pytest.approx(1.0)


def test_corr_matrix_matches_pandas(spark):
    import numpy as np
    import pandas as pd

    rng = np.random.default_rng(3)
    pdf = pd.DataFrame(rng.normal(1e6, 1, (300, 5)), columns=list("abcde"))
    pdf["b"] = pdf["a"] * 2 + rng.normal(0, 1, 300)
    pdf["e"] = 7.7
    pdf = pdf.mask(rng.random(pdf.shape) < 0.2)
    df = spark.createDataFrame([[None if np.isnan(v) else float(v) for v in row] for row in pdf.to_numpy()], "a double, b double, c double, d double, e double")
    want = pdf.corr()
    for r in features.corr_matrix(df).collect():
        if "e" in (r.a, r.b):
            assert r.r is None
        else:
            assert r.r == pytest.approx(want.loc[r.a, r.b], abs=1e-9)
    target = {r.column: r.r for r in features.corr_with_target(df, "a").collect()}
    assert target["b"] == pytest.approx(want.loc["a", "b"], abs=1e-6)


def test_zscore_of_constant(spark):
    assert values(scale.zscore_all(panel(spark, {"s": [5, 5, 5]}), ["y"])) == [0, 0, 0]


def test_scaling_looks_at_train_only_and_inverts(spark):
    df = splits.mark_train(panel(spark, {"s": [1, 2, 3, 100], "t": [5, 5, 5, 9]}), 0.75)
    params = scale.fit_scaler(df, ["y"], scaler="minmax", fit_on=F.col("is_train"))
    scaled = scale.apply_scaler(df, params, ["y"])
    assert by_series(scaled, "y") == {"s": [0, 0.5, 1, 49.5], "t": [0, 0, 0, 4]}
    back = scale.invert_scaler(scaled, params, "y", target="y")
    assert by_series(back, "y") == {"s": [1, 2, 3, 100], "t": [5, 5, 5, 9]}


def test_date_parts(spark):
    df = spark.createDataFrame([(dt.datetime(2021, 1, 3),)], "ts timestamp_ntz")
    row = df.select(*[calendar.date_part(F.col("ts"), a).alias(a) for a in ("week", "quarter", "dayofweek", "dayofyear")]).first()
    assert tuple(row) == (53, 1, 6, 3)


def test_factorize_order(spark):
    rows = [("s", START + dt.timedelta(days=i), v) for i, v in enumerate(["b", "a", "b", None])]
    df = spark.createDataFrame(rows, "series string, ts timestamp_ntz, v string")
    assert [r.v for r in scale.factorize(df, "v").orderBy("ts").collect()] == [0, 1, 0, -1]


def test_replace_sentinels(spark):
    numbers = spark.createDataFrame([(None,), (float("nan"),), (1.5,)], "v double")
    assert [r.v for r in clean.replace_sentinels(numbers).collect()] == [0, 0, 1.5]
    text = spark.createDataFrame([(None,), ("None",), ("",), ("x",)], "v string")
    assert [r.v for r in clean.replace_sentinels(text).collect()] == ["0", "0", "0", "x"]


def test_merge_first(spark):
    left = spark.createDataFrame([(1, 1.0), (2, 2.0)], "t int, v double")
    right = spark.createDataFrame([(2, 9.0, 7.0), (3, 8.0, 6.0)], "t int, v double, u double")
    assert sorted(map(tuple, align.merge_first(left, right, keys=["t"]).collect())) == [(1, 1.0, None), (2, 2.0, 7.0)]


def test_duplicate_columns_need_equal_content(spark):
    rows = [("s", 1, 1.0, 1, "1", None), ("s", 2, 2.0, 2, "2", None), ("s", 3, None, None, None, None)]
    df = spark.createDataFrame(rows, "series string, ts int, a double, b int, c string, d double")
    assert clean.duplicate_columns(df, ["series", "ts"]) == ["b"]


def test_classify_columns(spark):
    rows = [("s", 1, 1.0, "x", 7), ("s", 2, 2.0, "x", 7), ("t", 1, 3.0, "y", 7)]
    df = spark.createDataFrame(rows, "series string, ts int, y double, sector string, k int")
    assert clean.classify_columns(df, target="y") == (["y", "sector"], ["k"])
    assert clean.classify_columns(df, target="y", scope="series") == (["y"], ["sector", "k"])
    with pytest.raises(ValueError):
        clean.classify_columns(df, target="k")


def test_narrow_types(spark):
    rows = [(1, 300.0, -5, 2.5, "12", "x"), (2, 70000.0, 100, 1.0, None, "3")]
    df = spark.createDataFrame(rows, "a bigint, b double, c bigint, d double, e string, f string")
    types = dict(clean.narrow_types(df).dtypes)
    assert types == {"a": "smallint", "b": "bigint", "c": "tinyint", "d": "double", "e": "smallint", "f": "string"}


def test_metrics(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 1.0), (4.0, 5.0)], "y double, pred double").withColumn("g", F.lit(1))
    row = metrics.evaluate(df, ["g"]).first()
    assert (row.MAPE, row.RMSE, row.MAE) == pytest.approx((25, 0.816497, 0.666667), rel=1e-5)
    zero = spark.createDataFrame([(0.0, 1.0), (2.0, -3.0)], "y double, pred double").withColumn("g", F.lit(1))
    row = metrics.evaluate(zero, ["g"]).first()
    assert row.MAPE is None and row.RMSLE is None


def test_loss_names():
    assert metrics.loss_name("val_mape") == "MAPE" and metrics.loss_name("OPE") == "OPE" and metrics.loss_name(None) == "QUANTILE"


def test_top_changes(spark):
    df = spark.createDataFrame([("1st", 0.1), ("2nd", -0.5), ("3rd", 0.3)], "series string, change double")
    pick = lambda d: [r.series for r in ranking.top_changes(df, 2, d).collect()]
    assert (pick(1), pick(-1), pick(0)) == (["3rd", "1st"], ["2nd", "1st"], ["2nd", "3rd"])


def test_drift(spark):
    out = naive.drift(panel(spark, {"s": [1, 2, 4]}), horizon=2)
    assert [r.pred for r in out.orderBy("step").collect()] == [5.5, 7.0]


def test_simple_smoothing(spark):
    assert naive.smoothed(panel(spark, {"s": [1, 0, 0, 4]}), horizon=1, alpha=0.3).first().pred == pytest.approx(1.543)


def test_croston(spark):
    train = panel(spark, {"s": [0, 3, 0, 0, 2, 0, 4], "none": [0, 0]})
    got = {r.series: r.pred for r in naive.croston(train, horizon=1).collect()}
    assert got["s"] == pytest.approx(1.440191, rel=1e-6) and got["none"] == 0


def test_holidays(spark):
    want = """2020-12-25 2021-01-01 2021-01-18 2021-02-15 2021-05-31 2021-06-18 2021-07-05 2021-09-06 2021-10-11 2021-11-11
    2021-11-25 2021-12-24 2021-12-31 2022-01-17 2022-02-21 2022-05-30 2022-06-20 2022-07-04 2022-09-05 2022-10-10 2022-11-11
    2022-11-24 2022-12-26 2023-01-02 2023-01-16""".split()
    days = calendar.holiday_table(spark, 2020, 2023).filter("ts >= '2020-12-01' and ts <= '2023-01-31'")
    assert sorted(str(r.ts.date()) for r in days.collect()) == want


def test_frequency_labels(spark):
    def label(times):
        return calendar.infer_frequency(spark.createDataFrame([(t,) for t in times], "ts timestamp_ntz")).first().freq

    days = [START + dt.timedelta(days=i) for i in range(30)]
    assert label(days) == "D"
    assert label([d for d in days if d.weekday() < 5]) == "B"
    assert label([START + dt.timedelta(hours=i) for i in range(30)]) == "H"
    assert label(days[:5] + days[9:]) is None


def test_next_steps(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 5), s) for s in range(1, 8)], "t timestamp_ntz, s int")  # a Friday
    got = [r[0].day for r in df.orderBy("s").select(next_steps(F.col("t"), F.col("s"), "B")).collect()]
    assert got == [8, 9, 10, 11, 12, 15, 16]
    sat = spark.createDataFrame([(dt.datetime(2024, 1, 6), s) for s in (1, 6)], "t timestamp_ntz, s int")
    assert [r[0].day for r in sat.orderBy("s").select(next_steps(F.col("t"), F.col("s"), "B")).collect()] == [8, 15]


def test_time_arithmetic_before_epoch(spark):
    t = dt.datetime(1969, 12, 31, 22, 30, 5)
    row = spark.createDataFrame([(t,)], "t timestamp_ntz").select(epoch_seconds(F.col("t")).alias("s"), floor_to(F.col("t"), HOUR).alias("f")).first()
    assert row.s == -5395 and row.f == dt.datetime(1969, 12, 31, 22)


def test_grid_and_asof(spark):
    rows = [("s", START + dt.timedelta(hours=h), v) for h, v in ((0, 1.0), (5, 2.0), (30, 3.0))]
    df = spark.createDataFrame(rows, "series string, ts timestamp_ntz, y double")
    grid = align.asof_grid(df, ["y"], step=6 * HOUR, bounds="series").orderBy("ts").collect()
    assert [r.y for r in grid] == [1, 2, 2, 2, 2, 3]


def test_duplicate_keys_are_reported(spark):
    with pytest.raises(ValueError, match="duplicate key"):
        align.assert_unique(spark.createDataFrame([("s", 1), ("s", 1)], "series string, ts int"), ["series", "ts"])


def test_extend_on_business_days(spark):
    df = panel(spark, {"s": [1, 2, 3]}).select("series", "ts", "y")  # ends on Friday 2020-01-03
    pred = spark.createDataFrame([("s", 1, 9.0), ("s", 2, 8.0)], "series string, step int, pred double")
    out = align.extend_with_forecast(df, pred, freq="B").filter("is_forecast").orderBy("ts").collect()
    assert [(r.ts.day, r.y) for r in out] == [(6, 9.0), (7, 8.0)]


def test_option_prices(spark):
    df = spark.createDataFrame([("C",), ("P",)], "kind string")
    price = options.option_price(F.lit(0.05), F.lit(100.0), F.lit(100.0), F.lit(1.0), F.lit(0.2), F.col("kind"))
    got = {r.kind: r.p for r in df.select("kind", price.alias("p")).collect()}
    assert got == {"C": 10.451, "P": 5.574}
