"""Search by rows of one plan, rounds of it, automatic orders and fitted quantiles, against numpy and one fit at a time."""

import datetime as dt
import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelloom.forecast import linear, quantile, registry
from tests.helpers import START, panel


def windows(spark, count=3, n=60, nt=48):
    rng = np.random.default_rng(3)
    rows = []
    for s in ("a", "b"):
        for w in range(count):
            y = 20 + np.cumsum(rng.normal(size=n)) + 3 * np.sin(np.arange(n) / 2)
            y[rng.random(n) < 0.1] = 0.0
            rows += [(s, w, START + dt.timedelta(days=w * n + i), i, n, nt, i < nt, float(v)) for i, v in enumerate(y)]
    return spark.createDataFrame(rows, "series string, window_id int, ts timestamp_ntz, idx bigint, n bigint, nt bigint, is_train boolean, y double")


SETS = {
    "SimpleSmoothing": [{"alpha": 0.1}, {"alpha": 0.7}],
    "Theta": [{"alpha": 0.1, "theta_": 1.5}, {"alpha": 0.4, "theta_": 3.0}],
    "Kalman": [{"q": 0.0, "r": 1.0}, {"q": 0.5, "r": 2.0}],
    "Croston": [{"version": "classic", "alpha": 0.2}, {"version": "sba", "alpha": 0.4}],
}


@pytest.mark.parametrize("name", sorted(SETS))
def test_rows_equal_single_fits(spark, name):
    df = windows(spark)
    model, keys = registry.MODELS[name], ["series", "window_id"]
    train = df.filter("is_train")
    got = {(r.trial, r.series, r.window_id, r.step): r.pred for r in model.many(train, [{**model.params, **t} for t in SETS[name]], horizon=3, keys=keys).collect()}
    assert len(got) == 2 * 2 * 3 * 3
    for i, t in enumerate(SETS[name]):
        for r in model.fit_predict(train, horizon=3, keys=keys, **{**model.params, **t}).collect():
            assert got[i, r.series, r.window_id, r.step] == pytest.approx(r.pred, rel=1e-9)


def test_plan_does_not_grow_with_trials(spark):
    df = windows(spark)
    for name, space in (("Theta", {"theta_": [1.5, 3.0], "alpha": [0.05, 0.5]}), ("Croston", {"alpha": [0.05, 0.5]}), ("ARIMA", {"p": [1, 2], "d": 1})):
        model, keys = registry.MODELS[name], ["series", "window_id"]
        sizes = []
        for count in (2, 50):
            candidates = [{**model.params, **t} for t in registry.draw(space, count)]
            plan = model.many(df.filter("is_train"), candidates, horizon=3, keys=keys)._jdf.queryExecution().optimizedPlan()
            sizes.append(plan.treeString().count("\n"))
        assert sizes[0] == sizes[1]
    # parameters that change the plan are branches
    assert registry.MODELS["Croston"].many(df, [{"version": "tsb"}], horizon=3) is None
    assert registry.search(df, "Croston", [{"version": "tsb"}, {"version": "classic"}], horizon=3, loss="MAE").count() == 2


def test_arima_candidates(spark):
    df = windows(spark)
    tried = [{"p": 3, "d": 1}, {"p": 1, "d": 0, "trend": "ct"}, {"p": 0, "d": 1, "trend": "n"}]
    got = registry.search(df, "ARIMA", tried, horizon=5, loss="MAE").orderBy("trial").collect()
    assert [r.trial for r in got] == [0, 1, 2] and all(r.loss is not None for r in got)
    last = registry.search(df, "LastValue", [{}], horizon=5, loss="MAE").first()
    assert got[2].loss == pytest.approx(last.loss)  # no lags, no trend, one difference


def test_halving(spark):
    df = windows(spark, count=4)
    trials = [{"alpha": a} for a in (0.05, 0.2, 0.4, 0.6, 0.95)]
    got = registry.halving(df, "SimpleSmoothing", trials, horizon=5, loss="MAE").orderBy("trial").collect()
    assert [r.trial for r in got] == [0, 1, 2, 3, 4] and sorted(r.windows for r in got) == [1, 1, 2, 4, 4]
    first = {r.trial: r.loss for r in registry.search(df.filter("window_id = 0"), "SimpleSmoothing", trials, horizon=5, loss="MAE").collect()}
    dropped = {r.trial for r in got if r.windows == 1}
    assert min(first[t] for t in dropped) >= max(loss for t, loss in first.items() if t not in dropped)
    final = {r.trial: r.loss for r in registry.search(df, "SimpleSmoothing", trials, horizon=5, loss="MAE").collect()}
    assert all(r.loss == pytest.approx(final[r.trial]) for r in got if r.windows == 4)


def test_levinson_solves_yule_walker():
    rng = np.random.default_rng(1)
    x = np.convolve(rng.normal(size=500), [1, 0.6, 0.3])
    x -= x.mean()
    g = np.array([x[: len(x) - i] @ x[i:] / len(x) for i in range(8)])
    for p, (phi, error) in enumerate(linear.levinson(g, 7)):
        want = np.linalg.solve(np.array([[g[abs(i - j)] for j in range(p)] for i in range(p)]), g[1 : p + 1]) if p else np.zeros(0)
        assert np.allclose(phi, want) and error == pytest.approx(g[0] - want @ g[1 : p + 1])
    assert len(linear.levinson(np.zeros(4), 3)) == 1  # a constant series


def test_automatic_order(spark, monkeypatch):
    from panelloom.operators import blocks

    monkeypatch.setattr(blocks, "BLOCK_ROWS", 50)
    rng = np.random.default_rng(2)
    e = rng.normal(size=600)
    ar = np.zeros(600)
    for t in range(2, 600):
        ar[t] = 0.5 * ar[t - 1] + 0.3 * ar[t - 2] + e[t]
    series = {"level": 10 + ar, "walk": np.cumsum(e) + 5, "twice": np.cumsum(np.cumsum(e)), "flat": np.full(600, 4.0), "short": ar[:8],
              "hole": [None if i == 300 else v for i, v in enumerate(ar)]}
    got = linear.auto_arima(panel(spark, series), horizon=4, season=12)
    rows = {r.series: r for r in got.filter("step = 1").collect()}
    assert got.count() == 4 * len(series)
    assert (rows["level"].d, rows["level"].p) == (0, 2) and rows["walk"].d == 1 and rows["twice"].d == 2
    assert rows["flat"].pred == pytest.approx(4.0) and rows["short"].pred is None and rows["hole"].pred is None
    c = np.array(series["walk"]) - np.mean(series["walk"])
    s, g = np.cumsum(np.diff(c) - np.diff(c).mean()), np.diff(c) - np.diff(c).mean()
    width = int(4 * (599 / 100) ** 0.25)
    long_run = (g @ g + 2 * sum((1 - i / (width + 1)) * (g[i:] @ g[:-i]) for i in range(1, width + 1))) / 599
    assert rows["walk"].kpss == pytest.approx((s @ s) / 599**2 / long_run, rel=1e-9)


def test_seasonal_differences(spark):
    """A season that repeats with a drift is continued exactly by one seasonal difference."""
    wave = [10 * np.sin(2 * np.pi * (i % 12) / 12) + i // 12 for i in range(96)]
    got = linear.arima(panel(spark, {"s": wave}), horizon=24, p=0, d=0, season=12, D=1).orderBy("step").collect()
    assert np.allclose([r.pred for r in got], [10 * np.sin(2 * np.pi * (i % 12) / 12) + i // 12 for i in range(96, 120)])
    with pytest.raises(ValueError):
        linear.arima(panel(spark, {"s": wave}), horizon=1, D=1)


def test_driver_passes_covariates_to_arima_and_varima(spark):
    df = windows(spark).withColumn("plan", F.pmod(F.hash("idx"), F.lit(101)) / 50 - 1).withColumn("seen", F.cos("idx"))
    df = df.withColumn("y", F.col("y") + 50 * F.col("plan"))
    sizes = {"ARIMA": {"p": 2}, "VARIMA": {"p": 2}, "AutoARIMA": {"max_p": 2, "season": 0}}
    plain = registry.score(df, registry.run_models(df, sizes, horizon=6, overrides=sizes))
    more = registry.score(df, registry.run_models(df, sizes, horizon=6, overrides=sizes, past=["seen"], future=["plan"]))
    error = F.avg(F.abs(F.col("y") - F.col("pred"))).alias("e")
    before, after = ({r.model: r.e for r in x.groupBy("model").agg(error).collect()} for x in (plain, more))
    assert after["ARIMA"] < before["ARIMA"] / 2 and after["AutoARIMA"] < before["AutoARIMA"] / 2 and after["VARIMA"] != before["VARIMA"]


def test_fitted_quantiles(spark):
    """Intercepts are exact; with slopes the loss is near that of the best line through two points; order, nulls, short series."""
    rng = np.random.default_rng(4)
    y = [10.0]
    for _ in range(150):
        y.append(5 + 0.5 * y[-1] + rng.exponential(1 + 0.1 * abs(y[-1])))
    series = {"a": y, "b": y[40:70], "c": [1.0], "d": [*y[:20], None]}
    df, qs = panel(spark, series), [0.5, 0.1, 0.9]
    plain = quantile.quantile_linear(df, qs, horizon=2, input_len=1)
    rises = sorted(s[i + 1] - s[i] for s in (y, y[40:70], y[:20]) for i in range(len(s) - 2))
    got = {(r.series, r.step, r.q): r.pred for r in plain.collect()}
    assert len(got) == 4 * 2 * 3 and got["d", 1, 0.5] is None
    for q in qs:
        rank = max(1, len(rises) - int(np.floor(len(rises) - q * len(rises))))
        assert got["a", 1, q] == y[-1] + rises[rank - 1]
    fitted = quantile.quantile_linear(df, qs, horizon=1, input_len=2)
    by = {(r.series, r.q): r.pred for r in fitted.collect()}
    assert by["c", 0.5] is None and all(by[s, 0.1] <= by[s, 0.5] <= by[s, 0.9] for s in "ab")
    pairs = np.array([(s[i - 1] - s[i], s[i + 1] - s[i]) for s in (y, y[40:70], y[:20]) for i in range(1, len(s) - 1)])

    def loss(line, q):
        r = pairs[:, 1] - line[0] - line[1] * pairs[:, 0]
        return np.maximum(q * r, (q - 1) * r).sum()

    for q in qs:
        # the fitted line from its values for two series
        ends = [(s[-2] - s[-1], by[k, q] - s[-1]) for k, s in (("a", y), ("b", y[40:70]))]
        slope = (ends[0][1] - ends[1][1]) / (ends[0][0] - ends[1][0])
        own = (ends[0][1] - slope * ends[0][0], slope)
        lines = []
        for (x0, t0), (x1, t1) in itertools.combinations(pairs[::3], 2):
            if x0 != x1:
                b = (t0 - t1) / (x0 - x1)
                lines.append((t0 - b * x0, b))
        assert loss(own, q) <= min(loss(line, q) for line in lines) * 1.002
    with pytest.raises(ValueError):
        quantile.quantile_linear(df, [1.0], horizon=1)
    assert quantile.quantile_linear(panel(spark, {"c": [1.0]}), qs, horizon=1).filter("pred is not null").count() == 0
