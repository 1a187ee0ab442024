"""Forecasters against direct computations in numpy on short series."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelloom.forecast import learned, linear, naive, registry, smoothing, spectral
from panelloom.operators import ranking
from tests.helpers import panel

rng = np.random.default_rng(7)
N = 60
WAVE = 20 + 0.3 * np.arange(N) + 5 * np.sin(2 * np.pi * np.arange(N) / 7) + rng.normal(0, 1, N)
SERIES = {"s": WAVE.tolist(), "t": (50 + rng.normal(0, 4, N).cumsum()).tolist()}


def paths(df, cols=("pred",)):
    out: dict = {}
    for r in sorted(df.select("series", "step", *cols).collect(), key=lambda r: (r[0], r[1])):
        out.setdefault(r[0], []).append(r[2])
    return out


def smoothing_loop(y, c, period, x):
    """One pass of the recursion; (squared error, final state)."""
    level, trend, season = x[0], x[1], list(x[2:])
    period = period if c["season"] else 0
    sse = 0.0
    for v in y:
        e = v - level - c["phi"] * trend - (season[0] if period else 0)
        level, trend = level + c["phi"] * trend + c["alpha"] * e, c["phi"] * trend + c["alpha"] * c["beta"] * e
        if period:
            season = season[1:] + [season[0] + c["gamma"] * (1 - c["alpha"]) * e]
        sse += e * e
    return sse, [level, trend, *season]


@pytest.mark.parametrize("block", [1, 5, 1000])
@pytest.mark.parametrize("period", [0, 4])
def test_blocked_smoothing_equals_one_pass(spark, block, period, monkeypatch):
    monkeypatch.setattr(smoothing, "COMPOSE", 3)
    kinds = ["simple", "holt", "damped"] + (["simple+season", "holt+season"] if period else [])
    cands = smoothing.candidates(kinds, alphas=(0.2, 0.6))
    rows = panel(spark, SERIES, "v")
    got = smoothing.fit(rows, cands, period=period, block_rows=block).collect()
    assert len(got) == len(cands) * 2
    for r in got:
        c, y = cands[r.cand], np.array(SERIES[r.series])
        sse, state = smoothing_loop(y, c, period, smoothing.initial_state(y, c, period))
        assert r.sse == pytest.approx(sse, rel=1e-9) and r.state[:len(state)] == pytest.approx(state, rel=1e-9)
        if not c["season"]:  # a model without season does not depend on the period of the others
            plain = smoothing_loop(y, c, 0, smoothing.initial_state(y, c, 0))
            assert r.sse == pytest.approx(plain[0], rel=1e-9)


def test_automatic_smoothing_finds_the_season(spark):
    out = smoothing.exponential_smoothing(panel(spark, {"s": WAVE}), horizon=14, kinds=["simple", "holt", "holt+season"], period=7)
    assert out.first().kind == "holt+season"
    truth = 20 + 0.3 * np.arange(N, N + 14) + 5 * np.sin(2 * np.pi * np.arange(N, N + 14) / 7)
    assert np.abs(np.array(paths(out)["s"]) - truth).max() < 4


def test_multiplicative_smoothing_is_additive_in_logs(spark):
    logs = {k: np.log(v).tolist() for k, v in SERIES.items()}
    a = paths(smoothing.exponential_smoothing(panel(spark, SERIES), horizon=3, kinds=["holt"], multiplicative=True))
    b = paths(smoothing.exponential_smoothing(panel(spark, logs), horizon=3, kinds=["holt"]))
    for s in SERIES:
        assert a[s] == pytest.approx(np.exp(b[s]))


def lags(y, p, d):
    w = np.diff(y, n=d)
    X = np.array([[*w[t - p:t][::-1], 1.0] for t in range(p, len(w))])
    return X, w[p:]


def test_arima_is_least_squares(spark):
    got = paths(linear.arima(panel(spark, SERIES), horizon=5, p=3, d=1))
    for s, y in SERIES.items():
        X, t = lags(np.array(y), 3, 1)
        beta = np.linalg.lstsq(X, t, rcond=None)[0]
        assert got[s] == pytest.approx(linear.ar_path(np.array(y), beta, 1, 5), rel=1e-8)


def test_ar_path_twice_differenced():
    y = np.array([1.0, 4, 9, 16])  # constant second difference 2
    assert linear.ar_path(y, np.array([2.0]), 2, 3) == pytest.approx([25, 36, 49])


def test_order_of_least_aic(spark):
    out = linear.arima(panel(spark, SERIES), horizon=2, orders=[0, 2, 8], differences=[0, 1])
    for s, y in SERIES.items():
        best = None
        for d in (0, 1):
            w = np.diff(np.array(y), n=d)
            rows = range(8 + 1 - d, len(w))
            for p in (0, 2, 8):
                X = np.array([[*[w[t - i] for i in range(1, p + 1)], 1.0] for t in rows])
                t = w[list(rows)]
                sse = ((t - X @ np.linalg.lstsq(X, t, rcond=None)[0]) ** 2).sum()
                aic = len(t) * math.log(sse / len(t)) + 2 * (p + 1 + d)
                best = min(best or (aic, d, p), (aic, d, p))
        r = out.filter(F.col("series") == s).first()
        assert (r.d, r.p) == best[1:] and r.aic == pytest.approx(best[0], rel=1e-6)


def test_varima(spark):
    z = rng.normal(10, 2, N)
    df = panel(spark, {"s": WAVE}).withColumn("z", F.element_at(F.array(*[F.lit(float(v)) for v in z]), (F.col("idx") + 1).cast("int")))
    got = [r.preds for r in linear.varima(df, horizon=3, cols=["y", "z"], p=2, d=1).orderBy("step").collect()]
    w = np.diff(np.stack([WAVE, z], 1), axis=0)
    X = np.array([[*w[t - 1], *w[t - 2], 1.0] for t in range(2, len(w))])
    B = np.linalg.lstsq(X, w[2:], rcond=None)[0]
    hist, level = list(w), np.array([WAVE[-1], z[-1]])
    for step in range(3):
        nxt = np.array([*hist[-1], *hist[-2], 1.0]) @ B
        hist.append(nxt)
        level = level + nxt
        assert got[step] == pytest.approx(level, rel=1e-8)


def chunks(L, O, shift):
    X, Y = [], []
    for y in SERIES.values():
        for t in range(L, N - O + 1):
            base = y[t - 1] if shift else 0.0
            X.append([*(np.array(y[t - L:t]) - base), 1.0])
            Y.append(np.array(y[t:t + O]) - base)
    return np.array(X), np.array(Y)


@pytest.mark.parametrize("kind", ["linear", "nlinear", "dlinear"])
def test_chunk_linear_is_pooled_least_squares(spark, kind):
    L, O, ridge = 6, 3, 1e-3 if kind == "dlinear" else 0.0
    got = paths(linear.chunk_linear(panel(spark, SERIES), horizon=5, kind=kind, input_len=L, output_len=O, kernel=3, ridge=ridge))
    X, Y = chunks(L, O, kind == "nlinear")
    if kind == "dlinear":
        M = linear.moving_average_matrix(L, 3)
        T = lambda x: np.concatenate([M @ x, x - M @ x, [1.0]])
        Z = np.array([T(x[:-1]) for x in X])
        scale = np.sqrt((Z ** 2).sum(0))
        A = (Z / scale).T @ (Z / scale) + np.diag([ridge] * (2 * L) + [0.0])
        beta = np.linalg.solve(A, (Z / scale).T @ Y) / scale[:, None]
        step = lambda x: T(x) @ beta
    else:
        # shifted values of the last row are all 0: a minimum-norm solution
        beta = np.linalg.lstsq(X, Y, rcond=None)[0]
        step = (lambda x: np.append(x - x[-1], 1.0) @ beta + x[-1]) if kind == "nlinear" else (lambda x: np.append(x, 1.0) @ beta)
    for s, y in SERIES.items():
        w = list(y)
        while len(w) < N + 5:
            w.extend(step(np.array(w[-L:])))
        assert got[s] == pytest.approx(w[N:N + 5], rel=1e-6)


def test_moving_average_repeats_the_ends():
    x = np.array([1.0, 2, 6, 3])
    assert linear.moving_average_matrix(4, 3) @ x == pytest.approx([4 / 3, 3, 11 / 3, 4])


def test_structural_recovers_trend_and_season(spark):
    t = np.arange(70)
    y = 5 + 0.1 * t + 2 * np.sin(2 * np.pi * t / 7)
    out = linear.structural(panel(spark, {"s": y}), horizon=7, periods={7.0: 1}, holidays=False, ridge=0.0)
    f = np.arange(70, 77)
    assert paths(out)["s"] == pytest.approx(5 + 0.1 * f + 2 * np.sin(2 * np.pi * f / 7), rel=1e-6)
    capped = linear.structural(panel(spark, {"s": y}), horizon=7, periods={7.0: 1}, holidays=False, cap=12.0, floor=11.5)
    assert all(11.5 <= p <= 12.0 for p in paths(capped)["s"])


@pytest.mark.parametrize("n", [60, 59])
def test_fft(spark, n):
    got = paths(spectral.fft(panel(spark, {"s": WAVE[:n]}), horizon=4, keep=5))["s"]
    spec = np.fft.rfft(WAVE[:n])
    spec[np.argsort(-np.abs(spec))[5:]] = 0
    assert got == pytest.approx(np.fft.irfft(spec, n)[:4], rel=1e-9)  # continues periodically


@pytest.mark.parametrize("trend, degree", [("poly", 3), ("exp", 1)])
def test_fft_with_trend(spark, trend, degree):
    got = paths(spectral.fft(panel(spark, {"s": WAVE}), horizon=4, keep=3, trend=trend, degree=degree))["s"]
    t = np.arange(N + 4)
    fit = np.polyval(np.polyfit(t[:N], np.log(WAVE) if trend == "exp" else WAVE, degree), t)
    level = np.exp(fit) if trend == "exp" else fit
    spec = np.fft.rfft(WAVE - level[:N])
    spec[np.argsort(-np.abs(spec))[3:]] = 0
    assert got == pytest.approx(np.fft.irfft(spec, N)[:4] + level[N:], rel=1e-6)


@pytest.mark.parametrize("n", [1, 2, 5, 60])
def test_local_level(spark, n):
    got = paths(naive.local_level(panel(spark, {"s": WAVE[:n]}), horizon=1, q=0.2, r=2.0))["s"][0]
    m, p = 0.0, 1e6
    for i, v in enumerate(WAVE[:n]):
        p = p + (0.2 if i else 0)
        k = p / (p + 2.0)
        m, p = m + k * (v - m), (1 - k) * p
    assert got == pytest.approx(m, rel=1e-12)


def test_theta_on_a_line_continues_it(spark):
    y = 3 + 2.0 * np.arange(30)
    got = paths(naive.theta(panel(spark, {"s": y}), horizon=3, alpha=0.5))["s"]
    level = y[0]
    for v in y:
        level = 0.5 * (2 * v - v) + 0.5 * level
    assert got == pytest.approx([(3 + 2.0 * (29 + h)) / 2 + level / 2 for h in (1, 2, 3)])


def test_window_aggregate_shift(spark):
    out = naive.window_aggregate(panel(spark, {"s": range(10)}), horizon=2, input_len=4, output_len=2, shift=3)
    assert paths(out)["s"] == [7.5, 7.5]
    assert out.agg(F.min("ts")).first()[0].day == 14
    with pytest.raises(ValueError):
        naive.window_aggregate(panel(spark, {"s": range(10)}), horizon=3, input_len=4, output_len=2, shift=1)


def test_linear_on_lags_learns_a_recurrence(spark):
    y = [1.0, 2.0]
    while len(y) < 40:
        y.append(0.6 * y[-1] + 0.3 * y[-2] + 1)
    df = panel(spark, {"s": y})
    out, models = learned.direct(df, learned.regressor("linear"), lags=2, output_len=2)
    want = [0.6 * y[-1] + 0.3 * y[-2] + 1]
    want.append(0.6 * want[0] + 0.3 * y[-1] + 1)
    assert paths(out)["s"] == pytest.approx(want, rel=1e-4)
    weights = {r.feature: r.weight for r in learned.importance(models[:1], ["now", "before"], spark).collect()}
    assert weights == pytest.approx({"now": 0.6, "before": 0.3}, abs=1e-3)


def test_learned_models_see_training_rows_only(spark):
    df = panel(spark, {"s": WAVE}).withColumn("nt", F.lit(40).cast("bigint"))
    other = df.withColumn("y", F.when(F.col("idx") >= 40, 1e9).otherwise(F.col("y")))
    est = learned.regressor("random_forest", numTrees=5, maxDepth=4)
    a, b = (paths(learned.direct(d, est, lags=3, output_len=2)[0])["s"] for d in (df, other))
    assert a == b and max(a) < 100


def test_search_space_rules():
    space = {"a": [None, 3], "b": [True, False], "c": ["x", "y"], "d": [0.1, 10.0], "e": 7, "f": [[1], [2]]}
    drawn = registry.draw(space, 50)
    assert drawn == registry.draw(space, 50)
    assert {type(p["b"]) for p in drawn} == {bool} and {p["a"] for p in drawn} <= {0, 1, 2, 3} and {p["e"] for p in drawn} == {7}
    assert all(0.1 <= p["d"] <= 10 and p["c"] in "xy" and "f" not in p for p in drawn)


def test_inputs_follow_capabilities():
    args = {"past": ["p"], "future": ["f"], "static": ["s"]}
    assert registry.usable_inputs(registry.MODELS["NaiveDrift"], **args) == {"past": [], "future": [], "static": []}
    assert registry.usable_inputs(registry.MODELS["Kalman"], **args) == {"past": [], "future": ["f"], "static": []}
    assert registry.usable_inputs(registry.MODELS["NLinear"], **args) == args


def test_search_picks_the_better_parameter(spark):
    df = panel(spark, {"s": [5.0] * 20 + [9.0] * 20, "t": [1.0] * 20 + [2.0] * 20})
    p = registry.prepare(df.drop("nt"), split=0.75)
    scored = registry.search(p, "SimpleSmoothing", [{"alpha": 0.05}, {"alpha": 0.9}], horizon=5)
    history = {r.trial: (r.loss, r.best_so_far) for r in ranking.trial_history(scored).collect()}
    assert history[1][0] < history[0][0] and history[1][1] == history[1][0] and history[0][1] == history[0][0]


def test_best_model_respects_direction(spark):
    ev = spark.createDataFrame([("a", "s", 0.9, 3.0), ("b", "s", 0.2, 1.0)], "model string, series string, R2 double, MAPE double")
    assert ranking.best_model(ev, "R2").first().model == "a" and ranking.best_model(ev, "val_MAPE").first().model == "b"


@pytest.mark.parametrize("period", [0, 4])
def test_blocks_side_by_side(period):
    """Blocks of different lengths and phases, with nulls, give the maps and errors that a recursion gives from any state."""
    rng = np.random.default_rng(2)
    cands = smoothing.candidates(["simple", "holt", "damped"] + (["holt+season"] if period else []), alphas=(0.2, 0.7))
    sizes, start = [9, 4, 1, 40], np.array([0, 7, 3, 18])
    y = np.full((4, 40), np.inf)
    for k, n in enumerate(sizes):
        y[k, :n] = np.where(rng.random(n) < 0.2, np.nan, rng.normal(10, 3, n))
    M, c, Q, q, s = smoothing.reduce_blocks(y, start, cands, period)
    for k, n in enumerate(sizes):
        for i, cand in enumerate(cands):
            x = rng.normal(size=2 + period)
            level, trend, seasons, sse = x[0], x[1], x[2:].copy(), 0.0
            for t in range(n):
                level, trend = level + cand["phi"] * trend, cand["phi"] * trend
                if np.isnan(y[k, t]):
                    continue
                at = (start[k] + t) % period if period else 0
                e = y[k, t] - level - (seasons[at] if cand["season"] else 0.0)
                sse += e * e
                level, trend = level + cand["alpha"] * e, trend + cand["alpha"] * cand["beta"] * e
                if cand["season"]:
                    seasons[at] += cand["gamma"] * (1 - cand["alpha"]) * e
            np.testing.assert_allclose(M[k, i] @ x + c[k, i], [level, trend, *seasons], rtol=1e-9, atol=1e-9)
            np.testing.assert_allclose(s[k, i] + q[k, i] @ x + x @ Q[k, i] @ x, sse, rtol=1e-8, atol=1e-8)


def test_box_cox_finds_the_power(spark):
    """A line in the square root, in the logarithm and as it stands; values at or below 0 are not transformed; a null is skipped."""
    t, rng = np.arange(400), np.random.default_rng(8)
    line = 20 + 0.05 * t + rng.normal(0, 0.3, 400)
    series = {"root": line**2, "log": np.exp(line / 5), "plain": line, "negative": line - 25.0}
    series["gap"] = [None if k == 30 else v for k, v in enumerate(series["root"])]
    p = panel(spark, series)
    xs = [F.lit(1.0), F.col("idx") / 365.0]
    got = {r.series: r["lambda"] for r in linear.box_cox(p, ["series"], xs, "y", (-1.0, 0.0, 0.5, 1.0), ridge=0.0, free=[0, 1]).collect()}
    assert got == {"root": 0.5, "log": 0.0, "plain": 1.0, "negative": 1.0, "gap": 0.5}
    out = paths(linear.structural(p, horizon=5, periods={}, holidays=False, ridge=0.0, transform="boxcox", keys=["series"]))
    want = 20 + 0.05 * np.arange(400, 405)
    np.testing.assert_allclose(out["root"], want**2, rtol=0.02)
    np.testing.assert_allclose(out["log"], np.exp(want / 5), rtol=0.05)
    with pytest.raises(ValueError):
        linear.structural(p, horizon=5, transform="sqrt")
