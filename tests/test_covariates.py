"""Covariates of the linear models and of the fit driver, against numpy."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelloom.forecast import linear, registry
from tests.helpers import START

L, O, H = 3, 2, 5


def rows(spark, hide=()):
    """Two series driven by a planned column, an observed one and a constant; `hide` takes planned values away."""
    rng = np.random.default_rng(5)
    out = []
    for k, (name, n) in enumerate((("a", 60), ("b", 90))):
        plan, seen, y = rng.normal(size=n), rng.normal(size=n), [0.0]
        for i in range(1, n):
            y.append(0.6 * y[-1] + 2 * plan[i] + 0.5 * seen[i - 1] + k + rng.normal(0, 0.1))
        nt = n - 10
        out += [(name, 0, START + dt.timedelta(days=i), i, n, nt, i < nt, float(y[i]) if i < nt else 1e9, None if (name, i) in hide else float(plan[i]),
                 float(seen[i]) if i < nt else 1e9, float(k)) for i in range(n)]
    return spark.createDataFrame(out, "series string, window_id int, ts timestamp_ntz, idx bigint, n bigint, nt bigint, is_train boolean, y double, plan double, seen double, kind double")


def expected(df, kind, kernel=3, ridge=1e-6):
    """Pooled least squares on the chunk, its covariates and a constant; chunks are continued."""
    series = {}
    for r in df.orderBy("series", "idx").collect():
        series.setdefault(r.series, []).append(r)
    M = linear.moving_average_matrix(L, kernel)

    def inputs(ys, seen, plan, fixed):
        base = ys[-1] if kind == "nlinear" else 0.0
        own = np.concatenate([M @ ys, ys - M @ ys]) if kind == "dlinear" else ys - base
        return np.concatenate([own, seen, plan, [fixed, 1.0]]), base

    X, Y = [], []
    for s in series.values():
        train = [r for r in s if r.is_train]
        for i in range(L, len(train) - O + 1):
            x, base = inputs(*[np.array([getattr(r, c) for r in train[i - L : i]]) for c in ("y", "seen")], np.array([r.plan for r in train[i : i + O]]), train[i].kind)
            X.append(x)
            Y.append([r.y - base for r in train[i : i + O]])
    X, Y = np.array(X), np.array(Y)
    beta = linear.solve(X.T @ X, X.T @ Y, ridge, free=[X.shape[1] - 1])
    out = {}
    for name, s in series.items():
        nt = s[0].nt
        ys, seen = ([getattr(r, c) for r in s[nt - L : nt]] for c in ("y", "seen"))
        plan = [r.plan for r in s[nt : nt + H + O]]
        for k in range(0, H, O):
            x, base = inputs(np.array(ys[-L:]), np.array(seen[-L:]), np.array(plan[k : k + O]), s[0].kind)
            ys += list(x @ beta + base)
            seen += [seen[-1]] * O
        out[name] = ys[L : L + H]
    return out


@pytest.mark.parametrize("name,kind", [("LinearRegression", "linear"), ("NLinear", "nlinear"), ("DLinear", "dlinear")])
def test_driver_passes_covariates(spark, name, kind):
    df = rows(spark)
    sizes = {name: {"input_len": L, "output_len": O, "kernel": 3}}
    got = registry.run_models(df, [name, "LastValue"], horizon=H, overrides=sizes, past=["seen"], future=["plan"], static=["kind"])
    found = {}
    for r in got.where(F.col("model") == name).orderBy("series", "step").collect():
        found.setdefault(r.series, []).append(r.pred)
    want = expected(df, kind)
    assert found.keys() == want.keys()
    for s in want:
        assert np.allclose(found[s], want[s], rtol=1e-6, atol=1e-6)
    assert got.where("model = 'LastValue'").count() == 2 * H


def test_missing_plans_give_null_forecasts(spark):
    df = rows(spark, hide={("a", 50 + 2)})  # the third step of series a
    sizes = {"LinearRegression": {"input_len": L, "output_len": O}}
    got = registry.run_models(df, ["LinearRegression", "Kalman"], horizon=H, overrides=sizes, future=["plan"])
    missing = sorted((r.model, r.series, r.step) for r in got.where("pred is null").collect())
    assert missing == [("Kalman", "a", 3), *[("LinearRegression", "a", h) for h in (3, 4, 5)]]
    short = df.where("idx < nt or series = 'b'")
    got = registry.run_models(short, ["LinearRegression", "Kalman"], horizon=H, overrides=sizes, future=["plan"])
    assert got.where("series = 'a'").count() == 2 * H == got.where("series = 'a' and pred is null").count()
    with pytest.raises(ValueError):
        linear.chunk_linear(df.where("is_train"), horizon=2, future=["plan"])


def test_covariates_help(spark):
    df = rows(spark)
    plain, better = (registry.run_models(df, ["Kalman"], horizon=H, future=cols) for cols in ([], ["plan"]))
    assert plain.count() == better.count() == 2 * H
    assert plain.groupBy("series").agg(F.countDistinct("pred").alias("c")).where("c = 1").count() == 2
    assert better.groupBy("series").agg(F.countDistinct("pred").alias("c")).where(f"c = {H}").count() == 2
