"""Stored state: updates equal a fit on all rows, whatever the stretches; repeats and nulls."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from panelloom.forecast import naive, state
from tests.helpers import START

DDL = "series string, ts timestamp_ntz, y double"
FITS = {"LastValue": naive.last_value, "NaiveDrift": naive.drift, "SimpleSmoothing": naive.smoothed, "Theta": naive.theta, "OneLag": naive.one_lag}


def rows(seed=1, gaps=0.0):
    rng = random.Random(seed)
    return [(s, START + dt.timedelta(days=i), None if rng.random() < gaps else round(1e6 + i + rng.gauss(0, 5), 3)) for s, n in (("a", 90), ("b", 7), ("c", 1), ("d", 40)) for i in range(n)]


def forecasts(df):
    return {(r.series, r.step): r.pred for r in df.collect()}


def close(x, y):
    assert x.keys() == y.keys()
    for k in x:
        assert (x[k] is None and y[k] is None) or math.isclose(x[k], y[k], rel_tol=1e-9), k


@pytest.mark.parametrize("gaps", [0.0, 0.3])
def test_updates_equal_one_fit(spark, gaps):
    data, known, start = rows(gaps=gaps), None, START
    for days in (3, 1, 30, 60):
        end = start + dt.timedelta(days=days)
        # the stretch before comes again: rows that are in the state are left out
        stretch = spark.createDataFrame([r for r in data if start - dt.timedelta(days=2) <= r[1] < end], DDL)
        known = spark.createDataFrame(state.update_state(known, stretch).collect(), SCHEMA)  # as a stored table
        start = end
    whole = state.update_state(None, spark.createDataFrame(data, DDL))
    counts = {s: sum(r[0] == s for r in data) for s in "abcd"}
    placed = {}
    for s, t, y in data:
        placed.setdefault(s, []).append((s, t, len(placed.get(s, [])), counts[s], y))
    train = spark.createDataFrame([r for x in placed.values() for r in x], "series string, ts timestamp_ntz, idx bigint, nt bigint, y double")
    for model, fit in FITS.items():
        got = forecasts(state.predict_state(known, model, horizon=5))
        close(got, forecasts(state.predict_state(whole, model, horizon=5)))
        close(got, forecasts(fit(train, horizon=5)))


SCHEMA = ("series string, n bigint, known bigint, last_ts timestamp_ntz, first double, last double, s_sum double, s_weight double, t_sum double, t_idx double, t_weight double, "
          + ", ".join(f"{p}_{k} double" for p in state.PAIRS for k in ("m", "x", "y", "xx", "xy")))


def test_repeats_new_series_and_empty_tables(spark):
    data = spark.createDataFrame(rows(), DDL)
    once = state.update_state(None, data)
    again = state.update_state(once, data)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, once.collect()))
    more = state.update_state(once, spark.createDataFrame([("z", START, 3.0), (None, START, 1.0), ("z", None, 9.0)], DDL))
    assert {r.series: r.n for r in more.collect()} == {"a": 90, "b": 7, "c": 1, "d": 40, "z": 1}
    assert state.update_state(None, data.where("false")).collect() == []
    assert state.predict_state(more.where("series = 'z'"), "LastValue", horizon=2).where(F.col("pred") == 3.0).count() == 2
    with pytest.raises(ValueError):
        state.predict_state(once, "FFT", horizon=1)
