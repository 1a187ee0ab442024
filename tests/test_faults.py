"""Inputs that once lost rows or failed: fractions of a second, sub-daily calendars, null times, old files."""

import datetime as dt
import json
import math
import os
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from panelloom.forecast import naive, registry, smoothing, spectral
from panelloom.functions import calendar
from panelloom.functions.options import normal_cdf
from panelloom.functions.timeaxis import HOUR
from panelloom.operators import align, blocks, features, splits
from panelloom.sources import readers, sinks
from panelloom.streaming.ingest import ingest_once

DAY = dt.datetime(2024, 1, 1)


def times(spark, rows, value="y"):
    return spark.createDataFrame(rows, f"series string, ts timestamp_ntz, {value} double")


def test_asof_grid_keeps_fractions_of_a_second(spark):
    rows = [("a", DAY, 1.0), ("a", DAY + dt.timedelta(hours=1, microseconds=500_000), 2.0), ("a", DAY + dt.timedelta(hours=3), 3.0),
            ("a", DAY + dt.timedelta(hours=3, microseconds=1), 4.0), ("a", DAY + dt.timedelta(hours=5), None)]
    got = align.asof_grid(times(spark, rows), ["y"], step=HOUR).orderBy("ts").collect()
    assert [r.y for r in got] == [1.0, 1.0, 2.0, 3.0, 4.0, 4.0]


def test_calendar_of_any_step(spark):
    panel = times(spark, [("a", DAY, 1.0), ("b", DAY, 2.0)])
    econ = spark.createDataFrame([(DAY + dt.timedelta(hours=h, microseconds=h), float(h)) for h in (0, 12, 24, 31)] + [(None, 9.0)], "ts timestamp_ntz, rate double")
    got = sorted((r.series, r.ts, r.y, r.rate) for r in align.join_calendar(panel, econ).collect())
    want = [(s, DAY + dt.timedelta(hours=h, microseconds=h), (1.0 if s == "a" else 2.0) if h == 0 else None, float(h)) for s in "ab" for h in (0, 12, 24, 31)]
    assert got == want


@pytest.mark.parametrize("width", [None, 3600, 10_000_000])
def test_null_times_have_no_position(spark, width):
    rows = [("a", None, 0.0), ("a", DAY, 1.0), ("a", DAY + dt.timedelta(days=2), 2.0), (None, DAY, 3.0), ("b", None, 4.0)]
    got = blocks.position(times(spark, rows), width=width, total="n").collect()
    assert sorted((r.y, r.idx, r.n) for r in got) == [(1.0, 0, 2), (2.0, 1, 2)]


def test_holidays_of_any_year(spark):
    days = times(spark, [("a", dt.datetime(2004, 7, 5), 1.0), ("a", dt.datetime(1961, 12, 25), 1.0), ("a", dt.datetime(2030, 3, 3), 1.0)])
    got = {r.ts.year: r.holiday for r in calendar.join_holidays(days, calendar.holidays_of(days)).collect()}
    assert got == {2004: 1.0, 1961: 1.0, 2030: 0.0}


@pytest.mark.parametrize("steps, freq", [
    ([dt.timedelta(days=k) for k in range(9)], "D"), ([dt.timedelta(hours=k) for k in range(9)], "H"),
    ([dt.timedelta(days=k) for k in range(12) if k % 7 < 5], "B"), ([dt.timedelta(hours=k, milliseconds=k % 2) for k in range(9)], None)])
def test_frequency(spark, steps, freq):
    rows = times(spark, [("a", DAY + s, 1.0) for s in steps])  # 2024-01-01 is a Monday
    assert calendar.infer_frequency(rows).first().freq == freq


def test_draw_from_zero():
    drawn = registry.draw({"a": [None, 0.5], "b": [0.1, 0.5], "c": [0.0, 1.0]}, 50)
    assert all(0 <= d["a"] <= 0.5 and 0.1 <= d["b"] <= 0.5 and 0 <= d["c"] <= 1 for d in drawn)
    with pytest.raises(ValueError):
        registry.draw({"a": []}, 1)


def test_single_session(spark):
    df = spark.range(10).select(F.lit("a").alias("series"), F.col("id").alias("idx"), F.lit(10).cast("bigint").alias("n"))
    got = splits.overlapping_windows(df, 6, 1).collect()
    assert {r.window_id for r in got} == {0} and sorted(r.idx for r in got) == [0, 1, 2, 3, 4, 5]
    with pytest.raises(ValueError):
        splits.overlapping_windows(df, 6, 0)


def test_normal_cdf(spark):
    xs = [x / 7 for x in range(-300, 301)]
    got = spark.createDataFrame([(x,) for x in xs], "x double").select("x", normal_cdf(F.col("x")).alias("p")).collect()
    assert all(r.p == pytest.approx(0.5 * math.erfc(-r.x / math.sqrt(2)), abs=1e-14) for r in got)


def test_no_private_folder_on_a_cluster(tmp_path):
    def session(master, folder):
        return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: folder), sparkContext=SimpleNamespace(master=master, applicationId="app"))

    with pytest.raises(ValueError):
        sinks.scratch_dir(session("yarn", None))
    with pytest.raises(ValueError):
        sinks.scratch_dir(session("local-cluster[3,2,1000]", None))
    assert sinks.scratch_dir(session("yarn", "hdfs:///shared")).startswith("hdfs:///shared/")
    assert os.path.isdir(sinks.scratch_dir(session("local[8]", None)))


def test_ingest_ignores_file_times(spark, tmp_path):
    """Files with old times are read, repeats are stored once however old the stored value is, names keep their form."""
    def land(symbol, name, value, age_days, day="2024-01-02"):
        path = tmp_path / "in" / symbol / name
        os.makedirs(path.parent, exist_ok=True)
        path.write_text(json.dumps({"Meta Data": {}, "Daily": {day: {"1. close": value}}}))
        past = dt.datetime.now().timestamp() - age_days * 86_400
        os.utime(path, (past, past))

    def run():
        ingest_once(spark, f"{tmp_path}/in/*", f"{tmp_path}/out", f"{tmp_path}/state", files_per_batch=1)
        return sorted((r.series, r.ts.isoformat()[:10], r.value) for r in spark.read.parquet(f"{tmp_path}/out").collect())

    land("007", "a.json", "5", 0)
    assert run() == [("007", "2024-01-02", "5")]
    land("B", "b.json", "7", 40)
    for k, age in enumerate((100, 40, 5, 0)):
        land("007", f"again{k}.json", "5", age)
    land("007", "new.json", "6", 400, "1999-01-04")
    assert run() == [("007", "1999-01-04", "6"), ("007", "2024-01-02", "5"), ("B", "2024-01-02", "7")]


def test_asof_grid_before_1970(spark):
    old = dt.datetime(1969, 12, 31)
    rows = [("a", old, None), ("a", old + dt.timedelta(hours=1, minutes=30), 1.0), ("a", old + dt.timedelta(hours=4, minutes=30), 2.0),
            ("a", old + dt.timedelta(hours=6), 3.0), ("a", old + dt.timedelta(hours=6, microseconds=1), 4.0), ("a", old + dt.timedelta(hours=8), None)]
    shifted = [(s, t + dt.timedelta(days=400), y) for s, t, y in rows]
    got, later = ([r.y for r in align.asof_grid(times(spark, x), ["y"], step=HOUR).orderBy("ts").collect()] for x in (rows, shifted))
    assert got == later == [None, None, 1.0, 1.0, 1.0, 2.0, 3.0, 4.0, 4.0]


def test_levels_follow_the_last_known_value(spark):
    history = times(spark, [("a", DAY, 10.0), ("a", DAY + dt.timedelta(days=1), None), ("b", DAY, 4.0)])
    changes = times(spark, [(s, DAY + dt.timedelta(days=d), 10.0) for s in "ab" for d in (2, 3)], value="change").withColumnRenamed("change", "y (%)")
    got = features.from_percent_change(changes, history, ["y"]).where(F.col("ts") > DAY + dt.timedelta(days=1)).orderBy("series", "ts").collect()
    assert [round(r.y, 6) for r in got] == [11.0, 12.1, 4.4, 4.84]


def test_rejected_payloads_are_stored(spark, tmp_path):
    good = {"name": "CPI", "data": [{"date": "2020-01-01", "value": "1.5"}, {"date": "bad", "value": "2.5"}]}
    for name, payload in (("a", good), ("b", {"Note": "rate limit"}), ("c", {"name": "X", "data": []}), ("d", {"symbol": "Y", "quarterlyEarnings": []})):
        folder = tmp_path / "in" / name
        folder.mkdir(parents=True)
        (folder / "f.json").write_text(json.dumps(payload))
    (tmp_path / "in" / "b" / "g.json").write_text("not json")
    paths = [str(tmp_path / x) for x in ("out", "state")]
    for _ in range(2):
        ingest_once(spark, str(tmp_path / "in" / "*"), *paths, files_per_batch=2)
    stored = spark.read.parquet(paths[0]).collect()
    assert [(r.series, r.ts, r.name, r.value) for r in stored] == [("a", dt.datetime(2020, 1, 1), "CPI", "1.5")]
    refused = sorted((r.series, r.reason, r.name, r.value, (r.payload or "")[:8]) for r in spark.read.parquet(paths[0] + "-rejects").collect())
    assert refused == [("a", "no time", "CPI", "2.5", ""), ("b", "unknown shape", None, None, "not json"), ("b", "unknown shape", None, None, '{"Note":'),
                       ("c", "unknown shape", None, None, '{"name":'), ("d", "no values", None, None, '{"symbol')]


def gap(spark, n=45, at=40, value=None):
    """Values 0..n-1 with one replaced."""
    rows = [("a", DAY + dt.timedelta(days=i), i, n, n, value if i == at else float(i)) for i in range(n)]
    return spark.createDataFrame(rows, "series string, ts timestamp_ntz, idx bigint, n bigint, nt bigint, y double")


def test_a_null_inside_a_series(spark):
    train = gap(spark)
    first = lambda df: df.orderBy("step").first().pred
    weights = [(0.7 ** (44 - i)) * (1.0 if i == 0 else 0.3) for i in range(45)]
    level = sum(w * i for i, w in enumerate(weights) if i != 40) / sum(w for i, w in enumerate(weights) if i != 40)
    assert math.isclose(first(naive.smoothed(train, horizon=2)), level)
    assert 41 < first(naive.local_level(train, horizon=2)) < 43
    assert 42 < first(naive.theta(train, horizon=2)) < 44
    assert math.isclose(first(smoothing.exponential_smoothing(train, horizon=2, kinds=("holt",))), 45.0, rel_tol=1e-6)
    assert first(spectral.fft(train, horizon=2)) is None and first(spectral.fft(gap(spark, value=40.0), horizon=2)) is not None


def test_theta_with_a_phase_of_zeros(spark):
    rows = [("a", DAY + dt.timedelta(days=i), i, 30, 30, float(i % 3)) for i in range(30)]
    rows += [("b", DAY + dt.timedelta(days=i), i, 30, 30, float(1 + i % 3)) for i in range(30)]
    train = spark.createDataFrame(rows, "series string, ts timestamp_ntz, idx bigint, n bigint, nt bigint, y double")
    got = naive.theta(train, horizon=3, season=3)
    plain = {(r.series, r.step): r.pred for r in naive.theta(train, horizon=3).collect()}
    for r in got.collect():
        assert r.pred is not None and (r.series == "b" or math.isclose(r.pred, plain[r.series, r.step]))


@pytest.mark.parametrize("q,r,p0", [(0.1, 1.0, 1e6), (1e-8, 1.0, 1e6), (0.0, 2.0, 5.0), (3.0, 0.01, 1.0)])
def test_local_level_of_any_ratio(spark, q, r, p0):
    train = gap(spark, 300, value=7.0)
    m, p = 0.0, p0 - q
    for row in train.orderBy("idx").collect():
        k = (p + q) / (p + q + r)
        m, p = m + k * (row.y - m), (1 - k) * (p + q)
    assert math.isclose(naive.local_level(train, horizon=1, q=q, r=r, p0=p0).first().pred, m, rel_tol=1e-9)


def test_not_a_number_is_read_as_null(spark, tmp_path):
    spark.createDataFrame([("a", 1.0), ("b", float("nan")), (None, None)], "s string, y double").write.parquet(str(tmp_path / "p.parquet"))
    assert {(r.s, r.y) for r in readers.read_panel(spark, str(tmp_path / "p.parquet")).collect()} == {("a", 1.0), ("b", None), (None, None)}
