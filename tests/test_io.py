"""Sources, payloads, sinks and the incremental ingest."""

import datetime as dt
import json
import os

import pytest
from pyspark.errors import PySparkException
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from panelloom.sources import payloads, readers, sinks
from panelloom.streaming.ingest import ingest_once
from tests.helpers import panel

A = {"Meta Data": {}, "Time Series": {"2020-01-02": {"1. open": "10.0", "4. Close": "11.0"}}}
B = {"symbol": "X", "quarterlyEarnings": [{"fiscalDateEnding": "2020-03-31", "reportedEPS": "1.2"}]}
B2 = {"symbol": "X", "annualEarnings": [{"fiscalDateEnding": "2019-12-31", "reportedEPS": "4"}]}
C = {"name": "CPI", "data": [{"date": "2020-01-01", "value": "257.9"}, {"date": "2020-02-01", "value": "."}]}
ODD = [{"note": "limit reached"}, {"data": [{"date": "2020-01-01", "value": "1", "more": 2}]}, {}]


def frame(spark, *objects):
    return spark.createDataFrame([(i, json.dumps(o)) for i, o in enumerate(objects)], "id int, payload string")


def test_three_shapes(spark):
    got = sorted((r.id, r.shape, r.ts, r.fields) for r in payloads.parse_payloads(frame(spark, A, B, B2, C)).collect())
    day = lambda *d: dt.datetime(*d)
    assert got == [
        (0, "A", day(2020, 1, 2), {"open": "10.0", "close": "11.0"}),
        (1, "B", day(2020, 3, 31), {"reportedEPS": "1.2"}),
        (2, "B", day(2019, 12, 31), {"reportedEPS": "4"}),
        (3, "C", day(2020, 1, 1), {"CPI": "257.9"}),
        (3, "C", day(2020, 2, 1), {"CPI": None}),
    ]


def test_unknown_shapes(spark):
    df = frame(spark, A, *ODD)
    assert [r.id for r in payloads.rejected(df).orderBy("id").collect()] == [1, 2, 3]
    assert payloads.parse_payloads(df).count() == 1
    with pytest.raises(PySparkException, match="unknown data structure"):
        payloads.parse_payloads(df, strict=True).collect()


def test_format_by_extension(spark, tmp_path):
    df = panel(spark, {"s": [1, None, 3]}).select("series", "ts", "y")
    sinks.write_csv(df, f"{tmp_path}/p.csv")
    df.write.parquet(f"{tmp_path}/p.parquet")
    for name in ("p.csv", "p.parquet"):
        back = readers.read_panel(spark, f"{tmp_path}/{name}", df.schema)
        assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
    with pytest.raises(ValueError):
        readers.read_panel(spark, f"{tmp_path}/p.xlsx")


def test_folder_tree(spark, tmp_path):
    for ticker, name, lines in (("AAPL", "daily", ["ts,y", "2020-01-01,1.5"]), ("BRK B", "daily", ["ts,y", "2020-01-02,2"])):
        os.makedirs(tmp_path / ticker)
        (tmp_path / ticker / f"{name}.csv").write_text("\n".join(lines))
    (tmp_path / "AAPL" / "notes.txt").write_text("ignored")
    got = sorted(map(tuple, readers.read_tree(spark, str(tmp_path), "ts timestamp_ntz, y double").collect()))
    assert got == [("AAPL", "daily", dt.datetime(2020, 1, 1), 1.5), ("BRK B", "daily", dt.datetime(2020, 1, 2), 2.0)]


def test_leaderboard_keeps_versions(spark, tmp_path):
    path, first = f"{tmp_path}/board", ["loss", "second"]
    one = spark.createDataFrame([("a", 2.0, 1.0), ("b", 1.0, 1.0), ("a", 2.0, 1.0)], "name string, loss double, second double")
    two = spark.createDataFrame([("a", 2.0, 1.0, None), ("c", 0.5, 9.0, "x")], "name string, loss double, second double, note string")
    assert sinks.update_leaderboard(one, path, first) == 1
    assert sinks.update_leaderboard(two, path, first) == 2
    board = sinks.read_leaderboard(spark, path)
    assert board.columns == ["loss", "second", "name", "note"]
    assert [tuple(r) for r in board.orderBy("loss").collect()] == [(0.5, 9.0, "c", "x"), (1.0, 1.0, "b", None), (2.0, 1.0, "a", None)]


def test_best_settings_only_improve(spark, tmp_path):
    path = f"{tmp_path}/best"
    assert sinks.save_if_better(spark, path, {"lr": 1}, 0.5, None)
    assert not sinks.save_if_better(spark, path, {"lr": 2}, 0.7, 0.5)
    assert sinks.save_if_better(spark, path, {"lr": 3}, 0.1, 0.5)
    assert sinks.best_settings(spark, path) == {"lr": 3}


def test_writers_side_by_side_lose_nothing(spark, tmp_path):
    """Four writers update one leaderboard, one record and one registry at the same time."""
    from concurrent.futures import ThreadPoolExecutor

    board, best, registered = f"{tmp_path}/board", f"{tmp_path}/best", f"{tmp_path}/registry"

    def write(k):
        versions = []
        for i in range(2):
            row = spark.createDataFrame([(f"{k}-{i}", float(10 * k + i))], "name string, loss double")
            versions.append(sinks.update_leaderboard(row, board, ["loss"]))
        sinks.save_if_better(spark, best, {"lr": k}, 4.0 - k, None)
        try:
            sinks.register_model(spark, registered, "panel", "linear/a", f"m{k}", "settings", "1")
        except ValueError:
            return versions, 0
        return versions, 1

    with ThreadPoolExecutor(4) as pool:
        done = list(pool.map(write, range(4)))
    assert sorted(v for versions, _ in done for v in versions) == list(range(1, 9))
    rows = sinks.read_leaderboard(spark, board)
    assert {r.name for r in rows.collect()} == {f"{k}-{i}" for k in range(4) for i in range(2)}
    assert sinks.best_settings(spark, best) == {"lr": 3}
    assert sum(won for _, won in done) == 1 == spark.read.parquet(registered).count()
    with pytest.raises(ValueError):
        sinks.read_leaderboard(spark, f"{tmp_path}/none")


def test_trial_prefix(spark):
    df = spark.createDataFrame([(1, 2.0)], "number int, user_attrs_val_MAPE double")
    assert sinks.trial_columns(df).columns == ["number", "val_MAPE"]


def test_model_and_registry(spark, tmp_path):
    data = spark.createDataFrame([(Vectors.dense([float(x)]), 2.0 * x + 1) for x in range(5)], ["features", "label"])
    model = LinearRegression().fit(data)
    sinks.save_fitted(model, f"{tmp_path}/m")
    assert LinearRegressionModel.load(f"{tmp_path}/m").coefficients[0] == pytest.approx(2.0)
    for version in ("20240102", "20240301"):
        sinks.register_model(spark, f"{tmp_path}/registry", "panel", "linear", f"{tmp_path}/m", "settings", version)
    from panelloom.operators.ranking import latest_version

    assert latest_version(spark.read.parquet(f"{tmp_path}/registry"), by=["dataset", "model"]).first().version == "20240301"


def test_series_ids_follow_names(spark):
    df = panel(spark, {"b": [1], "a": [2], "aa": [3]}).withColumn("pred", F.col("y"))
    got = {r.stock_name: r.series_id for r in sinks.prediction_rows(df, "m").collect()}
    assert got == {"a": 0, "aa": 1, "b": 2}


def test_ingest_is_incremental_and_keeps_old_dates(spark, tmp_path):
    def land(symbol, name, obj):
        os.makedirs(tmp_path / "in" / symbol, exist_ok=True)
        (tmp_path / "in" / symbol / name).write_text(json.dumps(obj))

    def days(**values):
        return {"Meta Data": {}, "Daily": {d.replace("_", "-")[1:]: {"1. close": v} for d, v in values.items()}}

    def run():
        ingest_once(spark, f"{tmp_path}/in/*", f"{tmp_path}/out", f"{tmp_path}/state", files_per_batch=1)
        return sorted((r.series, r.ts.isoformat()[:10], r.value) for r in spark.read.parquet(f"{tmp_path}/out").collect())

    land("X", "1.json", days(d2024_01_02="5"))
    land("Y", "1.json", days(d2024_01_02="7"))
    assert run() == [("X", "2024-01-02", "5"), ("Y", "2024-01-02", "7")]
    # fetched again, with a new day and a very old one
    land("X", "2.json", days(d2024_01_02="5", d2024_01_03="6", d1999_01_04="1"))
    assert run() == [("X", "1999-01-04", "1"), ("X", "2024-01-02", "5"), ("X", "2024-01-03", "6"), ("Y", "2024-01-02", "7")]
    assert len(run()) == 4


def test_staged_tables_lie_in_the_shared_folder(spark):
    df = panel(spark, {"s": [1, None]}).withColumnRenamed("y", "y (%)")
    staged = sinks.stage(df)
    assert sorted(map(tuple, staged.collect()), key=str) == sorted(map(tuple, df.collect()), key=str)
    assert spark.conf.get("spark.checkpoint.dir") in staged.inputFiles()[0]
