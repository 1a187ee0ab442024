"""Fourier sums against numpy: whole, in four steps, and by chirps where the length has no fitting divisor."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelloom.forecast import spectral

SIZES = {"a": 1, "b": 2, "c": 37, "d": 36, "e": 97, "f": 64, "g": 211, "h": 120}


@pytest.mark.parametrize("local,top", [(1 << 16, None), (12, None), (1, None), (12, 5)])
def test_spectrum(spark, local, top):
    rng = np.random.default_rng(3)
    values = {s: rng.normal(size=n) for s, n in SIZES.items()}
    rows = [(s, i, len(x), float(v)) for s, x in values.items() for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "series string, idx bigint, nt bigint, v double")
    found = {}
    for r in spectral.spectrum(df, max_freq=top, local=local).collect():
        found.setdefault(r.series, {})[r.k] = (r.re, r.im, r.amp, r.nt)
    for s, x in values.items():
        want = np.fft.fft(x)[: len(x) // 2 + 1][: None if top is None else top + 1]
        assert sorted(found[s]) == list(range(len(want)))
        for k, w in enumerate(want):
            assert np.allclose(found[s][k], (w.real, -w.imag, abs(w), len(x)), atol=1e-8)


def test_empty_table(spark):
    df = spark.createDataFrame([], "series string, idx bigint, nt bigint, v double")
    assert spectral.spectrum(df).collect() == []


def test_forecast_repeats_a_wave(spark):
    wave = spark.range(60).select(F.lit("s").alias("series"), F.col("id").alias("idx"), F.lit(60).alias("nt"), F.timestamp_seconds(F.col("id") * 86400).cast("timestamp_ntz").alias("ts"),
                                  (5 + 2 * F.cos(2 * np.pi * F.col("id") / 12)).alias("y"))
    got = [r.pred for r in spectral.fft(wave, horizon=12, keep=2).orderBy("step").collect()]
    assert np.allclose(got, 5 + 2 * np.cos(2 * np.pi * np.arange(12) / 12))
