"""Forecast by the strongest frequencies of a series."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from panelloom.forecast.naive import KEYS, ends
from panelloom.operators import blocks
from panelloom.sources.sinks import stage

LOCAL = 1 << 16  # values that one task transforms


def _groups(rows: DataFrame, by: str, along: str, out: str, turn: Callable[[pd.DataFrame, np.ndarray], np.ndarray], keys: Sequence[str]) -> DataFrame:
    """Transforms of every group (keys, `by`) along its numbers `along`, which become `out`; `turn` may multiply the result."""
    carried = [c for c in rows.columns if c not in (*keys, by, along, "re", "im")]
    ddl = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in [*keys, by, *carried])

    def local(pdf: pd.DataFrame) -> pd.DataFrame:
        x = np.zeros(len(pdf), dtype=complex)
        x[pdf[along].to_numpy()] = pdf["re"].to_numpy() + 1j * pdf["im"].to_numpy()
        found = turn(pdf, np.fft.fft(x))
        frame = pdf[[*keys, by, *carried]].iloc[[0] * len(x)].reset_index(drop=True)
        return frame.assign(**{out: np.arange(len(x)), "re": found.real, "im": found.imag})

    return rows.groupBy(*keys, by).applyInPandas(local, f"{ddl}, {out} bigint, re double, im double")


def _four_steps(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Transforms of rows (keys, n, n1, i, re, im), i = 0..n-1, n1 a divisor of n: (keys, n, k, re, im).

    With n = n1 * n2: transforms of length n1 over every n2-th value, a twiddle factor, transforms of length n2.
    """
    n2 = F.expr("n div n1")
    cut = rows.select(*keys, "n", "n1", F.expr("i div (n div n1)").alias("i1"), (F.col("i") % n2).alias("i2"), "re", "im")

    def twiddle(pdf: pd.DataFrame, x: np.ndarray) -> np.ndarray:
        return x * np.exp(-2j * np.pi * int(pdf["i2"].iloc[0]) * np.arange(len(x)) / int(pdf["n"].iloc[0]))

    first = _groups(cut, "i2", "i1", "k1", twiddle, keys)
    second = _groups(first, "k1", "i2", "k2", lambda pdf, x: x, keys)
    return second.select(*keys, "n", (F.col("k1") + F.col("n1") * F.col("k2")).alias("k"), "re", "im")


def _chirp(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Transforms of any length n as a convolution of length m, a power of two of at least 2n - 1."""
    power = F.ceil(F.log2((2 * F.col("n") - 1).cast("double")))
    m, side = (F.pow(F.lit(2.0), p).cast("bigint") for p in (power, F.floor(power / 2)))
    # i * i modulo 2n keeps the angle small
    angle = F.lit(math.pi) * ((F.col("i") * F.col("i")) % (2 * F.col("n"))) / F.col("n")
    long = rows.select(*keys, "n", "i", "re", "im", F.cos(angle).alias("c"), F.sin(angle).alias("s"), m.alias("m"), side.alias("n1"))
    length = long.groupBy(*keys).agg(F.max("n").alias("size"), F.max("m").alias("m"), F.max("n1").alias("n1"))
    # zeros up to m; the chirp stands at both ends
    zero = F.lit(0.0)
    pad = length.select(*keys, F.col("m").alias("n"), "n1", F.explode(F.sequence(F.col("size"), F.col("m") - 1)).alias("i"), zero.alias("re"), zero.alias("im"))
    signal = long.select(*keys, F.col("m").alias("n"), "n1", "i", (F.col("re") * F.col("c") + F.col("im") * F.col("s")).alias("re"),
                         (F.col("im") * F.col("c") - F.col("re") * F.col("s")).alias("im")).unionByName(pad)
    right = long.select(*keys, F.col("m").alias("n"), "n1", "i", F.col("c").alias("re"), F.col("s").alias("im"))
    left = long.where("i > 0").select(*keys, F.col("m").alias("n"), "n1", (F.col("m") - F.col("i")).alias("i"), F.col("c").alias("re"), F.col("s").alias("im"))
    middle = length.where("2 * size - 1 < m").select(*keys, F.col("m").alias("n"), "n1", F.explode(F.sequence(F.col("size"), F.col("m") - F.col("size"))).alias("i"), zero.alias("re"), zero.alias("im"))
    a = _four_steps(signal, keys).withColumnsRenamed({"re": "ar", "im": "ai"})
    b = _four_steps(right.unionByName(left).unionByName(middle), keys).drop("n")
    both = a.join(b, [*keys, "k"]).join(length.select(*keys, "n1"), list(keys))
    # the inverse transform is the transform of the conjugate, conjugated, over m
    product = both.select(*keys, "n", "n1", F.col("k").alias("i"), (F.col("ar") * F.col("re") - F.col("ai") * F.col("im")).alias("re"),
                          (-F.col("ar") * F.col("im") - F.col("ai") * F.col("re")).alias("im"))
    folded = _four_steps(product, keys).select(*keys, F.col("k").alias("i"), (F.col("re") / F.col("n")).alias("x"), (-F.col("im") / F.col("n")).alias("y"))
    done = long.select(*keys, "n", "i", "c", "s").join(folded, [*keys, "i"])
    return done.select(*keys, "n", F.col("i").alias("k"), (F.col("x") * F.col("c") + F.col("y") * F.col("s")).alias("re"), (F.col("y") * F.col("c") - F.col("x") * F.col("s")).alias("im"))


def spectrum(train: DataFrame, *, max_freq: int | None = None, value: str = "v", keys: Sequence[str] = KEYS, local: int = LOCAL) -> DataFrame:
    """Fourier sums (keys, k, re, im, nt, amp) for k = 0..n/2, or up to `max_freq`.

    A series of at most `local` values is transformed by one task.  A longer one of n = n1 * n2 values is cut into n2 strided
    parts of n1 values, whose transforms are exchanged once and transformed again; where no divisor near the root of n
    exists, as for a prime, a convolution with a chirp of a length of two to some power takes its place.  Work is
    n log n, and no task holds more than `local` values as long as n stays below `local` squared.  Positions `idx` run from 0 to
    nt - 1 without a gap.
    """
    keys = list(keys)
    rows = train.select(*keys, F.col("nt").cast("bigint").alias("n"), F.col("idx").cast("bigint").alias("i"), F.col(value).cast("double").alias("re"), F.lit(0.0).alias("im"))
    divisors = F.filter(F.sequence(F.lit(1).cast("bigint"), F.floor(F.sqrt("n"))), lambda d: F.col("n") % d == 0)
    sizes = rows.where("n > 0").groupBy("n").agg(F.lit(1).alias("_")).select("n", F.when(F.col("n") <= local, F.col("n")).otherwise(F.array_max(divisors)).alias("n1"))
    way = F.when(F.col("n1") == F.col("n"), "whole").when(F.expr("n div n1") <= local, "steps").otherwise("chirp")
    sizes = stage(sizes.withColumn("way", way))
    found = {r.way for r in sizes.select("way").distinct().collect()}
    cut = rows.join(sizes, "n")

    def part(name: str) -> DataFrame:
        return cut.where(F.col("way") == name).drop("way")

    parts = []
    if "whole" in found or not found:
        one = part("whole").withColumn("_one", F.lit(0))
        parts.append(_groups(one, "_one", "i", "k", lambda pdf, x: x, keys).select(*keys, "n", "k", "re", "im"))
    if "steps" in found:
        parts.append(_four_steps(part("steps"), keys))
    if "chirp" in found:
        parts.append(_chirp(part("chirp").drop("n1"), keys))
    top = F.expr("n div 2") if max_freq is None else F.least(F.expr("n div 2"), F.lit(max_freq).cast("bigint"))
    sums = reduce(DataFrame.unionByName, parts).where(F.col("k") <= top)
    sums = sums.select(*keys, "k", "re", (-F.col("im")).alias("im"), F.col("n").alias("nt"))
    return sums.withColumn("amp", F.sqrt(F.col("re") * F.col("re") + F.col("im") * F.col("im")))


def strongest(spec: DataFrame, keep: int, *, keys: Sequence[str] = KEYS) -> DataFrame:
    """The `keep` frequencies of largest amplitude; ties go to the lower frequency."""
    w = W.partitionBy(*keys).orderBy(F.col("amp").desc(), "k")
    return spec.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= keep).drop("_r")


def polynomial_basis(degree: int) -> list:
    """Powers of the position relative to the training length, 0..degree."""
    z = F.col("idx") / F.col("nt")
    return [F.lit(1.0) if i == 0 else F.pow(z, F.lit(float(i))) for i in range(degree + 1)]


def fft(train: DataFrame, *, horizon: int, keep: int = 10, trend: str | None = None, degree: int = 3,
        max_freq: int | None = None, keys: Sequence[str] = KEYS, y: str = "y", freq: str = "D") -> DataFrame:
    """Remove an optional trend (poly or exp), keep the strongest frequencies, continue periodically.

    A transform needs every value: a series with a null has null forecasts and is to be filled before.
    """
    from panelloom.forecast.linear import coefficients, normal_equations

    keys = list(keys)
    base, data = ends(train, keys, known=F.count(y)), train.withColumn("v", F.col(y).cast("double"))
    deg = 1 if trend == "exp" else degree
    if trend:
        target = F.log(y) if trend == "exp" else F.col(y)
        fitted = coefficients(normal_equations(train, keys, polynomial_basis(deg), [target]), deg + 1).select(*keys, "beta")
        data = blocks.lookup(data, fitted, keys)
        base = base.join(fitted, keys)

        def level():
            value = sum((F.col("beta")[i] * b for i, b in enumerate(polynomial_basis(deg)[1:], 1)), F.col("beta")[0])
            return F.exp(value) if trend == "exp" else value

        data = data.withColumn("v", F.col("v") - level())
    waves = strongest(spectrum(data, max_freq=max_freq, keys=keys), keep, keys=keys)
    packed = waves.groupBy(*keys).agg(F.collect_list(F.struct("k", "re", "im")).alias("waves"))  # `keep` entries
    rows = base.join(packed, keys).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(horizon))))
    rows = rows.withColumn("idx", F.col("nt") - 1 + F.col("step"))

    def wave(acc, e):
        angle = F.lit(2 * math.pi) * ((e["k"] * F.col("idx")) % F.col("nt")) / F.col("nt")
        # every frequency but 0 and n/2 stands for itself and its mirror image
        double = F.when((e["k"] == 0) | (e["k"] * 2 == F.col("nt")), 1.0).otherwise(2.0)
        return acc + double * (e["re"] * F.cos(angle) + e["im"] * F.sin(angle)) / F.col("nt")

    pred = F.aggregate("waves", F.lit(0.0), wave)
    if trend:
        pred = pred + level()
    pred = F.when(F.col("known") == F.col("nt"), pred)
    from panelloom.functions.timeaxis import next_steps

    return rows.select(*keys, "step", next_steps(F.col("last_ts"), F.col("step"), freq).alias("ts"), pred.alias("pred"))
