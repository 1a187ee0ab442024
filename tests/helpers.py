from __future__ import annotations

import datetime as dt

import numpy as np

START = dt.datetime(2020, 1, 1)


def panel(spark, series: dict[str, list], value: str = "y"):
    """Daily panel with idx, n and nt (all rows train) from lists of values."""
    rows = [
        (s, START + dt.timedelta(days=i), i, len(vs), len(vs), None if v is None else float(v))
        for s, vs in series.items() for i, v in enumerate(vs)
    ]
    return spark.createDataFrame(rows, f"series string, ts timestamp_ntz, idx bigint, n bigint, nt bigint, {value} double")


def by_series(df, value: str, order: str = "idx") -> dict[str, list]:
    out: dict[str, list] = {}
    for r in sorted(df.select("series", order, f"`{value}`").collect(), key=lambda r: (r[0], r[1])):
        out.setdefault(r[0], []).append(r[2])
    return out


def skewed(seed: int = 0, gaps: float = 0.3) -> dict[str, list]:
    """Series of very different length; one holds more than a third of all rows."""
    rng = np.random.default_rng(seed)
    sizes = {"hot": 120, "a": 40, "b": 31, "c": 1, "d": 7, "e": 50}
    return {
        s: [None if rng.random() < gaps else round(float(rng.normal(10, 3)), 3) for _ in range(n)] for s, n in sizes.items()
    }
