"""Calendar parts, cyclic encodings and US federal holidays as column expressions."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Number of steps in one cycle of each attribute.
PERIODS = {"week": 52, "month": 12, "quarter": 4, "dayofweek": 7, "hour": 24, "dayofyear": 365}

_PARTS: dict[str, Callable[[Column], Column]] = {
    "year": F.year,
    "month": F.month,
    "quarter": F.quarter,
    "week": F.weekofyear,
    "day": F.dayofmonth,
    "dayofweek": F.weekday,
    "dayofyear": F.dayofyear,
    "hour": F.hour,
}

# Which parts are derived for a time axis of each frequency.
PARTS_BY_FREQ = {
    "D": ["year", "month", "day", "dayofweek", "dayofyear", "week"],
    "H": ["year", "month", "hour"],
    "B": ["year", "month"],
}


def date_part(ts: Column, attribute: str) -> Column:
    """One calendar attribute; Monday is day 0 and weeks are ISO weeks."""
    return _PARTS[attribute](ts)


def date_parts(ts: Column, freq: str | None) -> list[Column]:
    """the parts that make sense for a frequency, none when it is unknown."""
    return [date_part(ts, a).alias(a) for a in PARTS_BY_FREQ.get(freq, [])]


def calendar_covariates(ts: Column, attributes: Sequence[str] = ("week", "month", "quarter")) -> list[Column]:
    """calendar attributes as float covariates."""
    return [date_part(ts, a).cast("float").alias(a) for a in attributes]


def cyclic(value: Column, period: float) -> tuple[Column, Column]:
    """sine and cosine of a value that repeats every `period`."""
    angle = value * F.lit(2 * math.pi / period)
    return F.sin(angle), F.cos(angle)


def cyclic_parts(ts: Column, attributes: Sequence[str] = ("week", "month", "quarter")) -> list[Column]:
    out = []
    for a in attributes:
        s, c = cyclic(date_part(ts, a), PERIODS[a])
        out += [s.alias(f"{a}_sin"), c.alias(f"{a}_cos")]
    return out


def in_zone(ts: Column, tz: str = "Europe/Paris") -> Column:
    """F8: shift a UTC timestamp to local time of a zone."""
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), ts)


def infer_frequency(df: DataFrame, *, ts: str = "ts") -> DataFrame:
    """label of the time axis: H, D, B (gaps only over weekends) or null.

    Steps are differences of consecutive distinct timestamps; distinct times are ordered per
    time block and the first step of a block looks back through the block table.
    """
    from panelloom.sources.sinks import stage
    from panelloom.operators.blocks import block_seconds, over_halo, rank_in_order
    from panelloom.functions.timeaxis import DAY, HOUR, epoch_micros, time_block

    distinct = stage(df.select(F.col(ts).alias("t")).distinct())
    times = distinct.withColumn("_tb", time_block(F.col("t"), block_seconds(distinct, "t")))
    ranked = rank_in_order(times, keys=[], blocks=["_tb"], order=["t"]).withColumn("_one", F.lit(0))
    steps = over_halo(
        ranked,
        {"step": lambda w: epoch_micros(F.col("t")) - epoch_micros(F.lag("t").over(w))},
        before=1, series="_one",
    )
    weekday, step, second = F.weekday("t"), F.col("step"), 1_000_000
    return steps.agg(
        F.min(step).alias("lo"), F.max(step).alias("hi"),
        F.max(weekday).alias("last_weekday"),
        F.every((step == DAY * second) | ((weekday == 0) & (step == 3 * DAY * second))).alias("weekend_gaps"),
        F.count(F.lit(1)).alias("n_times"),
    ).select(
        F.when(F.col("n_times") < 3, None)
        .when((F.col("lo") == DAY * second) & (F.col("hi") == DAY * second), "D")
        .when((F.col("lo") == HOUR * second) & (F.col("hi") == HOUR * second), "H")
        .when(F.col("weekend_gaps") & (F.col("last_weekday") <= 4), "B")
        .alias("freq"),
        F.col("n_times"), F.floor(F.col("lo") / second).alias("min_step"), F.floor(F.col("hi") / second).alias("max_step"),
    )


def _nth_weekday(ts: Column, month: int, weekday: int, first_day: int) -> Column:
    day = F.dayofmonth(ts)
    return (F.month(ts) == month) & (F.weekday(ts) == weekday) & day.between(first_day, first_day + 6)


def _observed(ts: Column, month: int, day: int) -> Column:
    """A fixed date on Monday-Friday, else the Friday before or the Monday after it."""
    wd = F.weekday(ts)

    def on(d: Column) -> Column:
        return (F.month(d) == month) & (F.dayofmonth(d) == day)

    date = F.to_date(ts)
    return (on(date) & (wd <= 4)) | (on(F.date_add(date, 1)) & (wd == 4)) | (on(F.date_sub(date, 1)) & (wd == 0))


def is_us_holiday(ts: Column) -> Column:
    """true at midnight of an observed US federal holiday."""
    rules = [
        _observed(ts, 1, 1),
        _nth_weekday(ts, 1, 0, 15) & (F.year(ts) >= 1986),
        _nth_weekday(ts, 2, 0, 15),
        _nth_weekday(ts, 5, 0, 25),
        _observed(ts, 6, 19) & (F.year(ts) >= 2021),
        _observed(ts, 7, 4),
        _nth_weekday(ts, 9, 0, 1),
        _nth_weekday(ts, 10, 0, 8),
        _observed(ts, 11, 11),
        _nth_weekday(ts, 11, 3, 22),
        _observed(ts, 12, 25),
    ]
    at_midnight = F.to_date(ts).cast("timestamp_ntz") == ts
    return at_midnight & reduce(lambda a, b: a | b, rules)


def holiday_flag(ts: Column) -> Column:
    return F.when(is_us_holiday(ts), 1.0).otherwise(0.0)


def holiday_table(spark: SparkSession, first_year: int, last_year: int) -> DataFrame:
    """Observed holidays as a dimension: at most a dozen rows per year, so safe to broadcast."""
    days = spark.range(0, (last_year - first_year + 1) * 366).select(
        F.date_add(F.lit(f"{first_year}-01-01").cast("date"), F.col("id").cast("int")).cast("timestamp_ntz").alias("ts")
    )
    return days.filter((F.year("ts") <= last_year) & is_us_holiday(F.col("ts")))


def holidays_of(df: DataFrame, *, ts: str = "ts") -> DataFrame:
    """Holidays of all years that `df` touches; two numbers reach the driver."""
    first, last = df.agg(F.min(F.year(ts)), F.max(F.year(ts))).first()
    return holiday_table(df.sparkSession, first or 1970, last or 1970)


def join_holidays(df: DataFrame, holidays: DataFrame, *, ts: str = "ts") -> DataFrame:
    """Membership of a timestamp in the holiday dimension."""
    dim = holidays.select(F.col("ts").alias(ts), F.lit(1.0).alias("holiday"))
    return df.join(dim, ts, "left").fillna(0.0, ["holiday"])


def encode_times(df: DataFrame, encoders: dict[str, Callable[[Column], Column]], *, ts: str = "ts") -> DataFrame:
    """K1: user-defined time encoders, each a function from the time column to a value column."""
    return df.select("*", *[make(F.col(ts)).cast(T.DoubleType()).alias(name) for name, make in encoders.items()])
