"""Time arithmetic on timestamp_ntz columns that never touches the session zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY = 86_400
HOUR = 3_600


def epoch_seconds(ts: Column) -> Column:
    """Whole seconds since 1970-01-01 as a bigint."""
    days = F.datediff(ts, F.lit("1970-01-01").cast("date")).cast("bigint")
    return days * DAY + F.hour(ts) * HOUR + F.minute(ts) * 60 + F.second(ts)


def epoch_micros(ts: Column) -> Column:
    """Microseconds since 1970-01-01 as a bigint."""
    fraction = F.pmod(F.date_part(F.lit("SECOND"), ts), F.lit(1).cast("decimal(8,6)"))
    return epoch_seconds(ts) * 1_000_000 + (fraction * 1_000_000).cast("bigint")


def from_epoch(seconds: Column) -> Column:
    days = F.floor(seconds / DAY).cast("int")
    rest = F.pmod(seconds, F.lit(DAY)).cast("int")
    return F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(days, F.lit(0), F.lit(0), rest)


def plus_seconds(ts: Column, seconds: Column) -> Column:
    days = F.floor(seconds / DAY).cast("int")
    rest = F.pmod(seconds, F.lit(DAY)).cast("int")
    return ts + F.make_dt_interval(days, F.lit(0), F.lit(0), rest)


def floor_to(ts: Column, step: int) -> Column:
    """Start of the `step`-second cell that holds `ts` (cells start at the epoch)."""
    s = epoch_seconds(ts)
    return from_epoch(s - F.pmod(s, F.lit(step)))


def time_block(ts: Column, seconds: Column) -> Column:
    """Number of the `seconds` long cell of a timestamp; order-preserving."""
    return F.floor(epoch_seconds(ts) / seconds).cast("bigint")


def next_steps(last_ts: Column, step_no: Column, freq: str = "D") -> Column:
    """Timestamp `step_no` (1-based) steps after `last_ts`; freq D, B (Mon-Fri) or H."""
    if freq == "D":
        return plus_seconds(last_ts, step_no * DAY)
    if freq == "H":
        return plus_seconds(last_ts, step_no * HOUR)
    if freq == "B":
        # a weekend start counts from its Friday, then every 5 steps span 7 days
        wd = F.weekday(last_ts)
        back = F.greatest(wd - 4, F.lit(0))
        pos = F.least(wd, F.lit(4)) + step_no
        days = step_no + 2 * F.floor(pos / 5).cast("int") - back
        return plus_seconds(last_ts, days * DAY)
    raise ValueError(f"unknown frequency {freq!r}")
