"""Wall-clock arithmetic on TIMESTAMP_NTZ, independent of the session zone."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

# First and last day of the date dimension.
CALENDAR_FIRST = date(2015, 1, 1)
CALENDAR_LAST = date(2040, 1, 1)

UNKNOWN_KEY = -1


def ntz(moment: datetime) -> Column:
    return F.lit(moment.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")


def day(value: date) -> Column:
    return F.lit(value.isoformat()).cast("date")


def shift_minutes(ts: Column, minutes: Column) -> Column:
    return ts + F.lit(timedelta(minutes=1)) * minutes.cast("int")


def shift_seconds(ts: Column, seconds: Column) -> Column:
    return ts + F.lit(timedelta(seconds=1)) * seconds


def shift_hours(ts: Column, hours: int) -> Column:
    return ts + F.make_dt_interval(F.lit(0), F.lit(hours), F.lit(0), F.lit(0))


def hour_floor(ts: Column) -> Column:
    """Start of the clock hour, still without a zone."""
    return ts - F.make_dt_interval(
        F.lit(0), F.lit(0), F.minute(ts), F.extract(F.lit("SECOND"), ts)
    )


def hour_ceil(ts: Column) -> Column:
    floor = hour_floor(ts)
    return F.when(floor == ts, ts).otherwise(shift_hours(floor, 1))


def delay_minutes(expected: Column, aimed: Column) -> Column:
    """Minutes late, rounded half away from zero; 0 where a time is missing."""
    # half minutes are whole seconds, so what is below a second decides nothing
    seconds = F.abs(expected - aimed).cast("bigint")
    minutes = F.call_function("div", seconds + 30, F.lit(60).cast("bigint"))
    signed = F.when(expected < aimed, -minutes).otherwise(minutes)
    return F.coalesce(signed.cast("int"), F.lit(0))


def date_key(value: Column) -> Column:
    """yyyymmdd as int, -1 for a missing date or one outside the calendar."""
    in_calendar = value.between(day(CALENDAR_FIRST), day(CALENDAR_LAST))
    number = F.year(value) * 10000 + F.month(value) * 100 + F.dayofmonth(value)
    return F.coalesce(F.when(in_calendar, number), F.lit(UNKNOWN_KEY)).cast("int")


def time_key(ts: Column) -> Column:
    """hhmmss as int, -1 for a missing time."""
    # by whole numbers: hour(), minute() and second() build a date and a time each
    second = (ts - ts.cast("date").cast("timestamp_ntz")).cast("int")
    hours = F.call_function("div", second, F.lit(3600))
    minutes = F.call_function("div", second, F.lit(60))
    number = hours * 10000 + (minutes - hours * 60) * 100 + second - minutes * 60
    return F.coalesce(number, F.lit(UNKNOWN_KEY).cast("bigint")).cast("int")


def key_of(value: date) -> int:
    return value.year * 10000 + value.month * 100 + value.day


def key_to_date(key: Column) -> Column:
    """Inverse of :func:`date_key`; NULL for the unknown member."""
    known = F.when(key > 0, key)
    year = F.call_function("div", known, F.lit(10000)).cast("int")
    month = F.call_function("div", F.pmod(known, F.lit(10000)), F.lit(100)).cast("int")
    return F.make_date(year, month, F.pmod(known, F.lit(100)).cast("int"))


def keys_to_ts(date_tk: Column, time_tk: Column) -> Column:
    """Date key plus time key as a timestamp; NULL when either is unknown."""
    known = F.when(time_tk >= 0, time_tk)
    hours = F.call_function("div", known, F.lit(10000)).cast("int")
    minutes = F.call_function("div", F.pmod(known, F.lit(10000)), F.lit(100)).cast("int")
    seconds = F.pmod(known, F.lit(100)).cast("int")
    return key_to_date(date_tk).cast("timestamp_ntz") + F.make_dt_interval(
        F.lit(0), hours, minutes, seconds
    )


def keys_to_hour(date_tk: Column, time_tk: Column) -> Column:
    """Start of the clock hour of a date key and a time key; NULL if unknown."""
    hours = F.call_function("div", F.when(time_tk >= 0, time_tk), F.lit(10000)).cast("int")
    return key_to_date(date_tk).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), hours)


def days_before(as_of: datetime, days: int) -> date:
    return as_of.date() - timedelta(days=days)
