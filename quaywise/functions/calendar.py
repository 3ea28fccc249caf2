"""Calendar and clock attributes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Public holidays of France as (name, month, day) and as
# (name, days after Easter Sunday).
FIXED_HOLIDAYS = (
    ("1er janvier", 1, 1),
    ("1er mai", 5, 1),
    ("8 mai", 5, 8),
    ("14 juillet", 7, 14),
    ("Assomption", 8, 15),
    ("Toussaint", 11, 1),
    ("11 novembre", 11, 11),
    ("Noël", 12, 25),
)
EASTER_HOLIDAYS = (("Lundi de Pâques", 1), ("Ascension", 39), ("Lundi de Pentecôte", 50))


def _month_name(month: Column, pattern: str) -> Column:
    return F.lower(F.date_format(F.make_date(F.lit(2018), month, F.lit(1)), pattern))


def date_attributes(d: Column) -> dict[str, Column]:
    """Every attribute of the date dimension, from a date column."""
    weekday = F.weekday(d) + 1  # Monday is 1
    month, quarter, year = F.month(d), F.quarter(d), F.year(d)
    year_text = F.date_format(d, "yyyy")
    month_short = F.lower(F.date_format(d, "MMM"))
    iso_week = F.weekofyear(d)
    iso_week_text = F.lpad(iso_week.cast("string"), 2, "0")
    quarter_start = (quarter - 1) * 3 + 1
    return {
        "tk_date": year * 10000 + month * 100 + F.dayofmonth(d),
        "date": d,
        "date_first_day_of_week": F.date_sub(d, weekday - 1),
        "date_last_day_of_week": F.date_add(d, 7 - weekday),
        "date_medium": F.concat(F.date_format(d, "dd"), F.lit(" "), month_short),
        "day_in_month": F.dayofmonth(d),
        "is_first_day_of_month": F.dayofmonth(d) == 1,
        "is_first_day_of_week": weekday == 1,
        "is_first_month_of_quarter": month.isin(1, 4, 7, 10),
        "is_last_day_of_month": F.last_day(d) == d,
        "is_last_day_of_week": weekday == 7,
        "is_last_month_of_quarter": month.isin(3, 6, 9, 12),
        "month_abbreviation": month_short,
        "month_medium": F.concat(month_short, F.lit(" "), year_text),
        "month_name": F.lower(F.date_format(d, "MMMM")),
        "month_number": month,
        "month_number_2digits": F.date_format(d, "MM"),
        "month_tk": year * 100 + month,
        "quarter_first_month": _month_name(quarter_start, "MMMM"),
        "quarter_last_month": _month_name(quarter_start + 2, "MMMM"),
        "quarter_name": F.when(quarter == 1, "1er").otherwise(
            F.concat(quarter.cast("string"), F.lit("ème"))
        ),
        "quarter_number": quarter,
        "quarter_tk": year * 10 + quarter,
        "week_in_month": iso_week - F.weekofyear(F.trunc(d, "MM")) + 1,
        "week_in_year": F.concat(year_text, F.lit("-S"), iso_week_text),
        "week_medium": F.concat(F.lit("S"), iso_week_text, year_text),
        "week_number": F.lit(None).cast("int"),
        "year_month_abbreviation": F.concat(year_text, F.lit("-"), month_short),
        "year_month_number": F.date_format(d, "yyyy-MM"),
        "year_quarter": F.concat(year_text, F.lit("-T"), quarter.cast("string")),
        "year4": year,
        "season": F.lit(None).cast("string"),
    }


def clock_attributes(second_of_day: Column) -> dict[str, Column]:
    """Every attribute of the time dimension, from a second of the day."""
    hour = F.call_function("div", second_of_day, F.lit(3600)).cast("int")
    minute = F.call_function("div", F.pmod(second_of_day, F.lit(3600)), F.lit(60)).cast("int")
    second = F.pmod(second_of_day, F.lit(60)).cast("int")

    def two(part: Column) -> Column:
        return F.lpad(part.cast("string"), 2, "0")

    return {
        "tk_time": (hour * 10000 + minute * 100 + second).cast("int"),
        "hour": hour,
        "minute": minute,
        "second": second,
        "day_moment": F.when(hour >= 12, "Soir").otherwise("Matin"),
        "hour_date": F.concat_ws(":", two(hour), two(minute), two(second)),
        "hour_2digits": two(hour),
        "minute_2digits": two(minute),
        "second_2digits": two(second),
    }


def easter_sunday(year: Column) -> Column:
    """Gregorian Easter by the published Meeus/Jones/Butcher method."""

    def div(value: Column, by: int) -> Column:
        return F.call_function("div", value, F.lit(by))

    golden = year % 19
    century, in_century = div(year, 100), year % 100
    skipped_leap = div(century - div(century + 8, 25) + 1, 3)
    epact = (golden * 19 + century - div(century, 4) - skipped_leap + 15) % 30
    to_sunday = (
        F.lit(32) + (century % 4) * 2 + div(in_century, 4) * 2 - epact - in_century % 4
    ) % 7
    correction = div(golden + epact * 11 + to_sunday * 22, 451)
    march_based = epact + to_sunday - correction * 7 + 114
    return F.make_date(year, div(march_based, 31).cast("int"), (march_based % 31 + 1).cast("int"))


def holidays(year: Column) -> Column:
    """Array of (name, date) structs, the public holidays of a year."""
    entries = [
        F.struct(F.lit(name).alias("name"), F.make_date(year, F.lit(m), F.lit(d)).alias("date"))
        for name, m, d in FIXED_HOLIDAYS
    ] + [
        F.struct(
            F.lit(name).alias("name"), F.date_add(easter_sunday(year), offset).alias("date")
        )
        for name, offset in EASTER_HOLIDAYS
    ]
    return F.array(*entries)
