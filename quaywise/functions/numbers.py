"""Exact integer rounding.

The queries round half away from zero on exact quotients. Rounding a double
would depend on how the quotient happens to be represented, so the quotient is
rounded in integers and only the rounded result becomes a double.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _long(value: Column) -> Column:
    return value.cast("bigint")


WIDE = "decimal(38,0)"


def round_div(num: Column, den: Column, scale: int, kind: str = "bigint") -> Column:
    """``num * scale / den`` rounded half away from zero, as bigint.

    ``num`` and ``den`` are integers and ``den`` is not negative; the result is
    NULL where ``den`` is 0 or NULL. ``kind`` is the type to calculate in.
    """
    num, den = num.cast(kind), den.cast(kind)
    twice = F.abs(num) * F.lit(2 * scale).cast(kind) + den
    halves = F.nullif(den * F.lit(2).cast(kind), F.lit(0).cast(kind))
    magnitude = F.call_function("div", twice, halves)
    return F.when(num < 0, -magnitude).otherwise(magnitude)


def round_ratio(num: Column, den: Column, digits: int, kind: str = "bigint") -> Column:
    """``round(num / den, digits)`` as double."""
    return round_div(num, den, 10**digits, kind).cast("double") / F.lit(float(10**digits))


def ratio(num: Column, den: Column) -> Column:
    """Unrounded quotient as double; NULL where ``den`` is 0 or NULL."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def int_div(num: Column, den: Column) -> Column:
    """Integer quotient truncated toward zero; NULL where ``den`` is 0."""
    return F.call_function("div", _long(num), F.nullif(_long(den), F.lit(0).cast("bigint")))


def percent_change(now: Column, before: Column, digits: int = 1) -> Column:
    """Change in percent, NULL where there is no base."""
    return round_ratio((_long(now) - _long(before)) * 100, before, digits)


def count_where(flag: Column) -> Column:
    """Number of rows where ``flag`` is true, as bigint (0 for no rows)."""
    return F.count(F.when(flag, F.lit(1)))


def sum_where(flag: Column, value: Column) -> Column:
    """Sum of ``value`` where ``flag`` is true; 0 where no row qualifies."""
    return F.coalesce(F.sum(F.when(flag, _long(value))), F.lit(0).cast("bigint"))


def any_flag(flag: Column) -> Column:
    """1 when any row of the group has ``flag``, else 0 (NULL counts as no)."""
    return F.max(F.when(flag, F.lit(1)).otherwise(F.lit(0)))
