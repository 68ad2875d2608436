"""Calendar arithmetic with PostgreSQL AGE() semantics.

AGE(end, start) counts whole calendar months, borrowing one month when the (day, time of day)
of the later instant is before that of the earlier one; the sign is applied to the whole
result, so AGE(a, b) = -AGE(b, a). ``months_between`` differs (e.g. it gives 1.0 for
2023-01-31 -> 2023-02-28), hence these explicit expressions.
"""

from __future__ import annotations

import datetime as dt  # noqa: F401  (type of ntz_literal's argument)

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _month_index(t: Column) -> Column:
    return F.year(t) * 12 + F.month(t)


def _offset_in_month(t: Column, with_time: bool) -> Column:
    """Position inside the month: the day, plus (with_time) the time of day with fraction."""
    if not with_time:
        return F.dayofmonth(t)
    return (F.dayofmonth(t) * 86400 + F.hour(t) * 3600 + F.minute(t) * 60
            + F.date_part(F.lit("SECOND"), t))


def age_total_months(end: Column | str, start: Column | str, with_time: bool = True) -> Column:
    """Signed whole months of AGE(end, start) (= years*12 + months).

    With d = month index difference: for end >= start one month is borrowed when end's position in
    its month is before start's; for end < start the mirror case adds one back. ``with_time=False``
    is the cheaper form for DATE inputs (midnight on both sides)."""
    kind = "timestamp_ntz" if with_time else "date"
    e = _c(end).cast(kind)
    s = _c(start).cast(kind)
    oe, os_ = _offset_in_month(e, with_time), _offset_in_month(s, with_time)
    d = _month_index(e) - _month_index(s)
    borrow = F.when((e >= s) & (oe < os_), 1).when((e < s) & (oe > os_), -1).otherwise(0)
    return (d - borrow).cast("int")


def age_year_part(end: Column | str, start: Column | str, with_time: bool = True) -> Column:
    """EXTRACT(YEAR FROM AGE(end, start)); truncates toward zero."""
    return (age_total_months(end, start, with_time) / F.lit(12)).cast("int")


def age_month_part(end: Column | str, start: Column | str, with_time: bool = True) -> Column:
    """EXTRACT(MONTH FROM AGE(end, start)); in -11..11 with the sign of the interval."""
    total = age_total_months(end, start, with_time)
    return total - (total / F.lit(12)).cast("int") * 12


def ntz_literal(value: "dt.datetime") -> Column:
    """A wall-clock TIMESTAMP_NTZ literal. (A Python datetime literal would be read as an instant
    in the Python process's local time zone.)"""
    return F.lit(value.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")


def day_of_week0(d: Column | str) -> Column:
    """EXTRACT(DOW): 0 = Sunday ... 6 = Saturday."""
    return F.dayofweek(_c(d)) - 1


def seconds_between(start: Column | str, end: Column | str) -> Column:
    """EXTRACT(EPOCH FROM end - start) as DOUBLE (whole seconds plus fraction)."""
    s = _c(start)
    e = _c(end)
    micros = F.timestamp_diff("MICROSECOND", s, e)
    return micros.cast("double") / F.lit(1_000_000.0)
