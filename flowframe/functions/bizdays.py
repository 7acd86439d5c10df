"""Working-day arithmetic (Monday to Friday) in closed form."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONDAY = "1969-12-29"  # a Monday on or before the epoch


def parse_day(x: Column) -> Column:
    """The day of a text that starts with yyyyMMdd or with year, month, day in separate parts."""
    s = x.cast("string")
    digits = F.regexp_replace(s, r"^\W*(\d{1,4})\W+(\d{1,2})\W+(\d{1,2}).*$", "$1-$2-$3")
    compact = F.concat_ws("-", F.substring(s, 1, 4), F.substring(s, 5, 2), F.substring(s, 7, 2))
    return F.when(s.rlike(r"^\w+$"), compact.try_cast("date")).otherwise(digits.try_cast("date"))


def add_workdays(day: Column, n: Column | int) -> Column:
    """The day on which the n-th working day after `day` is reached; `day` itself for n < 1."""
    n = F.lit(n) if isinstance(n, int) else n
    wd = F.weekday(day)
    wd5 = F.least(wd, F.lit(4))
    steps = wd5 + n
    moved = F.date_add(day, (F.floor(steps / 5) * 7 + F.pmod(steps, F.lit(5)) - wd).cast("int"))
    return F.when(n < 1, day).otherwise(moved)


def subtract_workdays(day: Column, n: Column | int) -> Column:
    """The day on which the n-th working day before `day` is reached; `day` itself for n < 1."""
    n = F.lit(n) if isinstance(n, int) else n
    wd = F.weekday(day)
    # a weekend counts from the Monday after it
    base = F.when(wd >= 5, F.date_add(day, (F.lit(7) - wd).cast("int"))).otherwise(day)
    wd5 = F.when(wd >= 5, F.lit(0)).otherwise(wd)
    steps = wd5 - n
    moved = F.date_add(base, (F.floor(steps / 5) * 7 + F.pmod(steps, F.lit(5)) - wd5).cast("int"))
    return F.when(n < 1, day).otherwise(moved)


def workdays_between(start: Column, end: Column) -> Column:
    """Working days in [start, end); zero when end is not after start."""

    def before(day: Column) -> Column:
        days = F.datediff(day, F.lit(MONDAY).cast("date"))
        return F.floor(days / 7) * 5 + F.least(F.pmod(days, F.lit(7)), F.lit(5))

    return F.greatest(before(end) - before(start), F.lit(0)).cast("int")


def last_day_of_month(day: Column) -> Column:
    return F.last_day(day)


def _back_to_friday(day: Column) -> Column:
    return F.date_sub(day, F.greatest(F.weekday(day) - F.lit(4), F.lit(0)).cast("int"))


def last_workday_of_month(day: Column) -> Column:
    return _back_to_friday(F.last_day(day))


def last_workday_of_quarter(day: Column) -> Column:
    """Quarters end in January, April, July and October."""
    # months to the quarter's end: 0 for Jan, Apr, Jul, Oct; 2 for Nov, Feb, May, Aug
    ahead = F.pmod(F.lit(1) - F.month(day), F.lit(3))
    return _back_to_friday(F.last_day(F.add_months(F.trunc(day, "month"), ahead)))
