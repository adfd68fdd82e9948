"""Calendar arithmetic as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_key(day: Column) -> Column:
    """Smart key YYYYMMDD."""
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def year_of(key: Column) -> Column:
    return F.call_function("div", key, F.lit(10000)).cast("int")


def month_of(key: Column) -> Column:
    """Month of a smart key, as YYYYMM."""
    return F.call_function("div", key, F.lit(100)).cast("int")


def monday_on_or_after(day: Column) -> Column:
    return F.date_add(day, (7 - F.weekday(day)) % 7)


def easter_sunday(year: Column) -> Column:
    """Gregorian Easter from the golden number, the paschal full moon and the next Sunday.

    Knuth's form (TAOCP 1.3.2, exercise 14): find the full moon as a day counted from
    1 March, then move to the following Sunday. Integer arithmetic only.
    """
    def div(a: Column, b: int) -> Column:
        return F.call_function("div", a, F.lit(b)).cast("int")

    golden = year % 19 + 1
    century = div(year, 100) + 1
    leap_drop = div(century * 3, 4) - 12
    moon_fix = div(century * 8 + 5, 25) - 5
    sunday = div(year * 5, 4) - leap_drop - 10
    epact = F.pmod(golden * 11 + 20 + moon_fix - leap_drop, F.lit(30))
    epact = F.when(((epact == 25) & (golden > 11)) | (epact == 24), epact + 1).otherwise(epact)
    moon = F.lit(44) - epact
    moon = F.when(moon < 21, moon + 30).otherwise(moon)
    march_day = moon + 7 - (sunday + moon) % 7
    return F.date_add(F.make_date(year, F.lit(3), F.lit(1)), (march_day - 1).cast("int"))
