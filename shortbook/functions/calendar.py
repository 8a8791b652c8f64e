"""Calendar expressions and the first-business-day lookup.

FIXED VALUES (US federal holidays, observed, as they can fall on a Monday):
  New Year's Day Jan 1 (observed Jan 2); Martin Luther King Jr. Day, third
  Monday of January; Washington's Birthday, third Monday of February;
  Memorial Day, last Monday of May; Juneteenth Jun 19 (observed Jun 20,
  from 2021); Independence Day Jul 4 (observed Jul 5); Labor Day, first
  Monday of September; Columbus Day, second Monday of October; Veterans Day
  Nov 11 (observed Nov 12); Christmas Day Dec 25 (observed Dec 26).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def mondays(bounds: DataFrame, start: str = "start", end: str = "end", out: str = "monday") -> DataFrame:
    """Dates from ``start`` to ``end`` in 7-day steps, kept only when
    they are Mondays (so a non-Monday start yields nothing). ``bounds`` has
    one row per range (typically an aggregate of the data's dates)."""
    seq = F.sequence(F.col(start), F.col(end), F.expr("INTERVAL 7 DAYS"))
    days = bounds.where(F.col(start) <= F.col(end)).select(F.explode(seq).alias(out))
    return days.where(F.weekday(out) == 0)


def this_monday(d) -> Column:
    """The Monday of the week of ``d``."""
    return F.date_trunc("week", _c(d)).cast("date")


def current_quarter(d) -> Column:
    """(month - 1) // 3 + 1."""
    return F.quarter(_c(d))


def us_monday_holiday(d) -> Column:
    """True when Monday ``d`` is a US federal holiday (observed)."""
    d = _c(d)
    m, day, y = F.month(d), F.dayofmonth(d), F.year(d)
    return (
        ((m == 1) & day.isin(1, 2))
        | ((m == 1) & day.between(15, 21))
        | ((m == 2) & day.between(15, 21))
        | ((m == 5) & (day >= 25))
        | ((m == 6) & day.isin(19, 20) & (y >= 2021))
        | ((m == 7) & day.isin(4, 5))
        | ((m == 9) & (day <= 7))
        | ((m == 10) & day.between(8, 14))
        | ((m == 11) & day.isin(11, 12))
        | ((m == 12) & day.isin(25, 26))
    )


def holiday_table(calendar: DataFrame, date_col: str = "monday") -> DataFrame:
    """Holiday dates among ``calendar`` by the rule above (a user can pass
    any other holiday table to ``first_business_days``)."""
    return calendar.where(us_monday_holiday(F.col(date_col))).select(F.col(date_col).alias("holiday"))


def first_business_days(calendar: DataFrame, holidays: DataFrame, date_col: str = "monday") -> DataFrame:
    """A Monday that is a holiday moves to Tuesday. ``holidays`` has one
    ``holiday`` date column."""
    h = holidays.select("holiday").distinct()
    j = calendar.join(h, calendar[date_col] == h["holiday"], "left")
    is_h = F.col("holiday").isNotNull()
    return j.select(
        F.col(date_col),
        is_h.alias("is_holiday"),
        F.when(is_h, F.date_add(F.col(date_col), 1)).otherwise(F.col(date_col)).alias("first_business_day"),
    )
