"""Date parsing and date arithmetic."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from trialmart.functions.text import WHITESPACE

# The accepted date forms are year-month-day, month/day/year and day/month/year;
# the first two may carry a time of day. They are tried in this order. Fields may have one
# digit, and any whitespace may surround the text and stand before the time.
_TIME = rf"{WHITESPACE}+(?:2[0-3]|[01]?[0-9]):[0-5]?[0-9]:[0-5]?[0-9]"
_DASHED = r"((?!0000)[0-9]{4}-[0-9]{1,2}-[0-9]{1,2})"
_SLASHED = r"([0-9]{1,2}/[0-9]{1,2}/(?!0000)[0-9]{4})"
YEAR_FIRST = rf"(?U)^{WHITESPACE}*{_DASHED}(?:{_TIME})?{WHITESPACE}*$"
MONTH_FIRST = rf"(?U)^{WHITESPACE}*{_SLASHED}(?:{_TIME})?{WHITESPACE}*$"
DAY_FIRST = rf"(?U)^{WHITESPACE}*{_SLASHED}{WHITESPACE}*$"


def parse_date(c: Column) -> Column:
    """First accepted form that yields a real calendar date, else NULL.

    A pattern picks the date part out of text of its own shape, and a cast that gives NULL
    for impossible days reads it. No date parser runs, and fails, on text of another shape.
    """

    def slashed(form: str, order: str) -> Column:
        day = F.regexp_extract(c, form, 1)
        return F.regexp_replace(day, r"^([0-9]+)/([0-9]+)/([0-9]+)$", order).try_cast("date")

    return F.coalesce(
        F.regexp_extract(c, YEAR_FIRST, 1).try_cast("date"),
        slashed(MONTH_FIRST, "$3-$1-$2"),
        slashed(DAY_FIRST, "$3-$2-$1"),
    )


def duration_days(start: Column, end: Column) -> Column:
    """Days from start to end; NULL when either is missing, negative when reversed."""
    return F.datediff(end, start)


def date_key(d: Column) -> Column:
    """Date as a yyyymmdd integer."""
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def key_date(key: Column) -> Column:
    """The date a yyyymmdd integer stands for."""
    whole = key.cast("int")
    return F.make_date(
        F.floor(whole / 10000).cast("int"),
        F.floor(F.pmod(whole, F.lit(10000)) / 100).cast("int"),
        F.pmod(whole, F.lit(100)).cast("int"),
    )


def first_year(as_of: dt.date, years: int) -> Column:
    """The year `years` before the one of `as_of`."""
    return F.year(F.lit(as_of)) - years


def month_start(year: Column, month: Column) -> Column:
    return F.make_date(year, month, F.lit(1))
