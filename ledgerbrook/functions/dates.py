"""Calendar expressions over 8-digit ``yyyyMMdd`` days and dates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Digits of a lenient day: year, month and a day of any length, after optional blanks.
_LENIENT_DAY = r"^[ \t]*([0-9]{4})([0-9]{2})([0-9]+)"
# More days than the calendar has, up to the year 9999.
_DAYS = 4_000_000


def parse_day(text: Column, *, lenient: bool = False) -> Column:
    """``yyyyMMdd`` text as a date.

    Strict: NULL unless it is exactly a real calendar day.  Lenient: a month or day
    out of range rolls over (``20140231`` is 3 March) and trailing text is ignored;
    all digits after the month are the day, and one beyond the year 9999 gives NULL.
    """
    if lenient:
        part = [F.regexp_extract(text, _LENIENT_DAY, i).try_cast("int") for i in (1, 2, 3)]
        year_start = F.concat(F.lpad(part[0].cast("string"), 4, "0"), F.lit("-01-01")).try_cast("date")
        days = F.when(part[2] < _DAYS, part[2])
        rolled = F.date_add(F.add_months(year_start, part[1] - 1), days - 1)
        return F.when(F.year(rolled) <= 9999, rolled)
    dashed = F.concat_ws("-", F.substring(text, 1, 4), F.substring(text, 5, 2), F.substring(text, 7, 2))
    # The cast from yyyy-MM-dd is far cheaper than a pattern-driven parser.
    return F.when(F.length(text) == 8, dashed.try_cast("date"))


def day_key(day: Column) -> Column:
    """A date as ``yyyyMMdd`` text."""
    return F.date_format(day, "yyyyMMdd")


def day_name(day: Column) -> Column:
    """Sunday .. Saturday."""
    return F.date_format(day, "EEEE")


def day_features(day: Column) -> dict[str, Column]:
    """Day of year, month and ISO weekday (Monday = 1 .. Sunday = 7)."""
    return {
        "day_of_year": F.dayofyear(day),
        "month": F.month(day),
        "day_of_week": F.weekday(day) + 1,
    }


def future_days(anchor: DataFrame, start: Column, horizon: int) -> DataFrame:
    """``horizon`` consecutive days from ``start``, for each row of ``anchor`` (usually one)."""
    days = F.sequence(start, F.date_add(start, horizon - 1))
    return anchor.select(F.explode(days).alias("report_date"))
