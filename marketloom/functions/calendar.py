"""Calendar parts and date parsing."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's for right results: year-month-day, day/month/year, month/day/year and
# year/month/day, tried in this order. One-letter patterns accept one or two digits.
DATE_FORMATS = ["yyyy-M-d", "d/M/yyyy", "M/d/yyyy", "yyyy/M/d"]

WEEKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]


def shape(fmt: str) -> str:
    """What text in a date format looks like, as a regular expression."""
    digits = {"yyyy": r"\d{4}", "M": r"\d{1,2}", "d": r"\d{1,2}"}
    return "^" + re.sub("yyyy|M|d", lambda m: digits[m.group()], fmt) + "$"


def parse_date(column: Column | str, fmt: str) -> Column:
    """Timestamp at midnight of the date written in ``fmt``, null for other text; needs no time zone.

    Text of another shape is sorted out first: a failing parse costs far more than a pattern match.
    """
    value = F.col(column) if isinstance(column, str) else column
    return F.when(value.rlike(shape(fmt)), F.try_to_date(value, fmt)).cast("timestamp_ntz")


def iso_year(column: Column | str) -> Column:
    return F.extract(F.lit("YEAROFWEEK"), F.col(column) if isinstance(column, str) else column).cast("int")


def in_dates(column: Column | str, first: str, last: str) -> Column:
    """Inclusive range on the date part, written as a half-open range on the timestamp so that scans can use it."""
    value = F.col(column) if isinstance(column, str) else column
    low, after = F.to_date(F.lit(first)), F.date_add(F.to_date(F.lit(last)), 1)
    return (value >= low.cast("timestamp_ntz")) & (value < after.cast("timestamp_ntz"))


def season(month: Column) -> Column:
    """1 December-February, 2 March-May, 3 June-August, 4 else; a missing month counts as 4."""
    return (
        F.when(month.isin(12, 1, 2), 1).when(month.isin(3, 4, 5), 2).when(month.isin(6, 7, 8), 3).otherwise(4)
    ).cast("int")


def date_parts(column: str) -> dict[str, Column]:
    """The eleven calendar features of a date column; flags of a missing date are 0."""
    d = F.col(column)
    day = F.to_date(d)

    def flag(condition: Column) -> Column:
        return F.coalesce(condition, F.lit(False)).cast("int")

    return {
        "year": F.year(d),
        "month": F.month(d),
        "day": F.dayofmonth(d),
        "day_of_week": F.weekday(d),
        "day_of_year": F.dayofyear(d),
        "week_of_year": F.weekofyear(d),
        "quarter": F.quarter(d),
        "is_weekend": flag(F.weekday(d) >= 5),
        "is_month_start": flag(F.dayofmonth(d) == 1),
        "is_month_end": flag(F.last_day(day) == day),
        "season": season(F.month(d)),
    }
