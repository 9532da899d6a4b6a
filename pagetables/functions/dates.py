"""Publication dates kept as text, and the recency test against a given day."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Date part of a date text, accepted year-month-day text (one- or two-digit month and day), stamp of a run.
DATE_PART_PATTERN = r"(?s)^([^T]*(?=T)|.{0,10})"
DAY_PATTERN = r"^[0-9]{4}-(?:1[0-2]|0[1-9]|[1-9])-(?:3[01]|[12][0-9]|0[1-9]|[1-9]| [1-9])\z"
RUN_STAMP_FORMAT = "yyyy-MM-dd_HH-mm-ss"


def as_day(value: Column | dt.date | str) -> Column:
    if isinstance(value, Column):
        return value.cast("date")
    return F.lit(str(value)).cast("date")


def date_part_text(text: Column) -> Column:
    """The text before the first capital T, or the first ten characters when there is none."""
    return F.regexp_extract(text, DATE_PART_PATTERN, 1)


def parse_day(text: Column) -> Column:
    """DATE, or null for text that is not a calendar day. Never throws under ANSI mode."""
    return F.try_to_date(F.replace(F.regexp_extract(text, DAY_PATTERN, 0), F.lit(" "), F.lit("")), "yyyy-M-d")


def is_recent(text: Column, as_of: Column | dt.date | str, days_limit: int) -> Column:
    """True when the day in `text` is `as_of` or one of the `days_limit` days before it; never null."""
    age = F.datediff(as_day(as_of), parse_day(date_part_text(text)))
    # The same as 0 <= age <= days_limit, but the date is parsed once.
    in_range = F.abs(age * 2 - days_limit) <= days_limit
    return F.coalesce(in_range, F.lit(False))


def run_stamp(ts: Column) -> Column:
    return F.date_format(ts, RUN_STAMP_FORMAT)
