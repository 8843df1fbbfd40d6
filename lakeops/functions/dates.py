"""Dates, month and week labels, durations."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta
from functools import reduce
from operator import and_

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakeops.functions.text import blank_to_null

# Accepted layouts, tried in this order. Single letters take one or two digits.
DATE_LAYOUTS = ["yyyy-M-d H:m:s", "yyyy-M-d", "d-M-yyyy H:m:s", "d-M-yyyy", "d/M/yyyy"]


def parse_date(text: Column, layouts: Sequence[str] = DATE_LAYOUTS) -> Column:
    """First layout that fits gives the timestamp; text no layout fits becomes null."""
    return parse_clean_date(blank_to_null(text), layouts)


def parse_clean_date(text: Column, layouts: Sequence[str] = DATE_LAYOUTS) -> Column:
    """The same for a column that :func:`blank_to_null` has been applied to; every layout looks at it anew.

    A text that does not fit costs an exception, so a layout is only tried on texts with its separators.
    """
    tried = [F.when(_may_fit(text, layout), F.try_to_timestamp(text, F.lit(layout))) for layout in layouts]
    return F.coalesce(*tried).cast("timestamp_ntz")


def _may_fit(text: Column, layout: str) -> Column:
    """False for most texts the layout does not fit, and for none that it does.

    Letters stand for digits, a year for four at least, and each may have a sign; a layout with anything else is tried always.
    """
    if set(layout) - set("yMdHms-/: "):
        return F.lit(True)
    tests = [text.contains(c) if c in layout else ~text.contains(c) for c in " :/"]
    if "-" in layout:
        tests.append(text.contains("-"))  # elsewhere it may be a sign
    day = layout.split(" ")[0]
    between = day.strip("yMd")[:1]
    if between and day.startswith("yyyy"):
        tests.append(~F.substring(text, 2, 2).contains(between))
    if between and day.endswith("yyyy"):
        tests.append(~F.substring(F.substring_index(text, " ", 1), -3, 2).contains(between))
    return reduce(and_, tests)


def month_label(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def week_label(day: Column) -> Column:
    """``2024-W07``: Monday-first weeks, days before the first Monday are week 00."""
    week = F.floor((F.dayofyear(day) + 6 - F.weekday(day)) / 7)
    return F.concat(F.year(day).cast("string"), F.lit("-W"), F.lpad(week.cast("string"), 2, "0"))


def month_start_back(day: Column, months: int) -> Column:
    """First day of the month ``months`` before the month of ``day``."""
    return F.add_months(F.trunc(day, "MM"), -months)


def month_index(start: Column, later: Column) -> Column:
    """Calendar months from ``start`` to ``later``, whatever the day of the month."""
    return (F.year(later) - F.year(start)) * 12 + (F.month(later) - F.month(start))


def minutes_between(start: Column, end: Column) -> Column:
    """Minutes with two decimals; null when either end is missing."""
    seconds = F.unix_timestamp(end) - F.unix_timestamp(start)
    return F.round(seconds.cast("decimal(20,0)") / 60, 2).cast("double")


def previous_period(first: date, last: date) -> tuple[date, date]:
    """The period of equal length that ends the day before ``first``."""
    if first > last:
        raise ValueError(f"period starts after it ends: {first} > {last}")
    days = (last - first).days + 1
    return first - timedelta(days=days), first - timedelta(days=1)
