"""Calendar-quarter column expressions.

All results are DATE (never a session-zone TIMESTAMP), so a bucket key means
the same thing on every executor whatever its clock zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def as_date(x) -> Column:
    """DATE from a DATE, TIMESTAMP or TIMESTAMP_NTZ column."""
    return _c(x).cast("date")


def parse_day(text) -> Column:
    """Parse ``yyyy-MM-dd`` text; malformed text gives null (never raises)."""
    return F.try_to_timestamp(_c(text), F.lit("yyyy-MM-dd")).cast("date")


def quarter_start(d) -> Column:
    """First day of the calendar quarter (left-closed 3-month bucket)."""
    return F.trunc(as_date(d), "quarter")


def quarter_end(d) -> Column:
    """Last day of the calendar quarter: 03-31, 06-30, 09-30 or 12-31."""
    return F.last_day(F.add_months(quarter_start(d), 2))


def quarter_end_offset(d) -> Column:
    """Anchored quarter-end offset: roll forward to the quarter end, and a date
    that already is a quarter end moves on to the next one."""
    return quarter_end(F.date_add(as_date(d), 1))


def quarter_label(d) -> Column:
    """Text label ``yyyyQn`` (for 4-digit years text order is time order)."""
    d = as_date(d)
    return F.concat(F.year(d).cast("string"), F.lit("Q"), F.quarter(d).cast("string"))
