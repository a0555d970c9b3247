"""Date helpers shared by the operators."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_start(ts: Column) -> Column:
    """First day of the month of a date or timestamp, as a date."""
    return F.trunc(F.to_date(ts), "month")


def as_date(value: str | _dt.date | _dt.datetime) -> _dt.date:
    if isinstance(value, _dt.datetime):
        return value.date()
    if isinstance(value, _dt.date):
        return value
    return _dt.date.fromisoformat(str(value)[:10])


def first_of_month(value: str | _dt.date | _dt.datetime) -> _dt.date:
    d = as_date(value)
    return d.replace(day=1)


def add_months(value: _dt.date | _dt.datetime, months: int):
    """Calendar month arithmetic that clamps to the month end (like
    ``ts - interval n month`` in Spark SQL), keeping the time of day."""
    year = value.year + (value.month - 1 + months) // 12
    month = (value.month - 1 + months) % 12 + 1
    if month == 12:
        last = 31
    else:
        last = (_dt.date(year, month + 1, 1) - _dt.timedelta(days=1)).day
    return value.replace(year=year, month=month, day=min(value.day, last))


def literal_of(value, dtype):
    """A date/timestamp literal of the given Spark type, built from its ISO
    text so the Python process time zone plays no part."""
    if isinstance(value, _dt.datetime):
        text = value.isoformat(sep=" ")
    elif isinstance(value, _dt.date):
        text = value.isoformat()
    else:
        text = str(value)
    return F.lit(text).cast(dtype)
