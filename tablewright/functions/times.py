"""Dates and instants. The reference day is always an argument, never the clock inside a query."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

CENTRAL = "America/Chicago"


def central_date(instant: Column) -> Column:
    """Calendar day in US Central time of an instant held in UTC."""
    return F.to_date(F.from_utc_timestamp(instant.cast("timestamp"), CENTRAL))


def central_today() -> Column:
    return F.to_date(F.from_utc_timestamp(F.current_timestamp(), CENTRAL))


def iso_to_utc(text: Column) -> Column:
    return F.try_to_timestamp(text, F.lit("yyyy-MM-dd'T'HH:mm:ssXXX"))


def compact_date(text: Column) -> Column:
    return F.to_date(F.try_to_timestamp(text, F.lit("yyyyMMdd")))


def timestamp_date(text: Column) -> Column:
    return F.to_date(F.try_to_timestamp(text))


def day_before(as_of: date, days: int = 1) -> date:
    return as_of - timedelta(days=days)


def _instant(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def after_yesterday(column: Column, as_of: date) -> Column:
    """Strictly after one second before yesterday's midnight."""
    return column > _instant(f"{day_before(as_of, 2)} 23:59:59")


def since_yesterday(column: Column, as_of: date) -> Column:
    """At or after yesterday's midnight."""
    return column >= _instant(f"{day_before(as_of)} 00:00:00")
