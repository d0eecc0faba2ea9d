"""Timestamp parsing and arithmetic on naive (``timestamp_ntz``) values."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

from edflux.constants import DATE_TEXT_PATTERN, PURCHASE_TIME_PATTERN
from edflux.functions.casts import blank_to_null


_USUAL_TIME = r"\A[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}\z"


def parse_purchase_time(c: Column) -> Column:
    """Text with or without a fraction of a second to ``timestamp_ntz``; anything else is null.

    Date-only text, a ``T`` separator, a zone suffix or an empty string give null. The
    lenient ``try_to_timestamp`` only decides validity; the value comes from the
    zone-free ``to_timestamp_ntz``, so the session time zone never shifts it. Text of the usual
    shape is cast, which needs no formatter.
    """
    fmt = F.lit(PURCHASE_TIME_PATTERN)
    usual = F.when(c.rlike(_USUAL_TIME), c.try_cast("timestamp_ntz"))
    return F.coalesce(usual, F.when(F.try_to_timestamp(c, fmt).isNotNull(), F.to_timestamp_ntz(c, fmt)))


def parse_strict_timestamp(c: Column) -> Column:
    """Text to ``timestamp_ntz``, failing the job on malformed text; blank is null."""
    return F.to_timestamp_ntz(blank_to_null(c))


def parse_day(c: Column, lenient: bool = False) -> Column:
    """``yyyy-MM-dd`` text to a date; other text fails the job, or is null if ``lenient``."""
    return (F.try_to_date if lenient else F.to_date)(blank_to_null(c), "yyyy-MM-dd")


def day_text(c: Column) -> Column:
    """Format as ``yyyy-MM-dd``; null stays null. A date of four-digit years is written so without a formatter."""
    day = c.cast("date")
    usual = (day >= F.lit("0001-01-01").cast("date")) & (day <= F.lit("9999-12-31").cast("date"))
    return F.when(usual, day.cast("string")).otherwise(F.date_format(c, DATE_TEXT_PATTERN))


def minus_days(c: Column, days: int) -> Column:
    """Subtract whole days; the type stays ``timestamp_ntz``."""
    return c - F.make_dt_interval(F.lit(days))


def as_timestamp_ntz(value: datetime | date | str) -> Column:
    """Literal ``timestamp_ntz`` from a Python value, independent of the session zone."""
    if isinstance(value, str):
        value = datetime.fromisoformat(value)
    if not isinstance(value, datetime):
        value = datetime(value.year, value.month, value.day)
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def normalize_as_of(value: datetime | date | str) -> datetime:
    if isinstance(value, str):
        value = datetime.fromisoformat(value)
    if not isinstance(value, datetime):
        value = datetime(value.year, value.month, value.day)
    return value.replace(tzinfo=None)


def midnight(value: datetime) -> datetime:
    return datetime(value.year, value.month, value.day)


def days_before(value: datetime, days: int) -> datetime:
    return value - timedelta(days=days)
