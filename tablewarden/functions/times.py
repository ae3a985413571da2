"""Dates and epoch numbers, independent of the session time zone."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from tablewarden.functions.naming import as_column


def _epoch() -> Column:
    return F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'")


def from_epoch_millis(millis: Column | str) -> Column:
    """Milliseconds since 1970 as a UTC timestamp without zone."""
    return F.timestamp_add("MILLISECOND", as_column(millis), _epoch())


def from_epoch_seconds(seconds: Column | str) -> Column:
    """Seconds since 1970 as a UTC timestamp without zone."""
    return F.timestamp_add("SECOND", as_column(seconds), _epoch())


def to_epoch_millis(ts: Column | str) -> Column:
    """Whole milliseconds since 1970 of a timestamp without zone."""
    return F.timestamp_diff("MILLISECOND", _epoch(), as_column(ts))


def to_epoch_seconds(ts: Column | str) -> Column:
    """Whole seconds since 1970 of a timestamp without zone."""
    return F.timestamp_diff("SECOND", _epoch(), as_column(ts))


def run_stamp(ts: Column | str) -> Column:
    """``yyyyMMddHHmmss`` text of a run time."""
    return F.date_format(as_column(ts), "yyyyMMddHHmmss")


def time_literal(moment: datetime | None) -> Column:
    """A moment as a timestamp without zone; through text, so no session zone shifts it."""
    text = None if moment is None else moment.isoformat(sep=" ")
    return F.lit(text).cast("timestamp_ntz")


def processing_date(run_date: date | str) -> Column:
    """The run date as a DATE literal; always injected, never taken from the clock."""
    return F.lit(str(run_date)).cast("date")
