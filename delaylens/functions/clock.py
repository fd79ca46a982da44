"""Dates, HHMM clock texts and scheduled instants (UTC, without a time zone)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss"


def clock_text(hhmm: Column, fold_midnight: bool = True) -> Column:
    """``HHMM`` as ``HH:MM:00``; hour 24 becomes 23:59 when ``fold_midnight`` is set."""
    hour, minute = F.substring(hhmm, 1, 2), F.substring(hhmm, 3, 2)
    text = F.concat(hour, F.lit(":"), minute, F.lit(":00"))
    return F.when(hour == "24", F.lit("23:59:00")).otherwise(text) if fold_midnight else text


def compact_date(yyyymmdd: Column) -> Column:
    """``YYYYMMDD`` as an ISO date text."""
    return F.concat(
        F.substring(yyyymmdd, 1, 4), F.lit("-"),
        F.substring(yyyymmdd, 5, 2), F.lit("-"),
        F.substring(yyyymmdd, 7, 2),
    )


def scheduled_at(date: Column, hhmm: Column) -> Column:
    """Instant of an ``HHMM`` clock text on a date; NULL for a text that is no clock time."""
    return F.concat(date.cast("string"), F.lit(" "), clock_text(hhmm)).try_cast("timestamp_ntz")


def next_day(instant: Column) -> Column:
    return instant + F.expr("INTERVAL 1 DAY")


def after_departure(departure: Column, arrival: Column) -> Column:
    """Move an arrival that lies before its departure to the next day."""
    return F.when(arrival < departure, next_day(arrival)).otherwise(arrival)


def after_departure_clock(departure: Column, arrival: Column) -> Column:
    """Same rule on the time of day alone, whatever dates the two instants carry."""
    earlier = F.date_format(arrival, "HHmmss") < F.date_format(departure, "HHmmss")
    return F.when(earlier, next_day(arrival)).otherwise(arrival)


def iso_text(instant: Column) -> Column:
    return F.date_format(instant, ISO_SECONDS)


def seconds_between(start: Column, end: Column) -> Column:
    return F.timestamp_diff("SECOND", start, end)


def day_of_week(date: Column, monday: int = 1) -> Column:
    """Day of the week counted from Monday, ISO numbering unless ``monday`` says otherwise."""
    return F.weekday(date) + F.lit(monday)
