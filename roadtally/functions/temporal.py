"""Dates and times. All values are wall-clock times without a zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from roadtally.functions.text import col_of, strip

# The accepted spellings of a date joined to a time.
DATETIME_FORMATS = ("M/d/yyyy H:mm[:ss]", "yyyy-MM-dd H:mm[:ss]", "yyyy-MM-dd'T'HH:mm:ss[.SSS] H:mm[:ss]")

# Weekday order of the charts.
WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")


def try_ts(c: Column | str) -> Column:
    """Timestamp of a text or timestamp column, null where it cannot be read."""
    return col_of(c).try_cast("timestamp_ntz")


def combine_datetime(date: Column | str, time: Column | str) -> Column:
    """One timestamp from date text and time text, null if either is missing or invalid."""
    both = F.concat(strip(date), F.lit(" "), strip(time))
    parsed = [F.try_to_timestamp(both, F.lit(fmt)) for fmt in DATETIME_FORMATS]
    return F.coalesce(*parsed).cast("timestamp_ntz")


def day_number(ts: Column | str) -> Column:
    """0 = Monday ... 6 = Sunday."""
    return F.weekday(try_ts(ts))


def day_type(ts: Column | str) -> Column:
    """'Weekend' for Saturday and Sunday, else 'Weekday' (also for an unreadable time)."""
    return F.when(F.weekday(try_ts(ts)) >= 5, "Weekend").otherwise("Weekday")


def date_parts(ts: Column | str) -> dict[str, Column]:
    t = try_ts(ts)
    return {
        "year": F.year(t),
        "month": F.month(t),
        "hour": F.hour(t),
        "day_of_week": F.date_format(t, "EEEE"),
        "day_number": F.weekday(t),
    }


def trunc_to(ts: Column | str, unit: str) -> Column:
    """Start of the period ('Year', 'Month' or 'Day') as a date."""
    return F.trunc(try_ts(ts).cast("date"), unit) if unit.lower() != "day" else try_ts(ts).cast("date")


def order_by_list(c: Column | str, values: tuple[str, ...] = WEEKDAYS) -> Column:
    """Sort key that follows a given list; values outside it come first (0)."""
    return F.array_position(F.array(*[F.lit(v) for v in values]), col_of(c))
