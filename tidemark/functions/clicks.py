"""Time-of-day expressions of the click jobs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Interval labels in order of the day, by style.
INTERVAL_LABELS = {
    "plain": ("0-6", "6-12", "12-18", "18-24"),
    "padded": ("00-06", "06-12", "12-18", "18-24"),
    "named": ("00-06 Night", "06-12 Morning", "12-18 Afternoon", "18-24 Evening"),
    "bracketed": ("00-06 (Night)", "06-12 (Morning)", "12-18 (Afternoon)", "18-24 (Evening)"),
}
HOURS_PER_INTERVAL = 6

# Shapes of a date and a time accepted by the regex check.
ISO_DATE = r"^\d{4}-\d{2}-\d{2}$"
ISO_TIME = r"^\d{2}:\d{2}:\d{2}$"


def _time_part(time: Column, position: int) -> Column:
    return F.get(F.split(time, ":"), F.lit(position)).try_cast("int")


def hour_of(time: Column) -> Column:
    """Hour of an ``H:mm`` token; NULL when it is not a number."""
    return _time_part(time, 0)


def minute_of_day(time: Column) -> Column:
    return hour_of(time) * 60 + _time_part(time, 1)


def clock(minutes: Column) -> Column:
    """Minutes since midnight as ``HH:mm``."""
    return F.format_string("%02d:%02d", F.floor(minutes / 60), minutes % 60)


def interval_number(hour: Column) -> Column:
    """0 to 3 for the quarters of the day; NULL outside 0 to 23 hours."""
    return F.when(hour.between(0, 23), F.floor(hour / HOURS_PER_INTERVAL).cast("int"))


def time_interval(hour: Column, style: str = "plain", otherwise: str | None = None) -> Column:
    """Label of the six-hour interval; hours outside the day get ``otherwise``."""
    labels = F.array(*[F.lit(label) for label in INTERVAL_LABELS[style]])
    return F.coalesce(F.get(labels, interval_number(hour)), F.lit(otherwise))
