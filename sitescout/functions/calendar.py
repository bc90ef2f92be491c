"""Weekday and hour labels and their order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Sunday is day 1.
WEEKDAYS = ("Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday")


def weekday_number(day: Column) -> Column:
    """1 for Sunday to 7 for Saturday; NULL for an unknown name."""
    position = F.array_position(F.array(*map(F.lit, WEEKDAYS)), day).cast("int")
    return F.when(position > 0, position)


def weekday_name(date: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, WEEKDAYS)), F.dayofweek(date))


def hour_number(hour: Column) -> Column:
    """The integer before the colon; NULL if there is none."""
    return F.split_part(hour, F.lit(":"), F.lit(1)).try_cast("int")


def hour_label(timestamp: Column) -> Column:
    return F.concat(F.hour(timestamp).cast("string"), F.lit(":00"))
