"""Check-in counts by weekday and hour, and the expected traffic of selected businesses."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitescout.functions.calendar import hour_number, weekday_number
from sitescout.joins import keep_selected


def checkins_hourly(raw: DataFrame) -> DataFrame:
    """(business_id, day_of_week, day_hour, check_in) from the nested day -> hour -> count."""
    days = raw.select("business_id", F.explode("time").alias("day_of_week", "hours"))
    return days.select("business_id", "day_of_week", F.explode("hours").alias("day_hour", "check_in"))


def checkins_daily(hourly: DataFrame) -> DataFrame:
    return hourly.groupBy("business_id", "day_of_week").agg(
        F.sum(F.col("check_in").cast("long")).alias("check_in")
    )


def weekday_profile(daily: DataFrame, ids: DataFrame) -> DataFrame:
    """Mean check-ins per weekday over the selected businesses that have a row for that day.

    (day_no, day, check_ins), Sunday first. An unknown weekday has a NULL number, comes last.
    """
    return (
        keep_selected(daily, ids)
        .groupBy(F.col("day_of_week").alias("day"))
        .agg(F.avg("check_in").alias("check_ins"))
        .select(weekday_number(F.col("day")).alias("day_no"), "day", "check_ins")
        .orderBy(F.asc_nulls_last("day_no"), "day")
    )


def hour_profile(hourly: DataFrame, ids: DataFrame) -> DataFrame:
    """Mean check-ins per hour label over the (business, weekday) rows of the selection.

    (hour_no, hour, check_ins) in the order of the hours.
    """
    return (
        keep_selected(hourly, ids)
        .groupBy(F.col("day_hour").alias("hour"))
        .agg(F.avg("check_in").alias("check_ins"))
        .select(hour_number(F.col("hour")).alias("hour_no"), "hour", "check_ins")
        .orderBy(F.asc_nulls_last("hour_no"), "hour")
    )
