"""Daily check-ins kept up to date from the hourly ones, at the cost of what has changed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitescout.joins import cut_lineage, size_checked
from sitescout.operators.checkins import checkins_daily
from sitescout.schemas import KEYS
from sitescout.settings import TABLES
from sitescout.sources.keyed import KeyedTable

_DAY = list(KEYS[TABLES.checkin_daily])


def create_checkin_tables(hourly: DataFrame, directory: str, buckets: int = 64) -> tuple[KeyedTable, KeyedTable]:
    """The hourly table and the daily one worked out from it. The daily table notes the hourly version it reflects."""
    stored = KeyedTable.create(hourly, f"{directory}/hourly", KEYS[TABLES.checkin_hourly], buckets)
    daily = checkins_daily(stored.read()).withColumn("check_in", F.coalesce("check_in", F.lit(0).cast("long")))
    return stored, KeyedTable.create(daily, f"{directory}/daily", _DAY, buckets, note=str(stored.version().number))


def daily_change(changes: DataFrame) -> DataFrame:
    """(business_id, day_of_week, change) from changes of the hourly table: a replaced row takes its
    old value back and adds its new one, an unchanged total has no row."""
    value = F.coalesce(F.col("new.check_in"), F.lit(0)).cast("long") - F.coalesce(F.col("old.check_in"), F.lit(0)).cast("long")
    summed = changes.groupBy(*_DAY).agg(F.sum(value).alias("change"), F.max(F.col("old").isNull().cast("int")).alias("has_new"))
    return summed.where("change <> 0 or has_new = 1").drop("has_new")


def update_daily(hourly: KeyedTable, daily: KeyedTable) -> int:
    """Brings the daily table to the hourly table's latest version; gives its own version.

    Only buckets of hours written since the version the daily table notes, and buckets of the days they
    belong to, are read. The note and the totals are committed together, so a run that died half-way,
    or one that is repeated, neither loses nor doubles a change.
    """
    until = hourly.version().number
    since = int(daily.version().note)
    if since == until:
        return daily.version().number
    change = cut_lineage(daily_change(hourly.changes(since, until)))
    known = daily.rows_of(change).withColumnRenamed("check_in", "before")
    total = F.coalesce("before", F.lit(0)) + F.col("change")
    updated = change.join(size_checked(cut_lineage(known)), _DAY, "left").select(*_DAY, total.alias("check_in"))
    return daily.upsert(updated, note=str(until))
