"""The report on one candidate site."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitescout.functions.request import coordinates, radius, wanted_categories
from sitescout.joins import cut_lineage, size_checked
from sitescout.operators import checkins, competitors, sentiment
from sitescout.settings import SETTINGS, Settings


@dataclass(frozen=True)
class SiteTables:
    """The derived tables a report reads."""

    directory: DataFrame
    business_categories: DataFrame
    checkin_daily: DataFrame
    checkin_hourly: DataFrame
    sentiments: DataFrame


@dataclass(frozen=True)
class SiteReport:
    weekdays: DataFrame
    hours: DataFrame
    competitors: DataFrame
    top: DataFrame
    negative_words: DataFrame
    positive_words: DataFrame
    map_rows: DataFrame


def site_report(
    tables: SiteTables,
    wanted: str | Iterable[str],
    lat: str | float,
    lon: str | float,
    km: str | float = SETTINGS.default_radius_km,
    settings: Settings = SETTINGS,
) -> SiteReport:
    """All parts of the report on a site.

    The competitors are found once and kept for the parts that build on them. Their ids are
    broadcast to the check-ins and sentiments if a count shows that they are few enough.
    """
    lat, lon = coordinates(lat, lon)
    found = cut_lineage(
        competitors.find_competitors(
            tables.directory,
            tables.business_categories,
            wanted_categories(wanted),
            lat,
            lon,
            radius(km),
            settings.containment_threshold,
        )
    )
    ids = size_checked(found.select("business_id"), settings.broadcast_bytes)
    return SiteReport(
        weekdays=checkins.weekday_profile(tables.checkin_daily, ids),
        hours=checkins.hour_profile(tables.checkin_hourly, ids),
        competitors=found,
        top=competitors.top_competitors(found, settings.top_competitors),
        negative_words=sentiment.word_counts(tables.sentiments, ids, sentiment.NEGATIVE),
        positive_words=sentiment.word_counts(tables.sentiments, ids, sentiment.POSITIVE),
        map_rows=competitors.report_map_rows(found, lat, lon),
    )


PLACE_COLUMNS = {
    "name": "string", "distance": "double", "stars": "double", "review_count": "int",
    "latitude": "double", "longitude": "double",
}


def report_lines(report: SiteReport) -> DataFrame:
    """The report as one table, for printing or storing.

    (section, label, position, value) and, for places, their name, distance to two decimals,
    stars, number of reviews, and for the map also where they are.
    """

    def lines(
        section: str, df: DataFrame, label: str, position: str | None, value: str, place: tuple[str, ...] = ()
    ) -> DataFrame:
        shown = {c: F.round("distance", 2) if c == "distance" else F.col(c) for c in place}
        return df.select(
            F.lit(section).alias("section"),
            F.col(label).cast("string").alias("label"),
            (F.col(position) if position else F.lit(None)).cast("int").alias("position"),
            F.col(value).cast("double").alias("value"),
            *[shown.get(c, F.lit(None)).cast(kind).alias(c) for c, kind in PLACE_COLUMNS.items()],
        )

    rated = ("name", "distance", "stars", "review_count")
    parts = [
        lines("weekday", report.weekdays, "day", "day_no", "check_ins"),
        lines("hour", report.hours, "hour", "hour_no", "check_ins"),
        lines("competitor", report.competitors, "business_id", None, "distance", rated),
        lines("top", report.top, "business_id", None, "stars", rated),
        lines("negative", report.negative_words, "text", None, "size"),
        lines("positive", report.positive_words, "text", None, "size"),
        lines("map", report.map_rows, "kind", None, "distance", tuple(PLACE_COLUMNS)),
    ]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole
