"""Businesses near a site, and those of them that compete with the planned one."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitescout.functions.geo import distance_km, inside_box
from sitescout.operators.categories import matching_businesses
from sitescout.settings import SETTINGS

# The columns of the results.
NEARBY_COLUMNS = ("latitude", "longitude", "city", "business_id", "name", "stars", "review_count")
MAP_COLUMNS = ("name", "review_count", "stars", "distance", "latitude", "longitude")


def _nearby(business: DataFrame, lat: float, lon: float, km: float) -> DataFrame:
    site_lat, site_lon = F.lit(float(lat)), F.lit(float(lon))
    distance = distance_km(site_lat, site_lon, F.col("latitude"), F.col("longitude"))
    return (
        business.where(inside_box(F.col("latitude"), F.col("longitude"), lat, lon, km))
        .select(*NEARBY_COLUMNS, distance.alias("distance"))
        .where(F.col("distance") < km)
    )


def radius_search(business: DataFrame, lat: float, lon: float, km: float) -> DataFrame:
    """Businesses closer than ``km`` to a site, nearest first, with their distance in km."""
    return _nearby(business, lat, lon, km).orderBy("distance", "business_id")


def find_competitors(
    business: DataFrame,
    pairs: DataFrame,
    wanted: str | Iterable[str],
    lat: float,
    lon: float,
    km: float = SETTINGS.default_radius_km,
    threshold: float = SETTINGS.containment_threshold,
) -> DataFrame:
    """Businesses near a site having at least ``threshold`` of the wanted categories, with ``score``."""
    matches = matching_businesses(pairs, wanted, threshold)
    return (
        _nearby(business, lat, lon, km)
        .join(matches, "business_id")
        .select(*NEARBY_COLUMNS, "distance", "score")
    )


def competitors(
    business: DataFrame,
    pairs: DataFrame,
    wanted: str | Iterable[str],
    lat: float,
    lon: float,
    km: float = SETTINGS.default_radius_km,
    threshold: float = SETTINGS.containment_threshold,
) -> DataFrame:
    """The competitors of a site, weakest match first."""
    found = find_competitors(business, pairs, wanted, lat, lon, km, threshold)
    return found.orderBy("score", "distance", "business_id")


def top_competitors(found: DataFrame, k: int = SETTINGS.top_competitors) -> DataFrame:
    """The ``k`` best rated; among equals the nearer, then the lower id."""
    return (
        found.select("business_id", "name", "distance", "stars", "review_count")
        .orderBy(F.desc("stars"), "distance", "business_id")
        .limit(k)
    )


def report_map_rows(found: DataFrame, lat: float, lon: float) -> DataFrame:
    """The places to draw on a map: every competitor, and the site itself."""
    places = found.select(F.lit("competitor").alias("kind"), *MAP_COLUMNS)
    at_site = {
        "name": F.lit("Your Location"),
        "distance": F.lit(0.0),
        "latitude": F.lit(float(lat)),
        "longitude": F.lit(float(lon)),
    }
    types = dict(found.dtypes)
    site = found.sparkSession.range(0, 1, 1, 1).select(
        F.lit("site").alias("kind"),
        *[at_site.get(c, F.lit(None)).cast(types[c]).alias(c) for c in MAP_COLUMNS],
    )
    return places.unionByName(site)
