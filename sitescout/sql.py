"""The operators in SQL: table functions over the registered views, and texts with named parameters.

``register`` makes the views of a set of tables and these functions, for the session:

* ``near_site(lat, lon, km)``: businesses closer than km, with their distance
* ``category_match(wanted)``: the share of the wanted categories (a list separated by commas) of each business
* ``competitors_of(wanted, lat, lon, km, threshold)``: both together
* ``categories_like(text)``: categories that hold a text, or its form with capital initials

Parameters can be given by name, ``km`` and ``threshold`` have defaults. Arguments that are constants are
folded into the plan, so the latitudes of a search reach the scan. ``QUERIES`` has the profiles and the
list of the best, which take the same values as ``:wanted``, ``:lat``, ``:lon``, ``:km``; see ``run``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sitescout.functions.geo import BOX_MARGIN, EARTH_KM
from sitescout.operators import categories
from sitescout.plans.report import SiteTables
from sitescout.settings import SETTINGS, TABLES

_WANTED = "array_distinct(filter(transform(split(wanted, ','), x -> trim(x)), x -> x <> ''))"
_COSINE = (
    "cos(radians(lat)) * cos(radians(b.latitude)) * cos(radians(b.longitude) - radians(lon))"
    " + sin(radians(lat)) * sin(radians(b.latitude))"
)
_REACH = f"(degrees(km / {EARTH_KM}D) + {BOX_MARGIN}D)"


def _functions(types: dict[str, str]) -> list[str]:
    """The statements that make the functions; ``types`` are those of the directory's columns."""
    listed = ", ".join(f"{c} {t}" for c, t in types.items())
    names = ", ".join(f"b.{c}" for c in types)
    key = types["business_id"]
    place = f"lat DOUBLE, lon DOUBLE, km DOUBLE DEFAULT {SETTINGS.default_radius_km}"
    return [
        f"""CREATE OR REPLACE TEMPORARY FUNCTION near_site({place}) RETURNS TABLE ({listed}, distance DOUBLE)
RETURN SELECT * FROM (
  SELECT {names}, {EARTH_KM}D * acos(greatest(-1D, least(1D, {_COSINE}))) AS distance FROM {TABLES.directory} AS b
  WHERE b.latitude BETWEEN lat - {_REACH} AND lat + {_REACH})
WHERE distance < km""",
        f"""CREATE OR REPLACE TEMPORARY FUNCTION category_match(wanted STRING) RETURNS TABLE (business_id {key}, score DOUBLE)
RETURN SELECT business_id, size(array_intersect(categories, {_WANTED})) / CAST(size({_WANTED}) AS DOUBLE) AS score
FROM category_sets""",
        f"""CREATE OR REPLACE TEMPORARY FUNCTION competitors_of(wanted STRING, {place},
  threshold DOUBLE DEFAULT {SETTINGS.containment_threshold}) RETURNS TABLE ({listed}, distance DOUBLE, score DOUBLE)
RETURN SELECT b.*, size(array_intersect(s.categories, {_WANTED})) / CAST(size({_WANTED}) AS DOUBLE) AS score
FROM (SELECT {names}, {EARTH_KM}D * acos(greatest(-1D, least(1D, {_COSINE}))) AS distance FROM {TABLES.directory} AS b
      WHERE b.latitude BETWEEN lat - {_REACH} AND lat + {_REACH}) AS b JOIN category_sets AS s ON s.business_id = b.business_id
WHERE b.distance < km AND size(array_intersect(s.categories, {_WANTED})) >= threshold * size({_WANTED})""",
        f"""CREATE OR REPLACE TEMPORARY FUNCTION categories_like(text STRING) RETURNS TABLE (category STRING)
RETURN SELECT c.category FROM {TABLES.categories} AS c
WHERE contains(c.category, text) OR contains(c.category, initcap(text))""",
    ]


_FOUND = "competitors_of(wanted => :wanted, lat => :lat, lon => :lon, km => :km)"
QUERIES = {
    "competitors": f"SELECT * FROM {_FOUND}",
    "top_competitors": f"""SELECT business_id, name, distance, stars, review_count FROM {_FOUND}
ORDER BY stars DESC, distance, business_id LIMIT {SETTINGS.top_competitors}""",
    "weekday_profile": f"""SELECT d.day_of_week AS day, avg(d.check_in) AS check_ins FROM {TABLES.checkin_daily} AS d
WHERE d.business_id IN (SELECT business_id FROM {_FOUND}) GROUP BY 1""",
    "hour_profile": f"""SELECT h.day_hour AS hour, avg(h.check_in) AS check_ins FROM {TABLES.checkin_hourly} AS h
WHERE h.business_id IN (SELECT business_id FROM {_FOUND}) GROUP BY 1""",
    "category_search": "SELECT * FROM categories_like(text => :text)",
}


def register(spark: SparkSession, tables: SiteTables) -> None:
    """Views of the tables by their names, ``category_sets`` and ``categories``, and the functions."""
    pairs = tables.business_categories
    views = {
        TABLES.directory: tables.directory,
        TABLES.business_categories: pairs,
        TABLES.checkin_daily: tables.checkin_daily,
        TABLES.checkin_hourly: tables.checkin_hourly,
        TABLES.sentiments: tables.sentiments,
        TABLES.categories: categories.category_dictionary(pairs),
        "category_sets": categories.category_sets(pairs),
    }
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    for statement in _functions(dict(tables.directory.dtypes)):
        spark.sql(statement)


def run(spark: SparkSession, name: str, **values: object) -> DataFrame:
    """One of ``QUERIES`` with its named values."""
    return spark.sql(QUERIES[name], args=values)
