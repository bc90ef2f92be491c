"""The k nearest businesses of many sites, without a radius given.

Businesses are counted by cell on every level. The smallest cell around a site that holds k of them bounds
how far the k-th can be, as no two places of a cell are further apart than its width allows. The circle of that
radius is covered by cells, in which the site meets the businesses; the k nearest within it are the answer.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sitescout.functions import cells
from sitescout.functions.geo import EARTH_KM, distance_from_parts, trig_parts
from sitescout.joins import cut_lineage, hot_keys, join_in_slices, lookup_join, slice_hot_keys
from sitescout.settings import SETTINGS

#: Levels on which businesses are counted; radii below the smallest cell's do not occur.
COUNTED_LEVELS = tuple(range(cells.DEEPEST - cells.RIM_LEVELS))
#: Distances count by the metre, so that computed ties are ties.
_PLACES, _METRE = 3, 0.001


def batch_nearest(
    sites: DataFrame, business: DataFrame, k: int, per_slice: int = SETTINGS.places_per_slice
) -> DataFrame:
    """(site_id, business_id, distance, rank) of the ``k`` nearest businesses of each site (site_id, lat, lon).

    Ties in metres go to the lower id. A site has fewer rows only if there are fewer businesses with a place.
    Of the businesses at one and the same place no more than the ``k`` lowest ids can matter, so a crowded
    place is cut to these before anything else. A site on a face of the cube (a sixth of the Earth) with
    fewer than ``k`` businesses is compared with all. Crowded cells are joined in slices.
    """
    if k < 1:
        raise ValueError("at least one business must be asked for")
    here = F.col("latitude"), F.col("longitude")
    business_parts, site_parts = ("_sin2", "_cos2", "_lon2"), ("_sin1", "_cos1", "_lon1")
    in_place = W.partitionBy("latitude", "longitude").orderBy("business_id")
    placed = (
        business.select("business_id", "latitude", "longitude").dropna()
        .withColumn("nth", F.row_number().over(in_place)).where(F.col("nth") <= k)
        .select("business_id", cells.place(*here).alias("at"), *[c.alias(n) for c, n in zip(trig_parts(*here), business_parts)])
    )
    placed = cut_lineage(placed)

    levels = list(COUNTED_LEVELS)
    deepest = placed.groupBy("at").agg(F.count("*").alias("n"))
    held = deepest.select("n", F.posexplode(cells.ancestors(F.col("at"), levels)).alias("level", "cell"))
    full = cut_lineage(held.groupBy("cell", "level").agg(F.sum("n").alias("n")).where(F.col("n") >= k).select("cell", "level"))
    place = F.col("lat"), F.col("lon")
    asked = cut_lineage(sites.select("site_id", *place).dropna())
    around = asked.select("site_id", F.explode(cells.ancestors(cells.place(*place), levels)).alias("cell"))
    smallest = lookup_join(around, full, "cell", F.col("site_id"), how="inner").groupBy("site_id").agg(F.max("level").alias("full"))
    across = 2 * cells.reach(F.col("full")) * EARTH_KM + _METRE
    radius = F.least(F.coalesce(across, F.lit(math.inf)), F.lit(math.pi * EARTH_KM + _METRE))
    asked = asked.join(smallest, "site_id", "left").select(
        "site_id", "lat", "lon", radius.alias("km"), *[c.alias(n) for c, n in zip(trig_parts(*place), site_parts)]
    )
    partitions = int(sites.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    asked = cut_lineage(asked.repartition(partitions, "site_id"))
    starts = [r[0] for r in asked.select(cells.first_level(F.col("km"))).distinct().collect()]  # of some two dozen
    used = sorted({s + step for s in starts for step in range(cells.RIM_LEVELS + 1)})
    asked = cells.with_covering(asked).drop("lat", "lon", "level")
    offered = placed.withColumn("cell", F.explode(cells.ancestors(F.col("at"), used))).drop("at")
    left, right = slice_hot_keys(
        asked, offered, "cell", F.col("site_id"), F.col("business_id"),
        hot_keys(asked.select("cell"), offered.select("cell"), "cell", per_slice),
    )
    distance = distance_from_parts(tuple(map(F.col, site_parts)), tuple(map(F.col, business_parts)))
    met = join_in_slices(left, right, "cell").where(distance <= F.col("km"))
    nearest = W.partitionBy("site_id").orderBy("distance", "business_id")
    ranked = met.select("site_id", "business_id", F.round(distance, _PLACES).alias("distance"))
    return ranked.withColumn("rank", F.row_number().over(nearest)).where(F.col("rank") <= k)
