"""Cells of the cube and coverings, against distances worked out point by point."""

import random

import pytest
from pyspark.sql import functions as F

from sitescout.functions import cells
from sitescout.functions.geo import EARTH_KM, distance_km
from sitescout.joins import cut_lineage
from sitescout.plans.batch import batch_competitors

CORNER = 35.26438968275465  # latitude where three faces meet, at longitude 45


def points(rng, n):
    odd = [(90.0, 0.0), (-90.0, 13.0), (0.0, 180.0), (0.0, -180.0), (0.0, 45.0), (CORNER, 45.0), (CORNER, -135.0), (0.0, 0.0), (45.0, 0.0)]
    return odd + [(rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(n)]


def test_levels_nest_and_cells_reach_no_further(spark):
    rows = points(random.Random(1), 4000)
    df = spark.createDataFrame(rows, "lat double, lon double").withColumn("at", cells.place(F.col("lat"), F.col("lon")))
    xyz = cells.unit_vector(F.col("lat"), F.col("lon"))
    worst = []
    for level in (0, 1, 2, 5, 12):
        shift = cells.DEEPEST - level
        far = F.lit(None).cast("double")
        for face in range(cells.FACES):
            away = cells.middle_distance(cells._framed(xyz, face), F.lit(level), F.shiftright("at.i", shift), F.shiftright("at.j", shift))
            far = F.when(F.col("at.face") == face, away).otherwise(far)
        worst.append(F.max(far / cells.reach(F.lit(level))).alias(f"w{level}"))
    assert all(0.5 < w <= 1.0000001 for w in df.agg(*worst).first())
    ids = df.select(*[cells.ancestor(F.col("at"), n).alias(f"c{n}") for n in (3, 4)])
    assert ids.groupBy("c4").agg(F.count_distinct("c3").alias("n")).where("n > 1").count() == 0


@pytest.mark.parametrize("km", [0.002, 0.5, 7.0, 80.0, 2000.0, 9000.0, 15000.0, 20014.0])
def test_coverings_hold_every_point_of_the_circle(spark, km):
    rng = random.Random(int(km * 10))
    sites = spark.createDataFrame([(i, *p, km) for i, p in enumerate(points(rng, 20))], "site int, slat double, slon double, km double")
    covered = cells.with_covering(sites, "slat", "slon").groupBy(*sites.columns, "level").agg(F.collect_list("cell").alias("cells"))
    sites = cut_lineage(covered)
    assert sites.count() == 29 and sites.agg(F.max(F.size("cells"))).first()[0] <= 150
    # points near and on both sides of the rim, by a bearing and a part of the radius
    steps = [(b, part) for b in range(0, 360, 23) for part in (0.0, 0.3, 0.9, 0.999, 1.01)]
    around = sites.crossJoin(spark.createDataFrame(steps, "bearing int, part double"))
    angle, turn, phi = F.col("km") * F.col("part") / EARTH_KM, F.radians("bearing"), F.radians("slat")
    sine = F.sin(phi) * F.cos(angle) + F.cos(phi) * F.sin(angle) * F.cos(turn)
    lat = F.degrees(F.asin(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), sine))))
    lon = F.col("slon") + F.degrees(F.atan2(F.sin(turn) * F.sin(angle) * F.cos(phi), F.cos(angle) - F.sin(phi) * sine))
    around = around.select("*", lat.alias("lat"), (F.pmod(lon + 180, F.lit(360.0)) - 180).alias("lon"))
    near = distance_km(F.col("slat"), F.col("slon"), F.col("lat"), F.col("lon")) < F.col("km")
    at = cells.place(F.col("lat"), F.col("lon"))
    start = sites.first()["level"]
    hits = [F.array_contains("cells", cells.ancestor(F.col("at"), start + n)).cast("int") for n in range(cells.RIM_LEVELS + 1)]
    judged = around.withColumn("at", at).select(near.alias("near"), sum(hits[1:], hits[0]).alias("hits"))
    assert judged.where("near").count() > 800
    assert judged.where("near and hits <> 1").count() == 0 and judged.where("hits > 1").count() == 0


def test_sites_of_very_different_radii(spark):
    rng = random.Random(5)
    places = points(rng, 300)
    business = spark.createDataFrame([(i, *p) for i, p in enumerate(places)], "business_id int, latitude double, longitude double")
    pairs = spark.createDataFrame([(i, c) for i in range(len(places)) for c in rng.sample("xyz", 2)], "business_id int, category string")
    wanted = [(n, *rng.choice(places), rng.choice([0.1, 30.0, 3000.0, 19000.0]), rng.sample("xyz", 2)) for n in range(25)]
    sites = spark.createDataFrame(wanted, "site_id int, lat double, lon double, km double, wanted array<string>")
    for threshold in (0.5, 0.0):
        got = batch_competitors(sites, business, pairs, threshold).select("site_id", "business_id", "score").collect()
        score = pairs.join(sites, F.array_contains("wanted", F.col("category")), "right").groupBy("site_id", "business_id").agg((F.count("*") / 2).alias("score"))
        near = sites.crossJoin(business).where(distance_km(*map(F.col, ("lat", "lon", "latitude", "longitude"))) < F.col("km"))
        want = near.join(score, ["site_id", "business_id"], "left").select("site_id", "business_id", F.coalesce("score", F.lit(0.0)).alias("score"))
        assert sorted(map(tuple, got)) == sorted(map(tuple, want.where(F.col("score") >= threshold).collect()))
