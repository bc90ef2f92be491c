import math
import random

import pytest
from pyspark.sql import functions as F

from sitescout.functions.geo import bounding_box, covering_cells, distance_km, grid_cell, inside_box
from sitescout.operators.competitors import competitors, radius_search, report_map_rows, top_competitors

SCHEMA = (
    "business_id string, name string, city string, latitude double, longitude double, "
    "stars double, review_count int"
)


def places(spark, points):
    rows = [(f"b{i}", f"n{i}", "c", float(la), float(lo), 3.0, 1) for i, (la, lo) in enumerate(points)]
    return spark.createDataFrame(rows, SCHEMA)


def true_distance(a, b):
    (la1, lo1), (la2, lo2) = [(math.radians(x), math.radians(y)) for x, y in (a, b)]
    h = math.sin((la2 - la1) / 2) ** 2 + math.cos(la1) * math.cos(la2) * math.sin((lo2 - lo1) / 2) ** 2
    return 2 * 6371 * math.asin(min(1, math.sqrt(h)))


SITES = [(43.8, -79.25), (0, 0), (89.95, 10), (-89.99, 0), (51.0, 179.97), (-20.0, -179.99), (90, 0)]


@pytest.mark.parametrize("site", SITES)
def test_box_and_cells_lose_no_hit(spark, site):
    rng = random.Random(7)
    km = 20.0
    points = []
    for _ in range(400):
        la = max(-90.0, min(90.0, site[0] + rng.uniform(-0.3, 0.3)))
        lo = site[1] + rng.uniform(-1, 1) * (0.5 if abs(site[0]) < 80 else 180)
        points.append((la, (lo + 180) % 360 - 180))
    near = {f"b{i}" for i, p in enumerate(points) if true_distance(site, p) < km - 1e-6}
    assert near
    df = places(spark, points)
    assert near == {r.business_id for r in radius_search(df, *site, km).collect()}
    cells = spark.range(1).select(
        covering_cells(F.lit(float(site[0])), F.lit(float(site[1])), F.lit(km)).alias("cells")
    ).first().cells
    assert len(cells) == len(set(cells))
    in_cells = df.where(grid_cell(F.col("latitude"), F.col("longitude")).isin(cells))
    assert near <= {r.business_id for r in in_cells.collect()}


def test_box_splits_at_the_date_line():
    _, _, ranges = bounding_box(10, 179.9, 50)
    assert len(ranges) == 2
    assert bounding_box(89.9, 0, 50)[2] == [(-180.0, 180.0)]


def test_radius_is_strict_and_keeps_a_business_at_the_site(spark):
    # points whose cosine with themselves rounds to just above 1 are among these
    points = [(43.0 + i * 0.01, -79.0 - i * 0.013) for i in range(60)]
    df = places(spark, points)
    for i in range(0, 60, 7):
        found = radius_search(df, *points[i], 0.001).collect()
        assert [r.business_id for r in found] == [f"b{i}"]
    exact = df.select(distance_km(F.lit(43.0), F.lit(-79.0), F.col("latitude"), F.col("longitude")).alias("d"))
    d = exact.where("d > 1").orderBy("d").first().d
    nearer = radius_search(df, 43.0, -79.0, d).collect()
    assert all(r.distance < d for r in nearer) and len(nearer) == 1
    assert [r.distance for r in radius_search(df, 43.0, -79.0, 10).collect()] == sorted(
        r.distance for r in radius_search(df, 43.0, -79.0, 10).collect()
    )


def test_box_reaches_the_scan(spark, tmp_path):
    places(spark, [(43.8, -79.2), (10, 10)]).write.parquet(str(tmp_path / "d"))
    stored = spark.read.schema(SCHEMA).parquet(str(tmp_path / "d"))
    plan = radius_search(stored, 43.8, -79.25, 20)._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters"):]
    assert "GreaterThanOrEqual(latitude" in pushed and "IsNotNull(longitude)" in pushed
    assert "stars" in pushed and "address" not in pushed


def test_competitors_threshold_is_inclusive_and_weakest_first(spark):
    df = places(spark, [(43.80, -79.25), (43.81, -79.25), (43.82, -79.25), (50, 0)])
    pairs = spark.createDataFrame(
        [("b0", "x"), ("b1", "x"), ("b1", "y"), ("b1", "y"), ("b2", "z"), ("b3", "x"), ("b3", "y")],
        "business_id string, category string",
    )
    found = competitors(df, pairs, " x, y ,,x", 43.8, -79.25, 20).collect()
    assert [(r.business_id, r.score) for r in found] == [("b0", 0.5), ("b1", 1.0)]
    everyone = competitors(df, pairs, ["x", "y"], 43.8, -79.25, 20, threshold=0).collect()
    assert {r.business_id: r.score for r in everyone} == {"b0": 0.5, "b1": 1.0, "b2": 0.0}


def test_top_and_map(spark):
    rows = [("a", 5.0, 2.0), ("b", 5.0, 1.0), ("c", 4.0, 0.5), ("d", 5.0, 1.0)]
    found = spark.createDataFrame(
        [(i, i, d, s, 1, 43.0, -79.0) for i, s, d in rows],
        "business_id string, name string, distance double, stars double, review_count int, latitude double, longitude double",
    )
    assert [r.business_id for r in top_competitors(found, 3).collect()] == ["b", "d", "a"]
    places_on_map = report_map_rows(found, 43.8, -79.25).collect()
    assert [r.kind for r in places_on_map].count("site") == 1 and len(places_on_map) == 5


def test_inside_box_handles_two_ranges(spark):
    df = spark.createDataFrame([(0.0, 179.95), (0.0, -179.95), (0.0, 0.0)], "a double, b double")
    assert df.where(inside_box(F.col("a"), F.col("b"), 0, 180, 20)).count() == 2
