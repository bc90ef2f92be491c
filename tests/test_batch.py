import random

import pytest
from pyspark.sql import functions as F

from sitescout import joins
from sitescout.operators import checkins, sentiment
from sitescout.plans import batch
from sitescout.plans.batch import (
    Search, batch_competitors, batch_hour_profile, batch_top_competitors, batch_weekday_profile, batch_word_counts,
    find_competitors, site_report_batch,
)
from sitescout.plans.report import SiteTables, report_lines, site_report

CATEGORIES = ["Food", "Coffee & Tea", "Bars", "Books", "Gyms"]


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(11)
    rows, pairs = [], []
    for i in range(120):
        # a third of all businesses stand in one spot of the city; some lie across the date line
        if i < 40:
            lat, lon = 43.65 + rng.uniform(0, 0.01), -79.38 + rng.uniform(0, 0.01)
        elif i < 100:
            lat, lon = 43.65 + rng.uniform(-0.3, 0.3), -79.38 + rng.uniform(-0.3, 0.3)
        else:
            lat, lon = rng.uniform(-0.1, 0.1), rng.choice([179.95, -179.95]) + rng.uniform(-0.04, 0.04)
        rows.append((f"b{i:03}", f"n{i}", "toronto", lat, lon, rng.randint(2, 10) / 2, rng.randint(0, 99)))
        pairs += [(f"b{i:03}", c) for c in rng.sample(CATEGORIES, rng.randint(1, 4))]
    directory = spark.createDataFrame(
        rows,
        "business_id string, name string, city string, latitude double, longitude double, stars double, review_count int",
    )
    hours = [
        (f"b{i:03}", day, f"{h}:00", rng.randint(1, 9))
        for i in range(0, 120, 2) for day in ("Sunday", "Friday") for h in (9, 10, 21)
    ]
    hourly = spark.createDataFrame(hours, "business_id string, day_of_week string, day_hour string, check_in int")
    words = [(f"b{i:03}", w) for i in range(120) for w in rng.choices(["good", "bad", "ok"], k=4)]
    tokens = spark.createDataFrame(words, "business_id string, word string")
    lexicon = spark.createDataFrame([("good", 1), ("bad", -1)], "word string, sentiment int")
    return SiteTables(
        directory=directory,
        business_categories=spark.createDataFrame(pairs, "business_id string, category string"),
        checkin_daily=checkins.checkins_daily(hourly),
        checkin_hourly=hourly,
        sentiments=sentiment.business_sentiment(directory, tokens, lexicon),
    )


SITES = [
    (1, 43.655, -79.375, 2.0, ["Food", "Bars"]),
    (2, 43.50, -79.20, 20.0, ["Books"]),
    (3, 0.0, 180.0, 15.0, ["Gyms", "Food", "Bars"]),
    (4, 0.0, -179.98, 10.0, ["Gyms", "Books"]),
    (5, 10.0, 10.0, 20.0, ["Food"]),
]
SCHEMA = "site_id int, lat double, lon double, km double, wanted array<string>"


def rounded(rows, *columns):
    return sorted(
        tuple(round(v, 9) if isinstance(v, float) else v for v in (r[c] for c in columns)) for r in rows
    )


@pytest.fixture(scope="module")
def singles(tables):
    return {
        site_id: site_report(tables, wanted, lat, lon, km) for site_id, lat, lon, km, wanted in SITES
    }


@pytest.mark.parametrize("limits", [{}, {"per_slice": 3}])
def test_batch_equals_one_by_one(spark, tables, singles, limits):
    found = batch_competitors(
        spark.createDataFrame(SITES, SCHEMA), tables.directory, tables.business_categories, **limits
    ).collect()
    assert found
    for site_id, report in singles.items():
        columns = ("business_id", "distance", "score", "stars")
        one = rounded(report.competitors.collect(), *columns)
        assert rounded([r for r in found if r.site_id == site_id], *columns) == one


def test_batch_parts_equal_one_by_one(spark, tables, singles):
    batch = site_report_batch(tables, spark.createDataFrame(SITES, SCHEMA))
    parts = {
        "weekdays": ("day_no", "day", "check_ins"),
        "hours": ("hour_no", "hour", "check_ins"),
        "top": ("business_id", "stars"),
        "negative_words": ("text", "size"),
        "positive_words": ("text", "size"),
    }
    for part, columns in parts.items():
        rows = getattr(batch, part).collect()
        for site_id, report in singles.items():
            one = rounded(getattr(report, part).collect(), *columns)
            assert rounded([r for r in rows if r.site_id == site_id], *columns) == one, part


def test_top_is_ranked(spark, tables):
    found = batch_competitors(spark.createDataFrame(SITES, SCHEMA), tables.directory, tables.business_categories)
    rows = [r for r in batch_top_competitors(found, 3).collect() if r.site_id == 1]
    rows.sort(key=lambda r: r["rank"])
    assert [r["rank"] for r in rows] == [1, 2, 3]
    assert [r.stars for r in rows] == sorted((r.stars for r in rows), reverse=True)
    plan = batch_top_competitors(found)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_report_lines(singles):
    lines = report_lines(singles[1]).collect()
    sections = {r.section for r in lines}
    assert sections == {"weekday", "hour", "competitor", "top", "negative", "positive", "map"}
    found = singles[1].competitors.count()
    assert sum(r.section == "competitor" for r in lines) == found
    assert singles[1].map_rows.count() == found + 1


def test_report_checks_its_request(tables):
    with pytest.raises(ValueError):
        site_report(tables, " , ", 43, -79)
    with pytest.raises(ValueError):
        site_report(tables, "Food", "143", "-79")
    with pytest.raises(ValueError):
        site_report(tables, "Food", 43, -79, "-1")


def test_profiles_average_existing_rows_only(spark):
    daily = spark.createDataFrame(
        [("a", "Sunday", 4), ("b", "Sunday", 8), ("a", "Monday", 3), ("c", "Monday", 99), ("a", "Someday", 1)],
        "business_id string, day_of_week string, check_in int",
    )
    ids = spark.createDataFrame([("a",), ("b",), ("b",)], "business_id string")
    got = [tuple(r) for r in checkins.weekday_profile(daily, ids).collect()]
    assert got == [(1, "Sunday", 6.0), (2, "Monday", 3.0), (None, "Someday", 1.0)]
    hourly = spark.createDataFrame(
        [("a", "Sunday", "10:00", 4), ("a", "Monday", "10:00", 2), ("b", "Sunday", "9:00", 5), ("b", "Sunday", "x", 7)],
        "business_id string, day_of_week string, day_hour string, check_in int",
    )
    got = [tuple(r) for r in checkins.hour_profile(hourly, ids).collect()]
    assert got == [(9, "9:00", 5.0), (10, "10:00", 3.0), (None, "x", 7.0)]



def test_batch_takes_repeated_ids_and_untidy_wishes_as_one_site_does(spark, tables):
    again = tables.directory.where("business_id = 'b001'").selectExpr("business_id", "name", "'york' as city", "latitude", "longitude", "stars", "review_count")
    twice = SiteTables(
        tables.directory.unionByName(again), tables.business_categories, tables.checkin_daily, tables.checkin_hourly, tables.sentiments
    )
    sites = spark.createDataFrame([(1, 43.655, -79.375, 5.0, [" Food", "", None, "Bars\t", "Food"])], SCHEMA)
    batch, one = site_report_batch(twice, sites), site_report(twice, "Food, Bars", 43.655, -79.375, 5.0)
    for part, columns in {"weekdays": ("day", "check_ins"), "hours": ("hour", "check_ins"), "positive_words": ("text", "size")}.items():
        assert rounded(getattr(batch, part).collect(), *columns) == rounded(getattr(one, part).collect(), *columns)
    assert rounded(batch.competitors.collect(), "business_id", "score") == rounded(one.competitors.collect(), "business_id", "score")


@pytest.mark.parametrize("site", [(1, 143.0, 0.0, 1.0, ["Food"]), (1, 43.0, 0.0, -1.0, ["Food"]), (1, 43.0, 0.0, 1.0, [" "]), (1, None, 0.0, 1.0, ["Food"])])
def test_batch_checks_its_sites(spark, tables, site):
    with pytest.raises(Exception, match="not a proper request"):
        batch_competitors(spark.createDataFrame([site], SCHEMA), tables.directory, tables.business_categories).collect()


def test_no_threshold_keeps_those_without_a_match(spark, tables):
    site = [(1, 43.65, -79.38, 50.0, ["Food"])]
    found = batch_competitors(spark.createDataFrame(site, SCHEMA), tables.directory, tables.business_categories, threshold=0.0)
    assert {r.score for r in found.collect()} == {0.0, 1.0}


def test_search_brings_facts_to_sites_as_found_pairs_do(spark, tables):
    sites = spark.createDataFrame(SITES, SCHEMA)
    first = tables.directory.where("business_id < 'b020'")
    # some businesses have a second place in reach of the same sites, and a third that is not
    near = first.withColumn("latitude", F.col("latitude") + 0.001)
    directory = tables.directory.unionByName(near).unionByName(first.withColumn("latitude", F.lit(-60.0)))
    cases = (
        (0.5, lambda f: batch_weekday_profile(tables.checkin_daily, f)),
        (0.0, lambda f: batch_hour_profile(tables.checkin_hourly, f)),
        (0.5, lambda f: batch_word_counts(tables.sentiments, f, sentiment.NEGATIVE)),
    )
    for threshold, profile in cases:
        found = joins.cut_lineage(find_competitors(sites, directory, tables.business_categories, threshold))
        search = Search(sites, directory, tables.business_categories, threshold)
        assert sorted(profile(search).collect()) == sorted(profile(found).collect()) != []


def test_nothing_stored_grows_with_the_pairs(spark, tables, monkeypatch):
    sites = spark.range(400).selectExpr(
        "id as site_id", "43.655 as lat", "-79.375 as lon", "5D as km", "array('Food', 'Bars') as wanted"
    ).withColumns({"lat": F.col("lat").cast("double"), "lon": F.col("lon").cast("double")})
    counts = []
    for name in ("cut_lineage", "stored"):
        keep = getattr(batch, name, None)
        if keep:
            monkeypatch.setattr(batch, name, lambda df, *a, keep=keep: counts.append((kept := keep(df, *a)).count()) or kept)
    found = batch_competitors(sites, tables.directory, tables.business_categories).count()
    batch_weekday_profile(tables.checkin_daily, getattr(batch, "Search", find_competitors)(sites, tables.directory, tables.business_categories)).count()
    assert found > 10_000 > 1_000 > max(counts)


def test_top_of_a_search_is_the_top_of_all_found_and_few_are_ranked(spark, tables):
    sites = spark.createDataFrame([*SITES, (6, 43.655, -79.375, 300.0, ["Food", "Bars"])], SCHEMA)
    odd = F.when(F.col("review_count") % 7 == 0, F.lit(None)).when(F.col("review_count") % 5 == 0, F.col("stars") + 1e-9)
    directory = tables.directory.withColumn("stars", F.when(F.col("review_count") == 3, float("nan")).otherwise(F.coalesce(odd, "stars")))
    search = Search(sites, directory, tables.business_categories, decimals=1)
    found = batch_competitors(sites, directory, tables.business_categories).withColumn("distance", F.round("distance", 1))
    for k in (2, 17):
        tops = [[str(r) for r in batch_top_competitors(f, k).orderBy("site_id", "rank").collect()] for f in (search, found)]
        assert tops[0] == tops[1] != []
    assert batch._best_candidates(search, 2).count() < found.count() / 2
