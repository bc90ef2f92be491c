import json

import pytest
from pyspark.sql import functions as F

from sitescout import schemas
from sitescout.__main__ import parser, run as run_command
from sitescout.functions.request import wanted_categories
from sitescout.joins import cut_lineage, hot_keys, join_hot, keep_selected, lookup_join, size_checked, slice_hot_keys
from sitescout.operators import categories, checkins, directory
from sitescout.plans.etl import JOBS, Run, run_jobs
from sitescout.settings import TABLES
from sitescout.sources import raw, tables

BUSINESSES = [
    {"business_id": "b1", "name": "A", "neighborhood": "", "address": "1 St", "city": "toronto", "state": "ON",
     "postal_code": "M5V", "latitude": 43.65, "longitude": -79.38, "stars": 4.5, "review_count": 12, "is_open": 1,
     "categories": ["Food", "Coffee & Tea", "Food"]},
    {"business_id": "b2", "name": "B", "city": "new-york", "state": "NY", "latitude": 43.70, "longitude": -79.40,
     "stars": 3.0, "review_count": 3, "is_open": 0, "categories": None},
    {"business_id": "b3", "name": "C", "city": "Toronto", "state": "ON", "latitude": 43.66, "longitude": -79.39,
     "stars": 2.0, "review_count": 1, "is_open": 1, "categories": []},
    {"business_id": "b4", "name": "D", "city": "TORONTO", "state": "ON", "latitude": 43.67, "longitude": -79.37,
     "stars": 5.0, "review_count": 8, "is_open": 1, "categories": ["Food", "Bars"]},
]
CHECKINS = [
    {"business_id": "b1", "time": {"Friday": {"20:00": 2, "9:00": 1}, "Sunday": {"0:00": 5}}},
    {"business_id": "b4", "time": {"Friday": {"20:00": 4}}},
    {"business_id": "b3", "time": None},
]
TIPS = [
    {"business_id": "b1", "user_id": "u1", "date": "2017-01-01", "text": "It's GREAT, great coffee; not bad!"},
    {"business_id": "b4", "user_id": "u1", "date": "2017-01-02", "text": "the of and"},
    {"business_id": "b9", "user_id": "u2", "date": "2017-01-03", "text": "great"},
    {"business_id": "b4", "user_id": "u2", "date": "2017-01-04", "text": ""},
]
USERS = [
    {"user_id": "u1", "name": "Ann", "yelping_since": "2012-02-25", "fans": 0, "review_count": 7},
    {"user_id": "u2", "name": "Sam", "yelping_since": "never", "fans": 1, "review_count": 2},
    {"user_id": "u3", "name": "Zoe", "yelping_since": None, "fans": 1, "review_count": 2},
]


@pytest.fixture(scope="module")
def source(tmp_path_factory):
    folder = tmp_path_factory.mktemp("raw")
    for name, rows in {"business": BUSINESSES, "checkin": CHECKINS, "tip": TIPS, "user": USERS}.items():
        (folder / f"{name}.json").write_text("".join(json.dumps(r) + "\n" for r in rows))
    (folder / "sentiments.csv").write_text("word,sentiment\ngreat,1\nbad,-1\nGREAT,1\nmeh,0\ngreat,1\n")
    (folder / "positive_words.txt").write_text("great\ngood\n")
    (folder / "negative_words.txt").write_text("bad\n")
    (folder / "name_gender.csv").write_text("name,gender\nAnn,female\nSam,male\nSam,female\n")
    return str(folder)


@pytest.fixture(scope="module")
def built(spark, source, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("tables"))
    run_jobs(Run(spark, source, out, min_similarity=0.2, name_gender=True))
    return out


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_build_writes_every_table(spark, built):
    def read(table):
        return tables.read_table(spark, built, table)

    assert read(TABLES.directory).count() == 4
    assert set(read(TABLES.directory).columns) == set(directory.DIRECTORY_COLUMNS)
    assert rows(read(TABLES.business_categories), "business_id", "category") == [
        ("b1", "Coffee & Tea"), ("b1", "Food"), ("b4", "Bars"), ("b4", "Food"),
    ]
    assert rows(read(TABLES.categories), "category") == [("Bars",), ("Coffee & Tea",), ("Food",)]
    assert rows(read(TABLES.checkin_hourly), "business_id", "day_of_week", "day_hour", "check_in") == [
        ("b1", "Friday", "20:00", 2), ("b1", "Friday", "9:00", 1), ("b1", "Sunday", "0:00", 5), ("b4", "Friday", "20:00", 4),
    ]
    assert rows(read(TABLES.checkin_daily), "business_id", "day_of_week", "check_in") == [
        ("b1", "Friday", 3), ("b1", "Sunday", 5), ("b4", "Friday", 4),
    ]
    assert rows(read(TABLES.positive_words), "word", "sentiment") == [("GREAT", 1), ("great", 1)]
    assert rows(read(TABLES.negative_words), "word", "sentiment") == [("bad", -1)]
    assert rows(read(TABLES.users), "user_id", "gender") == [("u1", "female"), ("u2", None), ("u3", None)]
    assert [str(r.yelp_since) for r in read(TABLES.users).orderBy("user_id").collect()] == ["2012-02-25", "None", "None"]
    scored = {r.business_id: r for r in read(TABLES.sentiments).collect()}
    assert scored.keys() == {"b1", "b2", "b3", "b4"}
    assert scored["b1"].avg_sentiments == pytest.approx(1 / 3) and scored["b1"].n_tokens == 4
    assert scored["b4"].avg_sentiments is None and scored["b4"].n_tokens == 0
    assert rows(read(TABLES.business_similarity), "jaccard") == [(1 / 3,)]


def test_rebuild_over_earlier_tables(spark, source, built, tmp_path):
    newer = tmp_path / "newer"
    newer.mkdir()
    changed = dict(BUSINESSES[0], stars=1.0)
    added = dict(BUSINESSES[0], business_id="b5")
    (newer / "business.json").write_text(json.dumps(changed) + "\n" + json.dumps(added) + "\n")
    out = str(tmp_path / "out")
    run_jobs(Run(spark, str(newer), out, previous=built), ["directory"])
    stars = {r.business_id: r.stars for r in tables.read_table(spark, out, TABLES.directory).collect()}
    assert stars == {"b1": 1.0, "b2": 3.0, "b3": 2.0, "b4": 5.0, "b5": 4.5}
    with pytest.raises(ValueError):
        run_jobs(Run(spark, source, out), ["nonsense"])


def test_word_lists(spark, source, tmp_path):
    run_jobs(Run(spark, source, str(tmp_path), word_lists=True), ["lexicon"])
    assert rows(tables.read_table(spark, str(tmp_path), TABLES.positive_words), "word", "sentiment") == [("good", 1), ("great", 1)]


def test_command_line(spark, built, source, tmp_path, capfd):
    report = ["report", "--tables", built, "--lat", "43.65", "--lon", "-79.38", "--km", "10", "--categories", "Food, Bars"]
    run_command(spark, parser().parse_args([*report, "--out", str(tmp_path / "r")]))
    lines = spark.read.parquet(str(tmp_path / "r"))
    assert rows(lines.where("section = 'competitor'"), "label") == [("b1",), ("b4",)]
    assert rows(lines.where("section = 'positive'"), "label", "value") == [("GREAT", 1.0), ("great", 1.0)]
    run_command(spark, parser().parse_args(["search", "--tables", built, "--text", "offee"]))
    assert "Coffee & Tea" in capfd.readouterr().out
    with pytest.raises(SystemExit):
        run_command(spark, parser().parse_args(["search", "--tables", built, "--text", "of"]))
    run_command(spark, parser().parse_args(["build", "--source", source, "--out", str(tmp_path / "b"), "--jobs", "directory"]))
    assert tables.read_table(spark, str(tmp_path / "b"), TABLES.directory).count() == 4
    assert list(JOBS)[0] == "directory"


def test_malformed_lines(spark, source, tmp_path):
    path = tmp_path / "business.json"
    path.write_text(json.dumps(BUSINESSES[0]) + "\n{not json\n")
    kept = raw.read_businesses(spark, str(tmp_path), "PERMISSIVE").select("business_id", schemas.CORRUPT).collect()
    assert [(r[0], r[1]) for r in kept] == [("b1", None), (None, "{not json")]
    with pytest.raises(Exception, match="(?i)malformed"):
        raw.read_businesses(spark, str(tmp_path)).collect()
    run_jobs(Run(spark, str(tmp_path), str(tmp_path / "out"), mode="PERMISSIVE"), ["directory"])
    assert tables.read_table(spark, str(tmp_path / "out"), TABLES.directory).count() == 1
    assert tables.read_table(spark, str(tmp_path / "out"), f"{TABLES.directory}_rejected").count() == 1
    (tmp_path / "sentiments.csv").write_text("word,sentiment\ngreat,very\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        raw.read_lexicon_csv(spark, str(tmp_path / "sentiments.csv")).collect()


def test_a_business_without_a_city_is_set_aside(spark, tmp_path):
    (tmp_path / "business.json").write_text(json.dumps(BUSINESSES[0]) + "\n" + json.dumps(dict(BUSINESSES[1], city=None)) + "\n")
    run_jobs(Run(spark, str(tmp_path), str(tmp_path / "out")), ["directory"])
    rejected = tables.read_table(spark, str(tmp_path / "out"), f"{TABLES.directory}_rejected")
    assert rows(rejected, "business_id", "name") == [("b2", "B")]


def test_known_genders_stay(spark):
    users = spark.createDataFrame([(1, "Ann", "m"), (2, "Ann", None), (3, "Zoe", "f")], "user_id int, name string, gender string")
    names = spark.createDataFrame([("Ann", "f")], "name string, gender string")
    assert rows(directory.enrich_users(users, names), "user_id", "gender") == [(1, "m"), (2, "f"), (3, "f")]


def test_keys_of_many_pairs_are_hot(spark, monkeypatch):
    from dataclasses import replace

    from sitescout import joins

    monkeypatch.setattr(joins, "SETTINGS", replace(joins.SETTINGS, pairs_per_slice=100))
    keys = spark.range(49).select(F.lit("k").alias("k"))
    assert [(r.left_slices, r.right_slices) for r in hot_keys(keys, keys, "k", 50).collect()] == [(5, 5)]


def test_raw_readers_take_directories_and_views_are_registered(spark, source, built):
    assert raw.read_tips(spark, source).count() == 4
    assert raw.read_json_lines(spark, source + "/tip*.json", schemas.RAW_TIP).count() == 4
    tables.read_table(spark, built, TABLES.categories)
    assert spark.sql("select count(*) from categories where category like :p", args={"p": "%oo%"}).first()[0] == 1


def test_literal_rows(spark):
    assert raw.from_rows(spark, [], "business_id string").count() == 0
    dicts = raw.from_rows(spark, [{"b": 2, "a": 1}], "a int, b int").first()
    assert (dicts.a, dicts.b) == (1, 2)


def test_categories(spark):
    raw_rows = spark.createDataFrame(
        [("b1", ["x", "y", "x", None]), ("b2", None), ("b3", [])], "business_id string, categories array<string>"
    )
    assert [r.category for r in categories.explode_categories(raw_rows).collect()] == ["x", "y", "x", None]
    pairs = categories.category_pairs(raw_rows)
    assert rows(pairs, "business_id", "category") == [("b1", "x"), ("b1", "y")]
    assert rows(categories.category_cardinality(pairs), "businesses", "categories") == [(1, 2)]
    assert categories.business_ids(categories.explode_categories(raw_rows)).count() == 4


def test_containment_counts_each_wanted_category_once(spark):
    many = [f"c{i}" for i in range(150)]
    pairs = spark.createDataFrame(
        [("all", c) for c in many] + [("one", "c149"), ("one", "c149"), ("other", "q")], "business_id string, category string"
    )
    score = {r.business_id: r.score for r in categories.category_containment(pairs, many).collect()}
    assert score == {"all": 1.0, "one": 1 / 150, "other": 0.0}
    assert categories.category_containment(pairs, ["c149", "zz"]).where("business_id = 'one'").first().score == 0.5


def test_category_search(spark):
    df = spark.createDataFrame([("Coffee",), ("iced coffee",), ("100% Fun",), ("COFFEE",)], "category string")
    assert {r[0] for r in categories.category_search(df, "coffee").collect()} == {"Coffee", "iced coffee"}
    assert categories.category_search(df, "%").count() == 1
    assert [r[0] for r in categories.category_search(df, "coffee", 1).collect()] == ["Coffee"]


def test_wanted_categories():
    assert wanted_categories(" Food,Coffee & Tea,,Food ") == ["Food", "Coffee & Tea"]
    with pytest.raises(ValueError):
        wanted_categories([""])


def test_city_directory(spark):
    df = spark.createDataFrame([("toronto", "ON"), ("TORONTO", "ON"), ("new-york", "NY")], "city string, state string")
    assert rows(directory.city_directory(df), "city", "state") == [("New-York", "NY"), ("Toronto", "ON")]


def test_daily_is_the_sum_of_hourly(spark):
    hourly = spark.createDataFrame(
        [("a", "Sunday", f"{h}:00", h) for h in range(24)], "business_id string, day_of_week string, day_hour string, check_in int"
    )
    assert rows(checkins.checkins_daily(hourly), "check_in") == [(sum(range(24)),)]


TARGET = "id int, a string, b int"


def test_upsert_replaces_adds_and_collapses(spark):
    target = spark.createDataFrame([(1, "x", 1), (2, "y", 2)], TARGET)
    source = spark.createDataFrame([(2, "z", 9), (2, "z", 9), (3, "w", None)], TARGET)
    assert rows(tables.upsert(target, source, ["id"]), "id", "a", "b") == [(1, "x", 1), (2, "z", 9), (3, "w", None)]


def test_upsert_keeps_columns_the_source_lacks(spark):
    target = spark.createDataFrame([(1, "x", 1), (2, "y", 2)], TARGET)
    source = spark.createDataFrame([(2, 9), (3, 8)], "id int, b int")
    assert rows(tables.upsert(target, source, ["id"]), "id", "a", "b") == [(1, "x", 1), (2, "y", 9), (3, None, 8)]


def test_upsert_takes_the_latest(spark):
    target = spark.createDataFrame([], "id int, v string, at int")
    source = spark.createDataFrame([(1, "old", 1), (1, "new", 2), (1, "mid", 1)], "id int, v string, at int")
    assert rows(tables.upsert(target, source, ["id"], order_by="at"), "id", "v") == [(1, "new")]


def test_upsert_is_idempotent_and_never_in_place(spark, tmp_path):
    df = spark.createDataFrame([(1, "x", 1), (2, "y", 2)], TARGET)
    tables.write_table(df, str(tmp_path / "a"), "t")
    again = tables.upsert_table(spark, str(tmp_path / "a"), "t", df, ["id"], str(tmp_path / "b"))
    assert rows(again, "id", "a", "b") == rows(df, "id", "a", "b")
    with pytest.raises(ValueError):
        tables.upsert_table(spark, str(tmp_path / "a"), "t", df, ["id"], str(tmp_path / "a"))


def test_bucketed_tables_join_without_a_shuffle(spark):
    for name in ("bucketed_left", "bucketed_right"):
        tables.write_bucketed(spark.range(100).withColumnRenamed("id", "business_id"), name, "business_id", 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        joined = spark.table("bucketed_left").join(spark.table("bucketed_right"), "business_id")
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == 100
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_hot_keys_are_sliced_without_changing_the_join(spark):
    left = spark.range(300).select(F.col("id").alias("l"), F.when(F.col("id") < 200, "hot").otherwise("cold").alias("k"))
    right = spark.range(60).select(F.col("id").alias("r"), F.when(F.col("id") < 40, "hot").otherwise("cold").alias("k"))
    hot = hot_keys(left, right, "k", 25)
    a, b = slice_hot_keys(left, right, "k", F.col("l"), F.col("r"), hot)
    sliced = a.join(b, ["k", "left_slice", "right_slice"]).select("l", "r")
    assert rows(sliced, "l", "r") == rows(left.join(right, "k"), "l", "r")
    assert a.where("k = 'hot'").select("left_slice").distinct().count() == 8


def test_join_hot_cuts_one_side_or_both(spark):
    left = spark.range(200).select(F.col("id").alias("l"), (F.col("id") > 150).cast("int").alias("k"))
    right = spark.createDataFrame([(0, "a"), (0, "b"), (1, "c")], "k int, r string")
    expected = rows(left.join(right, "k"), "l", "r")
    assert rows(join_hot(left, right, "k", F.col("l"), per_slice=9), "l", "r") == expected
    assert rows(join_hot(left, right, "k", F.col("l"), F.col("r"), per_slice=1), "l", "r") == expected


def test_lookup_join_by_broadcast_and_by_slices(spark):
    facts = spark.range(100).select(F.col("id"), F.when(F.col("id") < 90, "a").otherwise(F.col("id").cast("string")).alias("k"))
    dim = spark.createDataFrame([("a", 1), ("95", 2)], "k string, v int")
    for how in ("left", "inner"):
        expected = rows(facts.join(dim, "k", how), "id", "k", "v")
        assert rows(lookup_join(facts, dim, "k", F.col("id"), how), "id", "k", "v") == expected
        assert rows(lookup_join(facts, dim, "k", F.col("id"), how, max_bytes=0, per_slice=7), "id", "k", "v") == expected


def test_size_check_decides_the_broadcast(spark):
    df = spark.range(10)
    analysed = [size_checked(df, n)._jdf.queryExecution().analyzed().toString() for n in (160, 159)]
    assert ["broadcast" in plan for plan in analysed] == [True, False]


def test_keep_selected_does_not_repeat_rows(spark):
    facts = spark.createDataFrame([("a", 1), ("b", 2)], "business_id string, v int")
    ids = spark.createDataFrame([("a",), ("a",)], "business_id string")
    assert rows(keep_selected(facts, ids), "v") == [(1,)]


def test_shared_results_go_to_the_checkpoint_folder(spark, tmp_path):
    before = spark.sparkContext.getCheckpointDir()
    spark.sparkContext.setCheckpointDir(str(tmp_path))
    kept = cut_lineage(spark.range(5))
    assert list(tmp_path.rglob("part-*")) and kept.count() == 5
    assert "Range" not in kept._jdf.queryExecution().optimizedPlan().toString()
    if before:
        spark.sparkContext.setCheckpointDir(before)


def test_sides_of_a_sliced_join_are_not_broadcast_by_their_compressed_size(spark, tmp_path):
    # one file of a few kB that explodes to many rows, far below Spark's own limit by its estimate
    spark.range(2000).select(F.lit(1).alias("key"), "id").write.parquet(str(tmp_path / "few"))
    few = spark.read.parquet(str(tmp_path / "few"))
    many = few.withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(5))))
    joined = join_hot(many, few.withColumnRenamed("id", "other"), "key", F.struct("id", "n"), F.col("other"), per_slice=1000)
    assert joined.count() == 2000 * 5 * 2000
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") == 1 and plan.count("BroadcastHashJoin") == 2  # those of the hot keys
    assert "SortMergeJoin" in many.join(size_checked(few, max_bytes=1), "key")._jdf.queryExecution().executedPlan().toString()
