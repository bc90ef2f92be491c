import glob
import os
import random

import pytest
from pyspark.sql import functions as F

from sitescout.joins import release_scratch, scratch_path
from sitescout.operators.checkins import checkins_daily
from sitescout.plans.increments import create_checkin_tables, update_daily
from sitescout.sources.keyed import KeyedTable


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def files(folder):
    return {os.path.relpath(f, folder) for f in glob.glob(f"{folder}/data/**/*.parquet", recursive=True)}


@pytest.fixture
def table(spark, tmp_path):
    start = spark.range(2000).select("id", F.concat(F.lit("n"), "id").alias("name"), (F.col("id") % 7).cast("double").alias("v"))
    return KeyedTable.create(start, str(tmp_path / "t"), ["id"], buckets=32)


def test_batch_leaves_files_of_other_buckets(spark, table):
    before = files(table.directory)
    batch = spark.createDataFrame([(i, -1.0) for i in range(5)], "id long, v double")
    assert table.upsert(batch) == 2
    added = files(table.directory) - before
    assert before <= files(table.directory) and 0 < len(added) <= 5
    old, new = table.version(1).batches, table.version(2).batches
    assert sum(old[b] != new[b] for b in old) == len(added)
    assert rows(table.read()) == rows(table.read(1).withColumn("v", F.when(F.col("id") < 5, -1.0).otherwise(F.col("v"))))


def test_repeated_batch_changes_nothing(spark, table):
    batch = spark.createDataFrame([(3, "x", 9.5), (5000, "new", None)], "id long, name string, v double")
    assert table.upsert(batch) == 2
    before = files(table.directory)
    assert table.upsert(batch) == 2 and files(table.directory) == before
    assert table.upsert(spark.createDataFrame([], batch.schema)) == 2
    assert table.read().where("id in (3, 5000)").count() == 2 and table.read().count() == 2001


def test_columns_and_repeats_in_the_batch(spark, table):
    batch = spark.createDataFrame([(1, 5.0, 1), (1, 6.0, 2), (9000, 7.0, 1)], "id long, v double, at int")
    table.upsert(batch.select("id", "v", "at"), order_by="at")
    assert rows(table.read().where("id in (1, 9000)")) == [(1, "n1", 6.0), (9000, None, 7.0)]


def test_changes_between_versions(spark, table):
    table.upsert(spark.createDataFrame([(1, 50.0), (2, 2.0), (7000, 1.0)], "id long, v double"))
    table.upsert(spark.createDataFrame([(1, 60.0)], "id long, v double"))
    got = {r["id"]: (r["old"] and r["old"]["v"], r["new"]["v"]) for r in table.changes(1).collect()}
    assert got == {1: (1.0, 60.0), 7000: (None, 1.0)}
    assert table.changes(3).count() == 0
    assert rows(table.rows_of(spark.createDataFrame([(1,), (99999,)], "id long"))) == [(1, "n1", 60.0)]


def test_two_writers_of_one_version(spark, table):
    at = table.version()
    batch = spark.createDataFrame([(1, 50.0)], "id long, v double")
    table.upsert(batch)
    with pytest.raises(Exception, match="already exists|PATH_ALREADY_EXISTS"):
        table._commit(at, table._placed(table.read(1).limit(1)), {0}, "")
    assert rows(table.rows_of(batch)) == [(1, "n1", 50.0)]


def test_release_keeps_what_is_named(spark, table):
    for value in (1.5, 2.5, 3.5):
        table.upsert(spark.createDataFrame([(1, value)], "id long, v double"))
    want, before = rows(table.read()), files(table.directory)
    table.release(keep=1)
    assert rows(table.read()) == want and len(files(table.directory)) == len(before) - 2
    with pytest.raises(ValueError):
        table.read(1)


def test_random_batches_equal_a_dict(spark, tmp_path):
    rng = random.Random(1)
    held = {(rng.randint(0, 30), str(rng.randint(0, 3))): rng.randint(0, 9) for _ in range(40)}
    schema = "a int, b string, v int"
    table = KeyedTable.create(spark.createDataFrame([(*k, v) for k, v in held.items()], schema), str(tmp_path / "r"), ["a", "b"], 8)
    for _ in range(3):
        batch = {(rng.randint(0, 40), str(rng.randint(0, 3))): rng.randint(0, 9) for _ in range(rng.randint(1, 12))}
        held |= batch
        table.upsert(spark.createDataFrame([(*k, v) for k, v in batch.items()], schema))
        assert rows(table.read()) == sorted(((*k, v) for k, v in held.items()), key=repr)


def test_daily_follows_hourly(spark, tmp_path):
    rng = random.Random(2)
    schema = "business_id long, day_of_week string, day_hour string, check_in long"

    def some(n):
        found = {(rng.randint(0, 60), rng.choice(["Monday", "Sunday"]), f"{rng.randint(0, 5)}:00") for _ in range(n)}
        return spark.createDataFrame([(*k, rng.randint(0, 4)) for k in sorted(found)], schema)

    hourly, daily = create_checkin_tables(some(200), str(tmp_path), 16)
    for n in (30, 1, 60):
        batch = some(n)
        hourly.upsert(batch)
        if n == 1:
            continue  # the daily table falls behind, as if the job had died here
        version = update_daily(hourly, daily)
        assert rows(daily.read()) == rows(checkins_daily(hourly.read()))
        hourly.upsert(batch)
        assert update_daily(hourly, daily) == version


def test_scratch_is_released(spark):
    path = scratch_path(spark, "x")
    spark.range(3).write.parquet(path)
    local = path.removeprefix("file:")
    assert os.path.isdir(local)
    assert release_scratch(spark) >= 1 and not os.path.exists(local)
