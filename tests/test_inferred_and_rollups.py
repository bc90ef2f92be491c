import json
import random

from pyspark.sql import functions as F

from sitescout import schemas
from sitescout.operators import rollups
from sitescout.sources import inferred, raw


def write(path, rows):
    path.write_text("".join((r if isinstance(r, str) else json.dumps(r)) + "\n" for r in rows))


def test_files_with_different_fields_are_one_table(spark, tmp_path):
    write(tmp_path / "a.json", [{"id": 1, "n": 2, "place": {"x": 1.5}}, {"id": 2, "tags": ["a"], "none": None}])
    write(tmp_path / "b.json", [{"id": 3, "n": 2.25, "place": {"y": "s"}, "odd `name": True}, "{broken", "[1]", "", {"id": 4, "mark": 1}])
    write(tmp_path / "c.json", [{"id": 5, "mark": "one", "list": [{"p": 1}, {"p": "q"}], "empty": {}}])
    rows, malformed, differing = inferred.read_json_inferred(spark, str(tmp_path))
    assert {f.name: f.dataType.simpleString() for f in rows.schema} == {
        "id": "bigint", "n": "double", "place": "struct<x:double,y:string>", "tags": "array<string>", "none": "string",
        "odd `name": "boolean", "mark": "variant", "list": "array<struct<p:variant>>", "empty": "variant",
    }
    got = {r["id"]: r for r in rows.collect()}
    assert sorted(got) == [1, 2, 3, 4, 5]
    assert (got[1]["n"], got[3]["n"], got[2]["n"]) == (2.0, 2.25, None)
    assert (got[1]["place"], got[3]["place"], got[2]["place"]) == ((1.5, None), (None, "s"), None)
    assert (got[2]["tags"], got[3]["odd `name"], got[2]["none"]) == (["a"], True, None)
    assert (got[4]["mark"].toPython(), got[5]["mark"].toPython()) == (1, "one")
    assert sorted(differing) == ["empty", "list[].p", "mark"]
    assert sorted(r[0] for r in malformed.collect()) == ["[1]", "{broken"]


def test_equals_the_reader_with_a_schema(spark, tmp_path):
    write(tmp_path / "tip.json", [{"business_id": f"b{i % 3}", "user_id": f"u{i}", "text": "é " * i, "likes": i, "date": "2014-01-01"} for i in range(20)])
    stated = raw.read_json_lines(spark, str(tmp_path / "tip.json"), schemas.RAW_TIP)
    rows, malformed, differing = inferred.read_json_inferred(spark, str(tmp_path / "tip.json"))
    same = rows.select(*[F.col(f.name).cast(f.dataType) for f in stated.schema])
    assert sorted(same.collect()) == sorted(stated.collect())
    assert malformed.count() == 0 and differing == []


def test_no_lines_and_no_objects(spark, tmp_path):
    for name, rows in (("none", []), ("bad", ["{", "3"])):
        (tmp_path / name).mkdir()
        write(tmp_path / name / "x.json", rows)
        found, malformed, differing = inferred.read_json_inferred(spark, str(tmp_path / name))
        assert (found.columns, malformed.count(), differing) == ([], len(rows), [])


def test_checkins_of_any_days_and_hours(spark):
    rows = [("a", '{"Friday": {"20:00": 2, "21:00": 1}, "Holiday": {"1:00": 7}}'), ("b", "{}"), ("c", None), ("d", '{"Monday": {}}')]
    nested = spark.createDataFrame(rows, "business_id string, t string").select("business_id", F.parse_json("t").alias("time"))
    got = sorted(map(tuple, inferred.checkins_from_json(nested).collect()))
    assert got == [("a", "Friday", "20:00", 2), ("a", "Friday", "21:00", 1), ("a", "Holiday", "1:00", 7)]


def test_counts_equal_sets(spark):
    rng = random.Random(5)
    business = [(f"b{i}", rng.choice(["ON", "QC", None]), rng.choice(["x", "y", None])) for i in range(300)]
    business += [("b7", "ON", "elsewhere"), business[8], (None, "ON", "x")]
    pairs = [(f"b{rng.randrange(320)}", rng.choice("pqrs")) for _ in range(900)]
    pairs += [pairs[0], (None, "p")]
    directory = spark.createDataFrame(business, "business_id string, state string, city string")
    table = spark.createDataFrame(pairs, "business_id string, category string")
    bitmaps = rollups.category_bitmaps(table, directory, rollups.number_by_place(directory))
    facts = {(c, s, t, b) for b, c in pairs if b is not None for b2, s, t in business if b == b2}
    for by, at in ((["state", "city"], (1, 2)), (["state"], (1,)), (["category"], (0,)), (["category", "city"], (0, 2)), ([], ())):
        want = {}
        for f in facts:
            want.setdefault(tuple(f[i] for i in at), set()).add(f[3])
        got = {tuple(r)[:-1]: r.businesses for r in rollups.distinct_businesses(bitmaps, by).collect()}
        assert got == {k: len(v) for k, v in want.items()}


def test_nothing_to_count(spark):
    directory = spark.createDataFrame([], "business_id long, state string, city string")
    table = spark.createDataFrame([(1, "p")], "business_id long, category string")
    bitmaps = rollups.category_bitmaps(table, directory, rollups.number_by_place(directory))
    assert [tuple(r) for r in rollups.cardinality_levels(bitmaps).collect()] == [("all", None, None, None, 0)]


def test_bitmaps_are_merged_in_a_fixed_number_of_tasks(spark):
    schema = "category string, state string, city string, block long, bits binary"
    bitmaps = spark.createDataFrame([("c", "s", "t", b, bytearray(b"\xff" * 4096)) for b in range(50)], schema)
    merged = rollups.distinct_businesses(bitmaps, ["city"])
    assert merged.first()["businesses"] == 50 * 32768
    # dealt by number: else these bitmaps, all alike, are so small in a shuffle that one task gets them all
    assert "REPARTITION_BY_NUM" in merged._jdf.queryExecution().toString()
