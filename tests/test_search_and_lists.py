import random

import pytest
from pyspark.sql import functions as F

from sitescout import sql
from sitescout.operators import categories, checkins, sentiment
from sitescout.operators.search_index import read_index, search_index, write_index
from sitescout.operators.word_lists import word_chunks
from sitescout.plans.report import SiteTables


def test_index_finds_what_a_scan_finds(spark, tmp_path):
    rng = random.Random(3)
    names = ["", "a", "ab", "Ab Ab", "Coffee & Tea", "coffee", "Café", "é", "x" * 50, "日本料理", None]
    names += ["".join(rng.choices("aAbB &", k=rng.randint(1, 9))) for _ in range(200)]
    df = spark.createDataFrame([(n,) for n in names + names[:5]], "category string")
    write_index(df, "category", str(tmp_path / "i"))
    index = read_index(spark, str(tmp_path / "i"))
    for text in ("a", "ab", "aba", "coff", "& T", "é", "本料", "xxxx", "zzz", "abab", "aBa a", "a" * 60):
        want = {r.category for r in categories.category_search(df, text).collect()}
        assert sorted(r.category for r in search_index(index, text).collect()) == sorted(want), text
    assert search_index(index, "").count() == len({n for n in names if n})
    assert [r.category for r in search_index(index, "coffee", limit=1).collect()] == ["Coffee & Tea"]
    with pytest.raises(ValueError):
        search_index(index, "a\x00")
    plan = search_index(index, "coffee")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(gram," in plan


@pytest.mark.parametrize("size, per_part", [(7, 100_000), (1, 3), (1000, 2)])
def test_chunks_are_the_lists(spark, size, per_part):
    rng = random.Random(size)
    rows = [(1 if i % 3 else rng.randint(2, 9), i, " ".join(rng.choices(["good", "Bad", "the", "x,y"], k=rng.randint(0, 30)))) for i in range(120)]
    rows += [(50, 1, None), (51, 2, "the of"), (None, 3, "lost"), (1, 500, "long " * 200)]
    tips = spark.createDataFrame(rows, "business_id int, tip int, text string").repartition(5)
    got = word_chunks(tips, "tip", size, tips_per_part=per_part).collect()
    lists = {}
    for business, _, text in sorted((r for r in rows if r[0] is not None), key=lambda r: r[:2]):
        lists.setdefault(business, []).extend(w.replace(",", "") for w in (text or "").split() if w not in ("the", "of"))
    want = {b: [ws[i : i + size] for i in range(0, len(ws), size)] for b, ws in lists.items() if ws}
    found = {}
    for r in sorted(got, key=lambda r: (r.business_id, r.chunk_no)):
        found.setdefault(r.business_id, []).append(r.words)
    assert found == want and len(got) == sum(map(len, want.values()))


def test_sql_functions_push_their_filters(spark, tmp_path):
    rows = [(i, f"n{i}", "t", 43.0 + i * 0.01, -79.0, 3.0 + i % 3, i) for i in range(50)]
    directory = spark.createDataFrame(rows, "business_id int, name string, city string, latitude double, longitude double, stars double, review_count int")
    directory.write.parquet(str(tmp_path / "d"))
    pairs = spark.createDataFrame([(i, c) for i in range(50) for c in ("Food", "Bars")[: 1 + i % 2]], "business_id int, category string")
    hourly = spark.createDataFrame([(i, "Friday", "9:00", i) for i in range(50)], "business_id int, day_of_week string, day_hour string, check_in int")
    tokens = spark.createDataFrame([(1, "x")], "business_id int, word string")
    lexicon = spark.createDataFrame([("x", 1)], "word string, sentiment int")
    scored = sentiment.business_sentiment(directory, tokens, lexicon)
    stored = spark.read.schema(directory.schema).parquet(str(tmp_path / "d"))
    sql.register(spark, SiteTables(stored, pairs, checkins.checkins_daily(hourly), hourly, scored))
    near = spark.sql("SELECT * FROM near_site(lat => :lat, lon => :lon)", args={"lat": 43.1, "lon": -79.0})
    assert sorted(r.business_id for r in near.collect()) == list(range(6, 15))
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(latitude" in plan[plan.index("PushedFilters"):]
    place = {"wanted": "Bars, Gyms ,", "lat": 43.1, "lon": -79.0, "km": 5.0}
    assert {(r.business_id, r.score) for r in sql.run(spark, "competitors", **place).collect()} == {(i, 0.5) for i in (7, 9, 11, 13)}
    assert [r.business_id for r in sql.run(spark, "top_competitors", **place).collect()] == [11, 7, 13, 9]
    assert [(r.day, r.check_ins) for r in sql.run(spark, "weekday_profile", **place).collect()] == [("Friday", 10.0)]
    assert [(r.hour, r.check_ins) for r in sql.run(spark, "hour_profile", **place).collect()] == [("9:00", 10.0)]
    assert [r.category for r in sql.run(spark, "category_search", text="ood").collect()] == ["Food"]
    assert spark.sql("SELECT * FROM category_match('Food')").where(F.col("score") == 1).count() == 50
