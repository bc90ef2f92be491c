
from __future__ import annotations

import os
import sys
from collections.abc import Callable
from dataclasses import replace
from importlib.util import find_spec

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import Column, DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

import fixtures as fx  # noqa: E402
from oracles import ORACLES  # noqa: E402
from sitescout import joins, sql  # noqa: E402
from sitescout.operators import (  # noqa: E402
    categories, checkins, competitors, directory, rollups, search_index, sentiment, similarity, word_lists,
)
from sitescout.plans import batch, increments, nearest, report  # noqa: E402
from sitescout.sources import inferred, raw  # noqa: E402
from sitescout.sources.keyed import KeyedTable  # noqa: E402

Query = Callable[[SparkSession, str], DataFrame]


def _rounded(df: DataFrame, places: int = 4) -> DataFrame:
    return df.withColumn("distance", F.round("distance", places))


def _competitors(spark: SparkSession, sf: str) -> DataFrame:
    return competitors.competitors(
        fx.business(spark, sf), fx.business_categories(spark, sf), fx.WANTED, **fx.SITE
    )


def _selected(spark: SparkSession, sf: str) -> DataFrame:
    """The ids of the competitors, found once, and broadcast if they are few."""
    found = competitors.find_competitors(
        fx.business(spark, sf), fx.business_categories(spark, sf), fx.WANTED, **fx.SITE
    )
    return joins.size_checked(joins.cut_lineage(found.select("business_id")))


def _bag_text(words: str) -> Column:
    return F.array_join(
        F.transform(words, lambda w: F.concat(w["word"], F.lit(":"), w["n"].cast("string"))), " "
    ).alias(words)


# ---- sources and sinks


def json_props_parse(spark, sf):
    events = fx.table(spark, sf, "events")
    return events.select("event_id", raw.parse_json(F.col("props"), "k int")["k"].alias("k"))


def json_inferred(spark, sf):
    """Events as JSON lines of differing fields, one of them of two types, read without a schema."""
    events = fx.table(spark, sf, "events")
    own = ["event_id", F.when(F.col("event_type") == "click", F.col("value")).alias("amount")]
    own += [F.when(F.col("event_type") != "click", F.col("user_id")).alias("visitor"), F.from_json("props", "k int").alias("props")]
    as_number = F.to_json(F.struct(*own, F.col("user_id").alias("mark")))
    as_text = F.to_json(F.struct(*own, F.concat(F.lit("u"), "user_id").alias("mark")))
    lines = events.select(F.when(F.col("event_id") % 2 == 0, as_number).otherwise(as_text).alias("value"))
    objects = joins.cut_lineage(inferred.parse_objects(lines))
    rows = inferred.typed(objects, inferred.inferred_schema(objects))
    return rows.select("event_id", "amount", "visitor", F.col("props.k").alias("k"), F.col("mark").cast("string").alias("mark"))


def literal_id_list_join(spark, sf):
    ids = raw.from_rows(spark, [(1,), (2,), (3,)], "business_id long")
    return fx.business(spark, sf).join(F.broadcast(ids), "business_id", "left_semi").select("business_id", "name")


def keyed_upsert(spark, sf):
    """Closed businesses are rated anew and one business is added; names stay as they are.

    The table is stored by key first; the batch rewrites the buckets its keys fall in.
    """
    target = fx.business(spark, sf).select("business_id", "name", "stars", "review_count")
    closed = fx.business(spark, sf).where("is_open = 0").select("business_id", F.lit(1.0).alias("stars"))
    added = raw.from_rows(spark, [(-1, 5.0)], "business_id long, stars double")
    table = KeyedTable.create(target, joins.scratch_path(spark, "keyed_upsert"), ["business_id"], buckets=16)
    table.upsert(closed.unionByName(added))
    return table.read()


def report_map_rows(spark, sf):
    return _rounded(competitors.report_map_rows(_competitors(spark, sf), fx.SITE["lat"], fx.SITE["lon"]))


# ---- directories


def business_directory(spark, sf):
    return fx.business(spark, sf)


def user_directory(spark, sf):
    return directory.user_directory(fx.raw_users(spark, sf))


def city_directory(spark, sf):
    return directory.city_directory(fx.business(spark, sf))


def name_enrichment(spark, sf):
    users = fx.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("user_id"), F.col("c_mktsegment").alias("name")
    )
    genders = raw.from_rows(spark, fx.NAME_GENDER, "name string, gender string")
    return directory.enrich_users(users, genders)


# ---- categories


def category_explode(spark, sf):
    sets = categories.category_sets(fx.business_categories(spark, sf))
    return categories.explode_categories(sets)


def category_sets(spark, sf):
    sets = categories.category_sets(fx.business_categories(spark, sf))
    return sets.select("business_id", F.array_join("categories", ", ").alias("categories"))


def business_id_list(spark, sf):
    return categories.business_ids(fx.business_categories(spark, sf))


def category_dictionary(spark, sf):
    return categories.category_dictionary(fx.business_categories(spark, sf))


def category_search(spark, sf):
    return categories.category_search(category_dictionary(spark, sf), "bolt")


def category_search_indexed(spark, sf):
    path = joins.scratch_path(spark, "grams")
    search_index.write_index(category_dictionary(spark, sf), "category", path)
    return search_index.search_index(search_index.read_index(spark, path), "bolt")


def category_cardinality_by_city(spark, sf):
    """Distinct businesses by city, by state, over all and by category, from bitmaps made once."""
    business = fx.business(spark, sf)
    bitmaps = rollups.category_bitmaps(fx.business_categories(spark, sf), business, rollups.number_by_place(business))
    return rollups.cardinality_levels(joins.cut_lineage(bitmaps))


def category_cardinality(spark, sf):
    return categories.category_cardinality(fx.business_categories(spark, sf))


def category_containment(spark, sf):
    return categories.category_containment(fx.business_categories(spark, sf), fx.WANTED)


def category_profiles(spark, sf):
    return similarity.category_profiles(fx.business_categories(spark, sf)).drop("categories")


def pairwise_jaccard(spark, sf):
    return similarity.pairwise_jaccard(fx.business_categories(spark, sf), fx.MIN_SIMILARITY)


def similar_businesses(spark, sf):
    pairs = fx.business_categories(spark, sf)
    chosen = fx.business(spark, sf).where(F.col("business_id") % 50 == 0)
    return similarity.similar_businesses(pairs, chosen, fx.MIN_SIMILARITY / 2)


# ---- competitors


def radius_search(spark, sf):
    return _rounded(competitors.radius_search(fx.business(spark, sf), **fx.SITE))


def site_competitors(spark, sf):
    return _rounded(_competitors(spark, sf))


def top_competitors(spark, sf):
    return _rounded(competitors.top_competitors(_competitors(spark, sf)))


# ---- check-ins


def checkin_flatten_nested(spark, sf):
    hours = F.map_from_entries(F.collect_list(F.struct("day_hour", "check_in")))
    days = fx.checkin_hourly(spark, sf).groupBy("business_id", "day_of_week").agg(hours.alias("hours"))
    nested = F.map_from_entries(F.collect_list(F.struct("day_of_week", "hours")))
    return checkins.checkins_hourly(days.groupBy("business_id").agg(nested.alias("time")))


def checkin_flatten_json(spark, sf):
    """Hourly check-ins out of JSON texts of days and hours, with no schema stated."""
    hours = F.map_from_entries(F.collect_list(F.struct("day_hour", "check_in")))
    days = fx.checkin_hourly(spark, sf).groupBy("business_id", "day_of_week").agg(hours.alias("hours"))
    nested = days.groupBy("business_id").agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("day_of_week", "hours")))).alias("t"))
    return inferred.checkins_from_json(nested.select("business_id", F.parse_json("t").alias("time")))


def checkin_daily_delta(spark, sf):
    """Daily totals after a batch of hours, given twice, from the changed hours alone."""
    hourly, daily = increments.create_checkin_tables(
        fx.checkin_hourly(spark, sf), joins.scratch_path(spark, "checkins"), buckets=16
    )
    hourly.upsert(fx.checkin_batch(spark, sf))
    increments.update_daily(hourly, daily)
    hourly.upsert(fx.checkin_batch(spark, sf))
    increments.update_daily(hourly, daily)
    return daily.read()


def weekday_profile(spark, sf):
    return checkins.weekday_profile(fx.checkin_daily(spark, sf), _selected(spark, sf))


def hour_profile(spark, sf):
    return checkins.hour_profile(fx.checkin_hourly(spark, sf), _selected(spark, sf))


# ---- tips and sentiment


def business_tip_bag(spark, sf):
    return sentiment.tip_bag(fx.business(spark, sf), fx.tip_tokens(spark, sf))


def business_word_lists(spark, sf):
    chunks = word_lists.word_chunks(fx.tips(spark, sf, "doc_id"), "doc_id", size=1000)
    return chunks.select("business_id", "chunk_no", F.size("words").alias("n"), F.array_join("words", " ").alias("words"))


def lexicon_join(spark, sf):
    return sentiment.lexicon_join(fx.tip_tokens(spark, sf), fx.lexicon(spark, sf))


def lexicon_split(spark, sf):
    positive, negative = sentiment.split_lexicon(fx.lexicon(spark, sf))
    return positive.select(F.lit("positive").alias("side"), "word", "sentiment").unionByName(
        negative.select(F.lit("negative").alias("side"), "word", "sentiment")
    )


def lexicon_union(spark, sf):
    return sentiment.union_lexicon(*sentiment.split_lexicon(fx.lexicon(spark, sf)))


def business_sentiment(spark, sf):
    scored = fx.sentiments(spark, sf)
    kept = [c for c in scored.columns if c not in ("pos_words", "neg_words")]
    return scored.select(*kept, _bag_text("pos_words"), _bag_text("neg_words"))


def _word_counts(polarity: int) -> Query:
    return lambda spark, sf: sentiment.word_counts(fx.sentiments(spark, sf), _selected(spark, sf), polarity)


# ---- reports


def sql_competitors(spark, sf):
    """The competitors by the SQL table function, its values given by name."""
    sql.register(spark, fx.site_tables(spark, sf))
    found = sql.run(spark, "competitors", wanted=", ".join(fx.WANTED), **fx.SITE)
    return _rounded(found).select(*competitors.NEARBY_COLUMNS, "distance", "score")


def sql_weekday_profile(spark, sf):
    sql.register(spark, fx.site_tables(spark, sf))
    return sql.run(spark, "weekday_profile", wanted=", ".join(fx.WANTED), **fx.SITE)


def site_report(spark, sf):
    lines = report.report_lines(report.site_report(fx.site_tables(spark, sf), fx.WANTED, **fx.SITE))
    is_distance = F.col("section").isin("competitor", "map")
    return lines.withColumn("value", F.when(is_distance, F.round("value", 4)).otherwise(F.col("value")))


def _batch(spark: SparkSession, sf: str) -> DataFrame:
    return batch.batch_competitors(
        fx.sites(spark, sf), fx.business(spark, sf), fx.business_categories(spark, sf)
    )


def _batch_search(spark: SparkSession, sf: str) -> batch.Search:
    return batch.Search(fx.sites(spark, sf), fx.business(spark, sf), fx.business_categories(spark, sf))


def batch_competitors(spark, sf):
    return _rounded(_batch(spark, sf), 3).select("site_id", "business_id", "name", "stars", "distance", "score")


def batch_top_competitors(spark, sf):
    return batch.batch_top_competitors(replace(_batch_search(spark, sf), decimals=3))


def batch_nearest(spark, sf):
    return nearest.batch_nearest(fx.sites(spark, sf), fx.business(spark, sf), k=5)


def batch_weekday_profile(spark, sf):
    return batch.batch_weekday_profile(fx.checkin_daily(spark, sf), _batch_search(spark, sf))


def batch_hour_profile(spark, sf):
    return batch.batch_hour_profile(fx.checkin_hourly(spark, sf), _batch_search(spark, sf))


def _batch_words(polarity: int) -> Query:
    return lambda spark, sf: batch.batch_word_counts(fx.sentiments(spark, sf), _batch_search(spark, sf), polarity)


QUERIES: dict[str, Query] = {
    "json_props_parse": json_props_parse,
    "json_inferred": json_inferred,
    "literal_id_list_join": literal_id_list_join,
    "keyed_upsert": keyed_upsert,
    "report_map_rows": report_map_rows,
    "business_directory": business_directory,
    "user_directory": user_directory,
    "city_directory": city_directory,
    "name_enrichment": name_enrichment,
    "radius_search": radius_search,
    "category_containment": category_containment,
    "competitors": site_competitors,
    "top_competitors": top_competitors,
    "category_explode": category_explode,
    "category_sets": category_sets,
    "business_id_list": business_id_list,
    "category_dictionary": category_dictionary,
    "category_search": category_search,
    "category_search_indexed": category_search_indexed,
    "category_cardinality": category_cardinality,
    "category_cardinality_by_city": category_cardinality_by_city,
    "category_profiles": category_profiles,
    "pairwise_jaccard": pairwise_jaccard,
    "similar_businesses": similar_businesses,
    "checkin_hourly": fx.checkin_hourly,
    "checkin_flatten_nested": checkin_flatten_nested,
    "checkin_flatten_json": checkin_flatten_json,
    "checkin_daily": fx.checkin_daily,
    "checkin_daily_delta": checkin_daily_delta,
    "weekday_profile": weekday_profile,
    "hour_profile": hour_profile,
    "tip_tokens": fx.tip_tokens,
    "business_tip_bag": business_tip_bag,
    "business_word_lists": business_word_lists,
    "lexicon_join": lexicon_join,
    "lexicon_split": lexicon_split,
    "lexicon_union": lexicon_union,
    "business_sentiment": business_sentiment,
    "positive_word_counts": _word_counts(sentiment.POSITIVE),
    "negative_word_counts": _word_counts(sentiment.NEGATIVE),
    "sql_competitors": sql_competitors,
    "sql_weekday_profile": sql_weekday_profile,
    "site_report": site_report,
    "batch_competitors": batch_competitors,
    "batch_top_competitors": batch_top_competitors,
    "batch_nearest": batch_nearest,
    "batch_weekday_profile": batch_weekday_profile,
    "batch_hour_profile": batch_hour_profile,
    "batch_positive_word_counts": _batch_words(sentiment.POSITIVE),
    "batch_negative_word_counts": _batch_words(sentiment.NEGATIVE),
}


CORE = tuple(QUERIES)

# The corpus operators are one removable subpackage, with the pipeline built on them.
if getattr(find_spec("sitescout.llm"), "origin", None) and find_spec("corpus_pipeline"):
    import corpus_pipeline
    from sitescout.llm import queries as corpus_queries

    QUERIES.update(corpus_queries.QUERIES)
    QUERIES["pipeline"] = corpus_pipeline.run
    ORACLES.update(corpus_queries.ORACLES)
    if corpus_pipeline.ORACLE_SQL:
        ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL


def entry(spark: SparkSession) -> DataFrame:
    """The competitors of the planned business at sf0.001."""
    return site_competitors(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
