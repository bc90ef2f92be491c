"""The application's tables, derived from the driver's Parquet tables.

Orders stand for businesses, the parts of their lines for their categories (the part's name, and
the name with its brand), events for check-ins, documents for tips, the words of the benchmark
texts for the lexicon, and customers for users and for candidate sites. Every row is read. The
tips of the commonest source are all of one business, those of the others of many.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitescout.functions.calendar import hour_label, weekday_name
from sitescout.functions.text import words
from sitescout.operators import checkins, sentiment
from sitescout.plans.report import SiteTables

SITE = {"lat": 44.8, "lon": -78.0, "km": 150.0}
WANTED = ["red widget", "blue bolt"]
SEGMENT_WANTED = {
    "AUTOMOBILE": ["new gear", "hot rod", "cold plate"],
    "BUILDING": ["large plate", "old bolt", "small anvil", "new rod"],
    "FURNITURE": ["red gizmo", "blue ring"],
    "HOUSEHOLD": WANTED,
    "MACHINERY": ["hot gear", "cold bolt", "large rod", "red anvil", "new widget"],
}
NAME_GENDER = [("AUTOMOBILE", "f"), ("BUILDING", "m"), ("HOUSEHOLD", "f"), ("HOUSEHOLD", "m")]
MIN_SIMILARITY = 0.6


# Stated rather than read from the files, which would take a job per table.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
    "benchmark": "item_id long, text string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(os.path.join(sf_dir, f"{name}.parquet"))


def business(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    return (
        table(spark, sf_dir, "orders")
        .join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            key.alias("business_id"),
            F.concat(F.lit("Order#"), key.cast("string")).alias("name"),
            F.col("n_name").alias("city"),
            F.col("r_name").alias("state"),
            (F.lit(43.60) + ((key * 37) % 1000) * F.lit(0.004)).alias("latitude"),
            (F.lit(-79.50) + ((key * 53) % 1000) * F.lit(0.005)).alias("longitude"),
            (F.lit(1.0) + F.lit(0.5) * (key % 9)).alias("stars"),
            ((key * 7) % 300).cast("int").alias("review_count"),
            (F.col("o_orderstatus") != "F").cast("int").alias("is_open"),
        )
    )


def business_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shuffled once, by business and before names are doubled; it then stands as grouped by business."""
    names = F.array("p_name", F.concat_ws(" ", "p_name", "p_brand"))
    return (
        table(spark, sf_dir, "lineitem")
        .join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .select(F.col("l_orderkey").alias("business_id"), "p_name", "p_brand")
        .repartition("business_id")
        .select("business_id", F.explode(names).alias("category"))
        .distinct()
    )


def checkin_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "events")
        .groupBy(
            (F.col("user_id") + 15 * (F.col("event_id") % 100)).alias("business_id"),
            weekday_name(F.col("ts")).alias("day_of_week"),
            hour_label(F.col("ts")).alias("day_hour"),
        )
        .agg(F.count("*").alias("check_in"))
    )


def checkin_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checkins.checkins_daily(checkin_hourly(spark, sf_dir))


def checkin_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hours that arrive later: all of the weekends anew, one higher, and a holiday for open businesses."""
    weekends = checkin_hourly(spark, sf_dir).where(F.col("day_of_week").isin("Saturday", "Sunday"))
    holidays = business(spark, sf_dir).where("is_open = 1").select(
        "business_id", F.lit("Holiday").alias("day_of_week"), F.lit("12:00").alias("day_hour"), F.lit(1).cast("long").alias("check_in")
    )
    return weekends.withColumn("check_in", F.col("check_in") + 1).unionByName(holidays)


def tips(spark: SparkSession, sf_dir: str, *ids: str) -> DataFrame:
    number = F.expr("substring(source, 4)").cast("long")
    spread = F.when(number == 0, number).otherwise(number + 20 * (F.col("doc_id") % 75))
    return table(spark, sf_dir, "documents").select(spread.alias("business_id"), "text", *ids)


def tip_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentiment.tip_tokens(tips(spark, sf_dir))


def lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The distinct benchmark words: the short ones positive, middling ones negative, others 0."""
    word = F.explode(words(F.col("text"))).alias("word")
    size = F.length("word")
    return (
        table(spark, sf_dir, "benchmark")
        .select(word)
        .where(F.col("word") != "")
        .distinct()
        .select("word", F.when(size <= 4, 1).when(size <= 6, -1).otherwise(0).alias("sentiment"))
    )


def sentiments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentiment.business_sentiment(
        business(spark, sf_dir), tip_tokens(spark, sf_dir), lexicon(spark, sf_dir)
    )


def raw_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return (
        table(spark, sf_dir, "customer")
        .join(orders, F.col("c_custkey") == F.col("o_custkey"), "left")
        .groupBy(F.col("c_custkey").alias("user_id"), F.col("c_name").alias("name"))
        .agg(
            F.min("o_orderdate").cast("date").cast("string").alias("yelping_since"),
            F.count(F.when(F.col("o_orderstatus") == "F", 1)).alias("fans"),
            F.count("o_orderkey").alias("review_count"),
        )
    )


def sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer plans a business somewhere, of the kind its segment wants."""
    key = F.col("c_custkey")
    wanted = F.lit(None).cast("array<string>")
    for segment, names in SEGMENT_WANTED.items():
        wanted = F.when(
            F.col("c_mktsegment") == segment, F.array(*map(F.lit, names))
        ).otherwise(wanted)
    return table(spark, sf_dir, "customer").select(
        key.alias("site_id"),
        (F.lit(43.6015) + ((key * 29) % 1000) * F.lit(0.004)).alias("lat"),
        (F.lit(-79.4985) + ((key * 41) % 1000) * F.lit(0.005)).alias("lon"),
        (F.lit(5.0) + F.col("c_nationkey")).alias("km"),
        wanted.alias("wanted"),
    )


def site_tables(spark: SparkSession, sf_dir: str) -> SiteTables:
    return SiteTables(
        directory=business(spark, sf_dir),
        business_categories=business_categories(spark, sf_dir),
        checkin_daily=checkin_daily(spark, sf_dir),
        checkin_hourly=checkin_hourly(spark, sf_dir),
        sentiments=sentiments(spark, sf_dir),
    )
