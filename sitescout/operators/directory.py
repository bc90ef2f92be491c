"""Business, user and city directories."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitescout.functions.text import title
from sitescout.joins import lookup_join

# The columns of the directory.
DIRECTORY_COLUMNS = (
    "business_id", "city", "state", "latitude", "longitude", "stars",
    "review_count", "name", "neighborhood", "postal_code", "address", "is_open",
)


def business_directory(raw: DataFrame) -> DataFrame:
    return raw.select(*DIRECTORY_COLUMNS)


def user_directory(raw: DataFrame) -> DataFrame:
    """Users with ``yelp_since`` as a date and a ``gender`` still to be filled in."""
    return raw.select(
        "user_id",
        "name",
        F.col("yelping_since").try_cast("date").alias("yelp_since"),
        "fans",
        "review_count",
        F.lit(None).cast("string").alias("gender"),
    )


def enrich_users(users: DataFrame, name_gender: DataFrame) -> DataFrame:
    """Fill in ``gender`` by name where it is not known yet; NULL if the name is unknown or has two."""
    known = (
        name_gender.groupBy("name")
        .agg(F.min("gender").alias("_found"), F.max("gender").alias("_other"))
        .where(F.col("_found") == F.col("_other"))
        .drop("_other")
    )
    if "gender" not in users.columns:
        users = users.withColumn("gender", F.lit(None).cast("string"))
    joined = lookup_join(users, known, "name", F.col("user_id"))
    return joined.withColumn("gender", F.coalesce("gender", "_found")).select(*users.columns)


def city_directory(business: DataFrame) -> DataFrame:
    """Distinct (city, state), the city in title case. Titling runs once per spelling."""
    spellings = business.select("city", "state").distinct()
    return spellings.select(title(F.col("city")).alias("city"), "state").distinct()
