"""Readers of the raw files. Schemas are explicit: nothing is inferred, so nothing is read twice."""

from __future__ import annotations

import os
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sitescout import schemas


def read_json_lines(
    spark: SparkSession, path: str, schema: T.StructType, mode: str = "FAILFAST"
) -> DataFrame:
    """One JSON object per line; ``path`` may be a file, a directory or a glob.

    FAILFAST ends the job at the first malformed line. PERMISSIVE keeps the line's text in a
    ``_corrupt_record`` column and leaves the other columns NULL.
    """
    reader = spark.read.option("mode", mode)
    if mode.upper() == "PERMISSIVE":
        schema = T.StructType([*schema.fields, T.StructField(schemas.CORRUPT, T.StringType())])
        reader = reader.option("columnNameOfCorruptRecord", schemas.CORRUPT)
    return reader.schema(schema).json(path)


def read_businesses(spark: SparkSession, directory: str, mode: str = "FAILFAST") -> DataFrame:
    return read_json_lines(spark, os.path.join(directory, "business.json"), schemas.RAW_BUSINESS, mode)


def read_checkins(spark: SparkSession, directory: str, mode: str = "FAILFAST") -> DataFrame:
    return read_json_lines(spark, os.path.join(directory, "checkin.json"), schemas.RAW_CHECKIN, mode)


def read_tips(spark: SparkSession, directory: str, mode: str = "FAILFAST") -> DataFrame:
    return read_json_lines(spark, os.path.join(directory, "tip.json"), schemas.RAW_TIP, mode)


def read_users(spark: SparkSession, directory: str, mode: str = "FAILFAST") -> DataFrame:
    return read_json_lines(spark, os.path.join(directory, "user.json"), schemas.RAW_USER, mode)


def read_lexicon_csv(spark: SparkSession, path: str, mode: str = "FAILFAST") -> DataFrame:
    """(word, sentiment) from a CSV file with a header."""
    return spark.read.schema(schemas.LEXICON).option("header", True).option("mode", mode).csv(path)


def read_word_list(spark: SparkSession, path: str, sentiment: int) -> DataFrame:
    """(word, sentiment) from a text file with one word per line."""
    return spark.read.text(path).select(
        F.col("value").alias("word"), F.lit(sentiment).cast("int").alias("sentiment")
    )


def read_name_gender(spark: SparkSession, path: str, mode: str = "FAILFAST") -> DataFrame:
    """(name, gender) from a CSV file with a header."""
    return spark.read.schema(schemas.NAME_GENDER).option("header", True).option("mode", mode).csv(path)


def parse_json(column: Column, schema: T.DataType | str) -> Column:
    """Decode a JSON text column; a malformed value gives NULL."""
    return F.from_json(column, schema)


def from_rows(
    spark: SparkSession, rows: Iterable[Mapping[str, object] | tuple], schema: T.StructType | str
) -> DataFrame:
    """Literal rows, as dicts or tuples, with a stated schema (also right for no rows at all)."""
    return spark.createDataFrame(list(rows), schema)
