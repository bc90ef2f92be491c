"""A positional index of three-character grams, for finding a text anywhere inside many short ones.

A stored row is (gram, position, value): the three characters of the value from that position on, the
last ones filled up with the NUL character, so that every character starts a gram. Rows lie in order of
their gram, so a search for a few grams reads only the files and row groups that hold them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitescout.joins import size_checked

GRAM = 3
_FILL = "\x00"
_SCHEMA = "gram string, position int, value string"


def write_index(values: DataFrame, column: str, path: str) -> None:
    """Stores the index of the distinct, non-null values of a column."""
    value = F.col(column).cast("string")
    distinct = values.select(value.alias("value")).where("value <> ''").distinct()
    places = F.posexplode(F.transform(F.sequence(F.lit(1), F.char_length("value")), lambda i: F.substring(F.concat("value", F.lit(_FILL * (GRAM - 1))), i, F.lit(GRAM))))
    grams = distinct.select("value", places.alias("position", "gram")).select("gram", "position", "value")
    grams.repartitionByRange("gram", "value").sortWithinPartitions("gram", "value").write.parquet(path)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_SCHEMA).parquet(path)


def _holding(index: DataFrame, text: str) -> DataFrame:
    if _FILL in text:
        raise ValueError("the text has a NUL character")
    value = F.col("value")
    if not text:
        return index.select("value")
    if len(text) < GRAM:  # some gram starts with it
        return index.where(F.col("gram").startswith(text)).select("value")
    offsets: dict[str, int] = {}
    for i in range(len(text) - GRAM + 1):
        offsets.setdefault(text[i : i + GRAM], i)
    listed = index.where(F.col("gram").isin(*offsets))
    counts = {r["gram"]: r["count"] for r in listed.groupBy("gram").count().collect()}  # at most one per gram
    if len(counts) < len(offsets):
        return index.where("false").select("value")
    rarest, *others = sorted(offsets, key=lambda g: (counts[g], g))
    at = (F.col("position") - F.lit(offsets[rarest])).alias("start")
    found = index.where(F.col("gram") == rarest).select("value", at).where(value.contains(text))
    if others:  # the next rarest must stand where the text has it; the rest is told by the value itself
        second = index.where(F.col("gram") == others[0]).select("value", (F.col("position") - F.lit(offsets[others[0]])).alias("start"))
        found = found.join(size_checked(second), ["value", "start"], "left_semi")
    return found.select("value")


def search_index(index: DataFrame, text: str, column: str = "category", limit: int | None = None) -> DataFrame:
    """Values holding ``text`` or its title-cased form, as ``category_search`` finds them, each once.

    The postings of the rarest gram come first and are checked against the value; a text shorter than a gram
    is looked up as the start of one, an empty text finds all values. ``limit`` asks for the first few.
    """
    found = reduce(DataFrame.unionByName, [_holding(index, t) for t in dict.fromkeys((text, text.title()))])
    found = found.distinct().withColumnRenamed("value", column)
    return found if limit is None else found.orderBy(column).limit(limit)
