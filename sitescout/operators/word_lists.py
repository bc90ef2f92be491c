"""The words of a business as lists with repeats, cut into chunks of bounded length.

The words of all tips of a business stand in the order of its tips, then of the words in a tip. Word number
n of a business is in chunk n // size, so chunks are the same however the work was dealt out, and a
business with a third of all tips is many rows instead of one that no task can hold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sitescout.functions.text import ENGLISH_STOP_WORDS, is_word, words
from sitescout.joins import scratch_path

CHUNK_WORDS = 10_000
_TIPS_PER_PART = 100_000


def word_chunks(
    tips: DataFrame, tip_id: str, size: int = CHUNK_WORDS, stop_words: tuple[str, ...] = ENGLISH_STOP_WORDS,
    tips_per_part: int = _TIPS_PER_PART,
) -> DataFrame:
    """(business_id, chunk_no, words) of ``tips`` (business_id, text and an id that orders them).

    Words are those of ``tip_tokens``. Tips are sorted into parts of bounded size by business and id; a
    word's number is the words of its business in earlier parts, plus those of earlier tips in its part, plus
    its place in the tip. Only one number per business and part is added up beyond a part. A tip with as many
    words as several chunks is cut, too. Businesses without a word have no chunk.
    """
    spark = tips.sparkSession
    text = F.coalesce("text", F.lit(""))
    listed = tips.select(
        "business_id", F.col(tip_id).alias("tip_id"),
        F.filter(words(text), lambda w: is_word(w, tuple(stop_words))).alias("words"),
    ).where("business_id is not null and size(words) > 0")
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-tips.count() // tips_per_part))
    path = scratch_path(spark, "tips")
    order = ["business_id", "tip_id", "words"]
    listed.repartitionByRange(parts, *order).sortWithinPartitions(*order).write.parquet(path)
    stored = spark.read.schema(listed.schema).parquet(path)
    part = F.regexp_extract("_metadata.file_name", r"^part-(\d+)", 1).cast("int")
    placed = stored.select("*", part.alias("part"), F.col("_metadata.row_index").alias("row"), F.size("words").cast("long").alias("n"))

    until = W.partitionBy("business_id").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    per_part = placed.groupBy("business_id", "part").agg(F.sum("n").alias("n"))
    before = per_part.select("business_id", "part", F.coalesce(F.sum("n").over(until), F.lit(0)).alias("before"))
    earlier = W.partitionBy("business_id", "part").orderBy("row").rowsBetween(W.unboundedPreceding, -1)
    numbered = placed.withColumn("inside", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    numbered = numbered.join(before, ["business_id", "part"])
    number = F.col("before") + F.col("inside")

    # a tip's words are cut where a chunk ends, and the pieces of a chunk put together in their order
    chunks = F.sequence(F.floor(number / size), F.floor((number + F.col("n") - 1) / size))
    pieces = numbered.select("business_id", "words", number.alias("first"), F.explode(chunks).alias("chunk_no"))
    begin = F.greatest(F.col("chunk_no") * size - F.col("first"), F.lit(0))
    end = F.least((F.col("chunk_no") + 1) * size - F.col("first"), F.size("words"))
    piece = F.struct(F.greatest("first", F.col("chunk_no") * size).alias("at"), F.slice("words", (begin + 1).cast("int"), (end - begin).cast("int")).alias("words"))
    joined = pieces.groupBy("business_id", "chunk_no").agg(F.array_sort(F.collect_list(piece)).alias("pieces"))
    return joined.select("business_id", "chunk_no", F.flatten(F.col("pieces.words")).alias("words"))
