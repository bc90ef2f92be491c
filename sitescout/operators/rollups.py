"""Distinct businesses by category and place, kept as bitmaps that can be merged.

A stored bitmap has a bit for each business of a category in a city. Counts for any coarser group
come from OR over the bitmaps; the (business, category) pairs are not read again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitescout.joins import cut_lineage

PLACE = ["state", "city"]
GROUP = ["category", *PLACE]


def number_by_place(business: DataFrame) -> DataFrame:
    """(business_id, number): a number for each id, dense among neighbours in one city.

    A bitmap of a city so has few blocks, whatever the ids are. A city of any size is spread over many
    tasks, as the id is part of the sort key. The numbers are checkpointed, since a new run may
    give others: bitmaps of different numberings must not be merged.
    """
    ids = business.where("business_id is not null").groupBy("business_id").agg(F.min(F.struct(*PLACE)).alias("at"))
    order = ["at.state", "at.city", "business_id"]
    dealt = ids.repartitionByRange(*order).sortWithinPartitions(*order)
    return cut_lineage(dealt.select("business_id", F.monotonically_increasing_id().alias("number")))


def category_bitmaps(pairs: DataFrame, business: DataFrame, numbers: DataFrame) -> DataFrame:
    """(category, state, city, block, bits): which businesses of a city are of a category.

    Repeated pairs count once. Pairs of businesses that are not in the directory are left out. Pairs are
    dealt by bitmap first, so that a bitmap is made once, in one task, and not sorted and merged from many.
    """
    places = business.select("business_id", *PLACE).distinct().join(numbers, "business_id")
    bit = F.bitmap_bit_position("number").alias("bit")
    placed = pairs.join(places, "business_id").select(*GROUP, F.bitmap_bucket_number("number").alias("block"), bit)
    return _dealt(placed, *GROUP, "block").groupBy(*GROUP, "block").agg(F.bitmap_construct_agg("bit").alias("bits"))


def _dealt(rows: DataFrame, *by: str) -> DataFrame:
    """Rows dealt to a fixed number of tasks. Bitmaps shrink a hundredfold when they are shuffled, so that by
    that size a single task would be given those of all others, and sort them."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *by)


def distinct_businesses(bitmaps: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(*by, businesses): the number of different businesses of each group of ``by``, from bitmaps."""
    merged = _dealt(bitmaps, *by, "block").groupBy(*by, "block").agg(F.bitmap_or_agg("bits").alias("bits"))
    return merged.groupBy(*by).agg(F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)).alias("businesses"))


def cardinality_levels(bitmaps: DataFrame) -> DataFrame:
    """(level, state, city, category, businesses) by city, by state, over all, and by category."""
    levels = {"city": PLACE, "state": PLACE[:1], "all": [], "category": ["category"]}
    found = None
    for level, by in levels.items():
        counted = distinct_businesses(bitmaps, by)
        blank = [(F.col(c) if c in by else F.lit(None).cast("string")).alias(c) for c in (*PLACE, "category")]
        counted = counted.select(F.lit(level).alias("level"), *blank, "businesses")
        found = counted if found is None else found.unionByName(counted)
    return found
