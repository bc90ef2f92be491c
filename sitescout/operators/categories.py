"""Categories of businesses: pairs, sets, dictionary, search, and the match with wanted ones."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitescout.functions.request import wanted_categories

_BITS = 63  # positions of a BIGINT that are safe to set


def explode_categories(raw: DataFrame) -> DataFrame:
    """(business_id, category), one row per list entry, repeats kept; no row for NULL or []."""
    return raw.select("business_id", F.explode("categories").alias("category"))


def category_pairs(raw: DataFrame) -> DataFrame:
    """The business_categories table: the exploded pairs, each once, without NULL categories."""
    return explode_categories(raw).where(F.col("category").isNotNull()).distinct()


def category_sets(pairs: DataFrame) -> DataFrame:
    """(business_id, categories): the sorted distinct categories of each business."""
    return pairs.groupBy("business_id").agg(
        F.sort_array(F.collect_set("category")).alias("categories")
    )


def business_ids(pairs: DataFrame) -> DataFrame:
    """The business id of every pair, repeats kept."""
    return pairs.select("business_id")


def category_dictionary(pairs: DataFrame) -> DataFrame:
    return pairs.select("category").distinct()


def category_cardinality(pairs: DataFrame) -> DataFrame:
    return pairs.agg(
        F.count_distinct("business_id").alias("businesses"),
        F.count_distinct("category").alias("categories"),
    )


def category_search(categories: DataFrame, text: str, limit: int | None = None) -> DataFrame:
    """Categories holding ``text`` or its title-cased form, literally and case-sensitively.

    ``limit`` asks for the first few in alphabetical order, for a suggestion box.
    """
    category = F.col("category")
    found = categories.where(category.contains(text) | category.contains(text.title()))
    return found if limit is None else found.orderBy("category").limit(limit)


def _wanted_bits(wanted: list[str]) -> list[Column]:
    """Per run of up to 63 wanted categories, a mask with the bit of the row's category set."""
    masks = []
    for start in range(0, len(wanted), _BITS):
        run = wanted[start : start + _BITS]
        mask = F.lit(0).cast("long")
        for bit, name in enumerate(run):
            mask = F.when(F.col("category") == name, F.lit(1 << bit).cast("long")).otherwise(mask)
        masks.append(mask)
    return masks


def category_containment(pairs: DataFrame, wanted: str | Iterable[str]) -> DataFrame:
    """Share of the wanted categories that each business has: (business_id, score).

    Every business with at least one category appears, if only with 0. The aggregate state is
    a bit per wanted category, so repeats count once, no list is built, and a business with
    very many rows is reduced before the shuffle.
    """
    names = wanted_categories(wanted)
    masks = _wanted_bits(names)
    seen = pairs.groupBy("business_id").agg(
        *[F.bit_or(mask).alias(f"seen{i}") for i, mask in enumerate(masks)]
    )
    matched = sum((F.bit_count(F.col(f"seen{i}")) for i in range(1, len(masks))), F.bit_count(F.col("seen0")))
    return seen.select("business_id", (matched.cast("double") / F.lit(float(len(names)))).alias("score"))


def matching_businesses(
    pairs: DataFrame, wanted: str | Iterable[str], threshold: float
) -> DataFrame:
    """The businesses whose containment reaches ``threshold`` (inclusive).

    With a positive threshold only rows of wanted categories can matter; that filter reaches
    the scan and leaves a small part of the pairs to aggregate.
    """
    names = wanted_categories(wanted)
    if threshold > 0:
        pairs = pairs.where(F.col("category").isin(*names))
    return category_containment(pairs, names).where(F.col("score") >= threshold)
