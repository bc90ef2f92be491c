"""Mixing sources to target weights.

Words are summed per source. Each source aims at its weight's share of the mix, but at no more
than ``most`` times its own size; what it cannot give is shared out again by weight. The rate of
a source is target / size, and each of its documents is emitted floor(rate) times, and once more
if a number hashed from its id lies below the fraction.

Null texts have no words; the null source is a source like any other, the last in order. Rows
that repeat an id draw the same number. Sources without words have target 0. No rows give no
rows. Columns named like the added ones are replaced, all others pass through.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sitescout.llm.common import broadcast_if_small, brought_back, set_apart, stored

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS, SHARE, MOST, SEED = (3, 1, 2), 1.5, 2.0, "mix"


def n_words(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(
    sized: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: float = MOST
) -> DataFrame:
    """(source, source_size, target) of rows with ``source`` and ``size``; one row per source.

    A source is held at its limit if the level of the others reaches limit / weight. Sources are
    taken by that ratio; the level is found where the first of them stays below its limit. The
    windows run over one row per source.
    """
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = sources.select(
        "*",
        F.element_at(cycle, ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int")).alias("weight"),
        (F.col("source_size") * F.lit(most)).alias("limit"),
        (F.sum("source_size").over(Window.partitionBy()) * F.lit(share)).alias("budget"),
    )
    before = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    before = before.rowsBetween(Window.unboundedPreceding, -1)
    weight_before = F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    limit_before = F.coalesce(F.sum("limit").over(before), F.lit(0.0))
    all_weights = F.sum("weight").over(Window.partitionBy())
    levelled = ranked.select("*", ((F.col("budget") - limit_before) / (all_weights - weight_before)).alias("own_level"))
    free = F.when(F.col("limit") >= F.col("weight") * F.col("own_level"), F.struct(F.col("limit") / F.col("weight"), "own_level"))
    level = F.min(free).over(Window.partitionBy())["own_level"]
    target = F.coalesce(F.least("limit", F.col("weight") * level), F.col("limit"))
    return levelled.select("source", "source_size", target.alias("target"))


def draw(doc_id: str = "doc_id", seed: str = SEED) -> Column:
    """A number from 0 to 1 (excluded) that depends on the id and the seed only."""
    text = F.concat(F.lit(seed + ":"), F.coalesce(F.col(doc_id).cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def mix_sources(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
    seed: str = SEED,
) -> DataFrame:
    """``docs`` with size, source_size, target (of its source), copies and taken (size * copies)."""
    given, docs = docs, set_apart(docs, "doc_id", "text", "source").withColumn("size", n_words())
    targets = broadcast_if_small(stored(source_targets(docs.select("source", "size"), weights, share, most)))
    targets = targets.withColumnRenamed("source", "_source")
    rate = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(most)))).otherwise(0.0)
    copies = (F.floor(rate) + (draw(seed=seed) < rate - F.floor(rate)).cast("long")).cast("long")
    mixed = (
        docs.join(targets, docs["source"].eqNullSafe(targets["_source"]), "inner")
        .withColumn("copies", copies)
        .withColumn("taken", F.col("size") * F.col("copies"))
    )
    return brought_back(mixed, given, "size", "source_size", "target", "copies", "taken")


def emit_copies(mixed: DataFrame, copy_no: str = "copy_no") -> DataFrame:
    """Each document as often as the mix takes it, numbered from 1 in a column of that name."""
    taken = mixed.where("copies > 0")
    return taken.withColumn(copy_no, F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
