"""Readers and writers of the derived tables: Parquet directories or bucketed catalog tables."""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitescout.functions.geo import grid_cell
from sitescout.joins import cut_lineage, size_checked


def read_table(spark: SparkSession, directory: str, table: str) -> DataFrame:
    """A table written below ``directory``, also registered as a temporary view of its name."""
    df = spark.read.parquet(os.path.join(directory, table))
    df.createOrReplaceTempView(table)
    return df


def write_table(df: DataFrame, directory: str, table: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).parquet(os.path.join(directory, table))


def cluster_by_place(directory: DataFrame) -> DataFrame:
    """Order a business directory by place before it is written.

    Files and row groups then cover small areas, and the bounding box of a radius search skips
    the others by their latitude and longitude statistics.
    """
    cell = grid_cell(F.col("latitude"), F.col("longitude"))
    return (
        directory.repartitionByRange(cell, "latitude", "longitude")
        .sortWithinPartitions(cell, "latitude", "longitude")
    )


def write_bucketed(
    df: DataFrame, table: str, key: str, buckets: int, mode: str = "errorifexists"
) -> None:
    """A catalog table bucketed and sorted by ``key``.

    Tables with the same buckets join on ``key`` without a shuffle: bucket the directory, the
    category pairs, both check-in tables and the sentiments by business_id.
    """
    df.repartition(buckets, key).write.mode(mode).bucketBy(buckets, key).sortBy(key).saveAsTable(table)


def latest_per_key(
    df: DataFrame, keys: Sequence[str], order_by: str | None = None
) -> DataFrame:
    """One row per key: the one with the greatest ``order_by``, ties going to the greatest row.

    An aggregate rather than a window, so that repeats of a hot key are combined before the
    shuffle. Columns must be orderable (no maps).
    """
    others = [c for c in df.columns if c not in keys]
    if not others:
        return df.dropDuplicates(list(keys))
    first = [order_by] if order_by else []
    ranked = F.struct(*first, *[c for c in others if c != order_by])
    best = df.groupBy(*keys).agg(F.max(ranked).alias("_best"))
    return best.select(*[c if c in keys else F.col(f"_best.{c}").alias(c) for c in df.columns])


def upsert(
    target: DataFrame, source: DataFrame, keys: Sequence[str], order_by: str | None = None
) -> DataFrame:
    """``target`` with the rows of ``source`` written over it by key.

    A key present in both takes the source's values, a new key is added, repeats of a key in
    the source collapse to one row. Columns the source lacks keep the target's values. The
    source is read once; the target is only shuffled if the source's keys are too big to broadcast.
    """
    keys = list(keys)
    latest = cut_lineage(latest_per_key(source, keys, order_by))
    written = size_checked(latest.select(*keys))
    absent = [c for c in target.columns if c not in source.columns]
    if absent:
        untouched = target.join(written, keys, "left_semi").select(*keys, *absent)
        latest = latest.join(untouched, keys, "left")
    kept = target.join(written, keys, "left_anti")
    return kept.unionByName(latest.select(*target.columns))


def upsert_table(
    spark: SparkSession,
    directory: str,
    table: str,
    source: DataFrame,
    keys: Sequence[str],
    new_directory: str,
    order_by: str | None = None,
) -> DataFrame:
    """Upsert into a stored table, writing the outcome below a new directory.

    The directory being read is never written to, so a job that dies half-way leaves the old
    table whole.
    """
    if os.path.normpath(directory) == os.path.normpath(new_directory):
        raise ValueError("the new directory must differ from the one being read")
    write_table(upsert(read_table(spark, directory, table), source, keys, order_by), new_directory, table)
    return read_table(spark, new_directory, table)
