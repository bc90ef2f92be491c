"""Helpers against what goes wrong at scale: oversized broadcasts, hot keys, repeated work."""

from __future__ import annotations

import math
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sitescout.settings import SETTINGS

SLICES = ["left_slice", "right_slice"]


def value_bytes(df: DataFrame) -> int:
    """About the bytes that the values of ``df`` take in memory. Each task sends one number."""
    width = F.lit(16 * len(df.columns)).cast("long")
    for column, kind in df.dtypes:
        if kind in ("string", "binary"):
            width = width + F.coalesce(F.octet_length(column), F.lit(0))
        elif kind.startswith(("array", "map")):
            width = width + F.coalesce(F.greatest(F.size(column), F.lit(0)) * 32, F.lit(0))
    return df.agg(F.sum(width)).first()[0] or 0


def fits_broadcast(df: DataFrame, max_bytes: int = SETTINGS.broadcast_bytes) -> bool:
    """Whether the values of ``df`` take at most ``max_bytes``."""
    return value_bytes(df) <= max_bytes


def shuffled(df: DataFrame) -> DataFrame:
    """``df`` marked to be joined by shuffle.

    Spark's own estimate goes by compressed files and does not know what explode multiplies, so that
    it may broadcast a hundred times its limit through the driver.
    """
    return df.hint("merge")


def size_checked(df: DataFrame, max_bytes: int = SETTINGS.broadcast_bytes) -> DataFrame:
    """``df`` marked for broadcast if it is small enough, else to be joined by shuffle.

    Meant for stored tables and checkpointed frames, which are cheap to measure.
    """
    return F.broadcast(df) if fits_broadcast(df, max_bytes) else shuffled(df)


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share: the session's ``spark.checkpoint.dir``.

    Where none is set, a local session gets a temporary one; on a cluster that is an error.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if context.master.split("[")[0] != "local":
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="sitescout-checkpoint-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the cluster's checkpoint folder, for several readers."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


_scratch: set[str] = set()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, for a table that ``release_scratch`` may delete."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    _scratch.add(path)
    return path


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as a scratch table and read back: compressed, and read only for the columns needed."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def delete_path(spark: SparkSession, path: str) -> None:
    """Deletes a file or folder in any store that Spark can reach."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def release_scratch(spark: SparkSession) -> int:
    """Deletes the scratch tables of this process and says how many; frames that read them end with that."""
    released = 0
    while _scratch:
        delete_path(spark, _scratch.pop())
        released += 1
    return released


def keep_selected(facts: DataFrame, ids: DataFrame, key: str = "business_id") -> DataFrame:
    """Rows of ``facts`` whose key is in ``ids``. Repeated ids do not repeat rows."""
    return facts.join(ids.select(key), key, "left_semi")


def hot_keys(left_keys: DataFrame, right_keys: DataFrame | None, key: str, per_slice: int) -> DataFrame:
    """(key, left_slices, right_slices) of the keys with over ``per_slice`` rows on a side.

    Without ``right_keys`` the right side has few rows for any key and is not counted. With them
    a slice also keeps below ``pairs_per_slice`` pairs of rows, as such a join makes pairs.
    """
    if right_keys is not None:
        per_slice = min(per_slice, math.isqrt(SETTINGS.pairs_per_slice))
    if right_keys is None:
        counted = left_keys.groupBy(key).agg(F.count("*").alias("l")).withColumn("r", F.lit(1))
    else:
        both = left_keys.select(key, F.lit(1).alias("l"), F.lit(0).alias("r")).unionByName(
            right_keys.select(key, F.lit(0).alias("l"), F.lit(1).alias("r"))
        )
        counted = both.groupBy(key).agg(F.sum("l").alias("l"), F.sum("r").alias("r"))

    def slices(rows: str) -> Column:
        return F.greatest(F.ceil(F.col(rows) / per_slice), F.lit(1)).cast("int")

    return counted.where((F.col("l") > per_slice) | (F.col("r") > per_slice)).select(
        key, slices("l").alias("left_slices"), slices("r").alias("right_slices")
    )


def slice_hot_keys(
    left: DataFrame, right: DataFrame, key: str, left_id: Column, right_id: Column, hot: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Add ``left_slice`` and ``right_slice`` so that a join on (key, left_slice, right_slice)
    gives the rows of a join on ``key``, with each ``hot`` key spread over many tasks.

    The rows of a hot key are cut into slices by the hash of their id, and repeated once per
    slice of the other side: each pair of rows meets in exactly one place. Other keys stay
    whole. The hash depends on the row only, so a task that is run again sends its rows to the
    same places.
    """
    hot = size_checked(cut_lineage(hot))

    def cut(df: DataFrame, row_id: Column, own: str, other: str) -> DataFrame:
        own_slices = F.coalesce(f"{own}_slices", F.lit(1))
        other_slices = F.coalesce(f"{other}_slices", F.lit(1))
        return (
            df.join(hot, key, "left")
            .withColumn(f"{own}_slice", F.pmod(F.xxhash64(row_id), own_slices).cast("int"))
            .withColumn(f"{other}_slice", F.explode(F.sequence(F.lit(0), other_slices - 1)))
            .drop("left_slices", "right_slices")
        )

    return cut(left, left_id, "left", "right"), cut(right, right_id, "right", "left")


def join_in_slices(left: DataFrame, right: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Join sliced sides on the key and the slices.

    These joins make far more work than their sides have bytes, so the number of partitions is
    fixed and not left to be coalesced by size, and neither side is broadcast.
    """
    partitions = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = [key, *SLICES]
    joined = left.repartition(partitions, *by).join(shuffled(right.repartition(partitions, *by)), by, how)
    return joined.drop(*SLICES)


def join_hot(
    left: DataFrame,
    right: DataFrame,
    key: str,
    left_id: Column,
    right_id: Column | None = None,
    how: str = "inner",
    per_slice: int = SETTINGS.rows_per_slice,
) -> DataFrame:
    """Join on ``key`` by shuffle, hot keys cut into slices. What is cut is read twice.

    Without ``right_id`` the right side has few rows for any key: it is repeated where the left
    side is cut, but not cut itself. A left join needs that.
    """
    hot = hot_keys(left.select(key), None if right_id is None else right.select(key), key, per_slice)
    cut_by = F.lit(0) if right_id is None else right_id
    left, right = slice_hot_keys(left, right, key, left_id, cut_by, hot)
    return join_in_slices(left, right, key, how)


def lookup_join(
    facts: DataFrame,
    dimension: DataFrame,
    key: str,
    fact_id: Column,
    how: str = "left",
    max_bytes: int = SETTINGS.broadcast_bytes,
    per_slice: int = SETTINGS.rows_per_slice,
) -> DataFrame:
    """Join ``facts`` with a ``dimension`` that has one row per key (``how``: left or inner).

    A dimension of up to ``max_bytes`` is broadcast, so the facts are not shuffled and hot
    keys do no harm. A larger one is joined by shuffle with the hot keys cut into slices.
    """
    if fits_broadcast(dimension, max_bytes):
        return facts.join(F.broadcast(dimension), key, how)
    return join_hot(facts, dimension, key, fact_id, how=how, per_slice=per_slice)
