"""Documents cut into shards of nearly equal bytes, equal texts always in one shard.

Equal texts are one group, an atom of the sum of its rows. Groups are ordered by a hash of the
text and the row of groups is cut into contiguous shards such that the largest is as small as
can be: the smallest feasible capacity is found by binary search, each tried by filling shards
greedily, and the cuts are where the greedy filling cuts. A group that alone has the share of a
shard or more gets one for itself, before the others are cut; so a text with a third of all rows
leaves the other shards even among themselves.

The search sees ranges of hashes instead of groups: at first some thousand, whose bytes come
from one aggregate. A range that no cut can lie in, whatever the capacity turns out to be, stays
whole; the others, a number that depends on the shards only, are split finer in the next round,
until only single groups are left there. So the cuts are those of the groups themselves, while
the driver never sees more than a bounded number of ranges.

Slots number the rows of a shard from 0 in the order of (hash, doc_id). The rows are range-sorted
into files, a row's rank is the files' rows before plus its place in the file, and its slot is the rank
less that of the shard's first row; no task ever holds a shard or a group.

A null text counts no bytes, has the checksum of an empty one, and all null texts are one group, as are
all empty texts. Null and repeated ids are kept; rows that are alike get different slots. Different texts
whose hashes agree (60 bits) would be one group. With fewer groups than shards some shards are empty; an
empty table gives an empty one. Only the id and the text are read, so other columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitescout.llm.common import stored

HASH_BITS, FIRST_BITS, NEXT_BITS = 60, 12, 8
ROWS_PER_FILE = 1_000_000


def text_hash(text: str = "text") -> Column:
    """60 bits of the text's SHA-256; 0 for null."""
    digits = F.substring(F.sha2(F.col(text).cast("binary"), 256), 1, HASH_BITS // 4)
    return F.coalesce(F.conv(digits, 16, 10).cast("long"), F.lit(0).cast("long"))


# ---- the minimax partition of a row of sizes


def greedy_cuts(ends: np.ndarray, capacity: int, shards: int) -> list[int]:
    """Where shards of at most ``capacity`` end, each as full as can be; ``ends`` are running sums."""
    cuts, at = [], 0
    for _ in range(shards):
        i = int(np.searchsorted(ends, at + capacity, side="right"))
        at = max(at, int(ends[i - 1]) if i else 0)
        cuts.append(at)
    return cuts


def smallest_capacity(sizes: np.ndarray, shards: int) -> int:
    """The least capacity with which ``shards`` contiguous shards hold all sizes."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    low, high = max(-(-total // shards), int(sizes.max(initial=0))), total
    while low < high:
        middle = (low + high) // 2
        if greedy_cuts(ends, middle, shards)[-1] == total:
            high = middle
        else:
            low = middle + 1
    return low


@dataclass(frozen=True)
class Ranges:
    """Ranges of hashes in order: first hash, bits of the hash that they fix, bytes, bytes of the
    largest group, number of groups."""

    first: np.ndarray
    bits: np.ndarray
    size: np.ndarray
    largest: np.ndarray
    groups: np.ndarray

    def __add__(self, other: Ranges) -> Ranges:
        joined = [np.concatenate(pair) for pair in zip(vars(self).values(), vars(other).values())]
        order = np.argsort(joined[0], kind="stable")
        return Ranges(*[c[order] for c in joined])

    def __getitem__(self, chosen: np.ndarray) -> Ranges:
        return Ranges(*[c[chosen] for c in vars(self).values()])


def open_ranges(ranges: Ranges, shards: int) -> np.ndarray:
    """Which ranges of several groups a cut of the groups' best partition may lie in.

    Its capacity is at least an even share and the largest group, and at most what the whole ranges
    need. The greedy filling with any capacity between ends its j-th shard between the bounds below.
    """
    ends = np.cumsum(ranges.size)
    starts, total = ends - ranges.size, int(ends[-1])
    least = max(-(-total // shards), int(ranges.largest.max()))
    most = smallest_capacity(ranges.size, shards)
    chosen = np.zeros(len(ends), bool)
    low = high = 0
    for _ in range(shards - 1):
        high = min(high + most, total)
        i = int(np.searchsorted(ends, low + least, side="right"))
        whole = int(ends[i - 1]) if i else 0
        inside = low + least - int(ranges.largest[i]) + 1 if i < len(ends) else total
        low = min(max(whole, inside), total)
        chosen |= (starts < high) & (ends > low)
    return chosen & (ranges.groups > 1)


def cut_hashes(summed: Callable[[int, list[tuple[int, int]]], Ranges], shards: int) -> list[int]:
    """First hashes of the second and later shards. ``summed`` gives the ranges that fix so many
    bits of the hash, within the given intervals [first, end)."""
    bits = FIRST_BITS
    ranges = summed(bits, [(0, 1 << HASH_BITS)])
    while len(ranges.first) and (split := open_ranges(ranges, shards)).any():
        bits = min(bits + NEXT_BITS, HASH_BITS)
        finer = [ranges[~split]]
        for old in np.unique(ranges.bits[split]):
            here = ranges.first[split & (ranges.bits == old)]
            width = 1 << (HASH_BITS - int(old))
            breaks = np.flatnonzero(np.diff(here) != width)
            intervals = list(zip(here[np.r_[0, breaks + 1]].tolist(), (here[np.r_[breaks, len(here) - 1]] + width).tolist()))
            finer.append(summed(bits, intervals))
        ranges = finer[0]
        for more in finer[1:]:
            ranges = ranges + more
    if not len(ranges.first):
        return [1 << HASH_BITS] * (shards - 1)
    ends = np.cumsum(ranges.size)
    cuts = greedy_cuts(ends, smallest_capacity(ranges.size, shards), shards)[:-1]
    nexts = np.append(ranges.first, 1 << HASH_BITS)
    return [int(nexts[np.searchsorted(ends, c, side="right")]) if c else int(nexts[0]) for c in cuts]


# ---- the job


@dataclass(frozen=True)
class ShardPlan:
    """Hashes of the groups with a shard of their own, and first hashes of the later ones of the others."""

    alone: tuple[int, ...]
    cuts: tuple[int, ...]

    def shard(self, key: Column) -> Column:
        number = F.lit(len(self.alone))
        for cut in self.cuts:
            number = number + (key >= cut).cast("int")
        for i, hot in enumerate(self.alone):
            number = F.when(key == hot, F.lit(i)).otherwise(number)
        return number.cast("int")


def _groups(rows: DataFrame) -> DataFrame:
    return stored(rows.groupBy("key").agg(F.sum("size").alias("size"), F.count("*").alias("n")))


def _plan(groups: DataFrame, shards: int) -> ShardPlan:
    if shards < 1:
        raise ValueError("at least one shard is needed")
    rest, left = int(groups.agg(F.sum("size")).first()[0] or 0), shards
    alone: list[int] = []
    for key, size in groups.select("key", "size").orderBy(F.desc("size"), "key").limit(shards - 1).collect():
        if size * left < rest:
            break
        alone.append(key)
        rest, left = rest - size, left - 1
    others = groups.where(~F.col("key").isin(alone)) if alone else groups

    def summed(bits: int, intervals: list[tuple[int, int]]) -> Ranges:
        key = F.col("key")
        inside = F.lit(False)
        for first, end in intervals:
            inside = inside | ((key >= first) & (key < end))
        rows = (
            others.where(inside)
            .groupBy(F.shiftright("key", HASH_BITS - bits).alias("r"))
            .agg(F.sum("size").alias("size"), F.max("size").alias("largest"), F.count("*").alias("groups"))
            .orderBy("r")
            .collect()
        )
        columns = np.array([tuple(r) for r in rows], np.int64).reshape(-1, 4).T
        return Ranges(columns[0] << (HASH_BITS - bits), np.full(len(rows), bits), *columns[1:])

    return ShardPlan(tuple(alone), tuple(cut_hashes(summed, left)))


def _narrow(docs: DataFrame) -> DataFrame:
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1
    checksum = F.crc32(F.coalesce("text", F.lit("")).cast("binary"))
    return docs.select(F.col("doc_id").cast("long"), size.alias("size"), checksum.alias("text_crc32"), text_hash().alias("key"))


def plan_shards(docs: DataFrame, shards: int = 8) -> ShardPlan:
    """Where to cut ``docs`` (text); the plan tells a row's shard from ``text_hash``."""
    return _plan(_groups(stored(_narrow(docs.select(F.lit(None).alias("doc_id"), "text")))), shards)


def write_shards(docs: DataFrame, path: str, shards: int = 8) -> ShardPlan:
    """Writes the whole rows of ``docs`` as Parquet below ``path``, a folder ``shard=N`` for each shard."""
    if "shard" in docs.columns:
        raise ValueError("the documents have a column named shard")
    plan = plan_shards(docs, shards)
    docs.withColumn("shard", plan.shard(text_hash())).write.partitionBy("shard").parquet(path)
    return plan


def assign_shards(docs: DataFrame, shards: int = 8) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) of each row of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    rows = stored(_narrow(docs))
    n_files = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // ROWS_PER_FILE))
    order = ["key", "doc_id", "tie"]  # rows that are alike may be so many that they need several files
    tied = rows.withColumn("tie", F.monotonically_increasing_id())
    files = stored(tied.repartitionByRange(n_files, *order).sortWithinPartitions(*order).drop("tie"))
    groups = _groups(files)
    plan = _plan(groups, shards)

    file = F.regexp_extract("_metadata.file_name", r"^part-(\d+)", 1).cast("int").alias("file")
    counted = files.groupBy(file).count().orderBy("file").collect()  # n_files numbers
    before = np.cumsum([0, *[r["count"] for r in counted]])[:-1].tolist()
    offsets = spark.createDataFrame([(r["file"], b) for r, b in zip(counted, before)], "file int, rows_before long")

    # rows of hashes below each shard's first, and of the groups that stand apart
    firsts = [*plan.alone, 0, *plan.cuts]
    sums = [F.coalesce(F.sum(F.when(F.col("key") < k, F.col("n"))), F.lit(0)) for k in firsts]
    sums += [F.coalesce(F.sum(F.when(F.col("key") == k, F.col("n"))), F.lit(0)) for k in plan.alone]
    ranks = list(groups.agg(*[s.alias(f"c{i}") for i, s in enumerate(sums)]).first())
    starts, apart = ranks[: len(firsts)], ranks[len(firsts) :]
    ranked = files.select("*", file, F.col("_metadata.row_index").alias("row")).join(F.broadcast(offsets), "file")
    shard = plan.shard(F.col("key"))
    slot = F.col("rows_before") + F.col("row") - F.element_at(F.array(*[F.lit(s).cast("long") for s in starts]), shard + 1)
    for hot, n in zip(plan.alone, apart):
        first = F.element_at(F.array(*[F.lit(k).cast("long") for k in firsts]), shard + 1)
        passed = (shard >= len(plan.alone)) & (F.col("key") > hot) & (first <= hot)
        slot = slot - F.when(passed, F.lit(n)).otherwise(F.lit(0))
    return ranked.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), shard.alias("shard"),
        slot.alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )
