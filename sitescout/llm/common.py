"""What the corpus operators share: labels' folds, stored intermediate tables, hashing of bytes."""

from __future__ import annotations

import os
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sitescout.joins import scratch_path

FOLDS, HELD_OUT = 4, 2
#: Spark may send a table of this many bytes to every executor.
BROADCAST_BYTES = 16 << 20


#: Where this package lies, for Python workers that are not told by their environment.
HOME = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.sparkContext.environment.setdefault("PYTHONPATH", HOME)
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def fold(doc_id: str = "doc_id") -> Column:
    """0 to 3, by the checksum of the id as text; null ids are in fold 0."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(FOLDS)), F.lit(0))


def held_out(doc_id: str = "doc_id") -> Column:
    return fold(doc_id) == HELD_OUT


def stored(df: DataFrame) -> DataFrame:
    """``df`` written once as Parquet in the shared folder, for several readers.

    A lost executor costs no more than the tasks it ran, and readers take only their columns.
    ``sitescout.joins.release_scratch`` deletes these tables once their readers are done.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "stored")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_OTHERS = "_other_columns"


def set_apart(docs: DataFrame, *needed: str) -> DataFrame:
    """The ``needed`` columns of ``docs`` that there are, and all others in one, where no name can clash."""
    kept = [c for c in docs.columns if c in needed]
    others = [docs[f"`{c}`"].alias(c) for c in docs.columns if c not in needed]
    return docs.select(*kept, F.struct(F.lit(True).alias(free_name(docs, "_")), *others).alias(_OTHERS))


def brought_back(worked: DataFrame, docs: DataFrame, *added: str) -> DataFrame:
    """The columns of ``docs``, from what was made of their ``set_apart``, and the ``added`` ones.

    A column of ``docs`` that bears the name of an added one is replaced by it.
    """
    packed = {f.name for f in worked.schema[_OTHERS].dataType.fields}
    own = [c for c in docs.columns if c not in added]
    return worked.select(*[F.col(_OTHERS)[c].alias(c) if c in packed else F.col(f"`{c}`") for c in own], *added)


def free_name(docs: DataFrame, name: str) -> str:
    """``name``, or if ``docs`` have it, the same with a number."""
    taken = {c.lower() for c in docs.columns}
    return next(n for n in [name, *(f"{name}_{i}" for i in range(2, len(taken) + 3))] if n.lower() not in taken)


#: Rows that Spark hands to a Python worker at once; whole texts are in them.
BATCH_ROWS = 1_000


def bounded_batches(spark: SparkSession) -> None:
    """Keeps what a Python worker holds at once to ``BATCH_ROWS`` rows, for this session."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name, "10000")) <= BATCH_ROWS:
        spark.conf.set(name, BATCH_ROWS)


def value_bytes(df: DataFrame) -> int:
    """About the bytes that the values of ``df`` take in memory, and no less."""
    widths = [F.coalesce(F.octet_length(c), F.lit(0)) for c, kind in df.dtypes if kind == "string"]
    widths += [8 * F.greatest(F.size(c), F.lit(1)) for c, kind in df.dtypes if kind.startswith("array")]
    width = sum(widths, F.lit(16 * len(df.columns)).cast("long"))
    return df.agg(F.sum(width)).first()[0] or 0


def broadcast_if_small(df: DataFrame) -> DataFrame:
    """A stored table, marked for broadcast if its values take at most ``BROADCAST_BYTES``.

    Beyond that it is joined by shuffle, where Spark splits the partitions of hot keys.
    """
    return F.broadcast(df) if value_bytes(df) <= BROADCAST_BYTES else df


def broadcast_parts(df: DataFrame, key: str) -> list[DataFrame]:
    """A stored table dealt by key into parts for broadcast, of about ``BROADCAST_BYTES`` at most."""
    parts = -(-value_bytes(df) // BROADCAST_BYTES) or 1
    return [F.broadcast(df.where(F.pmod(F.xxhash64(key), F.lit(parts)) == i)) for i in range(parts)]


def bring_together(pairs: DataFrame, texts: DataFrame, per_slice: int, extras: Sequence[str] = (), tasks: int | None = None) -> DataFrame:
    """(a, slice, slices, b, text) of stored ``pairs`` (a, b, weight) and ``texts`` (id, text).

    ``extras`` are columns of the pairs that go with b. Partitions are sorted by (a, slice); first come the texts of a, with b null, then those of
    each b. So the text of b travels once per pair. The members of a common a are cut into slices
    of about ``per_slice`` in weight, each of which gets the text of a. There are ``tasks`` partitions,
    or as many as their bytes fill.
    """
    ids = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct()
    texts = stored(texts.join(broadcast_if_small(stored(ids)), "id"))
    slices = pairs.groupBy("a").agg(F.ceil(F.sum("weight") / per_slice).cast("int").alias("slices"))
    leaders = texts.withColumnRenamed("id", "a").join(slices, "a").withColumn("b", F.lit(None).cast("long"))
    leaders = leaders.withColumns({c: F.lit(None).cast(pairs.schema[c].dataType) for c in extras})
    leaders = leaders.withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
    members = pairs.join(slices, "a").withColumn("slice", F.pmod(F.xxhash64("b"), F.col("slices")).cast("int"))
    members = members.join(texts.withColumnRenamed("id", "b"), "b")
    columns = ["a", "slice", "slices", "b", "text", *extras]
    met = leaders.select(columns).unionByName(members.select(columns))
    met = met.repartition(tasks, "a", "slice") if tasks else met.repartition("a", "slice")
    return met.sortWithinPartitions("a", "slice", F.col("b").asc_nulls_first())


# ---- vectorised hashing of many byte strings laid end to end

_ODD = 0x9E3779B97F4A7C15


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x.astype(np.uint64, copy=True)
    for shift, odd in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(odd)
    x ^= x >> np.uint64(31)
    return x


_BYTE_CODES = mix(np.arange(1, 257, dtype=np.uint64))


class Powers:
    """Powers of an odd base modulo 2^64 and of its inverse, grown on demand."""

    def __init__(self) -> None:
        self.up = np.ones(1, np.uint64)
        self.down = np.ones(1, np.uint64)

    def grow(self, n: int) -> None:
        if n > len(self.up):
            inverse = pow(_ODD, -1, 1 << 64)
            with np.errstate(over="ignore"):
                self.up = np.cumprod(np.r_[np.uint64(1), np.full(n, _ODD, np.uint64)], dtype=np.uint64)
                self.down = np.cumprod(np.r_[np.uint64(1), np.full(n, inverse, np.uint64)], dtype=np.uint64)


_POWERS = Powers()


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Sums from which ``span_hashes`` takes the hash of any span of ``data`` (bytes)."""
    _POWERS.grow(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_CODES[data] * _POWERS.up[: len(data)], dtype=np.uint64, out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the spans [start, end); equal bytes have equal hashes wherever they stand."""
    return mix((sums[ends] - sums[starts]) * _POWERS.down[starts] + (ends - starts).astype(np.uint64))


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def spans_of(is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True."""
    edges = np.flatnonzero(np.diff(np.r_[False, is_word, False].astype(np.int8)))
    return edges[::2], edges[1::2]


def words_of(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words ``[^\\x20\\x09-\\x0D]+`` of a byte array."""
    return spans_of(~_SPACE[data])


def as_bytes(text: str | None) -> bytes:
    return b"" if text is None else text.encode("utf-8", "surrogatepass")


def expand(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The numbers start, start + 1, ... of all ranges, one after another."""
    total = int(counts.sum())
    offsets = np.repeat(np.cumsum(counts) - counts, counts)
    return np.arange(total) - offsets + np.repeat(starts, counts)
