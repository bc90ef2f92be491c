"""Near-duplicate documents by HyperMinHash.

The set of a document's word shingles is dealt by hash to 128 buckets. Of the smallest hash in
each bucket a 16-bit register keeps the number of leading zeros (6 bits) and the bits after the
first one (10 bits); empty buckets borrow from the next. Four registers are a band of 64 bits.
Documents that share a band are candidates; equal sets are one class, compared once.

Comparing all pairs of a band's classes would cost the square of their number. Instead each is
compared, on its full set, with the smallest class of the band, the leader. Those linked to it are
connected. Two classes of which one is not linked to the leader can only be linked if they share
shingles that the leader does not have: a link needs an overlap of p (|x| + |y|) / (1 + p) shingles,
and no y is smaller than the leader, so more than x shares with the leader. How many more is known,
so pairs are sought by prefixes of those shingles, rarest first. The similarity of such a pair is
estimated from equal registers, less the equality that chance gives to registers of such sizes,
and if it may reach the threshold the pair is verified on its full sets. Nothing is skipped but
pairs that are connected already.

The members of a leader are cut into slices that fit a task. Pairs across the slices of a leader
meet in a further round, in groups of members that share such a shingle.

A pair at the very threshold shares no band with probability (1 - 0.8^4)^32 < 10^-7.

Null and empty texts, or texts without words, have no shingle and no link; texts of fewer words
than a shingle are one shingle. Rows that share an id are one document: a link of one is a link
of all. Rows without id get no component and are kept. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitescout.llm.common import as_bytes, bounded_batches, bring_together, broadcast_if_small, mix, prefix_sums, span_hashes, stored, words_of
from sitescout.llm.components import components

REGISTERS, PER_BAND, MANTISSA_BITS = 128, 4, 10
BUCKET_BITS = REGISTERS.bit_length() - 1
#: Sets below this size borrow registers, which makes the estimate too rough to prune by.
ESTIMATED_FROM = 256
#: Standard deviations of the estimate below the threshold at which a pair is given up.
SPREADS = 5
CHUNK_BYTES = 1 << 20
#: What a task holds of a leader's members at once: 8 bytes each, and some copies.
SHINGLES_PER_SLICE = 1 << 20
_STEP = np.uint64(0xD6E8FEB86659FD93)


# ---- sets of shingles


def _chunks(texts: Iterable[str | None]) -> Iterator[list[bytes]]:
    chunk: list[bytes] = []
    held = 0
    for text in texts:
        data = as_bytes(text)
        if chunk and held + len(data) > CHUNK_BYTES:
            yield chunk
            chunk, held = [], 0
        chunk.append(data)
        held += len(data) + 1
    if chunk:
        yield chunk


def _word_hashes(texts: Iterable[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Chunks of word hashes, with the bounds of each text among them."""
    for chunk in _chunks(texts):
        data = np.frombuffer(b"\n".join(chunk).lower() + b"\n", np.uint8)
        starts, ends = words_of(data)
        lengths = np.fromiter(map(len, chunk), np.int64, len(chunk))
        bounds = np.searchsorted(starts, np.r_[0, np.cumsum(lengths + 1)])
        yield span_hashes(prefix_sums(data), starts, ends), bounds


def _rolled(words: np.ndarray, size: int) -> np.ndarray:
    rolled = words.copy()
    for k in range(1, size):
        rolled[: len(words) - k] = rolled[: len(words) - k] * _STEP + words[k:]
    return mix(rolled)


def shingle_sequences(texts: Iterable[str | None], size: int) -> Iterator[np.ndarray]:
    """For each text the hashes of its shingles of ``size`` words, in text order; none if it is shorter."""
    for words, bounds in _word_hashes(texts):
        rolled = _rolled(words, size)
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            yield rolled[a : max(a, b - size + 1)]


def shingle_sets(texts: Iterable[str | None], size: int) -> Iterator[np.ndarray]:
    """For each text the ascending distinct hashes of its shingles of ``size`` words."""
    for words, bounds in _word_hashes(texts):
        rolled = _rolled(words, size)
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            if b - a >= size:
                found = np.sort(rolled[a : b - size + 1])
                yield found[np.r_[True, found[1:] != found[:-1]]]
            elif b > a:
                whole = words[a : a + 1] + np.uint64(b - a)
                for i in range(a + 1, b):
                    whole = whole * _STEP + words[i : i + 1]
                yield mix(whole)
            else:
                yield np.empty(0, np.uint64)


# ---- sketches


def _registers(found: np.ndarray) -> np.ndarray:
    """16-bit registers of an ascending set of hashes; not for the empty set."""
    lows = np.arange(REGISTERS, dtype=np.uint64) << np.uint64(64 - BUCKET_BITS)
    at = np.searchsorted(found, lows)
    least = found[np.minimum(at, len(found) - 1)]
    filled = np.flatnonzero((at < len(found)) & (least >> np.uint64(64 - BUCKET_BITS) == np.arange(REGISTERS, dtype=np.uint64)))
    rest = (least[filled] << np.uint64(BUCKET_BITS)) | np.uint64(1 << (BUCKET_BITS - 1))  # never 0
    zeros = (64 - np.frexp((rest >> np.uint64(11)).astype(np.float64))[1] - 11).astype(np.uint64)
    mantissa = ((rest << zeros) << np.uint64(1)) >> np.uint64(64 - MANTISSA_BITS)
    own = (np.minimum(zeros, np.uint64(63)) << np.uint64(MANTISSA_BITS) | mantissa).astype(np.uint16)
    lender = np.searchsorted(filled, np.arange(REGISTERS)) % len(filled)
    return own[lender]


SKETCH = "doc_id long, n_shingles long, h1 long, h2 long, bands array<long>"


def _sketch_batches(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, sums, bands = [], [], []
            for found in shingle_sets((t.as_py() for t in batch.column("text")), size):
                counts.append(len(found))
                sums.append((found.sum(dtype=np.uint64), mix(found ^ _STEP).sum(dtype=np.uint64)))
                bands.append(_registers(found).view(np.int64) if len(found) else np.empty(0, np.int64))
            n = len(counts)
            offsets = np.r_[0, np.cumsum([len(b) for b in bands])].astype(np.int32)
            h = np.array(sums, np.uint64).reshape(n, 2).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(counts, pa.int64()),
                    pa.array(np.ascontiguousarray(h[:, 0])),
                    pa.array(np.ascontiguousarray(h[:, 1])),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([*bands, np.empty(0, np.int64)]))),
                ],
                ["doc_id", "n_shingles", "h1", "h2", "bands"],
            )

    return run


def sketch(docs: DataFrame, size: int) -> DataFrame:
    """(doc_id, n_shingles, h1, h2, bands): the size of each set, 128 bits that tell it, its bands."""
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_sketch_batches(size), SKETCH)


def chance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The probability that registers of unrelated sets of ``a`` and ``b`` shingles are equal.

    The least of n / 128 uniform numbers has density l * exp(-l x), l being that ratio. The cells
    of a register with z leading zeros are 2^-(z + 11) wide.
    """
    l, m = a / REGISTERS, b / REGISTERS  # noqa: E741
    total = np.zeros(len(l))
    for z in range(64 - BUCKET_BITS):
        high = 2.0**-z
        mass = np.exp(-(l + m) * high / 2) - np.exp(-(l + m) * high)
        total += high / 2 / (1 << MANTISSA_BITS) * l * m / (l + m) * mass
    return np.minimum(total, 0.5)


def estimate(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Jaccard similarity from rows of registers, corrected for equality by chance."""
    p = chance(n_a.astype(float), n_b.astype(float))
    return ((a == b).mean(axis=1) - p) / (1 - p)


# ---- comparison of a leader's members


class _Links:
    """Sets of members known to be connected; number 0 is the leader."""

    def __init__(self, n: int) -> None:
        self.parent = list(range(n))

    def root(self, i: int) -> int:
        parent = self.parent
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    def join(self, i: int, j: int) -> None:
        self.parent[self.root(j)] = self.root(i)


def _is_link(x: np.ndarray, y: np.ndarray, percent: int) -> tuple[bool, np.ndarray]:
    """Whether the sets are linked, and which elements of x are in y."""
    inside = y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x
    both = int(inside.sum())
    return 100 * both >= percent * (len(x) + len(y) - both), inside


@lru_cache(maxsize=1 << 14)
def _chance(eighths_a: int, eighths_b: int) -> float:
    """``chance`` for sizes given as eighths of their logarithms to base 2."""
    return float(chance(np.array([2 ** (eighths_a / 8)]), np.array([2 ** (eighths_b / 8)]))[0])


class _Sketches:
    """Registers of a leader's members, made when first asked for."""

    def __init__(self, sets: list[np.ndarray], percent: int) -> None:
        self.sets, self.percent = sets, percent
        p = percent / 100
        self.least = p - SPREADS * (p * (1 - p) / REGISTERS) ** 0.5
        self.made: dict[int, tuple[np.ndarray, int]] = {}

    def of(self, i: int) -> tuple[np.ndarray, int]:
        if i not in self.made:
            self.made[i] = _registers(self.sets[i]), round(8 * np.log2(len(self.sets[i])))
        return self.made[i]

    def may_be_link(self, i: int, j: int) -> bool:
        low, high = sorted((len(self.sets[i]), len(self.sets[j])))
        if 100 * low < self.percent * high:
            return False
        if low < ESTIMATED_FROM:
            return True
        (x, a), (y, b) = self.of(i), self.of(j)
        p = _chance(a, b)
        return (np.count_nonzero(x == y) / REGISTERS - p) / (1 - p) >= self.least


def _prefixes(rests: list[np.ndarray], lengths: np.ndarray, rarest_first: bool) -> tuple[np.ndarray, np.ndarray]:
    """(element, member) of the first ``lengths`` elements of each of ``rests``, in a common order."""
    owner = np.repeat(np.arange(len(rests)), [len(r) for r in rests])
    element = np.concatenate(rests)
    if rarest_first:
        _, inverse, counts = np.unique(element, return_inverse=True, return_counts=True)
        count = counts[inverse]
        order = np.lexsort((element, count, owner))
        owner, element, count = owner[order], element[order], count[order]
    rank = np.arange(len(owner)) - np.searchsorted(owner, owner)
    keep = rank < lengths[owner]
    if rarest_first:
        keep &= count > 1
    return element[keep], owner[keep]


def compare_members(
    leader: np.ndarray, sets: list[np.ndarray], percent: int, sliced: bool
) -> tuple[list[tuple[int, int]], tuple[np.ndarray, np.ndarray]]:
    """Links among members 1, 2, ... and the leader, 0; and the prefixes to meet other slices by.

    Every two that are linked are connected by the links returned.
    """
    links: list[tuple[int, int]] = []
    needed = [0]  # shingles beyond the leader's that a link takes
    linked = np.zeros(len(sets) + 1, bool)
    rests, lengths = [leader[:0]], [0]
    for i, x in enumerate(sets, 1):
        linked[i], inside = _is_link(x, leader, percent)
        rests.append(x[~inside])
        if linked[i]:
            links.append((0, i))
            needed.append(1)
        else:
            least = max(len(leader), -(-percent * len(x) // 100))
            needed.append(-(-percent * (len(x) + least) // (100 + percent)) - int(inside.sum()))
        lengths.append(max(0, len(rests[i]) - needed[i] + 1))
    nothing = np.empty(0, np.uint64), np.empty(0, np.int64)
    lengths = np.array(lengths)
    outward = _prefixes(rests, lengths, False) if sliced else nothing
    if linked[1:].all():
        return links, outward
    known = _Links(len(rests))
    for _, i in links:
        known.join(0, i)
    element, owner = _prefixes(rests, lengths, True)
    order = np.argsort(element, kind="stable")
    element, owner = element[order], owner[order]
    bounds = np.flatnonzero(np.r_[True, element[1:] != element[:-1], True]) if len(element) else []
    tried: set[tuple[int, int]] = set()
    sketches = _Sketches(sets, percent)
    for start, end in zip(bounds[:-1], bounds[1:]):
        members = owner[start:end].tolist()
        if len({known.root(i) for i in members}) == 1:
            continue
        for k, i in enumerate(members):
            for j in members[k + 1 :]:
                if known.root(i) == known.root(j) or (i, j) in tried:
                    continue
                tried.add((i, j))
                if not sketches.may_be_link(i - 1, j - 1):
                    continue
                if np.isin(rests[i], rests[j], kind="sort").sum() < max(needed[i], needed[j]):
                    continue
                if _is_link(sets[i - 1], sets[j - 1], percent)[0]:
                    known.join(i, j)
                    links.append((i, j))
    return links, outward


COMPARED = "u long, v long, element long"


def _compared(size: int, percent: int):
    """Over partitions of ``bring_together``: links (u, v), and (a, b, element) across slices."""

    def finish(group, leaders, ids, sets, out) -> None:
        a, _, sliced = group
        leaders.sort(key=len)
        if not leaders or not ids:
            return
        links, (element, owner) = compare_members(leaders[0], sets, percent, sliced)
        numbers = np.array([a, *ids], np.int64)
        ends = numbers[np.array(links, np.int64).reshape(-1, 2)]
        more = [(a, b) for b, x in zip(ids, sets) for y in leaders[1:] if _is_link(x, y, percent)[0]]
        ends = np.concatenate([ends, np.array(more, np.int64).reshape(-1, 2)])
        out.append((ends[:, 0], ends[:, 1], np.zeros(len(ends), np.int64), np.ones(len(ends), bool)))
        out.append((np.full(len(owner), a), numbers[owner], element.view(np.int64), np.zeros(len(owner), bool)))

    def as_batch(out) -> pa.RecordBatch:
        u, v, element, is_link = (np.concatenate(x) for x in zip(*out))
        return pa.RecordBatch.from_arrays(
            [pa.array(u, pa.int64()), pa.array(v, pa.int64()), pa.array(element, pa.int64(), mask=is_link)], ["u", "v", "element"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, leaders, ids, sets = None, [], [], []
        for batch in batches:
            out: list[tuple] = []
            columns = [batch.column(c).to_pylist() for c in ("a", "slice", "slices", "b")]
            found_sets = shingle_sets((t.as_py() for t in batch.column("text")), size)
            for a, part, slices, b, found in zip(*columns, found_sets):
                if (a, part, slices > 1) != group:
                    if group:
                        finish(group, leaders, ids, sets, out)
                    group, leaders, ids, sets = (a, part, slices > 1), [], [], []
                if not len(found):
                    continue  # another text of a repeated id
                if b is None:
                    leaders.append(found)
                else:
                    ids.append(b)
                    sets.append(found)
            if out:
                yield as_batch(out)
        if group:
            out = []
            finish(group, leaders, ids, sets, out)
            if out:
                yield as_batch(out)

    return run


def links_within(groups: DataFrame, docs: DataFrame, size: int, percent: int) -> list[DataFrame]:
    """Links (u, v) that connect all linked members of the ``groups`` (k1, k2, b, n).

    Leaders rise from round to round, by size and id, so the rounds end; a second is only needed
    where a leader has more members than a slice holds.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), "text")
    sizes = groups.select("b", "n").distinct()
    found = []
    while True:
        leaders = groups.groupBy("k1", "k2").agg(F.min(F.struct("n", "b")).alias("leader"), F.count("*").alias("members"))
        leaders = leaders.where("members > 1").select("k1", "k2", F.col("leader.b").alias("a"))
        pairs = groups.join(leaders, ["k1", "k2"]).where("a <> b").select("a", "b", F.col("n").alias("weight")).distinct()
        met = bring_together(stored(pairs), texts, SHINGLES_PER_SLICE)
        compared = stored(met.mapInArrow(_compared(size, percent), COMPARED))
        found.append(compared.where("element is null").select("u", "v"))
        apart = compared.where("element is not null")
        if apart.isEmpty():
            return found
        apart = apart.select(F.col("u").alias("k1"), F.col("element").alias("k2"), F.col("v").alias("b")).distinct()
        groups = stored(apart.join(sizes, "b"))


# ---- the operator


def _same_ids(members: DataFrame) -> DataFrame:
    """Links between the classes of rows that share an id."""
    several = members.groupBy("doc_id").agg(F.min("node").alias("v"), F.max("node").alias("high")).where("v < high")
    return members.join(several.drop("high"), "doc_id").where("node <> v").select(F.col("node").alias("u"), "v")


def near_duplicates(docs: DataFrame, size: int = 5, threshold: float = 0.8) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of each row of ``docs`` (doc_id, text)."""
    bounded_batches(docs.sparkSession)
    percent = round(100 * threshold)
    rows = stored(sketch(docs, size))
    linkable = rows.where("n_shingles > 0 and doc_id is not null")
    classes = linkable.groupBy("n_shingles", "h1", "h2").agg(F.min("doc_id").alias("node"))
    classes = stored(classes)
    heads = classes.withColumnRenamed("node", "doc_id")
    sketches = stored(linkable.join(heads, ["n_shingles", "h1", "h2", "doc_id"], "left_semi").dropDuplicates(["doc_id", "h1", "h2"]))

    banded = sketches.select(F.col("doc_id").alias("b"), F.col("n_shingles").alias("n"), F.posexplode("bands").alias("k1", "k2"))
    banded = stored(banded)
    shared = banded.groupBy("k1", "k2").agg(F.count("*").alias("members")).where("members > 1").drop("members")
    groups = stored(banded.join(shared, ["k1", "k2"]))
    links = links_within(groups, docs, size, percent)
    links.append(_same_ids(linkable.join(classes, ["n_shingles", "h1", "h2"]).select("doc_id", "node")))
    joined = stored(components(reduce(DataFrame.unionByName, links)))

    named = classes.join(joined, "node", "left").select(
        F.col("n_shingles"), "h1", "h2", F.coalesce("component", "node").alias("component_id")
    )
    found = linkable.join(named, ["n_shingles", "h1", "h2"]).select("doc_id", "n_shingles", "component_id")
    alone = rows.where("n_shingles = 0 or doc_id is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return found.unionByName(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def keep_one_of_each(docs: DataFrame, size: int = 5, threshold: float = 0.8) -> DataFrame:
    """The rows of ``docs`` but those that are near duplicates of one with a smaller id."""
    lost = near_duplicates(docs, size, threshold).where("not kept").select(F.col("doc_id").alias("_doc"))
    lost = broadcast_if_small(stored(lost.distinct()))
    return docs.join(lost, docs["doc_id"] == lost["_doc"], "left_anti")
