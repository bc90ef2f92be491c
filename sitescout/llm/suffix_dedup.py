"""Removal of repeated byte strings by merging Burrows-Wheeler transforms.

A byte goes if a string of 200 bytes that covers it also starts anywhere else, in the same document
or another.

Equal texts are told by hash; all but one of each only count as repeats. In every other text the
window of 200 bytes at each place is owned by the least hash among its grams of 64 bytes, the
anchor. Equal windows have equal anchors at equal distance, so only texts around anchors that
occur more than once go on, as segments. No repeat is lost by this. Equal segments of an anchor are
counted by hash: all their windows repeat, and one of them goes on to be compared with the others.

A task gets the different segments of its anchors from all shards of the corpus. Their windows, sorted by
anchor and distance alone, are the first interleave. Each round puts the eight bytes in front of
what has been compared so far, the symbols of the Burrows-Wheeler transform, before it: the
symbols are read in the order of the interleave and placed stably by symbol, which gives the
interleave by eight bytes more, as in merging transforms. No suffix is sorted again. Windows that
stand alone among equals leave; after 25 rounds those that are left share 200 bytes, a repeated
interval.

An anchor with more different segments than a task may hold is told apart further: their windows
are put into blocks by distance, and what all windows of a block have in common, longer than the anchor, takes the
anchor's place. So equal blocks are counted, others are compared, and where there are still too many,
at the end of a common passage, each window is a block of its own, which is only counted. Null texts are empty. Rows that repeat an id are documents of their own: if the texts
are equal, too, they are copies. Texts of under 200 bytes lose nothing. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitescout.llm.common import as_bytes, bounded_batches, broadcast_if_small, expand, mix, prefix_sums, span_hashes, stored

LENGTH, GRAM, SYMBOL = 200, 64, 8
ROW = ["doc_id", "_text_hash"]
CHUNK_BYTES = 1 << 20
#: Window starts are numbered within a piece of a text, below the hash of a gram.
PIECE_BITS = 22
MERGE_BYTES = 2 << 20
#: Different segments of an anchor that one task may hold.
SEGMENTS_PER_SLICE = 20_000
#: Windows of a block, where an anchor has more segments than that, and where a block has.
BLOCKS = (16, 1)


# ---- anchors


def _pieces(texts: list[bytes]) -> Iterator[list[tuple[int, int, bytes]]]:
    """Chunks of (row, offset, bytes); a long text is cut so that every window is in one piece."""
    chunk, held = [], 0
    for row, text in enumerate(texts):
        for offset in range(0, max(1, len(text) - LENGTH + 1), CHUNK_BYTES):
            piece = text[offset : offset + CHUNK_BYTES + LENGTH - 1]
            if len(piece) < LENGTH:
                continue
            if chunk and held + len(piece) > CHUNK_BYTES:
                yield chunk
                chunk, held = [], 0
            chunk.append((row, offset, piece))
            held += len(piece)
    if chunk:
        yield chunk


def find_anchors(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """row, hash, place, first and last window start of each run of windows with one anchor."""
    return _runs_of_anchors(texts)[:5]


def _runs_of_anchors(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """What ``find_anchors`` gives, and a hash of each run's bytes and of the anchor's place in them."""
    found: list[tuple[np.ndarray, ...]] = []
    grams = LENGTH - GRAM + 1
    for chunk in _pieces(texts):
        data = np.frombuffer(b"".join(p for _, _, p in chunk), np.uint8)
        sums = prefix_sums(data)
        at = np.arange(len(data) - GRAM + 1)
        hashes = span_hashes(sums, at, at + GRAM)
        least = (hashes >> np.uint64(PIECE_BITS) << np.uint64(PIECE_BITS)) | at.astype(np.uint64)
        span = 1
        while 2 * span <= grams:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        if span < grams:
            least = np.minimum(least[: len(least) - (grams - span)], least[grams - span :])
        owner = (least & np.uint64((1 << PIECE_BITS) - 1)).astype(np.int64)
        sizes = np.array([len(p) for _, _, p in chunk])
        starts = np.cumsum(sizes) - sizes
        piece = np.repeat(np.arange(len(chunk)), sizes - LENGTH + 1)
        window = expand(starts, sizes - LENGTH + 1)
        owner = owner[window]
        opens = np.r_[True, (owner[1:] != owner[:-1]) | (piece[1:] != piece[:-1])]
        first = np.flatnonzero(opens)
        last = np.r_[first[1:], len(owner)] - 1
        anchor, start, stop = owner[first], window[first], window[last]
        kind = mix(span_hashes(sums, start, stop + LENGTH) + (anchor - start).astype(np.uint64))
        piece = piece[first]
        shift = np.array([o for _, o, _ in chunk])[piece] - starts[piece]
        rows = np.array([r for r, _, _ in chunk])[piece]
        found.append((rows, hashes[anchor], anchor + shift, start + shift, stop + shift, kind))
    if not found:
        return tuple(np.empty(0, t) for t in (np.int64, np.uint64, np.int64, np.int64, np.int64, np.uint64))
    return tuple(np.concatenate(x) for x in zip(*found))


ANCHORS = "doc_id long, _text_hash long, anchor long, kind long, place int, first int, last int"


def _anchor_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows, hashes, place, first, last, kind = _runs_of_anchors([as_bytes(t.as_py()) for t in batch.column("text")])
        taken = pa.array(rows, pa.int64())
        ints = [pa.array(x.astype(np.int32)) for x in (place, first, last)]
        ids = [batch.column(c).take(taken) for c in ROW]
        longs = [pa.array(x.view(np.int64)) for x in (hashes, kind)]
        yield pa.RecordBatch.from_arrays([*ids, *longs, *ints], [*ROW, "anchor", "kind", "place", "first", "last"])


def _in_batches(rows: Iterator[tuple], names: list[str], kinds: list[pa.DataType], most: int = 5_000) -> Iterator[pa.RecordBatch]:
    while held := list(islice(rows, most)):
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names)


def _with_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for doc_id, text_hash, text, anchors in zip(*(batch.column(c).to_pylist() for c in [*ROW, "text", "anchors"])):
            data = as_bytes(text)
            for a in anchors:
                yield doc_id, text_hash, data, a


def _block_batches(size: int):
    """Segments cut into blocks of windows whose distances have one quotient by ``size``."""

    def number(data: bytes) -> int:
        return int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "little", signed=True)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for doc_id, text_hash, data, a in _with_anchors(batches):
            place = a["place"]
            for block in range((place - a["last"]) // size, (place - a["first"]) // size + 1):
                low, high = block * size, block * size + size - 1
                first, last = max(a["first"], place - high), min(a["last"], place - low)
                common = b"%d,%d;" % (a["anchor"], block) + data[place - low : place - high + LENGTH]
                whole = b"%d;" % (place - first) + data[first : last + LENGTH]
                yield doc_id, text_hash, number(common), number(whole), place, first, last

    kinds = [pa.int64()] * 4 + [pa.int32()] * 3
    return lambda batches: _in_batches(blocks(batches), [*ROW, "anchor", "kind", "place", "first", "last"], kinds)


# ---- segments

SEGMENTS = "anchor long, doc_id long, _text_hash long, known boolean, first int, distance int, windows int, segment binary"


def _segment_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The text around each anchor."""
    rows = (
        (a["anchor"], doc_id, text_hash, a["known"], a["first"], a["place"] - a["first"], a["last"] - a["first"] + 1, data[a["first"] : a["last"] + LENGTH])
        for doc_id, text_hash, data, a in _with_anchors(batches)
    )
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int32(), pa.int32(), pa.int32(), pa.binary()]
    yield from _in_batches(rows, ["anchor", *ROW, "known", "first", "distance", "windows", "segment"], kinds)


# ---- merging


def repeated_windows(groups: np.ndarray, distances: np.ndarray, windows: np.ndarray, segments: list[bytes]) -> np.ndarray:
    """For every window of every segment, one after another: whether an equal one is among them.

    ``groups`` numbers the anchors. A window starts at each of the first ``windows`` bytes of its
    segment; ``distances`` lead from a segment's first byte to its anchor.
    """
    data = np.frombuffer(b"".join(segments) + bytes(SYMBOL), np.uint8).astype(np.uint64)
    symbols = np.zeros(len(data) - SYMBOL, np.uint64)
    for k in range(SYMBOL):
        symbols |= data[k : len(data) - SYMBOL + k] << np.uint64(8 * (SYMBOL - 1 - k))
    sizes = np.array([len(s) for s in segments], np.int64)
    begins = np.cumsum(sizes) - sizes
    position = expand(begins, windows)
    segment = np.repeat(np.arange(len(segments)), windows)
    distance = distances[segment] - (position - begins[segment])
    # the first interleave: by anchor and distance
    order = np.lexsort((distance, groups[segment]))
    group, distance = groups[segment][order], distance[order]
    opens = np.r_[True, (group[1:] != group[:-1]) | (distance[1:] != distance[:-1])] if len(order) else np.empty(0, bool)
    block = np.cumsum(opens)
    for ahead in range(LENGTH - SYMBOL, -SYMBOL, -SYMBOL):
        alone = np.bincount(block)[block] == 1
        order, block = order[~alone], block[~alone]
        if not len(order) or ahead < 0:
            break
        symbol = symbols[position[order] + ahead]
        placed = np.argsort(symbol, kind="stable")
        order, block, symbol = order[placed], block[placed], symbol[placed]
        block = np.cumsum(np.r_[True, (symbol[1:] != symbol[:-1]) | (block[1:] != block[:-1])])
    if len(order):
        order = order[np.bincount(block)[block] > 1]
    repeated = np.zeros(len(position), bool)
    repeated[order] = True
    return repeated


SPANS = "doc_id long, _text_hash long, start int, stop int"


def _merge(rows: list[tuple]) -> pa.RecordBatch:
    """Repeated spans of the documents of some segments; all segments of an anchor are there."""
    anchors, doc_ids, text_hashes, known, firsts, distances, windows, segments = zip(*rows)
    groups = np.unique(np.array(anchors, np.int64), return_inverse=True)[1]
    windows = np.array(windows, np.int64)
    repeated = repeated_windows(groups, np.array(distances, np.int64), windows, list(segments))
    repeated &= ~np.repeat(np.array(known, bool), windows)
    # runs of repeated windows within each segment
    at = expand(np.array(firsts, np.int64), windows)
    segment = np.repeat(np.arange(len(rows)), windows)
    on = np.flatnonzero(repeated)
    opens = np.r_[True, (on[1:] != on[:-1] + 1) | (segment[on[1:]] != segment[on[:-1]])] if len(on) else np.empty(0, bool)
    first = np.flatnonzero(opens)
    last = np.r_[first[1:], len(on)] - 1 if len(first) else first
    runs: dict[tuple, list[tuple[int, int]]] = {}
    for s, a, b in zip(segment[on[first]].tolist(), at[on[first]].tolist(), at[on[last]].tolist()):
        runs.setdefault((doc_ids[s], text_hashes[s]), []).append((a, b + LENGTH))
    out = [(*doc, start, stop) for doc, spans in runs.items() for start, stop in merged(sorted(spans))]
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32()]
    columns = list(zip(*out)) if out else [()] * 4
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], [*ROW, "start", "stop"])


def _merge_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Takes whole anchors, which stand together, until there are ``MERGE_BYTES``."""
    held: list[tuple] = []
    size = 0
    for batch in batches:
        for row in zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns))):
            if size >= MERGE_BYTES and row[0] != held[-1][0]:
                yield _merge(held)
                held, size = [], 0
            held.append(row)
            size += len(row[-1])
    if held:
        yield _merge(held)


# ---- the operator


def _texts_at(heads: DataFrame, chosen: DataFrame) -> DataFrame:
    """The texts of the documents of ``chosen`` segments, each with an array of these."""
    fields = [c for c in chosen.columns if c not in ROW]
    per_doc = chosen.groupBy(*ROW).agg(F.collect_list(F.struct(*fields)).alias("anchors"))
    per_doc = stored(per_doc.withColumnsRenamed({"doc_id": "_d", "_text_hash": "_h"}))
    near = heads.join(per_doc, heads["doc_id"].eqNullSafe(per_doc["_d"]) & (heads["_text_hash"] == per_doc["_h"]))
    return near.select(*ROW, "text", "anchors")


def _spans_of_anchors(heads: DataFrame, anchors: DataFrame, may_cut: bool) -> tuple[list[DataFrame], DataFrame | None]:
    """Spans of the windows of ``anchors`` that repeat, and the segments of anchors that have too many, if any."""
    often = anchors.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor")
    wanted = stored(anchors.join(often, "anchor"))
    place = F.struct(*ROW, "place", "first", "last")
    groups = stored(wanted.groupBy("anchor", "kind").agg(F.count("*").alias("n"), F.min(place).alias("one")))
    equal = broadcast_if_small(stored(groups.where("n > 1").select("anchor", "kind")))
    span = [F.col("first").alias("start"), (F.col("last") + LENGTH).alias("stop")]
    spans = [wanted.join(equal, ["anchor", "kind"], "left_semi").select(*ROW, *span)]
    kinds = stored(groups.groupBy("anchor").agg(F.count("*").alias("kinds")).where("kinds > 1"))
    chosen = groups.join(broadcast_if_small(kinds), "anchor")
    chosen = stored(chosen.select("one.*", "anchor", (F.col("n") > 1).alias("known"), "kinds"))
    crowded = chosen.where(F.col("kinds") > SEGMENTS_PER_SLICE).drop("known", "kinds")
    if not may_cut or crowded.isEmpty():
        crowded = None
    else:
        chosen = chosen.where(F.col("kinds") <= SEGMENTS_PER_SLICE)
    segments = _texts_at(heads, chosen.drop("kinds")).mapInArrow(_segment_batches, SEGMENTS)
    met = segments.repartition("anchor").sortWithinPartitions("anchor")
    return [*spans, met.mapInArrow(_merge_batches, SPANS)], crowded


def repeated_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, _text_hash, spans) of the documents that lose bytes; spans are (start, stop), in order."""
    docs = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    docs = docs.withColumn("_text_hash", F.xxhash64("text"))
    kind = ["_text_hash", "_other_hash", "n_bytes"]
    rows = docs.select(
        *ROW, F.xxhash64(F.lit(1), "text").alias("_other_hash"), F.octet_length("text").alias("n_bytes")
    ).where(F.col("n_bytes") >= LENGTH)
    rows = stored(rows)
    copied = rows.groupBy(*kind).agg(F.count("*").alias("n"), F.min("doc_id").alias("head")).where("n > 1")
    copies = stored(rows.join(copied, kind))
    # one of each set of equal texts goes on; null ids cannot be told apart, so all of them do
    others = copies.where("doc_id > head").select(F.col("doc_id").alias("_d"), F.col("_text_hash").alias("_h")).distinct()
    others = broadcast_if_small(stored(others))
    same = (docs["doc_id"] == others["_d"]) & (docs["_text_hash"] == others["_h"])
    heads = docs.join(others, same, "left_anti")

    bounded_batches(docs.sparkSession)
    anchors = stored(heads.mapInArrow(_anchor_batches, ANCHORS))
    found = []
    for block in (*BLOCKS, None):
        spans, crowded = _spans_of_anchors(heads, anchors, may_cut=block is not None)
        found += spans
        if crowded is None:
            break
        anchors = stored(_texts_at(heads, crowded).mapInArrow(_block_batches(block), ANCHORS))
    whole = copies.select(*ROW, F.lit(0).alias("start"), F.col("n_bytes").cast("int").alias("stop"))
    span = F.struct("start", "stop")
    return reduce(DataFrame.unionByName, found, whole).groupBy(*ROW).agg(F.array_sort(F.collect_set(span)).alias("spans"))


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Ascending spans with those that meet or overlap made one."""
    runs: list[tuple[int, int]] = []
    for start, stop in spans:
        if runs and start <= runs[-1][1]:
            runs[-1] = (runs[-1][0], max(stop, runs[-1][1]))
        else:
            runs.append((start, stop))
    return runs


CUT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"


def _cut_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for doc_id, text, spans in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "spans"))):
            data = as_bytes(text)
            runs = merged([(s["start"], s["stop"]) for s in spans or ()])
            edges = [0, *(e for run in runs for e in run), len(data)]
            kept = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2]))
            out.append((doc_id, len(data), len(data) - len(kept), len(runs), kept))
        kinds = [pa.int64()] * 4 + [pa.binary()]
        columns = list(zip(*out)) if out else [()] * 5
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"]
        )


def remove_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept) of each row; ``kept`` is what is left, as bytes."""
    spans = stored(repeated_spans(docs)).withColumnsRenamed({"doc_id": "_d", "_text_hash": "_h"})
    docs = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    docs = docs.withColumn("_text_hash", F.xxhash64("text"))
    same = docs["doc_id"].eqNullSafe(spans["_d"]) & (docs["_text_hash"] == spans["_h"])
    return docs.join(spans, same, "left").select("doc_id", "text", "spans").mapInArrow(_cut_batches, CUT)

