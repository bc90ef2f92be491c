"""Two tokenizers' tokens aligned by the bytes they cover, and how often their ids meet in a corpus.

A text is cut into groups where tokens of both sides end at the same byte. Tokens of the two
sides whose byte ranges overlap are linked. The count of an id pair is the number of documents
that hold it linked; a link is best if its count is the highest of any pair of its A id.

Pairs are counted by spilling: a task encodes its texts block by block, makes the block's sorted
(pair, document, repeats) records and deals them by the last digits of the A id into runs,
compressed by zstd. What a run says of each pair, its number of documents, is merged with the
other runs by a heap, ``FAN`` runs at a time and level by level. The last level of a part sees
all pairs of an A id one after another, so it knows their maximum. Counts and maxima then take
the same way back to the blocks, each run getting those of its own pairs only, and there meet
the records of the documents. So a pair is in a run once, however many documents have it, a
task holds some ``FAN`` runs at most, and no table of all pairs is broadcast.

Texts that are null or empty, or that a tokenizer does not give back byte for byte, have no
tokens: zeros, and '' as groups. Each row counts as a document, also a repeated one; null ids are
kept. An empty table gives an empty one. A text is encoded whole; memory is that of a block, which
is one text at least. Only the id and the text are read, so other columns cannot clash.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import sentencepiece
import tiktoken
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitescout.llm.common import bounded_batches, expand, stored
from sitescout.llm.token_counts import PIECES, byte_symbols

DIGIT = 64  # parts of A ids, by remainder
FAN = 64  # runs merged at once
BLOCK_LINKS, BLOCK_DOCS = 1 << 21, 1 << 15
MEMO_CHUNKS = 400_000

#: Whitespace that starts with a space, and what follows up to the next such. Both sides' tokens
#: end where a space follows something else, so chunks can be encoded each for itself.
CHUNK = re.compile(r" \s*\S*(?:[^\S ]\s*\S*)*")
_SPACE_PIECE = "▁"

STATS = ("n_a", "n_b", "n_groups", "n_links")
RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


# ---- the two sides


class ByteSide:
    """A byte-level vocabulary file (.json): a text to ids, without special tokens."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        symbols = byte_symbols()
        special = {t["content"] for t in content.get("added_tokens", [])}
        vocabulary = {t: i for t, i in content["model"]["vocab"].items() if t not in special}
        ranks = {bytes(map(symbols.__getitem__, t)): i for t, i in vocabulary.items()}
        self.token_bytes = [b""] * (max(content["model"]["vocab"].values()) + 1)
        for token, i in ranks.items():
            self.token_bytes[i] = token
        self._coder = tiktoken.Encoding(path, pat_str=PIECES, mergeable_ranks=ranks, special_tokens={})

    def encode(self, chunks: list[str]) -> list[list[int]]:
        return list(map(self._coder.encode_ordinary, chunks))


class PieceSide:
    """A sentencepiece model (.model) that adds a space in front, keeps spaces and has byte fallback."""

    def __init__(self, path: str) -> None:
        self._coder = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self._coder.id_to_piece(i) for i in range(self._coder.get_piece_size())]
        if any(re.search(f"[^{_SPACE_PIECE}]{_SPACE_PIECE}", p) for p in pieces) or "".join(
            self._coder.encode("a  b ", out_type=str)
        ) != "▁a▁▁b▁":
            raise ValueError(f"{path}: texts of this model cannot be encoded word by word")
        self.token_bytes = [
            bytes([int(p[3:5], 16)]) if self._coder.is_byte(i) else p.replace(_SPACE_PIECE, " ").encode()
            for i, p in enumerate(pieces)
        ]
        self._space = self._coder.piece_to_id(_SPACE_PIECE)

    def encode(self, chunks: list[str]) -> list[list[int]]:
        """Ids of chunks, which start with the space that the model adds."""
        return [ids or [self._space] for ids in self._coder.encode([c[1:] for c in chunks], num_threads=1)]


class Aligner:
    """Chunks with their links and groups, those met before kept up to ``MEMO_CHUNKS``."""

    def __init__(self, a_path: str, b_path: str) -> None:
        self.a, self.b = ByteSide(a_path), PieceSide(b_path)
        self.b_size = len(self.b.token_bytes)
        self._widths = [np.array(list(map(len, side.token_bytes))) for side in (self.a, self.b)]
        # a token's text in a listing of groups: of side A before another or before |, of side B likewise
        self._words = [f"{i}{end}" for side, ends in ((self.a, ",|"), (self.b, ",;")) for end in ends for i in range(len(side.token_bytes))]
        self.clear()

    def clear(self) -> None:
        self.numbers: dict[str, int] = {}
        self.listings: list[str] = []
        self.keys = np.zeros(0, np.int64)  # of all links: the A id's last digits, the rest of it, the B id
        self.stats = np.zeros((0, len(STATS)), np.int64)
        self.is_whole = np.zeros(0, bool)

    def key(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (a % DIGIT * self.digit_span + a // DIGIT) * self.b_size + b

    @property
    def digit_span(self) -> int:
        return -(-len(self.a.token_bytes) // DIGIT)

    def learn(self, chunks: list[str]) -> None:
        """Aligns new chunks, all in one go, laid end to end."""
        coded = [side.encode(chunks) for side in (self.a, self.b)]
        ids = [np.fromiter(chain.from_iterable(c), np.int64) for c in coded]
        sizes = [np.fromiter(map(len, c), np.int64, len(c)) for c in coded]
        owners = [np.repeat(np.arange(len(chunks)), n) for n in sizes]
        raw = [c.encode("utf-8", "surrogatepass") for c in chunks]
        whole = np.ones(len(chunks), bool)
        for side, lists in ((self.a, coded[0]), (self.b, coded[1])):
            get = side.token_bytes.__getitem__
            whole &= np.fromiter((b"".join(map(get, x)) == r for x, r in zip(lists, raw)), bool, len(chunks))
        for s in range(2):  # what is not whole has no tokens
            ids[s] = ids[s][whole[owners[s]]]
            owners[s] = owners[s][whole[owners[s]]]
        ends = [np.cumsum(w[i]) for w, i in zip(self._widths, ids)]
        both = np.union1d(*ends)
        at = [np.searchsorted(e, both) for e in ends]  # the tokens that cover each piece between two ends
        linked = owners[0][at[0]] if len(both) else np.zeros(0, np.int64)
        closes = [np.isin(e, o, assume_unique=True) for e, o in (ends, ends[::-1])]

        n_links = np.bincount(linked, minlength=len(chunks))
        stats = [np.bincount(o, minlength=len(chunks)) for o in owners]
        stats += [np.bincount(owners[0][closes[0]], minlength=len(chunks)), n_links]

        # listings: tokens by group, A before B
        group = [np.cumsum(np.r_[0, c[:-1]]) if len(c) else np.zeros(0, np.int64) for c in closes]
        tables = np.cumsum([0, *[len(s.token_bytes) for s in (self.a, self.a, self.b)]])
        words = [np.where(closes[s], tables[2 * s + 1], tables[2 * s]) + ids[s] for s in range(2)]
        order = np.argsort(np.concatenate([2 * group[0], 2 * group[1] + 1]), kind="stable")
        listed = list(map(self._words.__getitem__, np.concatenate(words)[order].tolist()))
        cuts = np.r_[0, np.cumsum(stats[0] + stats[1])].tolist()
        self.listings += ["".join(listed[i:j]) for i, j in zip(cuts, cuts[1:])]

        first = len(self.numbers)
        self.numbers.update(zip(chunks, range(first, first + len(chunks))))
        self.keys = np.concatenate([self.keys, self.key(ids[0][at[0]], ids[1][at[1]])])
        self.stats = np.concatenate([self.stats, np.stack(stats, axis=1)])
        self.is_whole = np.concatenate([self.is_whole, whole])

    def block(self, texts: list[str | None]) -> dict[str, object]:
        """Per text its stats and groups; the sorted (pair, document, repeats) records of all."""
        chunks = [CHUNK.findall(" " + t) if t else [] for t in texts]
        known = self.numbers
        if new := list(dict.fromkeys(c for cs in chunks for c in cs if c not in known)):
            if len(known) + len(new) > MEMO_CHUNKS:
                self.clear()
                new = list(dict.fromkeys(chain.from_iterable(chunks)))
            self.learn(new)
        get = self.numbers.__getitem__
        numbers = np.fromiter(map(get, chain.from_iterable(chunks)), np.int64)
        sizes = np.fromiter(map(len, chunks), np.int64, len(chunks))
        owner = np.repeat(np.arange(len(texts)), sizes)
        broken = np.bincount(owner[~self.is_whole[numbers]], minlength=len(texts)) > 0
        kept = ~broken[owner]
        stats = np.zeros((len(texts), len(STATS)), np.int64)
        for s in range(len(STATS)):
            weights = np.where(kept, self.stats[numbers, s], 0)
            stats[:, s] = np.bincount(owner, weights, len(texts)).astype(np.int64)

        text_of = self.listings.__getitem__
        ends = np.cumsum(sizes).tolist()
        digests = []
        for end, size, bad in zip(ends, sizes.tolist(), broken.tolist()):
            listing = "" if bad else "".join(map(text_of, numbers[end - size : end].tolist()))
            digests.append(hashlib.sha256(listing[:-1].encode()).hexdigest() if listing else "")

        numbers, owner = numbers[kept], owner[kept]
        n_links = self.stats[:, STATS.index("n_links")]
        starts = np.cumsum(n_links) - n_links
        keys = self.keys[expand(starts[numbers], n_links[numbers])]
        records = np.sort(keys << 16 | np.repeat(owner, n_links[numbers]))  # BLOCK_DOCS fit 16 bits
        first = np.flatnonzero(np.r_[True, records[1:] != records[:-1]]) if len(records) else np.zeros(0, np.int64)
        repeats = np.diff(np.r_[first, len(records)])
        return {"stats": stats, "digests": digests, "records": records[first], "repeats": repeats}


@lru_cache(maxsize=1)
def aligner(a_path: str, b_path: str) -> Aligner:
    return Aligner(a_path, b_path)


# ---- runs


def pack(*columns: np.ndarray) -> bytes:
    """Columns of equal length; each byte of all numbers of a column lies together, which zstd likes."""
    planes = [c.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes() for c in columns]
    return zstandard.compress(b"".join(planes), 3)


def unpack(run: bytes, columns: int) -> list[np.ndarray]:
    data = np.frombuffer(zstandard.decompress(run), np.uint8).reshape(columns, 8, -1)
    return [np.ascontiguousarray(c.T).view("<u8").reshape(-1).astype(np.int64) for c in data]


def pack_head(keys: np.ndarray, counts: np.ndarray) -> bytes:
    return pack(np.diff(keys, prepend=0), counts)


def unpack_head(run: bytes) -> tuple[np.ndarray, np.ndarray]:
    steps, counts = unpack(run, 2)
    return np.cumsum(steps), counts


def merge_runs(runs: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys of sorted runs with the sums of their counts, by a heap over the runs."""
    shift = max(len(runs) - 1, 1).bit_length()
    number = (1 << shift) - 1
    counts = [iter(c.tolist()) for _, c in runs]
    cursors = [(k << shift | i).tolist() for i, (k, _) in enumerate(runs)]
    keys, sums, last = [], [], -1
    for item in heapq.merge(*cursors):
        key = item >> shift
        if key != last:
            keys.append(key)
            sums.append(0)
            last = key
        sums[-1] += next(counts[item & number])
    return np.array(keys, np.int64), np.array(sums, np.int64)


def with_best(keys: np.ndarray, sums: np.ndarray, b_size: int) -> np.ndarray:
    """Twice each sum, plus one if no pair of the same A id has a higher one."""
    a = keys // b_size
    opens = np.flatnonzero(np.r_[True, a[1:] != a[:-1]])
    highest = np.repeat(np.maximum.reduceat(sums, opens), np.diff(np.r_[opens, len(a)]))
    return 2 * sums + (sums == highest)


# ---- the job


def _blocks(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """One row per block: its documents with their stats, and a head and a body for each part."""
    schema = (
        "block long, doc_ids array<string>, n_a array<long>, n_b array<long>, n_groups array<long>,"
        " n_links array<long>, digests array<string>, heads array<binary>, bodies array<binary>"
    )
    strings, numbers, binaries = (pa.list_(kind()) for kind in (pa.string, pa.int64, pa.binary))
    kinds = [pa.int64(), strings, *[numbers] * len(STATS), strings, binaries, binaries]

    def row(number: int, ids: list[str | None], texts: list[str | None]) -> pa.RecordBatch:
        sides = aligner(a_path, b_path)
        made = sides.block(texts)
        keys, owners = made["records"] >> 16, made["records"] & 0xFFFF
        cuts = np.searchsorted(keys, np.arange(DIGIT + 1) * sides.digit_span * sides.b_size)
        heads, bodies = [], []
        for i, j in zip(cuts, cuts[1:]):
            opens = np.flatnonzero(np.diff(keys[i:j], prepend=-1))
            n = np.diff(np.r_[opens, j - i])
            heads.append(pack_head(keys[i:j][opens], n) if j > i else b"")
            steps = np.diff(owners[i:j], prepend=0)
            steps[opens] = owners[i:j][opens]
            bodies.append(pack(steps, made["repeats"][i:j]) if j > i else b"")
        values = [number, ids, *made["stats"].T.tolist(), made["digests"], heads, bodies]
        names = [f.split()[0] for f in schema.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names)

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        ids, texts, weight = [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids.append(doc_id)
                texts.append(text)
                weight += len(text or "")  # a text has fewer links than characters, mostly half as many
                if weight >= 2 * BLOCK_LINKS or len(ids) >= BLOCK_DOCS:
                    yield row(number, ids, texts)
                    number, ids, texts, weight = number + 1, [], [], 0
        if ids:
            yield row(number, ids, texts)

    return docs.select(F.col("doc_id").cast("string"), "text").mapInArrow(encode, schema)


def align(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): tokens, groups, links, best links, sum of counts, groups.

    ``a_path`` is a byte-level vocabulary (.json), ``b_path`` a sentencepiece model (.model); every
    executor can open both. Columns are those of ``RESULT``.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    blocks = stored(_blocks(docs, a_path, b_path))
    exploded = blocks.select(F.col("block").alias("run"), F.posexplode("heads").alias("part", "head"))
    level = exploded.where(F.octet_length("head") > 0)
    n_runs = blocks.count()
    b_size = sentencepiece.SentencePieceProcessor(model_file=b_path).get_piece_size()

    def merge(key: tuple, runs: pd.DataFrame) -> pd.DataFrame:
        merged = pack_head(*merge_runs([unpack_head(h) for h in runs["head"]]))
        return pd.DataFrame({"part": [key[0]], "run": [key[1]], "head": [merged]})

    levels = []
    while n_runs > FAN:
        n_runs = -(-n_runs // (FAN // 2))  # about half of FAN in each, as a hash deals them
        level = level.withColumn("up", F.pmod(F.xxhash64("run"), F.lit(n_runs)).cast("long"))
        levels.append(level)
        level = stored(level.groupBy("part", "up").applyInPandas(merge, "part int, run long, head binary"))

    def answers(runs: pd.DataFrame, keys: np.ndarray, values: np.ndarray) -> pd.DataFrame:
        replies = [pack(values[np.searchsorted(keys, unpack_head(h)[0])]) for h in runs["head"]]
        return pd.DataFrame({"part": runs["part"], "run": runs["run"], "reply": replies})

    def finish(runs: pd.DataFrame) -> pd.DataFrame:
        keys, sums = merge_runs([unpack_head(h) for h in runs["head"]])
        return answers(runs, keys, with_best(keys, sums, b_size))

    def pass_down(runs: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        return answers(runs, unpack_head(above["head"][0])[0], unpack(above["reply"][0], 1)[0])

    reply_schema = "part int, run long, reply binary"
    merged = level
    replies = level.groupBy("part").applyInPandas(finish, reply_schema)
    for level in reversed(levels):
        above = merged.join(replies, ["part", "run"]).withColumnRenamed("run", "up")
        below = level.groupBy("part", "up").cogroup(above.groupBy("part", "up"))
        merged, replies = level.drop("up"), below.applyInPandas(pass_down, reply_schema)

    def contribute(block: pd.DataFrame, replies: pd.DataFrame) -> pd.DataFrame:
        block = block.iloc[0]
        n_best, count_sum = (np.zeros(len(block["doc_ids"]), np.int64) for _ in range(2))
        for part, reply in zip(replies["part"], replies["reply"]):
            n = unpack_head(block["heads"][part])[1]
            steps, repeats = unpack(block["bodies"][part], 2)
            opens = np.cumsum(n) - n
            before = np.cumsum(steps)
            owners = before - np.repeat(before[opens] - steps[opens], n)
            value = np.repeat(unpack(reply, 1)[0], n)
            np.add.at(n_best, owners, repeats * (value & 1))
            np.add.at(count_sum, owners, repeats * (value >> 1))
        ids = pd.array([None if i is None else int(i) for i in block["doc_ids"]], "Int64")
        stats = {name: block[name] for name in STATS}
        return pd.DataFrame({"doc_id": ids, **stats, "n_best": n_best, "count_sum": count_sum, "groups_sha256": block["digests"]})

    back = replies.withColumnRenamed("run", "block").groupBy("block")
    return blocks.groupBy("block").cogroup(back).applyInPandas(contribute, RESULT)
