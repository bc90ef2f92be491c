"""Token counts by byte-pair merging.

A piece of text starts as its bytes, held in a linked list. A heap yields the adjacent pair of
lowest rank, leftmost first; the pair becomes one symbol and its new neighbours enter the heap.
The count is the number of bytes minus the number of merges: no identifiers are made.

Nulls and empty texts have no tokens. A text of any length is counted whole; memory is that of
its longest piece. Repeated rows are counted each for itself. Other columns pass through.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Callable
from functools import lru_cache

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: How byte-level vocabularies of this family cut text before merging. Fixed value.
PIECES = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
MEMO_PIECES, MEMO_CHARS = 1_000_000, 40


def byte_symbols() -> dict[str, int]:
    """The printable characters that stand for the 256 bytes in vocabulary files, with their bytes."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def read_merges(path: str) -> tuple[dict[int, int], list[str]]:
    """Ranks of pairs of symbols, and the special strings, of a byte-level vocabulary file.

    Bytes are symbols 0 to 255, and the merge of rank r makes symbol 256 + r. A pair is the number
    left << 32 | right.
    """
    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    symbols = byte_symbols()
    ranks: dict[int, int] = {}
    for rank, (left, right) in enumerate(content["model"]["merges"]):
        ranks[symbols[left] << 32 | symbols[right]] = rank
        symbols.setdefault(left + right, 256 + rank)
    return ranks, [t["content"] for t in content.get("added_tokens", [])]


def count_merged(piece: bytes, ranks: dict[int, int]) -> int:
    """The number of symbols left of ``piece`` when no pair can be merged."""
    size = len(piece)
    symbols = list(piece)
    before, after = list(range(-1, size - 1)), list(range(1, size + 1))
    get = ranks.get
    heap = [(r, i) for i in range(size - 1) if (r := get(symbols[i] << 32 | symbols[i + 1])) is not None]
    heapq.heapify(heap)
    merges = 0
    while heap:
        rank, i = heapq.heappop(heap)
        j = after[i]
        if symbols[i] < 0 or j >= size or get(symbols[i] << 32 | symbols[j]) != rank:
            continue  # one of the two has been merged meanwhile
        symbols[i], symbols[j] = 256 + rank, -1
        merges += 1
        k = after[i] = after[j]
        if k < size:
            before[k] = i
            if (r := get(symbols[i] << 32 | symbols[k])) is not None:
                heapq.heappush(heap, (r, i))
        if (h := before[i]) >= 0 and (r := get(symbols[h] << 32 | symbols[i])) is not None:
            heapq.heappush(heap, (r, h))
    return size - merges


class Memo(dict):
    """Counts of short pieces met before, of bounded size."""

    def __init__(self, ranks: dict[int, int]) -> None:
        super().__init__()
        self.ranks = ranks

    def __missing__(self, piece: str) -> int:
        count = count_merged(piece.encode("utf-8", "surrogatepass"), self.ranks)
        if len(piece) <= MEMO_CHARS:
            if len(self) >= MEMO_PIECES:
                self.clear()
            self[piece] = count
        return count


@lru_cache(maxsize=2)
def counter(path: str) -> Callable[[str | None], int]:
    """A function from a text to its number of tokens."""
    ranks, specials = read_merges(path)
    find, count = regex.compile(PIECES).findall, Memo(ranks).__getitem__
    # longer special strings first, as one may begin another
    cut = regex.compile("|".join(map(regex.escape, sorted(specials, key=len, reverse=True)))) if specials else None

    def plain(text: str) -> int:
        return sum(map(count, find(text)))

    def tokens(text: str | None) -> int:
        if not text:
            return 0
        if cut is None or not any(s in text for s in specials):
            return plain(text)
        parts = cut.split(text)
        return len(parts) - 1 + sum(map(plain, parts))

    return tokens


def count_tokens(docs: DataFrame, path: str, text: str = "text", limit: int = 512) -> DataFrame:
    """``docs`` with ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit`` (n_tokens > limit).

    ``path`` is a byte-level vocabulary file (.json) that every executor can open. Columns of
    these names are replaced.
    """

    @F.pandas_udf("long")
    def n_tokens(texts: pd.Series) -> pd.Series:
        tokens = counter(path)
        return pd.Series([tokens(t) for t in texts], dtype="int64")

    return (
        docs.withColumn("n_bytes", F.coalesce(F.octet_length(text), F.lit(0)).cast("long"))
        .withColumn("n_tokens", n_tokens(F.col(text)))
        .withColumn("over_limit", F.col("n_tokens") > limit)
    )
