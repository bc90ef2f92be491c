"""Stretches of words that repeat with a short period, found by longest common extensions.

A run is a stretch of words with smallest period q, at least ``max(6, 4 q)`` words long, that
cannot be extended by a neighbouring word with period q kept. Every stretch of 4 q words holds four
grid places 0, q, 2 q, ... with one and the same word, so for each period only such places are
tried: n / q of them for period q, a harmonic sum in all. From a place the run follows from the
longest common extensions of (x, x + q) to the right and to the left.

An extension is measured by a difference cover: of all places only those whose remainder modulo
``MODULUS`` is in ``COVER`` have their suffixes sorted, by doubling. Two places compare words until
both are such places at the same time, which takes less than ``MODULUS`` words; from there the
common prefixes of neighbouring sorted suffixes, with a sparse table of their minima, tell the rest.

Nulls and texts without words have no runs. Texts are treated whole, in one task each; memory grows
with n log n of the words of one text. Rows are treated each for itself, so repeated rows and ties of
ids change nothing, and an empty table gives an empty one. Only the id and the text are read, so
other columns cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitescout.llm.common import as_bytes, bounded_batches, expand

#: Every difference modulo 31 is one of two members of the cover.
MODULUS, COVER = 31, (1, 5, 11, 24, 25, 27)
LEAST_WORDS, LEAST_REPEATS = 6, 4
#: Grid places looked at together.
PLACES = 1 << 20

_RANK = np.full(MODULUS, -1)
_RANK[list(COVER)] = np.arange(len(COVER))
#: _SHIFT[r, s]: the least step that brings remainders r and s into the cover together.
_SHIFT = np.array(
    [[min(d for d in range(MODULUS) if {(r + d) % MODULUS, (s + d) % MODULUS} <= set(COVER)) for s in range(MODULUS)]
     for r in range(MODULUS)]
)


class Extensions:
    """Longest common extensions to the right between places of an array of non-negative numbers."""

    def __init__(self, words: np.ndarray) -> None:
        self.n = len(words)
        # as if the text went on with numbers that occur nowhere else, each of them once
        self.words = np.concatenate([words.astype(np.int64), -1 - np.arange(2 * MODULUS)])
        self._table: list[np.ndarray] | None = None

    def _sort(self) -> None:
        """Ranks of the sampled suffixes and the sparse table over their common prefixes."""
        blocks = -(-(self.n + 1) // MODULUS)
        places = (np.arange(blocks)[:, None] * MODULUS + np.array(COVER)).reshape(-1)
        count, width = len(places), len(COVER)
        padded = np.concatenate([self.words[: self.n], np.full(2 * MODULUS + blocks * MODULUS - self.n, -1)])
        # a sampled suffix's next MODULUS words, then those of the sample MODULUS words on, doubling
        first = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(padded, MODULUS)[places] + 1)
        rank = np.unique(first.astype(">u4").view(np.dtype((np.void, 4 * MODULUS))).reshape(-1), return_inverse=True)[1].reshape(-1)
        levels, step = [rank], 1
        while step < blocks and rank.max() + 1 < count:
            after = np.full(count, -1)
            after[: count - step * width] = rank[step * width :]
            rank = np.unique(rank * (count + 1) + after + 1, return_inverse=True)[1].reshape(-1)
            levels.append(rank)
            step *= 2
        order = np.lexsort((-np.arange(count), rank))  # ends of the text are equal ranks: the shorter first
        self._rank = np.empty(count, np.int64)
        self._rank[order] = np.arange(count)
        # common prefixes of neighbours: whole blocks by the levels, the rest word by word
        i, j = order[:-1].copy(), order[1:].copy()
        whole = np.zeros(len(i), np.int64)
        for k in range(len(levels) - 1, -1, -1):
            size = (1 << k) * width
            inside = (i < count) & (j < count)
            same = np.zeros(len(i), bool)
            same[inside] = levels[k][i[inside]] == levels[k][j[inside]]
            same &= (i + size <= count) & (j + size <= count)
            i[same] += size
            j[same] += size
            whole[same] += (1 << k) * MODULUS
        common = whole + self._direct(places[order[:-1]] + whole, places[order[1:]] + whole, np.full(len(i), MODULUS))
        self._table = [common]
        while len(self._table[-1]) > 1 << (len(self._table) - 1):
            last, half = self._table[-1], 1 << (len(self._table) - 1)
            self._table.append(np.minimum(last[:-half], last[half:]))

    def _direct(self, i: np.ndarray, j: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Equal words from i and j on, counted up to ``most``."""
        found = np.zeros(len(i), np.int64)
        going = np.flatnonzero((i < self.n) & (j < self.n) & (most > 0))
        step = 0
        while len(going):
            # beyond the end every number is another one, and i <> j
            at_i, at_j = np.minimum(i[going] + step, self.n + MODULUS - 1), np.minimum(j[going] + step, self.n + MODULUS - 1)
            going = going[(self.words[at_i] == self.words[at_j]) & (at_i != at_j)]
            found[going] += 1
            step += 1
            going = going[most[going] > step]
        return found

    def __call__(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Lengths of the common extensions of places i and j, which differ; up to n is allowed."""
        shift = _SHIFT[i % MODULUS, j % MODULUS]
        found = self._direct(i, j, shift)
        far = np.flatnonzero((found == shift) & (np.maximum(i, j) + shift < self.n))
        if len(far):
            if self._table is None:
                self._sort()
            a, b = (x[far] + shift[far] for x in (i, j))
            a, b = (self._rank[x // MODULUS * len(COVER) + _RANK[x % MODULUS]] for x in (a, b))
            low, high = np.minimum(a, b), np.maximum(a, b)
            depth = np.frexp((high - low).astype(float))[1] - 1
            least = np.empty(len(far), np.int64)
            for k in np.unique(depth):
                here = depth == k
                row = self._table[k]
                least[here] = np.minimum(row[low[here]], row[high[here] - (1 << int(k))])
            found[far] += least
        return found


def _grid(words: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(periods, places): grid places x of period q with one word at x, x + q, ... ``LEAST_REPEATS`` times."""
    n = len(words)
    periods = np.arange(1, n // LEAST_REPEATS + 1)
    tries = (n - 1 - (LEAST_REPEATS - 1) * periods) // periods + 1
    cuts = np.searchsorted(np.cumsum(tries), np.arange(PLACES, int(tries.sum()) + PLACES, PLACES))
    for low, high in zip(np.r_[0, cuts[:-1] + 1], np.minimum(cuts + 1, len(periods))):
        q = np.repeat(periods[low:high], tries[low:high])
        x = q * expand(np.zeros(high - low, np.int64), tries[low:high])
        same = words[x] == words[x + q]
        for k in range(2, LEAST_REPEATS):
            q, x = q[same], x[same]
            same = words[x] == words[x + k * q]
        yield q[same], x[same]


def find_runs(words: np.ndarray) -> np.ndarray:
    """(start, length, period) of the runs of an array of non-negative numbers, by start, then period."""
    n = len(words)
    if n < LEAST_WORDS:
        return np.zeros((0, 3), np.int64)
    right, left = Extensions(words), Extensions(words[::-1])
    found = [np.zeros((0, 3), np.int64)]
    for q, x in _grid(words):
        # places in a chain q apart lie in one run mostly: its first is tried, then the first beyond it
        chain = np.cumsum(np.r_[True, (q[1:] != q[:-1]) | (x[1:] - x[:-1] != q[:-1])])
        going = np.flatnonzero(np.r_[True, chain[1:] != chain[:-1]])[: len(q)]
        last = np.searchsorted(chain, chain, side="right") - 1
        while len(going):
            p, at = q[going], x[going]
            stop = at + p + right(at, at + p)
            start = at - left(n - at, n - at - p)
            length = stop - start
            kept = length >= np.maximum(LEAST_WORDS, LEAST_REPEATS * p)
            found.append(np.stack([start, length, p], axis=1)[kept])
            # the next place x with x + q at or beyond the stop
            skip = np.maximum(-(-(stop - p - at) // p), 1)
            going = (going + skip)[going + skip <= last[going]]
    runs = np.concatenate(found)
    if len(runs):  # a multiple of the smallest period gives the same stretch
        runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
        runs = runs[np.r_[True, (runs[1:, :2] != runs[:-1, :2]).any(axis=1)]]
        runs = runs[np.lexsort((runs[:, 2], runs[:, 0]))]
    return runs


def repeat_tail(words: list[bytes], code: int | None) -> list[bytes]:
    """The words, of which a tail is made periodic where the id's checksum ``code`` asks for it."""
    if code is None or code % 10 or not words:
        return words
    g, n = code // 10, len(words)
    start = g % n
    period = 1 + (n - start) // (3 + g % 8)
    unit = words[start : start + period]
    return words[:start] + (unit * -(-(n - start) // period))[: n - start]


def describe(text: str | None, code: int | None) -> tuple:
    """(n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256) of a text."""
    words = repeat_tail(as_bytes(text).split(), code)
    numbers: dict[bytes, int] = {}
    runs = find_runs(np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int64))
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs.tolist())
    best = (None, None, None, None)
    if len(runs):
        repeats = np.zeros(len(words) + 1, np.int64)  # how many runs a word repeats, as differences
        np.add.at(repeats, runs[:, 0] + runs[:, 2], 1)
        np.add.at(repeats, runs[:, 0] + runs[:, 1], -1)
        words = [words[i] for i in np.flatnonzero(np.cumsum(repeats[:-1]) == 0).tolist()]
        start, length, period = runs[0].tolist()
        for s, n, q in runs[1:].tolist():  # they come by start, then period
            if n * period > length * q:
                start, length, period = s, n, q
        best = (start, length, period, 1000 * length // period)
    return len(runs), *best, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(b" ".join(words)).hexdigest()


SCHEMA = (
    "doc_id long, n_runs long, start long, length long, period long, exponent_milli long,"
    " runs_sha256 string, collapsed_sha256 string"
)


def periodic_runs(docs: DataFrame) -> DataFrame:
    """The runs of the words ``[^\\x20\\x09-\\x0D]+`` of each text, after ``repeat_tail``; see ``SCHEMA``.

    The run described is that of the greatest length / period, ties to the smallest start, then
    period. ``collapsed_sha256`` is of the words outside the repeats, joined by a space: a run keeps its
    first period. Rows without an id keep their words as they are.
    """
    bounded_batches(docs.sparkSession)

    def describe_all(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64()] * 5 + [pa.string()] * 2
        for batch in batches:
            rows = [describe(t, c) for t, c in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            columns = list(zip(*rows)) or [()] * len(kinds)
            arrays = [batch.column(0), *map(pa.array, columns, kinds)]
            yield pa.RecordBatch.from_arrays(arrays, [f.split()[0] for f in SCHEMA.split(", ")])

    code = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    return docs.select(F.col("doc_id").cast("long"), "text", code).mapInArrow(describe_all, SCHEMA)
