"""Toxicity by class-conditional Kneser-Ney models of words as byte sequences.

A text is its words, lower case, each between spaces. A byte is predicted from up to five bytes
before it, not beyond the word's start. The two classes have counts of their own for the full
context; what a class has not seen backs off to continuation counts that both share: in how many
longer contexts a sequence occurs, recursively down to single bytes. So a rare word is judged by
its stem and endings.

All labelled rows outside the held-out fold count, but one fold of them, on which the weights of
four length-normalised features of the log-likelihood ratio are fitted: its mean over the text,
its largest sums over one word and over the three best, and the share of words that lean to toxic.
That fit uses at most ``FIT_ROWS`` rows, chosen by a hash of the id.

The ratios of all counted sequences and contexts are gathered, in parts, into one hash table that has
room for as many as there are, and go to the executors in it: 18 bytes for each.

Null and empty texts, and texts without letters, have features 0 and the score that goes with
them. Rows with null labels are not learned from; a document with several labels counts for each.
Without both classes among the labels every score is 0. Other columns pass through ``score``;
columns named like the added ones are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitescout.llm.common import HELD_OUT, bounded_batches, broadcast_if_small, fold, mix, stored

ORDER, DISCOUNT = 6, 0.75
FIT_FOLD, FIT_ROWS = 3, 20_000
#: Ratios that are gathered at once.
PART_ROWS = 1 << 20
CHUNK_CHARS = 1 << 20
THRESHOLD = 0.3

_LETTER = np.zeros(256, bool)
_LETTER[0x61:0x7B] = True
_LETTER[0x80:] = True
_MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


# ---- sequences


def _streams(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Chunks of bytes, words between single spaces, and the bytes that each text has in them."""
    chunk, held = [], 0
    for text in texts:
        chunk.append((text or "").lower().encode("utf-8", "surrogatepass"))
        held += len(chunk[-1])
        if held > CHUNK_CHARS:
            yield _stream(chunk)
            chunk, held = [], 0
    if chunk:
        yield _stream(chunk)


def _stream(chunk: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    data = np.frombuffer(b"\n".join(chunk) + b"\n", np.uint8)
    letter = _LETTER[data]
    keep = letter | np.r_[False, letter[:-1]]  # a space after each word
    lengths = np.fromiter(map(len, chunk), np.int64, len(chunk)) + 1
    bounds = np.r_[0, np.cumsum(lengths)]
    kept = np.r_[0, np.cumsum(keep)]
    return np.where(letter, data, np.uint8(0x20))[keep], np.diff(kept[bounds])


def _grams(stream: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The last up to six bytes at each place, from the space before the word on; and their number."""
    padded = np.r_[np.full(ORDER, 0x20, np.uint8), stream].astype(np.uint64)
    gram = np.zeros(len(stream), np.uint64)
    for k in range(ORDER):
        gram |= padded[ORDER - k : ORDER - k + len(stream)] << np.uint64(8 * k)
    place = np.arange(len(stream))
    spaces = np.where(stream == 0x20, place, -1)
    last = np.r_[-1, np.maximum.accumulate(spaces)[:-1]] if len(stream) else place
    size = np.minimum(place - last + 1, ORDER)
    return gram & _MASKS[size], size


GRAMS = "gram long, n0 long, n1 long"


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        toxic = batch.column("toxic").to_numpy(zero_copy_only=False)
        texts = batch.column("text").to_pylist()
        counts = []
        for label in (0, 1):
            parts = [_grams(s)[0] for s, _ in _streams([t for t, y in zip(texts, toxic) if y == label])]
            gram, n = np.unique(np.concatenate([*parts, np.empty(0, np.uint64)]), return_counts=True)
            nothing = np.zeros(len(n), np.int64)
            counts.append((gram.view(np.int64), *((nothing, n) if label else (n, nothing))))
        columns = [pa.array(np.concatenate(c), pa.int64()) for c in zip(*counts)]
        yield pa.RecordBatch.from_arrays(columns, ["gram", "n0", "n1"])


# ---- the models


def _size(gram: str) -> Column:
    """The number of bytes of a sequence; none of them is zero."""
    size = F.lit(1)
    for n in range(1, ORDER):
        size = size + (F.col(gram) >= F.lit(1 << 8 * n)).cast("int")
    return size


def _shorter(gram: str, size: Column) -> Column:
    """The sequence without its first byte."""
    masks = F.array(*[F.lit((1 << 8 * n) - 1).cast("long") for n in range(ORDER)])
    return F.col(gram).bitwiseAND(F.element_at(masks, size))


def _context(gram: str) -> Column:
    return F.shiftright(F.col(gram), 8)


def shared_models(counts: DataFrame) -> DataFrame:
    """(gram, shared): the backoff probability of the last byte of each sequence that was counted.

    ``shared`` of a sequence is that of the sequence without its first byte, from the numbers of
    longer sequences in which that occurs in either class.
    """
    sized = counts.select("gram", _size("gram").alias("size"))
    levels = []
    longer = sized.where(F.col("size") == ORDER).select("gram")
    for size in range(ORDER, 1, -1):
        seen = longer.unionByName(sized.where(F.col("size") == size).select("gram")) if size < ORDER else longer
        shorter = seen.groupBy(_shorter("gram", F.lit(size)).alias("gram")).agg(F.count("*").alias("n"))
        levels.append(stored(shorter))
        longer = levels[-1].select("gram")
    below, models = None, []
    for size, level in enumerate(reversed(levels), 1):  # from single bytes to five
        sums = level.groupBy(_context("gram").alias("h")).agg(F.sum("n").alias("total"), F.count("*").alias("types"))
        known = level.withColumn("h", _context("gram")).join(sums, "h")
        if below is None:
            known = known.withColumn("below", F.lit(1 / 256))
        else:
            known = known.withColumn("short", _shorter("gram", F.lit(size)))
            known = known.join(below.select(F.col("gram").alias("short"), F.col("p").alias("below")), "short")
        p = (F.col("n") - DISCOUNT + DISCOUNT * F.col("types") * F.col("below")) / F.col("total")
        below = stored(known.select("gram", p.alias("p")))
        models.append(below)
    probabilities = reduce(DataFrame.unionByName, models)
    wanted = sized.withColumn("short", _shorter("gram", F.col("size")))
    return wanted.join(probabilities.withColumnRenamed("gram", "short"), "short").select("gram", F.col("p").alias("shared"))


def log_ratios(counts: DataFrame) -> DataFrame:
    """(key, is_context, ratio): log(toxic / ordinary) of the last byte of each sequence, and of a
    byte not yet seen after each context."""
    counts = counts.withColumn("h", _context("gram"))
    contexts = counts.groupBy("h").agg(
        *[F.sum(f"n{c}").alias(f"total{c}") for c in (0, 1)],
        *[F.sum((F.col(f"n{c}") > 0).cast("long")).alias(f"types{c}") for c in (0, 1)],
    )
    contexts = stored(contexts)

    def backoff(c: int) -> Column:
        rest = DISCOUNT * F.col(f"types{c}") / F.col(f"total{c}")
        return F.when(F.col(f"total{c}") > 0, rest).otherwise(F.lit(1.0))

    def probability(c: int) -> Column:
        own = F.greatest(F.col(f"n{c}") - DISCOUNT, F.lit(0.0)) / F.greatest(f"total{c}", F.lit(1))
        return own + backoff(c) * F.col("shared")

    seen = counts.join(contexts, "h").join(shared_models(counts), "gram")
    seen = seen.select(
        F.col("gram").alias("key"),
        F.lit(False).alias("is_context"),
        F.log(probability(1) / probability(0)).alias("ratio"),
    )
    unseen = contexts.select(
        F.col("h").alias("key"),
        F.lit(True).alias("is_context"),
        F.log(backoff(1) / backoff(0)).alias("ratio"),
    )
    return seen.unionByName(unseen)


def _codes(keys: np.ndarray, is_context: np.ndarray | bool) -> np.ndarray:
    """A number for each sequence or context, never 0; they have at most 48 bits."""
    return keys.astype(np.uint64) << np.uint64(1) | np.asarray(is_context).astype(np.uint64)


@dataclass
class Model:
    """Codes and ratios by slot (code 0: none), and the weights of the features (the first for none).

    A code is in the first slot that was free from its own on; each search ends at a free slot.
    """

    codes: np.ndarray
    ratios: np.ndarray
    n_slots: int
    weights: np.ndarray | None = None

    @staticmethod
    def of(codes: np.ndarray, ratios: np.ndarray) -> Model:
        n_slots = len(codes) * 3 // 2 + 1
        slots = _slots(codes, n_slots)
        order = np.argsort(slots)
        rank = np.arange(len(order))
        at = np.maximum.accumulate(slots[order] - rank) + rank
        size = max(n_slots, int(at.max(initial=0)) + 1) + 1
        model = Model(np.zeros(size, np.uint64), np.zeros(size, np.float32), n_slots)
        model.codes[at], model.ratios[at] = codes[order], ratios[order]
        return model

    def look_up(self, keys: np.ndarray, is_context: bool) -> np.ndarray:
        codes = _codes(keys, is_context)
        found = np.full(len(codes), np.nan, np.float32)
        slots, sought = _slots(codes, self.n_slots), np.arange(len(codes))
        while len(sought):
            there = self.codes[slots]
            hit = there == codes
            found[sought[hit]] = self.ratios[slots[hit]]
            more = ~hit & (there != 0)
            slots, codes, sought = slots[more] + 1, codes[more], sought[more]
        return found


def _slots(codes: np.ndarray, n_slots: int) -> np.ndarray:
    if n_slots >> 32:
        return (mix(codes) % np.uint64(n_slots)).astype(np.int64)
    return ((mix(codes) >> np.uint64(32)) * np.uint64(n_slots) >> np.uint64(32)).astype(np.int64)


def gathered(ratios: DataFrame) -> Model:
    """The model of all ``ratios`` (key, is_context, ratio), without weights."""
    ratios = stored(ratios.select("key", "is_context", F.col("ratio").cast("float").alias("ratio")))
    parts = -(-ratios.count() // PART_ROWS) or 1
    codes, values = [np.empty(0, np.uint64)], [np.empty(0, np.float32)]
    for part in range(parts):
        rows = ratios.where(F.pmod(F.xxhash64("key"), F.lit(parts)) == part).toArrow()
        codes.append(_codes(rows["key"].to_numpy(), rows["is_context"].to_numpy()))
        values.append(rows["ratio"].to_numpy())
    return Model.of(np.concatenate(codes), np.concatenate(values))


N_FEATURES = 4


def features(model: Model, texts: list[str | None]) -> np.ndarray:
    """A row of features for each text."""
    rows = []
    for stream, sizes in _streams(texts):
        gram, _ = _grams(stream)
        own = model.look_up(gram, False)
        missing = np.flatnonzero(np.isnan(own))
        own[missing] = np.nan_to_num(model.look_up(gram[missing] >> np.uint64(8), True))
        ends = np.flatnonzero(stream == 0x20)
        begins = np.r_[0, ends[:-1] + 1]
        sums = np.add.reduceat(own.astype(np.float64), begins) if len(ends) else np.empty(0)
        per_byte = sums / np.maximum(ends - begins + 1, 1)
        bounds = np.r_[0, np.cumsum(sizes)]
        first = np.searchsorted(begins, bounds)
        for a, b, size in zip(first[:-1], first[1:], sizes):
            if a == b:
                rows.append(np.zeros(N_FEATURES))
                continue
            words = sums[a:b]
            top = np.sort(np.partition(words, -3)[-3:] if b - a > 3 else words)[::-1]
            rows.append(np.array([words.sum() / size, max(top[0], 0), np.clip(top, 0, None).sum() / 3, (per_byte[a:b] > 0.5).mean()]))
    return np.array(rows).reshape(-1, N_FEATURES)


def fit_weights(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 30) -> np.ndarray:
    """Logistic regression by Newton's method, a small penalty keeping it finite."""
    x = np.c_[np.ones(len(x)), x]
    w = np.zeros(x.shape[1])
    penalty = ridge * np.eye(len(w))
    penalty[0, 0] = 1e-3
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) + penalty @ w
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, gradient)
        w -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-6:
            break
    return w


def _feature_udf(shared):
    @F.pandas_udf("array<double>")
    def compute(texts: pd.Series) -> pd.Series:
        return pd.Series(list(features(shared.value, texts.tolist())))

    return compute


def train(docs: DataFrame, labels: DataFrame) -> Model | None:
    """The model learned from ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic), but not from
    the held-out fold; None if a class is missing."""
    spark = docs.sparkSession
    bounded_batches(spark)
    labels = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).where("toxic in (0, 1)")
    labels = broadcast_if_small(stored(labels))
    known = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(labels, "doc_id")
    known = known.where((fold() != HELD_OUT) & F.col("text").isNotNull())
    counted = known.where(fold() != FIT_FOLD).select("text", "toxic").mapInArrow(_count_batches, GRAMS)
    counts = stored(counted.groupBy("gram").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")))
    n0, n1 = counts.agg(F.sum("n0"), F.sum("n1")).first()
    if not n0 or not n1:
        return None
    model = gathered(log_ratios(counts))
    fitted = known.where(fold() == FIT_FOLD).orderBy(F.xxhash64("doc_id"), "text", "toxic").limit(FIT_ROWS)
    fitted = fitted.select("toxic", _feature_udf(spark.sparkContext.broadcast(model))("text").alias("x")).toPandas()
    if fitted["toxic"].nunique() < 2:
        model.weights = np.array([-2.0, 0.0, 0.5, 0.0, 0.0])  # too few rows: one strong word decides
    else:
        model.weights = fit_weights(np.stack(fitted["x"]), fitted["toxic"].to_numpy(float))
    return model


def score(docs: DataFrame, model: Model | None, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with ``score`` (0 to 1, higher: toxic is likelier) and ``predicted`` (score >= threshold)."""
    if model is None:
        return docs.withColumn("score", F.lit(0.0)).withColumn("predicted", F.lit(0))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def probability(texts: pd.Series) -> pd.Series:
        w = shared.value.weights
        z = w[0] + features(shared.value, texts.tolist()) @ w[1:]
        return pd.Series(1 / (1 + np.exp(-np.clip(z, -30, 30))))

    scored = docs.withColumn("score", probability(F.col("text").cast("string")))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
