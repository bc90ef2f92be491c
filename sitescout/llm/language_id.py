"""Language identification by a linear-chain conditional random field over words.

Each word of a text gets a language. Its features are the word itself (lexicon), its first one to
three and last one to four bytes (affixes) and its byte trigrams with the word's edges (n-grams);
the field adds a learned weight for each step from one language to another. Forward-backward gives
every word its probabilities given the whole text, so a few foreign words keep their own language.
The text gets the language with the highest mean probability, which is its score.

The field is fitted on a bounded sample of labelled rows outside the held-out fold: at most
``ROWS_PER_LANG`` texts, chosen by a hash of the id, for each language there is; of texts beyond
``FIT_BYTES`` bytes a piece at the beginning. Runs of their words are spliced into mixed sequences, so that
changes of language are learned too. Prediction reads whole texts, in pieces of bounded memory
but for a text longer than that.

Null texts, and texts without a letter, are ``und`` with score 0, as is everything if there is
nothing to learn from. Ties go to the first language by name. Rows are judged each for itself.
Other columns pass through; columns named like the added ones are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sitescout.llm.common import (
    bounded_batches, brought_back, held_out, mix, prefix_sums, set_apart, span_hashes, spans_of,
)

ROWS_PER_LANG, FIT_BYTES = 100, 1 << 16
RUN_WORDS, RUNS, ROUNDS, RATE, RIDGE = (4, 40), 12, 15, 0.6, 1e-6
TABLE_BITS, AFFIXES, BLOCK = 16, (3, 4), 128
CHUNK_BYTES = 1 << 20
UNKNOWN = "und"

_LETTER = np.zeros(256, bool)
_LETTER[0x61:0x7B] = True
_LETTER[0x80:] = True


# ---- features


@dataclass
class Words:
    """Words of some texts: rows of feature numbers, trigrams of all words, words of each text."""

    rows: np.ndarray
    trigrams: np.ndarray
    lengths: np.ndarray
    bounds: np.ndarray


def _number(values: np.ndarray, kind: int) -> np.ndarray:
    return (mix(values ^ np.uint64(kind * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) >> np.uint64(64 - TABLE_BITS)).astype(np.int64)


def words_of_texts(texts: list[bytes]) -> Words:
    """``texts`` are lower case already."""
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    letter = _LETTER[data]
    starts, ends = spans_of(letter)
    sums = prefix_sums(data)
    columns = [_number(span_hashes(sums, starts, ends), 1)]
    columns += [_number(span_hashes(sums, starts, np.minimum(starts + k, ends)), 1 + k) for k in range(1, AFFIXES[0] + 1)]
    columns += [_number(span_hashes(sums, np.maximum(ends - k, starts), ends), 5 + k) for k in range(1, AFFIXES[1] + 1)]
    clear = np.where(letter, data, 0).astype(np.uint64)
    around = np.r_[np.uint64(0), clear, np.uint64(0)]
    trigram = around[:-2] << np.uint64(16) | around[1:-1] << np.uint64(8) | around[2:]
    lengths = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    bounds = np.searchsorted(starts, np.r_[0, np.cumsum(lengths)])
    return Words(np.stack(columns, axis=1), _number(trigram[letter], 11), ends - starts, bounds)


def chunks(texts: list[str | None]) -> Iterator[tuple[list[int], list[bytes]]]:
    """Numbers and lower-case bytes of texts, about ``CHUNK_BYTES`` at a time."""
    numbers, chunk, held = [], [], 0
    for i, text in enumerate(texts):
        chunk.append((text or "").lower().encode("utf-8", "surrogatepass"))
        numbers.append(i)
        held += len(chunk[-1])
        if held > CHUNK_BYTES:
            yield numbers, chunk
            numbers, chunk, held = [], [], 0
    if chunk:
        yield numbers, chunk


# ---- the field


@dataclass
class Field:
    languages: list[str]
    weights: np.ndarray  # (feature, language)
    steps: np.ndarray  # (language, language)


def emissions(words: Words, weights: np.ndarray) -> np.ndarray:
    """Scores (word, language) from the features; the trigrams of a word count as one."""
    if not len(words.rows):
        return np.zeros((0, weights.shape[1]))
    total = weights[words.rows[:, 0]].astype(np.float64)
    for k in range(1, words.rows.shape[1]):
        total += weights[words.rows[:, k]]
    first = np.cumsum(words.lengths) - words.lengths
    return total + np.add.reduceat(weights[words.trigrams], first, axis=0) / words.lengths[:, None]


def _normal(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(x.sum(axis=-1, keepdims=True), 1e-300)


def marginals(scores: np.ndarray, steps: np.ndarray, opens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Probabilities (word, language), and the expected number of steps between languages.

    ``opens`` marks the first word of each text, before which the chain starts anew. The chain is
    cut into blocks whose words are taken together, block by block: first the products of the
    blocks, then the messages between blocks, then those within.
    """
    n, size = scores.shape
    expected = np.zeros((size, size))
    if not n:
        return scores, expected
    count = -(-n // BLOCK)
    shape = (count, BLOCK)
    local = np.ones((count * BLOCK, size))
    local[:n] = np.exp(scores - scores.max(axis=1, keepdims=True))
    local = np.maximum(local, 1e-30).reshape(*shape, size)
    fresh = np.zeros(count * BLOCK, bool)
    fresh[:n] = opens
    fresh = fresh.reshape(shape)
    padded = (np.arange(count * BLOCK) >= n).reshape(shape)
    step = np.exp(steps - steps.max())

    def forward(x: np.ndarray, k: int) -> np.ndarray:
        moved = x @ step
        anew, idle = fresh[:, k], padded[:, k]
        if anew.any():
            moved[anew] = x[anew].sum(axis=-1, keepdims=True) / size
        if idle.any():
            moved[idle] = x[idle]
        return moved

    product = np.broadcast_to(np.eye(size), (count, size, size)).copy()
    for k in range(BLOCK):
        product = forward(product, k) * local[:, k, None, :]
        product /= product.max(axis=(1, 2), keepdims=True)
    entering, leaving = np.empty((count, size)), np.empty((count, size))
    entering[0], leaving[-1] = 1 / size, 1 / size
    for b in range(count - 1):
        entering[b + 1] = _normal(entering[b] @ product[b])
        leaving[count - 2 - b] = _normal(product[count - 1 - b] @ leaving[count - 1 - b])
    ahead = np.empty((count, BLOCK, size))
    x = entering
    for k in range(BLOCK):
        x = ahead[:, k] = _normal(forward(x, k) * local[:, k])
    found = np.empty((count, BLOCK, size))
    back = leaving
    for k in reversed(range(BLOCK)):
        found[:, k] = _normal(ahead[:, k] * back)
        taken = local[:, k] * back
        before = ahead[:, k - 1] if k else entering
        anew, idle = fresh[:, k], padded[:, k]
        both = before[:, :, None] * step * taken[:, None, :]
        both /= np.maximum(both.sum(axis=(1, 2), keepdims=True), 1e-300)
        expected += both[~anew & ~idle].sum(axis=0)
        moved = taken @ step.T
        if anew.any():
            moved[anew] = taken[anew].sum(axis=-1, keepdims=True)
        if idle.any():
            moved[idle] = back[idle]
        back = _normal(moved)
    return found.reshape(-1, size)[:n], expected


def spliced(words: Words, languages: np.ndarray, seed: int = 7) -> tuple[Words, np.ndarray, np.ndarray]:
    """Runs of words of all texts in another order; the language of each word; first words of sequences."""
    rng = np.random.default_rng(seed)
    cuts, labels = [], []
    for a, b, language in zip(words.bounds[:-1], words.bounds[1:], languages):
        while a < b:
            end = min(b, a + int(rng.integers(*RUN_WORDS)))
            cuts.append((a, end))
            labels.append(language)
            a = end
    order = rng.permutation(len(cuts))
    picked = np.concatenate([np.arange(*cuts[i]) for i in order])
    sizes = np.array([cuts[i][1] - cuts[i][0] for i in order])
    begins = np.cumsum(sizes) - sizes
    opens = np.zeros(len(picked), bool)
    opens[begins[::RUNS]] = True
    first = np.cumsum(words.lengths) - words.lengths
    trigrams = np.concatenate([words.trigrams[first[w] : first[w] + words.lengths[w]] for w in picked])
    moved = Words(words.rows[picked], trigrams, words.lengths[picked], np.array([0, len(picked)]))
    return moved, np.repeat(np.array(labels)[order], sizes), opens


def fit(texts: list[str], labels: list[str], rounds: int = ROUNDS) -> Field | None:
    """A field from whole texts with one language each, by gradient ascent on the likelihood."""
    names = sorted(set(labels))
    words = words_of_texts([t.lower().encode("utf-8", "surrogatepass") for t in texts])
    if not len(words.rows):
        return None
    words, truth, opens = spliced(words, np.array([names.index(x) for x in labels]))
    size, table = len(names), 1 << TABLE_BITS
    weights, steps = np.zeros((table, size), np.float32), np.zeros((size, size))
    scale, step_scale = np.full((table, size), 1e-6), np.full((size, size), 1e-6)
    inside = np.flatnonzero(~opens)
    observed = np.zeros((size, size))
    np.add.at(observed, (truth[inside - 1], truth[inside]), 1)
    owner = np.repeat(np.arange(len(truth)), words.lengths)
    share = 1 / words.lengths[owner]
    n = len(truth)
    for _ in range(rounds):
        found, expected = marginals(emissions(words, weights), steps, opens)
        rest = -found
        rest[np.arange(n), truth] += 1
        for j in range(size):
            gradient = np.bincount(words.trigrams, weights=rest[owner, j] * share, minlength=table)
            for k in range(words.rows.shape[1]):
                gradient += np.bincount(words.rows[:, k], weights=rest[:, j], minlength=table)
            gradient = gradient / n - RIDGE * weights[:, j]
            scale[:, j] += gradient**2
            weights[:, j] += RATE * gradient / np.sqrt(scale[:, j])
        gradient = (observed - expected) / n
        step_scale += gradient**2
        steps += RATE * gradient / np.sqrt(step_scale)
    return Field(names, weights, steps)


def predict(field: Field, texts: list[str | None]) -> list[tuple[str, float]]:
    """Language and score of each text; texts without words are unknown."""
    out: list[tuple[str, float]] = [(UNKNOWN, 0.0)] * len(texts)
    for numbers, chunk in chunks(texts):
        words = words_of_texts(chunk)
        opens = np.zeros(len(words.rows), bool)
        filled = np.flatnonzero(np.diff(words.bounds))
        opens[words.bounds[filled]] = True
        found, _ = marginals(emissions(words, field.weights), field.steps, opens)
        if not len(filled):
            continue
        means = np.add.reduceat(found, words.bounds[filled], axis=0) / np.diff(words.bounds)[filled, None]
        for i, mean in zip(filled, means):
            best = int(mean.argmax())
            out[numbers[i]] = (field.languages[best], float(min(1.0, mean[best])))
    return out


# ---- the operator


def fit_sample(docs: DataFrame, rows_per_lang: int = ROWS_PER_LANG) -> list:
    """Rows (text, lang) to learn from: a bounded number for each language."""
    known = docs.where(~held_out()).select("doc_id", F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    known = known.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    # of a long text the piece from its first letter on, of at most four bytes a character
    since_letter = F.regexp_replace("text", r"^\P{L}+", "")
    piece = F.when(F.octet_length("text") <= FIT_BYTES, F.col("text")).otherwise(F.substring(since_letter, 1, FIT_BYTES // 4))
    known = known.withColumn("text", piece)
    counts = known.groupBy("lang").count().collect()
    if not counts:
        return []
    # about twice the rows wanted of each language, so that choosing among them is little work
    shares = docs.sparkSession.createDataFrame(
        [(r["lang"], min(1.0, (2 * rows_per_lang + 50) / r["count"])) for r in counts], "lang string, share double"
    )
    drawn = known.withColumn("u", F.pmod(F.xxhash64(F.lit("language"), "doc_id"), F.lit(1 << 30)) / float(1 << 30))
    drawn = drawn.join(F.broadcast(shares), "lang").where("u < share")
    first = Window.partitionBy("lang").orderBy("u", "doc_id", "text")
    return drawn.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= rows_per_lang).select("text", "lang").collect()


def train(docs: DataFrame) -> Field | None:
    """A field learned from the text and lang of ``docs``; None if there is nothing to learn from."""
    sample = sorted(fit_sample(docs), key=lambda r: (r["lang"], r["text"]))
    return fit([r["text"] for r in sample], [r["lang"] for r in sample]) if sample else None


def identify(docs: DataFrame, field: Field | None) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``."""
    text = F.col("text").cast("string")
    if field is None:
        return docs.withColumn("lang_pred", F.lit(UNKNOWN)).withColumn("score", F.lit(0.0))
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(field)

    @F.pandas_udf("lang_pred string, score double")
    def guess(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame(predict(shared.value, texts.tolist()), columns=["lang_pred", "score"])

    has_letter = F.coalesce(text.rlike(r"\p{L}"), F.lit(False))
    judged = set_apart(docs, "text").withColumn("guess", guess(F.when(has_letter, text)))
    judged = judged.withColumns({"lang_pred": F.col("guess.lang_pred"), "score": F.col("guess.score")})
    return brought_back(judged, docs, "lang_pred", "score")
