import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from sitescout.llm import toxicity as tx

WORDS = [["you scum", "loserly", "idiotic fool"], ["a good day", "the river", "bread and salt"]]


def grams_of(text):
    """All (context, byte) of the words of a text, by a plain loop."""
    out = []
    data = "".join(c if c.isalpha() else " " for c in text.lower()).encode()
    for word in data.split():
        padded = b" " + word + b" "
        for i in range(1, len(padded)):
            out.append(padded[max(0, i - 5) : i + 1])
    return out


def test_sequences():
    texts = ["The cat, sat!", None, "", "42 ...", "éa x", "longerwordshere"]
    for text, (stream, sizes) in zip(texts, (next(tx._streams([t])) for t in texts)):
        got = [int(g).to_bytes(8, "big").lstrip(b"\0") for g in tx._grams(stream)[0]]
        assert got == grams_of(text or "")
    stream, sizes = next(tx._streams(texts))
    assert sizes.tolist() == [sum(len(w) + 1 for w in "".join(c if c.isalpha() else " " for c in t or "").encode().split()) for t in texts]


def test_ratios_are_those_of_the_definition(spark):
    classes = [["the river runs", "a good day the"], ["you scum scum", "the scummy day"]]
    counts = [Counter(g for t in c for g in grams_of(t)) for c in classes]
    rows = [(int.from_bytes(g, "big"), counts[0][g], counts[1][g]) for g in {*counts[0], *counts[1]}]
    got = {(r.key, r.is_context): r.ratio for r in tx.log_ratios(spark.createDataFrame(rows, tx.GRAMS)).collect()}

    raw = {*counts[0], *counts[1]}
    extensions = defaultdict(int)  # sequence -> number of longer sequences
    level = {g for g in raw if len(g) == 6}
    for size in range(6, 1, -1):
        level = level | {g for g in raw if len(g) == size}
        shorter = set()
        for g in level:
            extensions[g[1:]] += 1
            shorter.add(g[1:])
        level = shorter
    by_context = defaultdict(list)
    for g, n in extensions.items():
        by_context[g[:-1]].append(n)

    def shared(g):
        if not g:
            return 1 / 256
        n = by_context[g[:-1]]
        return (extensions[g] - 0.75 + 0.75 * len(n) * shared(g[1:])) / sum(n)

    for g in raw:
        p = []
        for c in counts:
            seen = [n for x, n in c.items() if x[:-1] == g[:-1]]
            if seen:
                p.append((max(c[g] - 0.75, 0) + 0.75 * len(seen) * shared(g[1:])) / sum(seen))
            else:
                p.append(shared(g[1:]))
        assert got[int.from_bytes(g, "big"), False] == pytest.approx(math.log(p[1] / p[0]))


def test_learns_and_never_reads_the_held_out_fold(spark):
    rng = np.random.default_rng(1)
    rows, labels = [], []
    for i in range(600):
        toxic = int(i % 3 == 0)
        words = list(rng.choice(["stone", "river", "house", "walks", "green", "old"], 30))
        if toxic:
            words[int(rng.integers(30))] = str(rng.choice(["scum", "idiot", "scummy"]))
        rows.append((i, " ".join(words), 1.5))
        labels.append((i, 1, toxic))
    rows += [(1000, None, 0.0), (1001, "", 0.0), (1002, "123 ...", 0.0), (None, "the scummy", 0.0)]
    labels += [(5000, 1, 1), (None, 1, 1), (7, 1, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score double")
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    scored = {r.doc_id: r for r in tx.score(docs, tx.train(docs, table)).collect()}
    assert len(scored) == len(rows)
    held = [i for i in range(600) if zlib.crc32(str(i).encode()) % 4 == 2]
    wrong = sum(scored[i].predicted != (i % 3 == 0) for i in held)
    assert wrong <= len(held) // 50
    assert scored[None].predicted == 1 and scored[1000].score == scored[1001].score == scored[1002].score < 0.3
    flipped = table.withColumn("toxic", tx.F.when(tx.fold() == 2, 1 - tx.F.col("toxic")).otherwise(tx.F.col("toxic")))
    again = {r.doc_id: r.score for r in tx.score(docs, tx.train(docs, flipped)).collect()}
    assert again == {i: r.score for i, r in scored.items()}
    assert tx.train(docs, table.where("toxic = 0")) is None
    assert tx.score(docs.limit(0), None).count() == 0


def test_every_counted_sequence_is_kept(spark, monkeypatch):
    monkeypatch.setattr(tx, "PART_ROWS", 10_000, raising=False)
    rng = np.random.default_rng(4)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyz"))
    texts = [" ".join("".join(rng.choice(letters, 7)) for _ in range(60)) for _ in range(400)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(400)], "doc_id long, toxic int")
    model = tx.train(docs, labels)
    counted = [t for i, t in enumerate(texts) if zlib.crc32(str(i).encode()) % 4 not in (tx.HELD_OUT, tx.FIT_FOLD)]
    grams = np.array(sorted({int.from_bytes(g, "big") for t in counted for g in grams_of(t)}), np.uint64)
    assert len(grams) > 40_000
    assert not np.isnan(model.look_up(grams, False)).any()
    assert not np.isnan(model.look_up(grams >> np.uint64(8), True)).any()
    absent = grams + (np.uint64(1) << np.uint64(50))
    assert np.isnan(model.look_up(absent, False)).all()
