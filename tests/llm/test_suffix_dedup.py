import random

import numpy as np
import pytest

from sitescout.llm import suffix_dedup as sd


def brute(texts):
    """(n_bytes, n_removed, n_spans, kept) of each text, by a table of all strings of 200 bytes."""
    data = [(t or "").encode() for t in texts]
    seen = {}
    for d in data:
        for i in range(len(d) - 199):
            seen[d[i : i + 200]] = seen.get(d[i : i + 200], 0) + 1
    out = []
    for d in data:
        gone = np.zeros(len(d) + 1, bool)
        for i in range(len(d) - 199):
            if seen[d[i : i + 200]] > 1:
                gone[i : i + 200] = True
        kept = bytes(b for b, g in zip(d, gone) if not g)
        spans = int((gone[:-1] & ~np.r_[False, gone[:-2]]).sum()) if len(d) else 0
        out.append((len(d), int(gone.sum()), spans, kept))
    return out


def make_texts():
    rng = random.Random(4)

    def prose(n):
        return "".join(rng.choices("abcdé ñ\n", k=n))

    passages = [prose(n) for n in (150, 210, 400, 900)]
    texts = [None, "", "short", "x" * 199, "y" * 200, "y" * 201, "ab" * 700, "z" * 3000, prose(199)]
    for _ in range(60):
        parts = [prose(rng.randrange(5, 400))]
        for _ in range(rng.randrange(3)):
            parts += [rng.choice(passages)[rng.randrange(3) :], prose(rng.randrange(1, 300))]
        texts.append("".join(parts))
    texts += [texts[20], texts[20], texts[30], texts[30][:-1], "q" + texts[31], texts[33] + texts[34]]
    twice = prose(260)
    return [*texts, twice + prose(5) + twice, passages[3][100:350]]


@pytest.mark.parametrize("per_slice", [20_000, 3])
def test_agrees_with_brute_force(spark, monkeypatch, per_slice):
    monkeypatch.setattr(sd, "SEGMENTS_PER_SLICE", per_slice)
    texts = make_texts()
    docs = spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)], "doc_id long, text string, n_bytes int")
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in sd.remove_repeats(docs).collect()}
    assert got == dict(enumerate(brute(texts)))


def test_repeated_rows_null_ids_and_no_rows(spark):
    long = "".join(random.Random(1).choices("abcdefgh ", k=500))
    rows = [(1, long), (1, long), (None, "u" + long[:300]), (None, None), (2, "tiny")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id or -1, r.n_bytes, r.n_removed) for r in sd.remove_repeats(docs).collect())
    assert got == [(-1, 0, 0), (-1, 301, 300), (1, 500, 500), (1, 500, 500), (2, 4, 0)]
    assert sd.remove_repeats(docs.limit(0)).count() == 0


def test_long_texts_are_cut_without_loss(monkeypatch):
    text = bytes(random.Random(2).choices(range(97, 123), k=9000))
    whole = sd.find_anchors([text])
    monkeypatch.setattr(sd, "CHUNK_BYTES", 1000)
    cut = sd.find_anchors([text])

    def owners(found):
        return {p: (h, place) for _, h, place, a, b in zip(*(x.tolist() for x in found)) for p in range(a, b + 1)}

    assert owners(whole) == owners(cut)
    assert len(owners(whole)) == 9000 - 199


def test_merging_finds_equal_windows():
    rng = random.Random(3)
    base = bytes(rng.choices(b"abc", k=270))
    segments = [base, base[:-5] + b"xxxxx", b"y" + base[1:], base[:100] + b"-" + base[101:]]
    got = sd.repeated_windows(np.zeros(4, int), np.full(4, 50), np.full(4, 71), segments).reshape(4, 71)
    for i, s in enumerate(segments):
        for p in range(71):
            assert got[i, p] == any(s[p : p + 200] == o[p : p + 200] for j, o in enumerate(segments) if i != j)
