import hashlib
import random
from collections import defaultdict

import pytest
import public_tokenizers
import sentencepiece
import tokenizers

from sitescout.llm import alignment
from sitescout.llm.common import table

PATHS = [public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
ODD = [None, "", " ", "   ", "a", "a  b ", "\n", " \n  x\r\n\t y z", "▁a", "x ▁", "<|endoftext|> <s> <0x41>", "\x00a\x1cb \x85",
       "don't we'll  I'M", "日本語 テキスト 12 345", "🙂🙂 👩‍👩‍👧", "é é ﬁ", "a" * 3000, "to be or not to be, to be"]
SCHEMA = "doc_id long, text string"


@pytest.fixture(scope="module")
def sides():
    a = tokenizers.Tokenizer.from_file(PATHS[0])
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=PATHS[1])


def by_definition(rows, sides):
    """Whole texts by the libraries, links from sets of byte positions, counts from sets of rows."""
    a_side, b_side = sides
    decode = alignment.byte_symbols()
    made, holders = [], defaultdict(set)
    for number, (doc_id, text) in enumerate(rows):
        a = a_side.encode(" " + text, add_special_tokens=False).ids if text else []
        b = b_side.encode(text) if text else []
        a_bytes = [bytes(decode[c] for c in a_side.id_to_token(i)) for i in a]
        b_bytes = [bytes([int(p[3:5], 16)]) if b_side.is_byte(i) else p.replace("▁", " ").encode()
                   for i in b for p in [b_side.id_to_piece(i)]]
        raw = (" " + (text or "")).encode()
        if not text or b"".join(a_bytes) != raw or b"".join(b_bytes) != raw:
            made.append((doc_id, [], [], []))
            continue
        owner = [[n for n, t in enumerate(ts) for _ in t] for ts in (a_bytes, b_bytes)]
        met = sorted(set(zip(*owner)))
        links = [(a[i], b[j]) for i, j in met]
        for pair in links:
            holders[pair].add(number)
        groups, last = [], 0
        for end in range(1, len(raw) + 1):
            if end == len(raw) or all(o[end] != o[end - 1] for o in owner):
                groups.append([sorted(set(o[last:end])) for o in owner])
                last = end
        made.append((doc_id, links, (a, b), groups))
    highest = defaultdict(int)
    for (x, _), held in holders.items():
        highest[x] = max(highest[x], len(held))
    for doc_id, links, ids, groups in made:
        if not links:
            yield doc_id, 0, 0, 0, 0, 0, 0, ""
            continue
        counts = [len(holders[p]) for p in links]
        listing = ";".join("|".join(",".join(str(i[n]) for n in g) for i, g in zip(ids, group)) for group in groups)
        best = sum(c == highest[p[0]] for p, c in zip(links, counts))
        yield (doc_id, len(ids[0]), len(ids[1]), len(groups), len(links), best, sum(counts), hashlib.sha256(listing.encode()).hexdigest())


def odd_texts(n):
    rng = random.Random(5)
    letters = ["a", "b", "the", " ", "  ", "\n", "\t", "é", "日", "🙂", "'s", "12", ".", ",", " ", " ", "ing", "X", "<s>", "\x1f", "▁"]
    weights = [6] * 5 + [2] * 15 + [0.1]
    return ["".join(rng.choices(letters, weights, k=rng.randint(1, 60))) for _ in range(n)]


def ordered(rows):
    return sorted(map(tuple, rows), key=repr)


@pytest.mark.parametrize("links, fan", [(1 << 21, 64), (300, 4)])
def test_equals_definition(spark, sides, monkeypatch, links, fan):
    rows = [(i if i != 3 else None, t) for i, t in enumerate(ODD + odd_texts(150) + ODD[-2:])] + [(10**18, "to be"), (10**18, "to be")]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    monkeypatch.setattr(alignment, "FAN", fan)
    monkeypatch.setattr(alignment, "BLOCK_LINKS", links)
    assert ordered(alignment.align(docs, *PATHS).collect()) == ordered(by_definition(rows, sides))


def test_given_documents(spark, sides):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert ordered(alignment.align(docs, *PATHS).collect()) == ordered(by_definition(rows, sides))


def test_empty_table_and_other_columns(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert alignment.align(docs, *PATHS).collect() == []
    clashing = spark.createDataFrame([(1, "to be", "x", 5, "y")], SCHEMA + ", block string, run int, n_a string")
    assert alignment.align(clashing, *PATHS).columns == [f.split()[0] for f in alignment.RESULT.split(", ")]
    assert alignment.align(clashing, *PATHS).first().n_a == 2


def test_memo_is_bounded(monkeypatch, sides):
    texts = odd_texts(300)
    whole = alignment.Aligner(*PATHS).block(texts)
    monkeypatch.setattr(alignment, "MEMO_CHUNKS", 50)
    small = alignment.Aligner(*PATHS)
    assert [d for i in range(0, 300, 20) for d in small.block(texts[i : i + 20])["digests"]] == whole["digests"]
    assert all("".join(alignment.CHUNK.findall(" " + t)) == " " + t for t in texts)


def test_runs_survive_packing_and_merging():
    import numpy as np

    rng = np.random.default_rng(1)
    runs = []
    for n in (0, 1, 50, 500):
        keys = np.unique(rng.integers(0, 400, n))
        runs.append((keys, rng.integers(1, 1 << 40, len(keys))))
    back = [alignment.unpack_head(alignment.pack_head(*r)) for r in runs]
    assert all((k == k2).all() and (c == c2).all() for (k, c), (k2, c2) in zip(runs, back))
    want = defaultdict(int)
    for keys, counts in runs:
        for k, c in zip(keys.tolist(), counts.tolist()):
            want[k] += c
    keys, sums = alignment.merge_runs(runs)
    assert dict(zip(keys.tolist(), sums.tolist())) == want and (np.diff(keys) > 0).all()
    flags = alignment.with_best(keys, sums, 10) & 1
    for a in np.unique(keys // 10):
        here = keys // 10 == a
        assert (flags[here] == (sums[here] == sums[here].max())).all()
