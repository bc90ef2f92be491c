import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from sitescout.llm import periodicity
from sitescout.llm.common import table
from sitescout.llm.periodicity import Extensions, find_runs


def runs_by_definition(words):
    """Every maximal stretch of each period, by comparing words one by one."""
    found = {}
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(6, 4 * q) and j > i:
                found.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def row_by_definition(doc_id, text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())
    n = len(words)
    h = None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if n and h is not None and h % 10 == 0:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = runs_by_definition(words)
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
    exact = (None,) * 4 if best is None else (*best, 1000 * best[1] // best[2])
    listed = "".join(f"{s},{length},{q}\n" for s, length, q in runs).encode()
    kept = b" ".join(w for i, w in enumerate(words) if i not in dropped)
    return (doc_id, len(runs), *exact, hashlib.sha256(listed).hexdigest(), hashlib.sha256(kept).hexdigest())


def planted(rng, n, letters):
    words = rng.integers(0, letters, n)
    for _ in range(int(rng.integers(0, 4))):
        if n > 10:
            a, p = int(rng.integers(0, n)), int(rng.integers(1, 40))
            for i in range(a + p, int(rng.integers(a, n + 1))):
                words[i] = words[i - p]
    return words


@pytest.mark.parametrize("places", [1 << 20, 37])
def test_runs_equal_definition(monkeypatch, places):
    monkeypatch.setattr(periodicity, "PLACES", places)
    rng = np.random.default_rng(3)
    for _ in range(400):
        words = planted(rng, int(rng.integers(0, 260)), int(rng.integers(1, 5)))
        assert list(map(tuple, find_runs(words).tolist())) == runs_by_definition(words.tolist())


def test_extensions_equal_direct_comparison():
    rng = np.random.default_rng(4)
    for _ in range(150):
        n = int(rng.integers(1, 500))
        words = np.resize(rng.integers(0, 2, int(rng.integers(1, 100))), n)
        words[rng.integers(0, n)] = 3
        i, j = rng.integers(0, n + 1, 40), rng.integers(0, n + 1, 40)
        i, j = i[i != j], j[i != j]
        for a, b, got in zip(i.tolist(), j.tolist(), Extensions(words)(i, j).tolist()):
            m = n - max(a, b)
            differ = np.flatnonzero(words[a : a + m] != words[b : b + m])
            assert got == (differ[0] if len(differ) else m)


def test_cover_reaches_every_difference():
    cover = periodicity.COVER
    assert {(a - b) % periodicity.MODULUS for a in cover for b in cover} == set(range(periodicity.MODULUS))


def test_two_runs_of_one_period_on_one_grid():
    """The second run's grid places hold the same word as the first's, but an odd word parts them."""
    unit = [1, 2, 3, 4, 5]
    words = np.array(unit * 5 + [1, 2, 9, 4, 5] + unit * 5)
    assert list(map(tuple, find_runs(words).tolist())) == runs_by_definition(words.tolist())
    assert len(find_runs(words)) == 2


def odd_rows():
    rng = random.Random(8)
    rows = [(None, "a " * 9), (None, None), (1, None), (2, ""), (3, " \t\n\x0b\x0c\r"), (4, "a a a a a a"), (4, "a a a a a a"),
            (5, "a a a a a"), (6, "x\x1cy x\x1cy x\x1cy x\x1cy x\x1cy x\x1cy"), (7, "é é é é é é é"), (-8, "a b " * 500 + "c"), (10**18, "a b a b a b a b a")]
    rows += [(i, " ".join(rng.choices(["a", "b", "c", "dd"], k=rng.randint(0, 70)))) for i in range(20, 400)]
    rows.append((500, " ".join(rng.choices("abcdefgh", k=3000)) + " u v w" * 4000 + " z" * 2000))
    return rows


def ordered(rows):
    return sorted(map(tuple, rows), key=repr)


def test_rows_equal_definition(spark):
    rows = odd_rows()
    assert any(r[0] is not None and zlib.crc32(str(r[0]).encode()) % 10 == 0 for r in rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert ordered(periodicity.periodic_runs(docs).collect()) == ordered(row_by_definition(*r) for r in rows)


def test_given_documents(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    want = [row_by_definition(r.doc_id, r.text) for r in docs.collect()]
    assert any(w[1] for w in want)
    assert ordered(periodicity.periodic_runs(docs).collect()) == ordered(want)


def test_empty_table_and_other_columns(spark):
    assert periodicity.periodic_runs(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    clashing = spark.createDataFrame([("x", 4, "a a a a a a", 7)], "start string, doc_id long, text string, n_runs int")
    assert periodicity.periodic_runs(clashing).first()["n_runs"] == 1
