import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from sitescout.llm import fingerprints
from sitescout.llm.common import table

SCHEMA = "doc_id long, text string"


def edits_by_definition(rows):
    """{(id, text): (n_chars, digest of the edited text)} of rows with different (id, text)."""
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    out = {}
    for (doc_id, text), (_, following) in zip(ordered, ordered[1:] + ordered[:1]):
        text, following = text or "", following or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        out[doc_id] = (len(text), hashlib.sha256(edited.encode()).hexdigest(), edited)
    return out


def some_text(rng):
    return " ".join(rng.choices(["to", "be", "or", "não", "🙂", "question"], k=rng.randint(0, 40)))


def id_sets():
    rng = random.Random(7)
    return {
        "dense": list(range(300)),
        "sparse": [1, 10**18],
        "full range": [-(2**63), -1, 0, 2**63 - 1] + [rng.randint(-(2**63), 2**63 - 1) for _ in range(200)],
        "clusters between outliers": [*range(200), *range(10**15, 10**15 + 200), 10**18, 2 * 10**18],
        "a null": [None, *range(50)],
        "one": [5],
    }


@pytest.mark.parametrize("name", id_sets())
def test_edits_equal_definition(spark, monkeypatch, name):
    monkeypatch.setattr(fingerprints, "DOCS_PER_RANGE", 10)
    monkeypatch.setattr(fingerprints.with_next, "__defaults__", (10,))
    rng = random.Random(1)
    rows = [(i, some_text(rng)) for i in id_sets()[name]]
    rows[0] = (rows[0][0], None)
    got = {r.doc_id: r for r in fingerprints.fingerprint_edits(spark.createDataFrame(rows, SCHEMA)).collect()}
    want = edits_by_definition(rows)
    assert {i: (r.n_chars, r.edited_sha256) for i, r in got.items()} == {i: w[:2] for i, w in want.items()}
    # the edited text's fingerprint is that of a document with this text
    edited = spark.createDataFrame([(i, w[2]) for i, w in want.items()], SCHEMA)
    again = edited.select("doc_id", fingerprints.as_text(fingerprints.signature(F.col("text"))).alias("f")).collect()
    assert {r.doc_id: r.f for r in again} == {i: r.edited_fingerprint for i, r in got.items()}


def test_ranges_stay_small_where_ids_lie_unevenly(spark):
    ids = [*range(3000), *range(10**15, 10**15 + 3000), -(2**63), 2**63 - 1, *[7] * 500, *[None] * 500]
    rows = [(i, n) for n, i in enumerate(ids)]
    docs = spark.createDataFrame(rows, "doc_id long, n long").withColumn("_text_hash", F.xxhash64("n"))
    got = fingerprints.with_next(docs, ["n"], 20)
    plan = got.groupBy("n").count()
    assert got.count() == len(ids) and plan.count() == len(ids)
    ordered = sorted(docs.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, r["_text_hash"]))
    want = {a.n: b.n for a, b in zip(ordered, ordered[1:] + ordered[:1])}
    assert {r.n: r.next_n for r in got.collect()} == want


def kmers_by_definition(text):
    """Three pieces in a row each; a shorter text is one."""
    pieces = re.findall(r"\S{1,12}\s*|\s+", text)
    return [tuple(pieces[i : i + 3]) for i in range(max(len(pieces) - 2, min(len(pieces), 1)))]


@pytest.mark.parametrize("text, n", [("", 0), ("a", 1), ("a b c", 1), ("a b c d", 2), ("x" * 30, 1), ("a b c a b c a b c", 7)])
def test_every_kmer_counts_once(spark, text, n):
    """With a slot wide enough for all k-mers, repeats included, the numbered k-mers are as many as k-mers."""
    assert len(kmers_by_definition(text)) == n
    pieces = F.regexp_extract_all(F.lit(text), F.lit(fingerprints.PIECE), 0)
    numbered = fingerprints._let(fingerprints._let(pieces, lambda a: fingerprints._kmers(a, 3)), fingerprints._numbered)
    hashes = spark.range(1).select(numbered.alias("h")).first().h
    assert len(hashes) == n and len({h >> fingerprints.PLACE_BITS for h in hashes}) == n


def test_likeness_follows_edits_and_order(spark):
    rng = random.Random(3)
    words = [f"w{rng.randint(0, 900)}" for _ in range(600)]
    variants = {0: words, 1: words[:595] + ["x"] * 5, 2: words[:300] + ["y"] * 300, 3: words[300:] + words[:300], 4: words[::-1], 5: words}
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in variants.items()], SCHEMA)
    slots = df.select("doc_id", fingerprints.signature(F.col("text")).alias("s"))
    one = slots.where("doc_id = 0").select(F.col("s").alias("s0"))
    near = {r.doc_id: r.l for r in slots.crossJoin(one).select("doc_id", fingerprints.likeness(F.col("s"), F.col("s0")).alias("l")).collect()}
    assert near[0] == near[5] == 1.0
    assert near[1] > 0.85 > near[2] > near[4] and near[3] > near[4]


def test_odd_tables(spark):
    assert fingerprints.fingerprint_edits(spark.createDataFrame([], SCHEMA)).collect() == []
    rows = [(1, "a b"), (1, "a b"), (1, "c d"), (None, None), (None, "x"), (2, ""), (3, "long " * 200_000)]
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], SCHEMA + ", slots int, fingerprint int")
    got = fingerprints.fingerprint_edits(docs).collect()
    assert sorted(r.n_chars for r in got) == sorted(len(t or "") for _, t in rows)
    assert len({r.fingerprint for r in got if r.n_chars == 3 and r.near_next == 1.0}) <= 1


def test_given_documents(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    want = edits_by_definition([(r.doc_id, r.text) for r in docs.collect()])
    got = fingerprints.fingerprint_edits(docs).collect()
    assert {r.doc_id: (r.n_chars, r.edited_sha256) for r in got} == {i: w[:2] for i, w in want.items()}
