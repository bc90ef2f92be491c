import hashlib
import random
import zlib
from collections import defaultdict
from itertools import combinations_with_replacement

import numpy as np
import pytest

from sitescout.llm import sharding
from sitescout.llm.common import table

SCHEMA = "doc_id long, text string"


def best_by_definition(sizes, shards):
    """The least maximum over all ways to cut a row of sizes into contiguous shards."""
    n = len(sizes)
    return min(
        max(sum(sizes[i:j]) for i, j in zip((0, *cuts), (*cuts, n)))
        for cuts in combinations_with_replacement(range(n + 1), shards - 1)
    )


def key_of(text):
    return 0 if text is None else int(hashlib.sha256(text.encode()).hexdigest()[:15], 16)


def size_of(text):
    return len((text or "").encode()) + 1


def rows_by_definition(rows, shards):
    """Groups in order of hash; large ones apart; the least capacity by trying one after another."""
    group = defaultdict(int)
    for _, text in rows:
        group[key_of(text)] += size_of(text)
    rest, left, alone = sum(group.values()), shards, []
    for key, size in sorted(group.items(), key=lambda g: (-g[1], g[0]))[: shards - 1]:
        if size * left < rest:
            break
        alone.append(key)
        rest, left = rest - size, left - 1
    order = sorted(k for k in group if k not in alone)

    def fill(capacity):
        made, held = [[]], 0
        for k in order:
            if held + group[k] > capacity:
                made.append([])
                held = 0
            made[-1].append(k)
            held += group[k]
        return made

    capacity = max([-(-rest // left), *[group[k] for k in order]])
    while len(fill(capacity)) > left:
        capacity += 1
    shard = {k: i for i, k in enumerate(alone)}
    shard |= {k: len(alone) + i for i, keys in enumerate(fill(capacity)) for k in keys}
    slots = defaultdict(int)
    for doc_id, text in sorted(rows, key=lambda r: (key_of(r[1]), r[0] is not None, r[0] or 0)):
        s = shard[key_of(text)]
        yield doc_id, size_of(text), zlib.crc32((text or "").encode()), "bytes", s, slots[s], None
        slots[s] += 1


def ordered(rows):
    return sorted(map(tuple, rows), key=repr)


def test_smallest_capacity_is_least():
    rng = random.Random(2)
    for _ in range(300):
        sizes = [rng.choice([1, 2, 3, 9, 40]) for _ in range(rng.randint(1, 9))]
        shards = rng.randint(1, 4)
        want = best_by_definition(sizes, shards)
        assert sharding.smallest_capacity(np.array(sizes), shards) == want
        assert sharding.greedy_cuts(np.cumsum(sizes), want, shards)[-1] == sum(sizes)


@pytest.mark.parametrize("first, following", [(2, 1), (3, 2), (12, 8)])
def test_ranges_give_the_cuts_of_groups(monkeypatch, first, following):
    """Bounds on where a cut can lie never leave out the true one, however coarse the ranges are."""
    monkeypatch.setattr(sharding, "FIRST_BITS", first)
    monkeypatch.setattr(sharding, "NEXT_BITS", following)
    rng = np.random.default_rng(6)
    for _ in range(60):
        n, shards = int(rng.integers(1, 200)), int(rng.integers(1, 9))
        keys = np.unique(rng.integers(0, 1 << 60, n))
        sizes = rng.choice([1, 2, 50, 400], len(keys), p=[0.4, 0.3, 0.2, 0.1])

        def summed(bits, intervals):
            inside = np.any([(keys >= a) & (keys < b) for a, b in intervals], axis=0)
            part = keys[inside] >> (60 - bits)
            names, at = np.unique(part, return_inverse=True)
            total, largest = np.zeros(len(names), np.int64), np.zeros(len(names), np.int64)
            np.add.at(total, at, sizes[inside])
            np.maximum.at(largest, at, sizes[inside])
            return sharding.Ranges(names << (60 - bits), np.full(len(names), bits), total, largest, np.bincount(at))

        ends = np.cumsum(sizes)
        capacity = sharding.smallest_capacity(sizes, shards)
        held = np.searchsorted(sharding.greedy_cuts(ends, capacity, shards), ends)
        cuts = sharding.cut_hashes(summed, shards)
        assert (np.searchsorted(cuts, keys, side="right") == held).all()


def some_rows():
    rng = random.Random(4)
    rows = [(None, None), (None, "x"), (1, None), (2, ""), (2, ""), (3, "é" * 50), (3, "é" * 50), (10**18, "a"), (-5, "long " * 900)]
    return rows + [(i, rng.choice(["hot", "hot", "warm " * 9, f"t{rng.randint(0, 400)} " * rng.randint(1, 30)])) for i in range(10, 900)]


@pytest.mark.parametrize("rows, shards", [(some_rows(), 8), (some_rows(), 1), (some_rows()[:9], 8), ([(1, "a")] * 3000 + [(2, "b")], 3)])
def test_rows_equal_definition(spark, rows, shards):
    docs = spark.createDataFrame(rows, SCHEMA)
    assert ordered(sharding.assign_shards(docs, shards).collect()) == ordered(rows_by_definition(rows, shards))


def test_given_documents(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert ordered(sharding.assign_shards(docs, 8).collect()) == ordered(rows_by_definition(rows, 8))


def test_empty_table_and_other_columns(spark):
    assert sharding.assign_shards(spark.createDataFrame([], SCHEMA), 8).collect() == []
    docs = spark.createDataFrame([("k", 5, "a", 1, 2), ("l", 6, "b", 1, 2)], "key string, doc_id long, text string, size int, file int")
    assert sorted(r.slot for r in sharding.assign_shards(docs, 1).collect()) == [0, 1]


def test_written_shards_hold_whole_rows(spark, tmp_path):
    docs = spark.createDataFrame(some_rows(), SCHEMA).selectExpr("*", "doc_id * 2 as key")
    sharding.write_shards(docs, f"{tmp_path}/out", 4)
    back = spark.read.parquet(f"{tmp_path}/out")
    assert ordered(back.select(docs.columns).collect()) == ordered(docs.collect())
    where = defaultdict(set)
    for r in back.collect():
        where[r.text].add(r.shard)
    assert all(len(s) == 1 for s in where.values()) and len({s for v in where.values() for s in v}) == 4
    with pytest.raises(ValueError):
        sharding.write_shards(docs.withColumnRenamed("key", "shard"), f"{tmp_path}/other", 4)
