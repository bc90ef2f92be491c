import hashlib
import random
import re

import pytest

from sitescout.llm import decontaminate as dc


def words(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def windows(items, size):
    found = {}
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - size + 1) if w else 0):
            found.setdefault(tuple(w[i : i + size]), set()).add("" if item is None else str(item))
    return found


def brute_proximity(docs, items, slack, size):
    """All matches, trying each window at each place of its rarest word, the first of equally rare ones."""
    count = {}
    for _, text in set(docs):
        for w in words(text):
            count[w] = count.get(w, 0) + 1
    found = set()
    for phrase, owners in windows(items, size).items():
        if any(w not in count for w in phrase):
            continue
        rarest = min(range(len(phrase)), key=lambda j: (count[phrase[j]], j))
        for doc, text in docs:
            own = words(text)
            for position in [i for i, w in enumerate(own) if w == phrase[rarest]]:
                start = position - rarest
                near = [own[max(0, start + j - slack) : max(0, start + j + slack + 1)] for j in range(len(phrase))]
                if all(w in n for w, n in zip(phrase, near)):
                    exact = start >= 0 and tuple(own[start : start + len(phrase)]) == phrase
                    found |= {(doc, item or None, start, len(phrase), exact) for item in owners}
    return found


def brute_contamination(docs, items, size):
    out = []
    for doc, text in docs:
        own, hit, names = words(text), set(), set()
        for phrase, owners in windows(items, size).items():
            for i in range(len(own) - len(phrase) + 1):
                if tuple(own[i : i + len(phrase)]) == phrase:
                    hit |= set(range(i, i + len(phrase)))
                    names |= owners
        listed = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
        out.append((doc, len(own), len(hit), len(names), listed, bool(hit) and 20 * len(hit) >= len(own)))
    return out


def tables():
    rng = random.Random(11)
    vocabulary = [f"w{i}" for i in range(40)] + ["Été", "x9", "the", "the", "the"]

    def text(n):
        return rng.choice([" ", ", ", "\n"]).join(rng.choices(vocabulary, k=n))

    items = [(i, text(rng.randrange(1, 12))) for i in range(30)]
    items += [(90, None), (91, ""), (92, "?!"), (93, "zebra unknown"), (None, "w1 w2 w3"), items[3], (94, items[3][1])]
    docs = [(i, text(rng.randrange(0, 60))) for i in range(60)]
    for k in range(40):
        own = words(items[k % 30][1])
        if k % 2 and len(own) > 2:  # moved a little apart
            at = rng.randrange(1, len(own))
            own = [*own[:at], *rng.choices(vocabulary, k=rng.randrange(1, 3)), *own[at:]]
        if k % 5 == 0 and len(own) > 3:
            own[0], own[1] = own[1], own[0]
        docs.append((100 + k, f"{text(rng.randrange(4))} {' '.join(own)} {text(rng.randrange(4))}"))
    docs += [(None, docs[70][1]), (None, None), (300, ""), (301, "..."), docs[71], (302, docs[71][1]), (303, text(4000)), (1 << 60, "w1 W2 w3")]
    return docs, items


def frames(spark, docs, items):
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")


@pytest.mark.parametrize("slack, size", [(0, 5), (1, 5), (3, 4)])
def test_proximity_equals_definition(spark, slack, size):
    docs, items = tables()
    docs = sorted(set(docs), key=repr)  # equally rare words are the same with and without repeated rows
    got = {tuple(r) for r in dc.proximity(*frames(spark, docs, items), slack, size).collect()}
    want = brute_proximity(docs, items, slack, size)
    assert got == want
    assert (slack == 0) == all(r[-1] for r in got)


def test_contamination_equals_definition(spark):
    docs, items = tables()
    rows = dc.contamination(*frames(spark, docs, items), size=5).drop("_text_hash").collect()
    assert sorted(map(tuple, rows), key=repr) == sorted(brute_contamination(docs, items, 5), key=repr)


def test_empty_tables_and_other_columns(spark):
    docs, items = frames(spark, [(1, "a b c")], [(1, "a b c")])
    assert dc.proximity(docs, items.limit(0), 2).count() == 0
    assert dc.proximity(docs.limit(0), items, 2).count() == 0
    assert [r.contaminated for r in dc.contamination(docs, items.limit(0)).collect()] == [False]
    assert dc.contamination(docs.limit(0), items).count() == 0
    wide = spark.createDataFrame([(1, "a b c", "u", 5), (2, "b", "v", 6)], "doc_id long, text string, position string, n int")
    assert [tuple(r) for r in dc.decontaminate(wide, items).collect()] == [(2, "b", "v", 6)]
    with pytest.raises(ValueError):
        dc.proximity(docs, items, -1)
