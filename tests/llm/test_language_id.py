import itertools
import zlib

import numpy as np

from sitescout.llm import language_id as li


def test_marginals_are_those_of_all_paths():
    rng = np.random.default_rng(1)
    scores, steps = rng.normal(size=(6, 3)), rng.normal(size=(3, 3))
    opens = np.array([True, False, False, False, True, False])
    found, expected = li.marginals(scores, steps, opens)
    total, by_word, by_step = 0.0, np.zeros((6, 3)), np.zeros((3, 3))
    for path in itertools.product(range(3), repeat=6):
        weight = np.exp(sum(scores[i, y] for i, y in enumerate(path)) + sum(steps[path[i - 1], path[i]] for i in range(6) if not opens[i]))
        total += weight
        for i, y in enumerate(path):
            by_word[i, y] += weight
            if not opens[i]:
                by_step[path[i - 1], y] += weight
    assert np.allclose(found, by_word / total)
    assert np.allclose(expected, by_step / total)


def test_blocks_do_not_change_the_result(monkeypatch):
    rng = np.random.default_rng(2)
    scores, steps = rng.normal(size=(777, 4)), rng.normal(size=(4, 4))
    opens = rng.random(777) < 0.02
    opens[0] = True
    results = []
    for block in (1, 7, 1000):
        monkeypatch.setattr(li, "BLOCK", block)
        results.append(li.marginals(scores, steps, opens))
    for found, expected in results[1:]:
        assert np.allclose(found, results[0][0]) and np.allclose(expected, results[0][1])


VOCABULARY = {
    "xx": "stone river house walks green older thing",
    "yy": "pierre rivière maison marche verte vieux chose",
    "zz": "fluß häuser läuft grünes altes steiniger dinge",
}


def make_rows(n):
    rng = np.random.default_rng(5)
    langs = sorted(VOCABULARY)
    return [(i, " ".join(rng.choice(VOCABULARY[langs[i % 3]].split(), 25)) + ".", langs[i % 3], "s") for i in range(n)]


def test_learns_languages_and_switches(spark):
    rows = make_rows(240)
    others = [(1000, None, "xx", "s"), (1001, "", None, "s"), (1002, "123 -- 4", "yy", "s"), (None, "rivière maison", None, "s")]
    docs = spark.createDataFrame(rows + others, "doc_id long, text string, lang string, score string")
    field = li.train(docs)
    got = {r.doc_id: r for r in li.identify(docs, field).collect()}
    assert len(got) == len(rows) + len(others)
    assert all(got[i].lang_pred == lang for i, _, lang, _ in rows)
    assert all(0 <= r.score <= 1 for r in got.values())
    assert all((got[i].lang_pred, got[i].score) == ("und", 0.0) for i in (1000, 1001, 1002))
    assert got[None].lang_pred == "yy"
    mixed = "stone river house walks green older maison marche verte vieux chose pierre"
    words = li.words_of_texts([mixed.encode()])
    opens = np.arange(12) == 0
    found, _ = li.marginals(li.emissions(words, field.weights), field.steps, opens)
    assert found.argmax(axis=1).tolist() == [0] * 6 + [1] * 6


def test_held_out_labels_are_not_read_and_empty_tables_pass(spark):
    docs = spark.createDataFrame(make_rows(120), "doc_id long, text string, lang string, source string")
    changed = docs.withColumn("lang", li.F.when(li.held_out(), "qq").otherwise(li.F.col("lang")))
    first, second = li.train(docs), li.train(changed)
    assert first.languages == second.languages and np.array_equal(first.weights, second.weights)
    assert li.train(docs.limit(0)) is None
    assert {r.lang_pred for r in li.identify(docs, None).collect()} == {"und"}


def test_rare_languages_and_those_of_long_texts_are_learned(spark):
    kept = [i for i in range(1000) if zlib.crc32(str(i).encode()) % 4 != 2]
    rows = [(i, f"word{chr(97 + i % 26)} other", f"l{k % 60:02}") for k, i in enumerate(kept[:120])]
    rows += [(kept[120], "... " * 30_000 + "un long texte " * 10_000, "long"), (kept[121], "no language", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    sample = li.fit_sample(docs)
    assert {r.lang for r in sample} == {f"l{k:02}" for k in range(60)} | {"long"}
    assert all(len(r.text.encode()) <= li.FIT_BYTES for r in sample)
    assert next(r.text for r in sample if r.lang == "long").startswith("un long texte")
