import random
import string

import pytest
from pyspark.sql import functions as F

from sitescout.functions.text import ENGLISH_STOP_WORDS, title, words
from sitescout.operators import sentiment
from sitescout.settings import SETTINGS

TEXTS = [
    "It's GREAT, great coffee; not bad!",
    "",
    "   ",
    "the and of",
    "a b\tc\x1cd e　f\x85g",
    "¿Qué? — naïve «quotes» ﬁne",
    "x" * 50 + " " + "-" * 10,
    "\nleading and trailing\n",
]


def python_words(text, stop_words):
    bare = "".join(c for c in text if c not in string.punctuation)
    return [w for w in bare.split() if w.lower() not in stop_words]


def test_words_are_split_like_python(spark):
    rng = random.Random(3)
    alphabet = string.punctuation + " \t\n\r\x0b\x0c\x1c\x1f\x85    " + "abÀéß漢"
    texts = TEXTS + ["".join(rng.choice(alphabet) for _ in range(60)) for _ in range(200)]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    split = df.select("id", F.filter(words(F.col("text")), lambda w: w != "").alias("w")).collect()
    for row in split:
        assert row.w == python_words(texts[row.id], ()), repr(texts[row.id])


def test_tip_tokens_keep_case_and_repeats(spark):
    tips = spark.createDataFrame([("b1", "u1", t) for t in TEXTS], "business_id string, user_id string, text string")
    got = sorted(r.word for r in sentiment.tip_tokens(tips).collect())
    assert got == sorted(w for t in TEXTS for w in python_words(t, ENGLISH_STOP_WORDS))
    assert {"GREAT", "great"} <= set(got)
    folded = [r.word for r in sentiment.tip_tokens(tips, lowercase=True).collect()]
    assert folded.count("great") == 2
    every = [r.word for r in sentiment.tip_tokens(tips, stop_words=()).collect()]
    assert "the" in every and "" not in every


def test_a_very_long_text_is_read_to_its_end(spark):
    text = "word " * 300_000 + "last"
    tips = spark.createDataFrame([("b", text)], "business_id string, text string")
    tokens = sentiment.tip_tokens(tips)
    assert tokens.count() == 300_001 and tokens.where("word = 'last'").count() == 1


def test_title_is_pythons(spark):
    names = ["new-york", "o'neil", "3rd STREET", "TORONTO", "saint  jérôme", "", "a1b2", "_x_"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    assert [r.t for r in df.select(title(F.col("n")).alias("t")).collect()] == [n.title() for n in names]


LEXICON = [("great", 1), ("Great", 1), ("good", 1), ("mixed", 1), ("bad", -1), ("mixed", -1), ("odd", 0), ("none", None)]
BAGS = {
    "b1": ["great", "great", "Great", "bad", "coffee"],
    "b2": ["bad", "mixed"],
    "b3": ["coffee", "odd", "none"],
    "b4": [],
    "unknown": ["great"],
}
EXPECTED = {
    # n_tokens, average, predicted, positive, negative
    "b1": (5, 2 / 4, 1.0, {"great": 2, "Great": 1}, {"bad": 1}),
    "b2": (2, -1 / 3, 0.0, {"mixed": 1}, {"bad": 1, "mixed": 1}),
    "b3": (3, None, None, None, None),
    "b4": (0, None, None, None, None),
}


@pytest.fixture(scope="module")
def reviews(spark):
    business = spark.createDataFrame([(b,) for b in ("b1", "b2", "b3", "b4", "b1")], "business_id string")
    tokens = spark.createDataFrame([(b, w) for b, ws in BAGS.items() for w in ws], "business_id string, word string")
    lexicon = spark.createDataFrame(LEXICON, "word string, sentiment int")
    return business, tokens, lexicon


def as_counts(words):
    return None if words is None else {w.word: w.n for w in words}


@pytest.mark.parametrize("limits", [{}, {"max_lexicon_bytes": 0, "per_slice": 1}, {"max_lexicon_bytes": 0}])
def test_business_sentiment(reviews, limits):
    rows = sentiment.business_sentiment(*reviews, **limits).collect()
    got = {
        r.business_id: (r.n_tokens, r.avg_sentiments, r.predicted, as_counts(r.pos_words), as_counts(r.neg_words))
        for r in rows
    }
    assert len(rows) == 4 and got == EXPECTED


def test_lexicon_join_matches_twice_and_by_exact_case(reviews):
    _, tokens, lexicon = reviews
    got = [(r.word, r.sentiment) for r in sentiment.lexicon_join(tokens.where("business_id = 'b2'"), lexicon).collect()]
    assert sorted(got) == [("bad", -1), ("mixed", -1), ("mixed", 1)]
    assert sentiment.lexicon_join(tokens, lexicon).where("word = 'GREAT'").count() == 0


def test_lexicon_split_and_union(reviews):
    positive, negative = sentiment.split_lexicon(reviews[2])
    assert positive.count() == 4 and negative.count() == 2
    assert sentiment.union_lexicon(positive, negative).where("word = 'mixed'").count() == 2


def test_tip_bag(reviews):
    business, tokens, _ = reviews
    got = {(r.business_id, r.word, r.n) for r in sentiment.tip_bag(business, tokens).collect()}
    assert ("b4", None, 0) in got and ("b1", "great", 2) in got
    assert not any(b == "unknown" for b, _, _ in got)


def test_word_counts(spark, reviews):
    scored = sentiment.business_sentiment(*reviews)
    ids = spark.createDataFrame([("b1",), ("b2",), ("b2",), ("b3",)], "business_id string")
    positive = {r.text: r.size for r in sentiment.word_counts(scored, ids, sentiment.POSITIVE).collect()}
    negative = {r.text: r.size for r in sentiment.word_counts(scored, ids, sentiment.NEGATIVE).collect()}
    assert positive == {"great": 2, "Great": 1, "mixed": 1} and negative == {"bad": 2, "mixed": 1}


def test_lexicon_size_is_checked_before_broadcast(reviews):
    plans = [
        sentiment.business_sentiment(*reviews, max_lexicon_bytes=n)._jdf.queryExecution().analyzed().toString()
        for n in (SETTINGS.broadcast_bytes, 0)
    ]
    assert ["_slice" in plan for plan in plans] == [False, True]


def test_lexicon_join_keeps_words_without_a_sentiment(reviews):
    _, tokens, lexicon = reviews
    assert [r.sentiment for r in sentiment.lexicon_join(tokens, lexicon).where("word = 'none'").collect()] == [None]


def test_equal_tokens_of_a_large_lexicon_are_all_kept(spark):
    tokens = spark.range(1000).select(F.lit("b1").alias("business_id"), F.lit("great").alias("word"))
    lexicon = spark.createDataFrame([("great", 1), ("bad", -1)], "word string, sentiment int")
    assert sentiment.lexicon_join(tokens, lexicon, max_lexicon_bytes=0).count() == 1000
