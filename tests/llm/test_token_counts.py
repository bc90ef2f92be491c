import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from sitescout.llm import token_counts as tc

PATH = public_tokenizers.path("byte_bpe_50k.json")
CASES = [
    "", " ", "a", "Hello world", "it's we'll I'd've they're", "a  b\n\n c\t\td ", "<|endoftext|>", "x<|endoftext|>y <|endoftext|>",
    "naïve ÉÀ ßtra ciónñ 漢字かな 🙂👩‍👩‍👧   x", "12345 1,000.00 ½ ²", "\x00\x1c\x1d\x1e\x1f\x85 \x0b\x0c", "a" * 5000,
    "ab" * 3000, " " * 1000 + "x", "!!!???...", "<|endoftext", "é" * 700,
]


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    return lambda text: len(tokenizer.encode(text, add_special_tokens=False).ids)


def test_agrees_with_the_library(library):
    count = tc.counter(PATH)
    rng = random.Random(1)
    alphabet = "aeiou tns'lrdé ñß\n\t  .,!0123456789 漢🙂\x1c ʼ"
    random_texts = ["".join(rng.choices(alphabet, k=rng.randrange(1, 80))) for _ in range(3000)]
    for text in CASES + random_texts:
        assert count(text) == library(text), repr(text)


def test_query_columns(spark, library):
    texts = [*CASES, None, None]
    docs = spark.createDataFrame([(i, t, 7) for i, t in enumerate(texts)], "doc_id long, text string, n_tokens int")
    rows = tc.count_tokens(docs, PATH).collect()
    assert len(rows) == len(texts)
    for r in rows:
        text = texts[r.doc_id] or ""
        assert (r.n_bytes, r.n_tokens) == (len(text.encode()), library(text))
        assert r.over_limit == (r.n_tokens > 512)
    assert tc.count_tokens(docs.limit(0), PATH).count() == 0
