import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from postweave.llm.bpe import VOCABULARY, PairIndexEncoder, encode

tokenizers = pytest.importorskip("tokenizers")
ENCODER = PairIndexEncoder(VOCABULARY, keep=50)


@pytest.fixture(scope="module")
def reference():
    t = tokenizers.Tokenizer.from_file(VOCABULARY.replace(".tiktoken", ".json"))
    t.encode_special_tokens = True
    return lambda texts: [x.ids for x in t.encode_batch(texts, add_special_tokens=False)]


def test_like_the_tokenizer(reference):
    texts = ["", " ", "\n\n  x", "aaaaaaa", "а" * 999, "<|endoftext|>", "I'll we've", "Укладка плитки, Нови Сад 123", "😀​é", "x" * 5000]
    assert ENCODER.encode_batch(texts) == reference(texts)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"]), max_size=30), max_size=5))
def test_any_text(reference, texts):
    assert ENCODER.encode_batch(texts) == reference(texts)


def test_rows(spark):
    df = spark.createDataFrame([(1, "a b", "clash"), (2, None, ""), (3, "", ""), (1, "a b", "clash")], "ids int, text string, k string")
    got = sorted((r[0], list(r[1])) for r in encode(df.withColumnRenamed("ids", "doc"), "doc", "text").collect())
    assert got == [(1, ENCODER.encode_batch(["a b"])[0])] * 2 + [(2, []), (3, [])]
    assert encode(df.limit(0), "k", "text").count() == 0
