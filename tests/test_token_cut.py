"""Cut texts against the tokenizer's own truncation."""

import json
import os
from random import Random

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as spark_entry
from starloom.operators import token_cut

public_tokenizers = pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")
FOLDER = "/root/testdata/sf0.001"


def own(path, text, max_length):
    """The tokenizer's own truncation of the whole text."""
    if text is None:
        return None
    tokenizer = tokenizers.Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    if len(tokenizer.encode(text, add_special_tokens=False).ids) <= max_length:
        return text
    tokenizer.enable_truncation(max_length)
    return text[: tokenizer.encode(text, add_special_tokens=False).offsets[-1][1]]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
@pytest.mark.parametrize("max_length", [7, 512])
def test_cut_is_the_tokenizers_own(spark, name, max_length):
    path = public_tokenizers.path(name)
    odd = [None, "", " ", "x" * 30_000, "a  b\n\n c " * 2000, "漢字" * 500, "é" * 900 + " <|endoftext|> end", "word " * 511 + "last", "word " * 512 + "more"]
    rows = [(i, t, "kept") for i, t in enumerate(odd)]
    df = spark.createDataFrame(rows, "n long, text string, place string")
    found = token_cut.truncate_by_tokenizer(df, path, "text", max_length).collect()
    assert {r.n: r.text for r in found} == {i: own(path, t, max_length) for i, t, _ in rows}
    assert all(r.place == "kept" for r in found)


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables not there")
def test_query_on_all_documents(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    texts = dict(spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect())
    rows = spark_entry.truncate_model_tokens(spark, FOLDER).collect()
    tokenizer = tokenizers.Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    whole = {i: len(tokenizer.encode(t, add_special_tokens=False).ids) for i, t in texts.items()}
    tokenizer.enable_truncation(512)
    ends = {i: tokenizer.encode(t, add_special_tokens=False).offsets[-1][1] for i, t in texts.items() if whole[i] > 512}
    assert len(rows) == len(texts) and ends
    assert {r.review_id: r.n for r in rows} == {i: ends.get(i, len(t)) for i, t in texts.items()}


def test_empty_table(spark):
    df = spark.createDataFrame([], "`reviews.text` string")
    found = token_cut.truncate_by_tokenizer(df, public_tokenizers.path("word_bpe_49k.json"))
    assert found.count() == 0 and found.columns == ["reviews.text"]
    one = spark.createDataFrame([("a b c",)], "`reviews.text` string")
    cut = token_cut.truncate_by_tokenizer(one, public_tokenizers.path("word_bpe_49k.json"), max_length=2)
    assert cut.select(F.col("`reviews.text`")).first()[0] == "a b"


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_words_are_encoded_once_and_cut_alike(name, monkeypatch):
    path = public_tokenizers.path(name)
    tokenizer = token_cut._tokenizer(path)
    monkeypatch.setattr(token_cut, "KEPT_WORDS", 50)
    words = token_cut.Words(tokenizer)
    assert words.fit(tokenizer.to_str())
    random = Random(5)
    parts = ["a", "é", "é", " ", "  ", "\n", " ", "　", "!", "'s", "7", "漢", "\x1c", "\x85", "İ", "Σ", "<|endoftext|>", "word", "​", "x" * 60]
    for _ in range(1500):
        text, most = "".join(random.choices(parts, k=random.randint(0, 25))), random.randint(0, 12)
        found = tokenizer.encode(text, add_special_tokens=False)
        whole = len(found.ids) <= most and most > 0
        assert words.cut(text, most) == (text if whole else text[: found.offsets[most - 1][1]] if most else "")
    seen, known = [], token_cut.Words(tokenizer)
    monkeypatch.setattr(known, "tokenizer", Spy(tokenizer, seen))
    assert known.cut("one two " * 5000, 20_000) == "one two " * 5000
    assert len(seen) <= 5


def test_tokenizers_that_mark_the_beginning_take_whole_texts():
    parts = json.loads(token_cut._tokenizer(public_tokenizers.path("byte_bpe_50k.json")).to_str())
    assert token_cut.Words.fit(json.dumps(parts))
    parts["pre_tokenizer"]["add_prefix_space"] = True
    assert not token_cut.Words.fit(json.dumps(parts))
    parts["pre_tokenizer"] = {"type": "Metaspace", "replacement": "_", "prepend_scheme": "first", "split": True}
    assert not token_cut.Words.fit(json.dumps(parts))


class Spy:
    """A tokenizer that keeps the words it is given."""

    def __init__(self, tokenizer, seen):
        self.tokenizer, self.seen = tokenizer, seen

    def encode_batch_fast(self, words, **more):
        self.seen += words
        return self.tokenizer.encode_batch_fast(words, **more)
