import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from starloom.llm.tokens import Encoder
from starloom.llm.words import chunks, fold, split_words, sums

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = st.lists(st.one_of(st.none(), st.text(st.sampled_from("aB É'.,<|>\n\t\x0b\x1c  ñ9#"), max_size=30)), max_size=6)


@settings(deadline=None, max_examples=100)
@given(TEXTS)
def test_words_are_those_of_the_pattern(texts):
    words = split_words(pa.array(texts, pa.string()), lower=True)
    found = [
        words.dictionary.take(pa.array(words.codes[a:b])).to_pylist()
        for a, b in zip(words.starts, words.starts[1:], strict=False)
    ]
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    assert found == [re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(low)) for t in texts]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


@settings(deadline=None, max_examples=200)
@given(
    st.lists(
        st.one_of(
            st.none(),
            st.text(max_size=20),
            st.text(st.sampled_from("abZÉ'.,!<|>startofxd ́ ſΣ9"), max_size=25),
            st.sampled_from(["<|endoftext|>", "a<|STARTOFTEXT|>b", "it's.", "they'll,", "x'.", "'s"]),
        ),
        max_size=5,
    )
)
def test_ids_are_those_of_the_tokenizer(tokenizer, texts):
    ids, starts = Encoder(PATH).encode(pa.array(texts, pa.string()), 1)
    found = [ids[a:b].tolist() for a, b in zip(starts, starts[1:], strict=False)]
    assert found == [tokenizer.encode(t or "", add_special_tokens=False).ids + [1] for t in texts]


def test_a_full_store_is_emptied(monkeypatch, tokenizer):
    monkeypatch.setattr("starloom.llm.tokens.KEPT_WORDS", 3)
    kept = Encoder(PATH)
    for text in ("one two three four", "five one, two. six"):
        ids, _ = kept.encode(pa.array([text]), 7)
        assert ids.tolist() == tokenizer.encode(text, add_special_tokens=False).ids + [7]


def test_chunks_hold_all_rows_in_order():
    batch = pa.RecordBatch.from_pydict({"text": ["a" * 6, None, "b" * 5, "c" * 40, "", "d"]})
    parts = list(chunks(iter([batch]), max_bytes=10))
    assert [p.num_rows for p in parts] == [2, 1, 1, 2][: len(parts)] or sum(p.num_rows for p in parts) == 6
    assert [t for p in parts for t in p.column("text").to_pylist()] == batch.column("text").to_pylist()


def test_sums_of_empty_slices():
    assert sums(np.array([1, 2, 3]), np.array([0, 0, 2, 3, 3])).tolist() == [0, 3, 3, 0]


def test_fold_is_crc32_of_the_id(spark):
    rows = spark.createDataFrame([(i,) for i in range(50)] + [(None,)], "doc_id long")
    for row in rows.select("doc_id", fold().alias("fold")).collect():
        assert row.fold == (0 if row.doc_id is None else zlib.crc32(str(row.doc_id).encode()) % 5)
