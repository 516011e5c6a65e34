from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer

from starloom.llm import separator_scan as scan
from starloom.llm.queries import op1_separator_scan, tokenizer
from starloom.llm.words import table


def plain(ids, separator):
    found, start = [], 0
    for i, token in enumerate(ids):
        if token == separator:
            found.append((start, i - start, True))
            start = i + 1
    if start < len(ids):
        found.append((start, len(ids) - start, False))
    return [(n, *row) for n, row in enumerate(found)]


@pytest.mark.parametrize("width", [2, 4])
@pytest.mark.parametrize("block", [4, 10, 1 << 20])
def test_documents_span_blocks(spark, tmp_path, monkeypatch, width, block):
    monkeypatch.setattr(scan, "STRETCH", 3)
    random = np.random.default_rng(5)
    files = {
        "a": random.choice([0, 1, 2, 9], 200),
        "b": np.array([9, 9, 9]),
        "c": np.array([1] * 60),
        "d": np.array([], int),
        "e": np.append(random.choice([3, 256, 9 << 8], 50), 9),  # bytes of the separator across two numbers
    }
    for name, ids in files.items():
        (tmp_path / name).write_bytes(ids.astype(f"<u{width}").tobytes())
    rows = scan.document_lengths(spark, str(tmp_path), 9, width=width, block_bytes=block).collect()
    for name, ids in files.items():
        mine = [(r.document, r.start, r.n_tokens, r.terminated) for r in rows if r.path.endswith(f"/{name}")]
        assert sorted(mine) == plain(ids.tolist(), 9)


def test_a_cut_number_raises(spark, tmp_path):
    (tmp_path / "x").write_bytes(b"\x01\x00\x02")
    with pytest.raises(ValueError, match="multiple of 2"):
        scan.document_lengths(spark, str(tmp_path), 9)


def counts(texts):
    encode = Tokenizer.from_file(tokenizer())
    encode.encode_special_tokens = True
    return Counter(len(encode.encode(t or "", add_special_tokens=False).ids) for t in texts)


def test_query_on_the_test_tables(spark, small):
    rows = op1_separator_scan(spark, small).collect()
    assert all(r.terminated for r in rows)
    texts = [r.text for r in table(spark, small, "documents").select("text").collect()]
    assert Counter(r.n_tokens for r in rows) == counts(texts)


def test_odd_rows(spark, odd, tmp_path):
    texts = [r.text for r in odd.select("text").collect()]
    scan.write_token_files(odd, str(tmp_path / "odd"), tokenizer(), 49407)
    rows = scan.document_lengths(spark, str(tmp_path / "odd"), 49407, block_bytes=1 << 12).collect()
    assert Counter(r.n_tokens for r in rows) == counts(texts)


def test_special_strings_are_text(spark, tmp_path):
    docs = spark.createDataFrame([("a <|endoftext|> b",)], "text string")
    scan.write_token_files(docs, str(tmp_path / "special"), tokenizer(), 49407)
    assert scan.document_lengths(spark, str(tmp_path / "special"), 49407).count() == 1


def test_empty_table(spark, empty, tmp_path):
    scan.write_token_files(empty, str(tmp_path / "none"), tokenizer(), 49407)
    assert scan.document_lengths(spark, str(tmp_path / "none"), 49407).count() == 0
