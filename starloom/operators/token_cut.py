"""Texts cut to the first tokens of a model's own tokenizer."""

from __future__ import annotations

import json
import os
import re
from bisect import bisect_left
from collections.abc import Iterator
from functools import partial
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame, types as T

from starloom.fixed_values import TEXT
from starloom.functions.columns import named

# Characters per token that are encoded first; a text is only encoded as far as needed.
CHARACTERS = 8
_TOKENIZERS: dict = {}
# White space of Unicode, and a word with the white space before it, or that at the end of a text.
SPACE = " \t-\r\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
WORD = re.compile(f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")
WORD_END = re.compile(f"[^{SPACE}]*")
# Steps of a tokenizer that see nothing but a word and the white space before it.
LOCAL = {"NFC", "Lowercase", "Replace", "Split", "ByteLevel", "Sequence"}
KEPT_WORDS, KEPT_LETTERS = 200_000, 40
WINDOW = 4


def _tokenizer(path: str):
    """This process's tokenizer of the file; the strings of special tokens are ordinary text."""
    if path not in _TOKENIZERS:
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one task, one core
        _TOKENIZERS[path] = Tokenizer.from_file(path)
        _TOKENIZERS[path].encode_special_tokens = True
    return _TOKENIZERS[path]


def cut(tokenizer, text: str, max_length: int) -> str:
    """``text`` up to the end of its token number ``max_length``; shorter texts stay as they are.

    Tokenizers do not look beyond the white space after a word, so the first tokens are those of a part that ends
    before white space, as long as it has more than are wanted.
    """
    if max_length <= 0:
        return ""
    size = CHARACTERS * max_length
    while True:
        end = size
        while end < len(text) and not text[end].isspace():
            end += 1
        found = tokenizer.encode(text[:end], add_special_tokens=False)
        if len(found.ids) > max_length:
            return text[: found.offsets[max_length - 1][1]]
        if end >= len(text):
            return text
        size = 4 * end


class Words:
    """Numbers of tokens of words, of which each is encoded once and kept in a bounded store."""

    def __init__(self, tokenizer):
        self.tokenizer = tokenizer
        self.sizes: dict[str, int] = {}

    @staticmethod
    def fit(described: str) -> bool:
        """Whether a text's tokens are those of its words in a row, by the kinds of steps of the tokenizer."""
        parts = json.loads(described)
        steps = [parts[name] for name in ("normalizer", "pre_tokenizer") if parts.get(name)]
        while steps:
            step = steps.pop()
            if step["type"] not in LOCAL or step.get("add_prefix_space"):
                return False
            steps += [*step.get("normalizers", []), *step.get("pretokenizers", [])]
        return bool(parts.get("pre_tokenizer")) and parts["model"]["type"] == "BPE"

    def of(self, words: list[str]) -> list[int]:
        found = list(map(self.sizes.get, words))
        if None in found:
            if len(self.sizes) >= KEPT_WORDS:
                self.sizes.clear()
            new = list({word for word, size in zip(words, found, strict=True) if size is None})
            encoded = self.tokenizer.encode_batch_fast(new, add_special_tokens=False)
            sizes = {word: len(e) for word, e in zip(new, encoded, strict=True)}
            found = [sizes[word] if size is None else size for word, size in zip(words, found, strict=True)]
            self.sizes.update((word, size) for word, size in sizes.items() if len(word) <= KEPT_LETTERS)
        return found

    def cut(self, text: str, max_length: int) -> str:
        """As ``cut``, word by word."""
        if max_length <= 0:
            return ""
        at, left, last = 0, max_length, None
        while at < len(text):
            end = WORD_END.search(text, min(len(text), at + WINDOW * max_length)).end()
            words = WORD.findall(text, at, end)
            sizes = self.of(words)
            total = list(accumulate(sizes))
            if left > 0 and total[-1] >= left:
                i = bisect_left(total, left)
                wanted = left - total[i] + sizes[i]
                start = at + sum(map(len, words[:i]))
                last = start + self.tokenizer.encode(words[i], add_special_tokens=False).offsets[wanted - 1][1]
            left -= total[-1]
            if left < 0:
                return text[:last]
            at = end
        return text


def truncate_by_tokenizer(df: DataFrame, tokenizer: str, text_col: str = TEXT, max_length: int = 512) -> DataFrame:
    """``df`` with each text cut after ``max_length`` tokens of a tokenizer file, which has to be at the same path on
    every executor. A null text stays null; rows and other columns stay as they are."""
    place = df.columns.index(text_col)
    ready = df.withColumn(text_col, named(text_col).cast("string"))

    def shortened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _tokenizer(tokenizer)
        by_words = Words(encode).cut if Words.fit(encode.to_str()) else partial(cut, encode)
        for batch in batches:
            texts = [t if t is None else by_words(t, max_length) for t in batch.column(place).to_pylist()]
            columns = list(batch.columns)
            columns[place] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    # Names with a dot do not go through, so columns are numbered meanwhile.
    numbered = ready.toDF(*(f"c{i}" for i in range(len(df.columns))))
    fields = [T.StructField(f.name, f.dataType, True) for f in numbered.schema.fields]
    return numbered.mapInArrow(shortened, T.StructType(fields)).toDF(*df.columns)
