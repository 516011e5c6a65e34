"""Token ids of whole texts from a public tokenizer file.

The tokenizer drops white space and never looks across it, so a text's ids are those of its words in a
row. Each task encodes a word once and keeps its ids in a bounded store. The file has to be at the same
path on every executor.
"""

from __future__ import annotations

import os
import re
from bisect import bisect_left
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from starloom.llm.words import filled, split_words

KEPT_WORDS, KEPT_BYTES = 400_000, 16 << 20
LETTERS = re.compile("[a-zà-öø-ÿ]+")
TOGETHER = 100
# What is cut off the end of a word, where a letter or digit precedes: there the tokenizer cuts as well.
TAIL = ".,;:!?*$%&#|+-)]\"/"


class Encoder:
    """``special``: whether the strings of special tokens in a text stand for those tokens."""

    def __init__(self, path: str, special: bool = True):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one task, one core
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not special
        names = self.tokenizer.get_vocab()
        self.closes = np.zeros(max(names.values()) + 1, bool)
        self.closes[[i for name, i in names.items() if name.endswith("</w>")]] = True
        self.forget()

    @staticmethod
    def one_piece(word: str) -> bool:
        return LETTERS.fullmatch(word) is not None

    def forget(self) -> None:
        """Empties the store of words, as a worker process outlives the task that filled it."""
        self.place: dict[str, int] = {"": 0}
        self.bytes = 0
        self.ids = np.zeros(1 << 16, np.uint32)
        self.starts = np.zeros(1 << 16, np.int64)
        self.n = 1

    def places(self, words: list[str]) -> np.ndarray:
        """The number of each word in the store, encoding those that are new."""
        if self.n > KEPT_WORDS or self.bytes > KEPT_BYTES:
            self.forget()
        known = self.place
        new = [w for w in dict.fromkeys(words) if w not in known]
        if new:
            new.sort(key=self.one_piece)  # the others first
            alone = bisect_left(new, True, key=self.one_piece)
            rows = [e.ids for e in self.tokenizer.encode_batch_fast(new[:alone], add_special_tokens=False)]
            # Words of letters only are one unit of the tokenizer each, and its last token shows its end, so
            # they go many at a time, which costs half as much.
            lines = [" ".join(new[at : at + TOGETHER]) for at in range(alone, len(new), TOGETHER)]
            joined = [e.ids for e in self.tokenizer.encode_batch_fast(lines, add_special_tokens=False)]
            flat = np.fromiter(chain.from_iterable(rows + joined), np.uint32)
            sizes = np.fromiter(map(len, rows), np.int64, alone)
            ends = np.concatenate([np.cumsum(sizes), np.flatnonzero(self.closes[flat][sizes.sum() :]) + sizes.sum() + 1])
            first = self.starts[self.n]
            self.ids = _room(self.ids, first + len(flat))
            self.ids[first : first + len(flat)] = flat
            self.starts = _room(self.starts, self.n + len(new) + 1)
            self.starts[self.n + 1 : self.n + len(new) + 1] = first + ends
            known.update(zip(new, range(self.n, self.n + len(new)), strict=True))
            self.n += len(new)
            self.bytes += sum(map(len, new))
        return np.fromiter(map(known.__getitem__, words), np.int64, len(words))

    def encode(self, texts: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids, each text closed by ``end``, and where each text begins."""
        texts = filled(texts)
        # Folding A-Z changes nothing here but the strings of special tokens.
        marked = pc.any(pc.match_substring(texts, "<|")).as_py()
        words = split_words(texts, lower=not marked)
        dictionary = words.dictionary
        cores = pc.utf8_rtrim(dictionary, characters=TAIL)
        plain = pc.match_substring_regex(cores, r"[a-z0-9à-öø-ÿ]$")
        cores = pc.if_else(plain, cores, dictionary)
        n_kinds = len(dictionary)
        pairs = np.zeros((n_kinds, 2), np.int64)  # of the empty word, where there is no tail
        cut = np.flatnonzero(np.asarray(pc.binary_length(cores)) < np.asarray(pc.binary_length(dictionary)))
        whole, short = (_strings(words.take(pa.array(cut))) for words in (dictionary, cores))
        tails = [w[len(core) :] for w, core in zip(whole, short, strict=True)]
        places = self.places(_strings(cores) + tails)
        pairs[:, 0], pairs[cut, 1] = places[:n_kinds], places[n_kinds:]
        pairs = pairs.reshape(-1)
        flat, starts = ragged(self.ids, self.starts[pairs], self.starts[pairs + 1])
        flat, starts = np.append(flat, np.uint32(end)), np.append(starts[::2], len(flat) + 1)
        n_texts = len(texts)
        closed = words.starts + np.arange(n_texts + 1)
        codes = np.full(closed[-1], n_kinds)
        within = np.ones(closed[-1], bool)
        within[closed[1:] - 1] = False
        codes[within] = words.codes
        ids, places = ragged(flat, starts[codes], starts[codes + 1])
        return ids, places[closed]


def _strings(words: pa.Array) -> list[str]:
    return words.to_numpy(zero_copy_only=False).tolist()  # much faster than to_pylist()


def _room(held: np.ndarray, size: int) -> np.ndarray:
    if size < len(held):
        return held
    grown = np.zeros(max(2 * len(held), size + 1), held.dtype)
    grown[: len(held)] = held
    return grown


def ragged(flat: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The slices flat[first[i]:last[i]] one after the other, and where each begins."""
    sizes = last - first
    starts = np.concatenate([[0], np.cumsum(sizes)])
    return flat[np.repeat(first - starts[:-1], sizes) + np.arange(starts[-1])], starts


_ENCODERS: dict[tuple[str, bool], Encoder] = {}


def encoder(path: str, special: bool = True) -> Encoder:
    """This process's encoder for the file; its store serves the tasks that follow."""
    if (path, special) not in _ENCODERS:
        _ENCODERS[path, special] = Encoder(path, special)
    return _ENCODERS[path, special]
