"""Language-model scores of texts: the probability of a text over all its segmentations into subwords.

A text is its words and one end. A word, after the mark of a word's beginning, is any row of pieces of
an existing unigram vocabulary that spells it, each piece with its score (log10 of its probability), and
the word's probability is the sum over all such rows. The forward recursion takes that sum in log space,
left to right over the bytes. As no piece goes across white space, the recursion of a text falls apart into those
of its words, which are done once for each different word of the corpus.

Words are counted in blocks: a block is a slice of a task's texts, and has one row for each of its
different words. So the joins that fetch a word's score meet no hot key: the commonest word has one row a
block.

Defined cases: a null or empty text is one end; repeated ids are scored as they are; an empty table gives no
rows; without training texts every piece has the same score. Other columns are ignored, whatever
their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from starloom.llm.words import chunks, split_words
from starloom.session import written_once

MARK = "▁"
# A word cannot hold a blank, so this cannot be a word.
END = " "
BLOCK_BYTES = 32 << 20
# Blocks in a task that scores texts, with some 20 MB of word rows each.
TASK_BLOCKS = 4
SMOOTHING = 0.5
# Longer words are scored one by one, since few have the same length.
TOGETHER = 48

BLOCKS = "block long, doc_id long, train boolean, word string, n long, codes binary, counts binary"


class Vocabulary(NamedTuple):
    """A trie of pieces as sorted (node * 256 + byte) -> node, and each node's score, -inf within a piece."""

    edge: np.ndarray
    child: np.ndarray
    score: np.ndarray


def vocabulary(scores: dict[bytes, float]) -> Vocabulary:
    nodes: dict[bytes, int] = {b"": 0}
    edges = []
    for piece in sorted(scores):
        for end in range(1, len(piece) + 1):
            if piece[:end] not in nodes:
                nodes[piece[:end]] = len(nodes)
                edges.append((nodes[piece[: end - 1]] * 256 + piece[end - 1], len(nodes) - 1))
    edge, child = np.array(sorted(edges), np.int64).reshape(-1, 2).T
    score = np.full(len(nodes), -np.inf)
    for piece, value in scores.items():
        score[nodes[piece]] = value
    return Vocabulary(np.ascontiguousarray(edge), np.ascontiguousarray(child), score * np.log(10))


def piece_bytes(model: str) -> list[bytes]:
    """What each piece of a sentencepiece file spells: bytes for byte pieces, nothing for control pieces."""
    from sentencepiece import SentencePieceProcessor

    pieces = SentencePieceProcessor(model_file=model)
    return [
        b""
        if pieces.is_control(i) or pieces.is_unknown(i)
        else bytes([int(pieces.id_to_piece(i)[3:5], 16)])
        if pieces.is_byte(i)
        else pieces.id_to_piece(i).encode()
        for i in range(pieces.get_piece_size())
    ]


def log10_words(words: list[str], pieces: Vocabulary) -> np.ndarray:
    """log10 of each word's probability over all its segmentations; -inf where there is none."""
    spelled = [(MARK + w).encode() for w in words]
    sizes = np.array([len(s) for s in spelled], np.int64)
    found = np.empty(len(words))
    for size in np.unique(sizes):
        at = np.flatnonzero(sizes == size)
        for part in np.split(at, range(20_000, len(at), 20_000)) if size <= TOGETHER else at[:, None]:
            letters = np.frombuffer(b"".join(spelled[i] for i in part), np.uint8).reshape(len(part), size)
            found[part] = _forward(letters.astype(np.int64), pieces)
    return found / np.log(10)


def _forward(letters: np.ndarray, pieces: Vocabulary) -> np.ndarray:
    """The forward recursion, over words of one length at once: ``reached[i]`` is the log of the summed
    probability of all segmentations of the first i bytes."""
    n, size = letters.shape
    reached = np.full((size + 1, n), -np.inf)
    reached[0] = 0
    for start in range(size):
        active = np.flatnonzero(reached[start] > -np.inf)
        node = np.zeros(len(active), np.int64)
        for end in range(start + 1, size + 1):
            wanted = node * 256 + letters[active, end - 1]
            at = np.minimum(np.searchsorted(pieces.edge, wanted), len(pieces.edge) - 1)
            there = pieces.edge[at] == wanted
            if not there.all():
                active, at = active[there], at[there]
            if not len(active):
                break
            node = pieces.child[at]
            step = reached[start, active] + pieces.score[node]
            reached[end, active] = np.logaddexp(reached[end, active], step)
    return reached[size]


def word_blocks(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Rows of two kinds from (doc_id, text, train), to be written: for each block and different word, its
    number in the block's training texts (n) and its place (codes); for each text, its different words'
    places (codes) and their numbers (counts). A-Z are lower-cased."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for chunk in chunks(batches, max_bytes=block_bytes):
            words = split_words(chunk.column("text"), lower=True)
            kinds = len(words.dictionary)
            train = chunk.column("train").to_numpy(zero_copy_only=False)
            learned = np.bincount(words.codes, np.repeat(train, words.counts), minlength=kinds).astype(np.int64)
            for first in range(0, kinds, 20_000):
                part = words.dictionary.slice(first, 20_000)
                n = len(part)
                yield _rows(
                    block=np.full(n, block), word=part, n=learned[first : first + n],
                    codes=_binary(np.arange(first, first + n, dtype="<u4"), np.arange(n + 1)),
                )
            keys, counts = np.unique(words.owner * max(1, kinds) + words.codes, return_counts=True)
            starts = np.searchsorted(keys // max(1, kinds), np.arange(chunk.num_rows + 1))
            yield _rows(
                block=np.full(chunk.num_rows, block), doc_id=chunk.column("doc_id"), train=chunk.column("train"),
                codes=_binary((keys % max(1, kinds)).astype("<u4"), starts),
                counts=_binary(counts.astype("<u4"), starts),
            )
            block += 1

    return docs.select(
        F.col("doc_id").cast("long"), F.col("text").cast("string"), F.col("train").cast("boolean")
    ).mapInArrow(blocks, BLOCKS)


_KINDS = {"block": pa.int64(), "doc_id": pa.int64(), "train": pa.bool_(), "word": pa.string(), "n": pa.int64(), "codes": pa.binary(), "counts": pa.binary()}


def _rows(**columns) -> pa.RecordBatch:
    size = len(columns["block"])
    arrays = [
        pa.nulls(size, kind) if name not in columns
        else columns[name] if isinstance(columns[name], pa.Array)
        else pa.array(columns[name], kind)
        for name, kind in _KINDS.items()
    ]
    return pa.RecordBatch.from_arrays(arrays, list(_KINDS))


def _binary(values: np.ndarray, starts: np.ndarray) -> pa.Array:
    edges = np.ascontiguousarray(4 * starts.astype(np.int64))
    held = [None, pa.py_buffer(edges), pa.py_buffer(np.ascontiguousarray(values))]
    return pa.Array.from_buffers(pa.large_binary(), len(starts) - 1, held).cast(pa.binary())


def segmented_scores(counts: DataFrame, model: str, ends: int) -> dict[bytes, float]:
    """Scores (log10) of the pieces of a sentencepiece file, from the file's own segmentation of each word
    of (word, c). Each piece counts ``SMOOTHING`` more than it is found; the end counts ``ends``."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from sentencepiece import SentencePieceProcessor

        known = SentencePieceProcessor(model_file=model)
        total = np.zeros(known.get_piece_size())
        for batch in batches:
            rows = known.encode(batch.column("word").to_pylist(), num_threads=1)
            sizes = np.fromiter(map(len, rows), np.int64, len(rows))
            flat = np.fromiter((i for row in rows for i in row), np.int64, sizes.sum())
            total += np.bincount(flat, np.repeat(np.asarray(batch.column("c")), sizes), minlength=len(total))
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["piece", "n"])

    found = counts.select("word", "c").mapInArrow(pieces, "piece long, n double")
    numbers = {r[0]: r[1] for r in found.groupBy("piece").agg(F.sum("n")).collect()}
    spelled = piece_bytes(model)
    total = sum(numbers.values()) + ends + SMOOTHING * (len(spelled) + 1)
    merged: dict[bytes, float] = {}
    for i, piece in enumerate(spelled):
        if piece:
            merged[piece] = merged.get(piece, 0) + (numbers.get(i, 0) + SMOOTHING) / total
    scores = {piece: float(np.log10(p)) for piece, p in merged.items()}
    return scores | {b"": float(np.log10((ends + SMOOTHING) / total))}


def score(docs: DataFrame, model: str) -> DataFrame:
    """(doc_id, train, n_tokens, n_known, train_tokens, base_score, score) of each (doc_id, text, train).

    ``score`` is log10 of the text's probability; ``base_score`` that of independent words with counts from the
    training texts, each plus a half.
    """
    blocks = written_once(word_blocks(docs), "word-blocks")
    words = blocks.where("word IS NOT NULL").select("block", F.col("codes").alias("code"), "word", "n")
    counted = written_once(words.groupBy("word").agg(F.sum("n").alias("c")), "word-counts")
    known = counted.where("c > 0")
    totals = known.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    ends = blocks.where("word IS NULL AND train").count()
    n, v = totals[0] + ends, totals[1] + (1 if ends else 0)
    scores = segmented_scores(known, model, ends)
    end_score = scores.pop(b"")
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary(scores))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = log10_words(batch.column("word").to_pylist(), shared.value)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found)], ["word", "c", "logp"])

    lexicon = written_once(counted.mapInArrow(scored, "word string, c long, logp double"), "word-scores")
    looked_up = words.drop("n").join(lexicon, "word").select(
        F.col("block").alias("of_block"), "code", "c", "logp"
    )
    texts = blocks.where("word IS NULL").select("block", "doc_id", "train", "codes", "counts")
    base_all = float(np.log10(n + 0.5 * (v + 1)))
    end_base = float(np.log10(ends + 0.5)) - base_all

    def summed(texts: pa.Table, words: pa.Table) -> pa.Table:
        place = _numbers(words.column("code"))
        c, logp = np.zeros(len(place)), np.zeros(len(place))
        c[place] = np.asarray(words.column("c"))
        logp[place] = np.asarray(words.column("logp"))
        codes, counts = _numbers(texts.column("codes")), _numbers(texts.column("counts"))
        sizes = np.asarray(pc.binary_length(texts.column("codes"))) // 4
        owner = np.repeat(np.arange(len(sizes)), sizes)
        total = lambda values: np.bincount(owner, counts * values, minlength=len(sizes))
        tokens = total(np.ones(len(codes)))
        return pa.table(
            {
                "doc_id": texts.column("doc_id"),
                "train": texts.column("train"),
                "n_tokens": pa.array((tokens + 1).astype(np.int64)),
                "n_known": pa.array((total(c[codes] > 0) + (ends > 0)).astype(np.int64)),
                "train_tokens": pa.array(np.full(len(sizes), n)),
                "base_score": pa.array(total(np.log10(c[codes] + 0.5)) - tokens * base_all + end_base),
                "score": pa.array(total(logp[codes]) + end_score),
            }
        )

    fields = "doc_id long, train boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    # More tasks than the session's shuffles have, where the blocks are many; with fewer Spark would shuffle again.
    tasks = -(-texts.select("block").distinct().count() // TASK_BLOCKS)
    if tasks > int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        texts, looked_up = texts.repartition(tasks, "block"), looked_up.repartition(tasks, "of_block")
    return texts.groupBy("block").cogroup(looked_up.groupBy("of_block")).applyInArrow(summed, fields)


def _numbers(column: pa.ChunkedArray) -> np.ndarray:
    """The 32-bit numbers of all values of a binary column, one after the other."""
    parts = [np.frombuffer(b"".join(part.to_pylist()), "<u4") for part in column.chunks]
    return np.concatenate(parts).astype(np.int64) if parts else np.empty(0, np.int64)
