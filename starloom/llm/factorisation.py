"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

The score of a row x is sigmoid(b + w.x + sum_{i<j} <v_i, v_j> x_i x_j); the pairs are never formed, as
the sum equals half of (sum_i v_i x_i)^2 - sum_i (v_i x_i)^2, taken per factor.

It is fitted on the driver, on at most ``MAX_ROWS`` labelled rows (those with the smallest hash of their
id), and applied to every whole text in the tasks.

Defined cases: a null or empty text has no words and is scored by its statistics; ids may repeat or be
null; a missing statistic or metadata value counts as 0; without labelled rows, or with one class only,
every score is the smoothed share of label 1. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from starloom.llm.rule_forest import COUNTS, features, text_counts
from starloom.llm.words import chunks, filled, split_words

MAX_ROWS = 12_000
# Text that one step turns into features: some 15 arrays as long as its words are held meanwhile.
STEP_BYTES = 1 << 20
BUCKETS, FACTORS, EPOCHS, BATCH, RATE, DECAY, SEED = 1 << 15, 8, 6, 128, 0.05, 1e-5, 11
N_STATISTICS = 9


class Model(NamedTuple):
    bias: float
    weights: np.ndarray
    factors: np.ndarray
    centre: np.ndarray
    scale: np.ndarray


class Rows(NamedTuple):
    """Sparse rows: row i has features index[starts[i]:starts[i + 1]] with those values."""

    index: np.ndarray
    value: np.ndarray
    starts: np.ndarray
    dense: np.ndarray


def featurise(chunk: pa.RecordBatch, metadata: list[str]) -> Rows:
    """Hashed words of unit length, then statistics and metadata as they are."""
    texts = filled(chunk.column("text"))
    words = split_words(texts, lower=True)
    hashed = np.array([zlib.crc32(w.encode()) % BUCKETS for w in words.dictionary.to_pylist()], np.int64)
    n = len(texts)
    keys, counts = np.unique(words.owner * BUCKETS + hashed[words.codes], return_counts=True) if len(
        words.codes
    ) else (np.empty(0, np.int64), np.empty(0, np.int64))
    owner = keys // BUCKETS
    value = np.sqrt(counts)
    value /= np.sqrt(np.bincount(owner, value**2, minlength=n))[owner]
    starts = np.searchsorted(owner, np.arange(n + 1))
    counted = text_counts(texts)
    columns = [features(counted), np.log1p(counted["n_words"])[:, None]]
    for name in metadata:
        known = pc.fill_null(pc.cast(chunk.column(name), pa.float64()), 0.0).to_numpy(zero_copy_only=False)
        columns.append(np.log1p(np.maximum(0, np.nan_to_num(known)))[:, None])
    return Rows(keys % BUCKETS, value, starts, np.hstack(columns))


def with_statistics(rows: Rows, centre: np.ndarray, scale: np.ndarray) -> Rows:
    """Statistics, standardised and cut at five deviations, as features after the hashed words."""
    n, width = rows.dense.shape
    dense = np.clip((rows.dense - centre) / scale, -5, 5)
    starts = rows.starts + width * np.arange(n + 1)
    index, value = np.empty(starts[-1], np.int64), np.empty(starts[-1])
    place = starts[:-1, None] + np.arange(width)
    index[place], value[place] = BUCKETS + np.arange(width), dense
    rest = np.ones(starts[-1], bool)
    rest[place] = False
    index[rest], value[rest] = rows.index, rows.value
    return Rows(index, value, starts, dense)


def margins(model: Model, rows: Rows) -> np.ndarray:
    """Log odds of rows with statistics, in time linear in their features."""
    first = rows.starts[:-1]
    scaled = model.factors[rows.index] * rows.value[:, None]
    linear = np.add.reduceat(model.weights[rows.index] * rows.value, first)
    pairs = np.add.reduceat(scaled, first) ** 2 - np.add.reduceat(scaled**2, first)
    return model.bias + linear + 0.5 * pairs.sum(axis=1)


def fit(rows: Rows, labels: np.ndarray, seed: int = SEED) -> Model:
    """Logistic loss, adaptive steps, fixed order of the random numbers: the same rows, the same model."""
    width = rows.dense.shape[1]
    good = (labels.sum() + 1) / (len(labels) + 2)
    bias = float(np.log(good / (1 - good)))
    weights = np.zeros(BUCKETS + width)
    random = np.random.default_rng(seed)
    factors = random.normal(0, 0.02, (BUCKETS + width, FACTORS))
    centre = rows.dense.mean(axis=0) if len(labels) else np.zeros(width)
    scale = (rows.dense.std(axis=0) if len(labels) else np.ones(width)) + 1e-3
    if len(np.unique(labels)) < 2:
        return Model(bias, weights, np.zeros_like(factors), centre, scale)
    rows = with_statistics(rows, centre, scale)
    squares = [1e-6, np.full(len(weights), 1e-6), np.full(factors.shape, 1e-6)]
    for _ in range(EPOCHS):
        order = random.permutation(len(labels))
        for chosen in np.split(order, range(BATCH, len(order), BATCH)):
            sizes = np.diff(rows.starts)[chosen]
            starts = np.concatenate([[0], np.cumsum(sizes)])
            place = np.repeat(rows.starts[chosen] - starts[:-1], sizes) + np.arange(starts[-1])
            part = Rows(rows.index[place], rows.value[place], starts, rows.dense)
            odds = margins(Model(bias, weights, factors, centre, scale), part)
            error = (1 / (1 + np.exp(-odds)) - labels[chosen]) / len(chosen)
            used, inverse = np.unique(part.index, return_inverse=True)
            each = np.repeat(error, sizes)
            step = np.bincount(inverse, each * part.value) + DECAY * weights[used]
            scaled = factors[part.index] * part.value[:, None]
            total = np.repeat(np.add.reduceat(scaled, starts[:-1]), sizes, axis=0)
            pull = (each * part.value)[:, None] * (total - scaled)
            by_feature = np.argsort(inverse, kind="stable")
            edges = np.searchsorted(inverse[by_feature], np.arange(len(used)))
            slope = np.add.reduceat(pull[by_feature], edges) + DECAY * factors[used]
            squares[0] += error.sum() ** 2
            squares[1][used] += step**2
            squares[2][used] += slope**2
            bias -= RATE * error.sum() / np.sqrt(squares[0])
            weights[used] -= RATE * step / np.sqrt(squares[1][used])
            factors[used] -= RATE * slope / np.sqrt(squares[2][used])
    return Model(bias, weights, factors, centre, scale)


def train(docs: DataFrame, labelled: DataFrame, metadata: list[str], max_rows: int = MAX_ROWS) -> Model:
    """A model from ``labelled`` (doc_id, label), each id once; at most ``max_rows`` rows come to the driver."""
    chosen = labelled.orderBy(F.xxhash64("doc_id", F.lit(SEED)), "doc_id").limit(max_rows).toArrow()
    labels = dict(zip(chosen["doc_id"].to_pylist(), chosen["label"].to_pylist(), strict=True))
    shared = docs.sparkSession.sparkContext.broadcast(labels)

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pc.is_in(batch.column("doc_id"), pa.array(shared.value, pa.int64())))
            for chunk in chunks(iter([batch]), max_bytes=STEP_BYTES):
                rows = featurise(chunk, metadata)
                lists = [pa.array(x) for x in (rows.index.astype(np.int32), rows.value.astype(np.float32))]
                yield pa.RecordBatch.from_arrays(
                    [
                        chunk.column("doc_id"),
                        *(pa.ListArray.from_arrays(rows.starts.astype(np.int32), x) for x in lists),
                        pa.array(list(rows.dense)),
                    ],
                    ["doc_id", "index", "value", "dense"],
                )

    found = (
        columns(docs, metadata)
        .mapInArrow(sample, "doc_id long, index array<int>, value array<float>, dense array<double>")
        # Copies of an id are one row, so that the bound holds.
        .groupBy("doc_id")
        .agg(F.min(F.struct("index", "value", "dense")).alias("row"))
        .select("doc_id", "row.*")
        .orderBy("doc_id")
        .toArrow()
    )
    ids = found["doc_id"].to_pylist()
    starts = np.concatenate([[0], np.cumsum(pc.list_value_length(found["index"]).to_numpy())])
    dense = np.array(found["dense"].to_pylist()) if ids else np.zeros((0, N_STATISTICS + len(metadata)))
    index = pc.list_flatten(found["index"]).to_numpy().astype(np.int64)
    value = pc.list_flatten(found["value"]).to_numpy().astype(np.float64)
    return fit(Rows(index, value, starts.astype(np.int64), dense), np.array([labels[i] for i in ids]))


def columns(docs: DataFrame, metadata: list[str]) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("long"),
        F.col("text").cast("string"),
        *(F.col(f"`{m}`").cast("double") for m in metadata),
    )


def score(docs: DataFrame, model: Model, metadata: list[str]) -> DataFrame:
    """(doc_id, score) of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches, max_bytes=STEP_BYTES):
            found = pa.array(scores(shared.value, chunk, metadata))
            yield pa.RecordBatch.from_arrays([chunk.column("doc_id"), found], ["doc_id", "score"])

    return columns(docs, metadata).mapInArrow(scored, "doc_id long, score double")


def scores(model: Model, chunk: pa.RecordBatch, metadata: list[str]) -> np.ndarray:
    rows = with_statistics(featurise(chunk, metadata), model.centre, model.scale)
    return 1 / (1 + np.exp(-np.clip(margins(model, rows), -50, 50)))


def accepted(docs: DataFrame, model: Model, metadata: list[str], threshold: float) -> DataFrame:
    """The rows of ``docs``, with all their columns, that score at least ``threshold``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches, max_bytes=STEP_BYTES):
            yield chunk.filter(pa.array(scores(shared.value, chunk, metadata) >= threshold))

    return docs.mapInArrow(kept, docs.schema)
