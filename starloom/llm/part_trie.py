"""Vector codes from codebooks per part, with the nearest entries found along a lexicographic trie.

Vectors of integers are cut into equal parts, and each part position has a codebook of at most 256 entries.
Distinct parts are counted once for all rounds and lie in lexicographic order. A task walks the trie of its parts
depth first: a node holds the squared distances of its common leading dimensions to all entries, which everything
below it shares. An edge covers all dimensions up to the next branching, and small subtrees of a node are measured
together from the node's depth on, as one matrix product. Leaves take the nearest entry and add their components,
times the number of their copies, to its sums. Only these sums, one row per entry and task, are shuffled.

Defined cases: a vector that is null, empty, or holds a null or non-finite component is dropped; a null id comes
last in the order of ids and is coded like any other; rows of one id are coded each, and each of them may start an
entry, in the order of their components; fewer vectors than entries give smaller codebooks; equal entries are
allowed, of which the later ones stay unused; an empty table gives no rows. Vectors of different lengths, lengths
that the number of parts does not divide, and components too large for exact distances raise. Other columns are
ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from starloom.session import written_once

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
# Components are held in 32 bits, and the sums of squares of a part in 64.
LARGEST = 1 << 30
# A subtree of fewer leaves is measured with its neighbours, and so many leaves at a time.
SHARED, TOGETHER = 32, 2048
# Leading dimensions by which parts are dealt to tasks, and tasks among which those of equal ones are dealt.
LEAD, SPREAD = 2, 16
# Labels that are broadcast; more are joined by a shuffle.
BROADCAST_LABELS = 100_000


def whole_vectors(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, embedding) of the rows with finite components only."""
    kept = vectors.select(F.col("vec_id").cast("long"), "label", F.col("embedding").cast("array<double>"))
    infinite = F.lit(float("inf"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < infinite))
    return kept.where(F.col("embedding").isNotNull() & (F.size("embedding") > 0) & finite)


def integers(embeddings: pa.Array, dimensions: int) -> np.ndarray:
    """floor(SCALE * x) of each component, a row per vector."""
    flat = pc.list_flatten(embeddings).to_numpy(zero_copy_only=False)
    floored = np.floor(flat.astype(np.float64) * SCALE).reshape(-1, dimensions)
    if floored.size and np.abs(floored).max() > LARGEST:
        raise ValueError(f"a component is beyond {LARGEST} / {SCALE}")
    return floored.astype(np.int64)


def distinct_parts(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different rows in lexicographic order as bytes, where each row is among them, and their numbers."""
    ordered = (rows + (1 << 31)).astype(">u4")  # unsigned and big-endian: bytes sort as the numbers do
    packed = np.ascontiguousarray(ordered).view(f"V{4 * rows.shape[1]}").reshape(-1)
    return np.unique(packed, return_inverse=True, return_counts=True)


def unpacked(parts: np.ndarray, width: int) -> np.ndarray:
    return parts.view(">u4").reshape(-1, width).astype(np.int64) - (1 << 31)


def nearest(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry of each row of ``parts``, which are in lexicographic order, and its squared distance."""
    n, width = parts.shape
    best, error = np.empty(n, np.int64), np.empty(n, np.int64)
    top = int(max(np.abs(parts).max(initial=0), np.abs(entries).max(initial=0)))
    if width * (2 * top) ** 2 >= 1 << 63:
        raise ValueError("components are too large for exact distances")
    kind = np.float64 if width * (2 * top) ** 2 < 1 << 52 else np.int64  # both exact
    x, c = parts.astype(kind), entries.astype(kind)
    # The number of leading dimensions that a row shares with the row before it.
    shared = np.append(np.cumprod(parts[1:] == parts[:-1], axis=1).sum(axis=1), 0)
    stack = [(0, n, 0, np.zeros(len(c), kind))] if n else []
    while stack:
        low, high, depth, held = stack.pop()
        common = int(shared[low : high - 1].min()) if high - low > 1 else depth
        if common > depth:
            step = c[:, depth:common] - x[low, depth:common]
            held = held + (step * step).sum(axis=1)
        branches = np.flatnonzero(shared[low : high - 1] == common) + low + 1
        firsts = np.concatenate([[low], branches])
        sizes = np.diff(np.append(firsts, high))
        large = sizes >= SHARED if common < width else np.zeros(len(sizes), bool)
        for first, size in zip(firsts[large].tolist(), sizes[large].tolist(), strict=True):
            stack.append((first, first + size, common, held))
        small = np.repeat(~large, sizes)
        leaves = np.flatnonzero(small) + low
        for at in range(0, len(leaves), TOGETHER):
            rows = leaves[at : at + TOGETHER]
            far = measured(x[rows, common:], c[:, common:]) + held
            best[rows] = far.argmin(axis=1)
            error[rows] = far[np.arange(len(rows)), best[rows]]
    return best, error


def measured(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of ``x`` to all rows of ``c``."""
    return (x * x).sum(axis=1)[:, None] - 2 * (x @ c.T) + (c * c).sum(axis=1)


def counted_parts(vectors: DataFrame, dimensions: int, n_parts: int) -> DataFrame:
    """(position, part, copies): the distinct parts of whole vectors, sorted within the files of a written table."""
    width = dimensions // n_parts

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = integers(batch.column("embedding"), dimensions)
            for position in range(n_parts):
                found, _, copies = distinct_parts(rows[:, position * width : (position + 1) * width])
                packed = pa.Array.from_buffers(pa.binary(4 * width), len(found), [None, pa.py_buffer(found)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(found), position, np.int32)), packed.cast(pa.binary()), pa.array(copies)],
                    ["position", "part", "copies"],
                )

    each = vectors.select("embedding").mapInArrow(parts, "position int, part binary, copies long")
    # One shuffle: the grouping is by more columns than the rows are dealt by.
    by = ["position", "lead", "share"]
    lead, share = F.substring("part", 1, 4 * min(LEAD, width)), F.pmod(F.xxhash64("part"), F.lit(SPREAD))
    dealt = each.withColumns({"lead": lead, "share": share}).repartition(*by)
    counted = dealt.groupBy(*by, "part").agg(F.sum("copies").alias("copies"))
    return written_once(
        counted.select("position", "part", "copies").sortWithinPartitions("position", "part"), "distinct-parts"
    )


def bettered(parts: DataFrame, codebooks: np.ndarray) -> np.ndarray:
    """The codebooks (position, entry, component) after one round over the distinct parts."""
    n_parts, n_entries, width = codebooks.shape
    shared = parts.sparkSession.sparkContext.broadcast(codebooks)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((n_parts, n_entries, width + 1), np.int64)
        for batch in batches:
            positions = np.asarray(batch.column("position"))
            copies = np.asarray(batch.column("copies"))
            packed = batch.column("part").cast(pa.binary(4 * width)).buffers()[1]
            start = batch.column("part").cast(pa.binary(4 * width)).offset * 4 * width
            rows = unpacked(np.frombuffer(packed, np.uint8, len(copies) * 4 * width, start), width)
            for position in np.unique(positions).tolist():
                here = positions == position
                best, _ = nearest(rows[here], shared.value[position])
                weighted = np.column_stack([np.ones(here.sum(), np.int64), rows[here]]) * copies[here][:, None]
                np.add.at(totals[position], best, weighted)
        at = np.argwhere(totals[:, :, 0] > 0).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [pa.array(at[:, 0]), pa.array(at[:, 1]), pa.array(list(totals[at[:, 0], at[:, 1]]), pa.list_(pa.int64()))],
            ["position", "entry", "totals"],
        )

    found = parts.mapInArrow(summed, "position int, entry int, totals array<long>")
    sums = [F.sum(F.col("totals")[i]).alias(f"s{i}") for i in range(width + 1)]
    after = codebooks.copy()
    for row in found.groupBy("position", "entry").agg(*sums).collect():  # a row per entry
        after[row[0], row[1]] = np.array(row[3:], np.int64) // row[2]
    return after


def coded(vectors: DataFrame, codebooks: np.ndarray) -> DataFrame:
    """(vec_id, label, codes, error) of whole vectors; ``codes`` has an entry's index per part."""
    n_parts, _, width = codebooks.shape
    shared = vectors.sparkSession.sparkContext.broadcast(codebooks)

    def assigned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = integers(batch.column("embedding"), n_parts * width)
            codes, error = np.empty((len(rows), n_parts), np.int32), np.zeros(len(rows), np.int64)
            for position in range(n_parts):
                found, place, _ = distinct_parts(rows[:, position * width : (position + 1) * width])
                best, far = nearest(unpacked(found, width), shared.value[position])
                codes[:, position] = best[place]
                error += far[place]
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(0, codes.size + 1, n_parts, dtype=np.int32)), pa.array(codes.reshape(-1))
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), lists, pa.array(error)],
                ["vec_id", "label", "codes", "error"],
            )

    label = vectors.schema["label"].dataType.simpleString()
    return vectors.mapInArrow(assigned, f"vec_id long, label {label}, codes array<int>, error long")


def learn(
    vectors: DataFrame, n_parts: int = PARTS, n_entries: int = ENTRIES, rounds: int = ROUNDS
) -> np.ndarray | None:
    """Codebooks (position, entry, component) of whole vectors; None without any."""
    sizes = vectors.agg(F.min(F.size("embedding")), F.max(F.size("embedding"))).first()
    if sizes[0] is None:
        return None
    dimensions = sizes[1]
    if sizes[0] != dimensions or dimensions % n_parts:
        raise ValueError(f"vectors of {sizes[0]} to {dimensions} components do not make {n_parts} equal parts")
    first = vectors.orderBy(F.asc_nulls_last("vec_id"), "embedding").limit(n_entries).select("embedding").toArrow()
    start = integers(first["embedding"].combine_chunks(), dimensions)
    codebooks = np.stack(np.split(start, n_parts, axis=1))
    parts = counted_parts(vectors, dimensions, n_parts)
    for _ in range(rounds):
        codebooks = bettered(parts, codebooks)
    return codebooks


def digest(codebooks: np.ndarray) -> str:
    """SHA-256 of all components by part, entry and place, joined by commas."""
    return hashlib.sha256(",".join(map(str, codebooks.reshape(-1).tolist())).encode()).hexdigest()


def compressed(vectors: DataFrame, n_parts: int = PARTS, n_entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """(vec_id, label, code, error, label_error, codebooks_sha256) of each whole (vec_id, label, embedding).

    ``label_error`` sums the errors of equal labels, of which null is one.
    """
    whole = whole_vectors(vectors)
    label = whole.schema["label"].dataType.simpleString()
    codebooks = learn(whole, n_parts, n_entries, rounds)
    if codebooks is None:
        schema = f"vec_id long, label {label}, code string, error long, label_error long, codebooks_sha256 string"
        return whole.sparkSession.createDataFrame([], schema)
    rows = written_once(coded(whole, codebooks), "vector-codes")
    sums = rows.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    sums = written_once(sums, "label-errors")
    small = F.broadcast(sums) if sums.count() <= BROADCAST_LABELS else sums
    digits = F.transform("codes", lambda k: F.lpad(F.lower(F.hex(k)), 2, "0"))
    return rows.join(small, F.col("label").eqNullSafe(F.col("of"))).select(
        "vec_id",
        "label",
        F.array_join(digits, "").alias("code"),
        "error",
        "label_error",
        F.lit(digest(codebooks)).alias("codebooks_sha256"),
    )
