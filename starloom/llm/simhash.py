"""SimHash near-duplicates, with candidates filtered by pigeonring.

A fingerprint is cut into five segments in a ring. Where two fingerprints differ in no more than four
bits, there is a segment from which every chain of 1, 2, ... 5 segments differs in no more than its share
of four: 0, 1, 2, 3, 4 bits. So a pair has to meet under a key of one equal segment and the next one
with at most one bit changed; longer chains are checked before the full distance is.

Equal fingerprints are one row from the start. The members of a key are dealt to cells of bounded size, so
a key that very many fingerprints share is worked on by many tasks, and each task returns links that
span what it found connected, not all pairs.

Defined cases: a null or empty text has fingerprint 0 and is linked like any other; a text of fewer words than a
shingle is one shingle; repeated ids are one document each, of the same component if their texts are; the
component of rows without any id is null; an empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F
from xxhash import xxh64_intdigest

from starloom.llm.components import components
from starloom.llm.words import chunks, filled, sums
from starloom.session import written_once

SHINGLE, DISTANCE, HASH_SEED = 4, 4, 42
# Segments of the ring: first bit and number of bits.
EDGES = [0, 13, 26, 39, 52, 64]
SEGMENTS = [(low, high - low) for low, high in zip(EDGES, EDGES[1:], strict=False)]
CELL = 4096
PAIRS_AT_ONCE = 1 << 20
# Shared keys that are broadcast, three longs each; more are joined by a shuffle.
BROADCAST_KEYS = 500_000


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, row_key: Column | None = None) -> DataFrame:
    """(doc_id, fp) of each (doc_id, text), and its ``row_key`` where one is given; the fingerprint as a signed long."""
    carried = ["doc_id"] if row_key is None else ["doc_id", "row_key"]
    own = [] if row_key is None else [row_key.cast("long").alias("row_key")]

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches, max_bytes=1 << 20):
            found = text_fingerprints(chunk.column("text"), shingle)
            yield pa.RecordBatch.from_arrays(
                [*map(chunk.column, carried), pa.array(found.view(np.int64))], [*carried, "fp"]
            )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), *own).mapInArrow(
        hashed, ", ".join(f"{c} long" for c in [*carried, "fp"])
    )


def shingle_hashes(texts: pa.Array, shingle: int) -> list[np.ndarray]:
    """The hash of each shingle of each text."""
    trimmed = pc.ascii_trim_whitespace(pc.ascii_lower(filled(texts)))
    lists = pc.ascii_split_whitespace(trimmed)
    sizes = np.asarray(pc.list_value_length(lists)).astype(np.int64)
    sizes[np.asarray(pc.binary_length(trimmed)) == 0] = 0
    lengths = np.asarray(pc.binary_length(lists.flatten()))
    first = lists.offsets.to_numpy()
    hashes = []
    for row, text in enumerate(pc.binary_join(lists, " ").cast(pa.binary()).to_pylist()):
        n = int(sizes[row])
        if not n:
            found = []
        elif n <= shingle:
            found = [xxh64_intdigest(text, HASH_SEED)]
        else:
            after = np.cumsum(lengths[first[row] : first[row] + n] + 1)
            begins = np.concatenate([[0], after[: n - shingle]]).tolist()
            ends = (after[shingle - 1 :] - 1).tolist()
            found = [xxh64_intdigest(text[a:b], HASH_SEED) for a, b in zip(begins, ends, strict=True)]
        hashes.append(np.array(found, np.uint64))
    return hashes


def text_fingerprints(texts: pa.Array, shingle: int = SHINGLE) -> np.ndarray:
    hashes = shingle_hashes(texts, shingle)
    counts = np.array([len(h) for h in hashes], np.int64)
    total = np.zeros((len(texts), 64), np.int64)
    if hashes:
        each = np.concatenate(hashes)
        starts = np.concatenate([[0], np.cumsum(counts)])
        for low in range(0, 64, 8):  # a byte of all hashes at a time bounds the memory
            eight = (each >> np.uint64(low)).astype(np.uint8)
            total[:, low : low + 8] = sums(np.unpackbits(eight[:, None], axis=1, bitorder="little"), starts)
    bits = 2 * total > counts[:, None]
    return np.packbits(bits, axis=1, bitorder="little").view(np.uint64).reshape(-1)


def links(fps: DataFrame) -> DataFrame:
    """(a, b): links that connect what pairs of ``fps`` (fp, each once) at most ``DISTANCE`` apart connect."""
    entries = written_once(fps.select("fp").mapInArrow(_entries, "key long, fp long, own boolean"), "ring-keys")
    sizes = (
        entries.groupBy("key")
        .agg(F.sum(F.col("own").cast("long")).alias("owners"), F.count(F.lit(1)).alias("members"))
        .where("owners > 0 AND members > 1")
        .select(
            "key",
            F.expr(f"(owners - 1) div {CELL} + 1").alias("down"),
            F.expr(f"(members - 1) div {CELL} + 1").alias("across"),
        )
    )
    sizes = written_once(sizes, "ring-key-sizes")
    met = entries.join(F.broadcast(sizes) if sizes.count() <= BROADCAST_KEYS else sizes, "key")
    part = lambda n: F.pmod(F.xxhash64("fp"), F.col(n))
    cells = met.where("own").select(
        "key", part("down").alias("i"), F.explode(F.expr("sequence(0L, across - 1)")).alias("j"), F.lit(True).alias("own"), "fp"
    ).unionByName(
        met.select(
            "key", F.explode(F.expr("sequence(0L, down - 1)")).alias("i"), part("across").alias("j"), F.lit(False).alias("own"), "fp"
        )
    )
    dealt = cells.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "own")
    return dealt.mapInArrow(_linked, "a long, b long")


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The keys of each fingerprint: for each place in the ring, the segment there with the next segment as
    it is (``own``) and with each one bit of it changed."""
    for batch in batches:
        fps = np.asarray(batch.column("fp")).view(np.uint64)
        for at, (low, bits) in enumerate(SEGMENTS):
            next_low, next_bits = SEGMENTS[(at + 1) % len(SEGMENTS)]
            segment = fps >> np.uint64(low) & np.uint64((1 << bits) - 1)
            following = fps >> np.uint64(next_low) & np.uint64((1 << next_bits) - 1)
            changes = np.array([0] + [1 << b for b in range(next_bits)], np.uint64)
            key = (np.uint64(at) << np.uint64(26) | segment << np.uint64(13))[:, None] | following[:, None] ^ changes
            own = np.broadcast_to(changes == 0, key.shape)
            held = np.broadcast_to(fps[:, None], key.shape)
            yield pa.RecordBatch.from_arrays(
                [pa.array(key.reshape(-1).view(np.int64)), pa.array(held.reshape(-1).view(np.int64)), pa.array(own.reshape(-1))],
                ["key", "fp", "own"],
            )


def within(a: np.ndarray, b: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Whether pairs under a key hold the bounds of all chains from the key's place on."""
    apart, place = a ^ b, key >> 26
    holds = np.ones(len(a), bool)
    for at in range(len(SEGMENTS)):
        here = np.flatnonzero(place == at)
        mask = np.uint64(0)
        for chain in range(1, len(SEGMENTS) + 1):
            low, bits = SEGMENTS[(at + chain - 1) % len(SEGMENTS)]
            mask |= np.uint64(((1 << bits) - 1) << low)
            good = np.bitwise_count(apart[here] & mask) <= chain * DISTANCE // len(SEGMENTS)
            holds[here[~good]] = False
            here = here[good]
            if not len(here):
                break
    return holds


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole cells of the sorted rows at a time; of each, links that span its connected members."""
    held: pa.Table | None = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        held = rows if held is None else pa.concat_tables([held, rows])
        cell = np.column_stack([np.asarray(held.column(c)) for c in ("key", "i", "j")])
        if (cell[0] == cell[-1]).all():
            continue
        last = len(cell) - int(np.argmax((cell[::-1] != cell[-1]).any(axis=1)))
        yield from _cells(held.slice(0, last))
        held = held.slice(last)
    if held is not None and held.num_rows:
        yield from _cells(held)


def _cells(rows: pa.Table) -> Iterator[pa.RecordBatch]:
    cell = np.column_stack([np.asarray(rows.column(c)) for c in ("key", "i", "j")])
    own = np.asarray(rows.column("own"))
    fps, node = np.unique(np.asarray(rows.column("fp")), return_inverse=True)
    number = np.concatenate([[0], np.cumsum((cell[1:] != cell[:-1]).any(axis=1))])
    # False sorts before True: a cell has its members first, then its owners.
    member, owner = np.flatnonzero(~own), np.flatnonzero(own)
    first = np.searchsorted(number[member], number[owner])
    last = np.searchsorted(number[member], number[owner], side="right")
    label = np.arange(len(fps))
    bits = fps.view(np.uint64)
    done = np.cumsum(last - first)
    at = 0
    while at < len(owner):
        stop = max(at + 1, int(np.searchsorted(done, (done[at - 1] if at else 0) + PAIRS_AT_ONCE, side="right")))
        sizes = last[at:stop] - first[at:stop]
        starts = np.cumsum(sizes) - sizes
        b = node[member[np.repeat(first[at:stop] - starts, sizes) + np.arange(sizes.sum())]]
        a = np.repeat(node[owner[at:stop]], sizes)
        key = np.repeat(cell[owner[at:stop], 0], sizes)
        open_ = (a != b) & (label[a] != label[b])
        a, b, key = a[open_], b[open_], key[open_]
        good = within(bits[a], bits[b], key)
        merge(label, a[good], b[good])
        at = stop
    linked = np.flatnonzero(label != np.arange(len(fps)))
    yield pa.RecordBatch.from_arrays([pa.array(fps[linked]), pa.array(fps[label[linked]])], ["a", "b"])


def merge(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Gives the components that the pairs connect one label, the smallest."""
    while len(a):
        one, two = label[a], label[b]
        apart = one != two
        a, b, one, two = a[apart], b[apart], one[apart], two[apart]
        low, high = np.minimum(one, two), np.maximum(one, two)
        order = np.argsort(-low, kind="stable")
        label[high[order]] = low[order]  # the smallest comes last and stays
        while True:
            shorter = label[label]
            if (shorter == label).all():
                break
            label[:] = shorter


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp, component_id) of each (doc_id, text); the component is its smallest doc_id."""
    hashed = written_once(fingerprints(docs, shingle), "fingerprints")
    named = _first_of_each(hashed.groupBy("fp").agg(F.min("doc_id").alias("first")))
    return hashed.join(named, "fp").select("doc_id", "fp", F.col("first").alias("component_id"))


def keepers(docs: DataFrame, row_key: Column, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, row_key, kept) of each (doc_id, text): whether the row is the one that stands for its component.

    That is the row with the smallest id, one without an id only where no other is there, and of equal ids the
    one with the smallest ``row_key``. Rows equal in both are kept or not together.
    """
    hashed = written_once(fingerprints(docs, shingle, row_key), "fingerprints")
    place = F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "row_key")
    named = _first_of_each(hashed.groupBy("fp").agg(F.min(place).alias("first")))
    same = F.col("first.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("first.row_key") == F.col("row_key"))
    return hashed.join(named, "fp").select("doc_id", "row_key", same.alias("kept"))


def _first_of_each(known: DataFrame) -> DataFrame:
    """(fp, first) from the same of single fingerprints: the smallest ``first`` of the component."""
    known = written_once(known, "distinct-fingerprints")
    labels = components(links(known))
    rooted = written_once(
        known.join(labels.withColumnRenamed("node", "fp"), "fp", "left").select(
            "fp", "first", F.coalesce("label", "fp").alias("label")
        ),
        "rooted-fingerprints",
    )
    smallest = rooted.groupBy("label").agg(F.min("first").alias("first"))
    return written_once(rooted.drop("first").join(smallest, "label").select("fp", "first"), "named-fingerprints")
