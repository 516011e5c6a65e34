"""Near copies by min-max hashing: both ends of each permutation of the shingles are kept.

A text is a set of hashed shingles; equal sets are one node. A permutation gives a node two values, its smallest and
its largest shingle there, so ``PERMUTATIONS`` of them give twice as many, each equal for two sets with the
probability of their similarity s. A band takes minima of some permutations and maxima of others. Two nodes share a
band's key with probability s^6, and one of 30 bands with 1 - (1 - s^6)^30: at 0.85 all but seven in ten million do.

Candidates are confirmed on their full sets. Each node is first held against one other, the smallest node among those
that it shares keys with, which connects most of a group of copies. What is left is in keys that still hold nodes of
different components: there all members are compared that are not connected yet. The members of a key are dealt to
parts of bounded size and pairs of parts are cells, so that very many members are worked on by many tasks; a cell
returns links that span what it connected, not pairs.

Defined cases: a null text, an empty one and one of blanks have no shingles, are linked with nothing and are their own
component; a text of fewer words than a shingle is one shingle; rows of one id are a document each, of the same
component if their texts are; the component of rows without any id is null, and a row without an id is ``kept`` only
there; an empty table gives no rows. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from xxhash import xxh64_intdigest

from starloom.llm.components import components
from starloom.llm.simhash import merge, shingle_hashes
from starloom.llm.words import chunks
from starloom.session import written_once

SHINGLE, PERCENT = 3, 85
BANDS, ROWS = 30, 6
PERMUTATIONS = BANDS * ROWS // 2
FACTORS = np.array([xxh64_intdigest(b"%d" % i) | 1 for i in range(PERMUTATIONS + 1)], np.uint64)
# Text whose sets a task holds at once.
STEP_BYTES = 1 << 20
# Members and shingles that a part holds at most.
PART, PART_SHINGLES = 2048, 1 << 20
# Rows of two or three longs that are broadcast; more are joined by a shuffle.
BROADCAST_ROWS = 200_000


def shingle_sets(texts: pa.Array, shingle: int = SHINGLE) -> list[np.ndarray]:
    """The different shingles of each text, as sorted hashes."""
    return [np.unique(h) for h in shingle_hashes(texts, shingle)]


def band_keys(sets: list[np.ndarray]) -> np.ndarray:
    """The keys of each set, none of which is empty, a row each."""
    values = np.concatenate(sets)
    starts = np.cumsum([0, *map(len, sets)])[:-1]
    lows, highs = (np.empty((PERMUTATIONS, len(sets)), np.uint64) for _ in range(2))
    for p, factor in enumerate(FACTORS[:PERMUTATIONS]):
        permuted = values * factor
        np.minimum.reduceat(permuted, starts, out=lows[p])
        np.maximum.reduceat(permuted, starts, out=highs[p])
    keys = np.empty((len(sets), BANDS), np.uint64)
    half = ROWS // 2
    for band in range(BANDS):
        key = np.full(len(sets), band, np.uint64)
        after = (band + 1) % BANDS  # an end of a permutation tells a little of the other end
        for value in (*lows[band * half : (band + 1) * half], *highs[after * half : (after + 1) * half]):
            key = (key ^ value) * FACTORS[-1]
            key ^= key >> np.uint64(29)
        keys[:, band] = key
    return keys


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for chunk in chunks(batches, max_bytes=STEP_BYTES):
        sets = shingle_sets(chunk.column("text"))
        sizes = np.array([len(s) for s in sets], np.int64)
        full = np.flatnonzero(sizes)
        nodes, keys = [None] * len(sets), [None] * len(sets)
        if len(full):
            found = band_keys([sets[i] for i in full]).view(np.int64)
            for row, i in enumerate(full.tolist()):
                nodes[i], keys[i] = np.uint64(xxh64_intdigest(sets[i].tobytes())).view(np.int64), found[row]
        yield pa.RecordBatch.from_arrays(
            [
                chunk.column("doc_id"),
                chunk.column("row_key"),
                pa.array(nodes, pa.int64()),
                pa.array(sizes),
                pa.array(keys, pa.list_(pa.int64())),
            ],
            ["doc_id", "row_key", "node", "size", "keys"],
        )


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for chunk in chunks(batches, max_bytes=STEP_BYTES):
        held = [s.tobytes() for s in shingle_sets(chunk.column("text"))]
        yield pa.RecordBatch.from_arrays([chunk.column("node"), pa.array(held, pa.binary())], ["node", "shingles"])


def _few(rows: DataFrame) -> DataFrame:
    return F.broadcast(rows) if rows.count() <= BROADCAST_ROWS else rows


def meetings(nodes: DataFrame) -> DataFrame:
    """(key, node, size, hub, hub_size): the nodes of each key that several have, with the smallest of them."""
    entries = nodes.select(F.explode("keys").alias("key"), "node", "size")
    ends = entries.groupBy("key").agg(F.min("node").alias("hub"), F.max("node").alias("top"))
    shared = written_once(ends.where("hub <> top").select("key"), "shared-keys")
    met = written_once(entries.join(_few(shared), "key"), "key-members")
    hubs = met.groupBy("key").agg(F.min("node").alias("hub"), F.min_by("size", "node").alias("hub_size"))
    return written_once(met.join(_few(written_once(hubs, "key-hubs")), "key"), "meetings")


def similar_sizes(a: str, b: str) -> F.Column:
    """Whether sets of these sizes can be similar enough."""
    return 100 * F.least(a, b) >= PERCENT * F.greatest(a, b)


def enough(common: np.ndarray | int, a: np.ndarray | int, b: np.ndarray | int) -> np.ndarray | bool:
    return 100 * common >= PERCENT * (a + b - common)


def hub_links(met: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b): each node and its smallest hub, where their full sets are similar."""
    pairs = met.where((F.col("node") != F.col("hub")) & similar_sizes("size", "hub_size"))
    pairs = written_once(pairs.groupBy("node").agg(F.min("hub").alias("hub")), "hub-pairs")
    # A hub that very many nodes have is dealt to many tasks.
    parts = pairs.groupBy("hub").agg(F.expr(f"(count(1) - 1) div {PART} + 1").alias("parts"))
    parts = written_once(parts, "hub-parts")
    members = pairs.join(_few(parts), "hub").join(sets, "node")
    members = members.select("hub", F.pmod(F.xxhash64("node"), "parts").alias("part"), "node", "shingles")
    hubs = parts.withColumnRenamed("hub", "node").join(sets, "node")
    hubs = hubs.select(
        F.col("node").alias("hub"), F.explode(F.expr("sequence(0L, parts - 1)")).alias("part"), "node", "shingles"
    )
    dealt = members.unionByName(hubs).repartition("hub", "part")
    return dealt.sortWithinPartitions("hub", "part", F.col("node") != F.col("hub")).mapInArrow(_with_hub, "a long, b long")


def _with_hub(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A hub comes first, then its members."""
    held = np.empty(0, np.uint64)
    for batch in batches:
        linked = []
        hubs, nodes = (batch.column(c).to_pylist() for c in ("hub", "node"))
        for hub, node, shingles in zip(hubs, nodes, batch.column("shingles"), strict=True):
            own = np.frombuffer(shingles.as_buffer(), np.uint64)
            if hub == node:
                held = own.copy()
            else:
                at = np.minimum(np.searchsorted(held, own), len(held) - 1)
                if enough(int((held[at] == own).sum()), len(own), len(held)):
                    linked.append((hub, node))
        a, b = zip(*linked, strict=True) if linked else ((), ())
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def rest_links(met: DataFrame, labels: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b): links between nodes of a key that are of different components by ``labels`` (node, label)."""
    known = met.join(_few(labels), "node", "left").select("key", "node", "size", F.coalesce("label", "node").alias("label"))
    known = written_once(known, "labelled-members")
    open_ = (
        known.groupBy("key")
        .agg(F.min("label").alias("low"), F.max("label").alias("high"), F.sum("size").alias("held"), F.count(F.lit(1)).alias("n"))
        .where("low <> high")
        .select("key", F.expr(f"greatest((held - 1) div {PART_SHINGLES}, (n - 1) div {PART}) + 1").alias("parts"))
    )
    members = known.join(_few(written_once(open_, "open-keys")), "key")
    members = members.withColumn("part", F.pmod(F.xxhash64("node"), "parts"))
    members = written_once(members.select("key", "node", "label", "part", "parts"), "open-members")
    cells = members.join(sets, "node").withColumn("other", F.explode(F.expr("sequence(0L, parts - 1)"))).select(
        "key", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "part", "node", "label", "shingles"
    )
    dealt = cells.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    return dealt.mapInArrow(_in_cells, "a long, b long")


def _in_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole cells of the sorted rows, one after the other."""
    at, held = None, []
    for batch in batches:
        cell = np.column_stack([np.asarray(batch.column(c)) for c in ("key", "i", "j")])
        edges = [0, *(np.flatnonzero((cell[1:] != cell[:-1]).any(axis=1)) + 1).tolist(), len(cell)]
        for first, last in zip(edges, edges[1:], strict=False):
            if first == last:
                continue
            here = tuple(cell[first].tolist())
            if held and here != at:
                yield _cell(pa.Table.from_batches(held))
                held = []
            at = here
            held.append(batch.slice(first, last - first))
    if held:
        yield _cell(pa.Table.from_batches(held))


def _cell(rows: pa.Table) -> pa.RecordBatch:
    nodes, labels = np.asarray(rows.column("node")), np.asarray(rows.column("label"))
    first = np.asarray(rows.column("part")) == rows.column("i")[0].as_py()
    sets = [np.frombuffer(s, np.uint64) for s in rows.column("shingles").to_pylist()]
    order = np.lexsort((nodes, ~first))  # members of the first part lead; in a cell of one part all do
    nodes = nodes[order]
    _, start, known = np.unique(labels[order], return_index=True, return_inverse=True)
    before = start[known]  # the first member of each one's component
    after = connected([sets[i] for i in order], int(first.sum()), before.copy())
    linked = np.flatnonzero((after != before) & (before == np.arange(len(before))))
    return pa.RecordBatch.from_arrays([pa.array(nodes[linked]), pa.array(nodes[after[linked]])], ["a", "b"])


def connected(sets: list[np.ndarray], leaders: int, label: np.ndarray) -> np.ndarray:
    """``label``, the smallest index that each set is connected with, after all pairs of which one is among the first
    ``leaders``; those connected already are not compared."""
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, codes = np.unique(np.concatenate(sets), return_inverse=True)
    by_code = np.argsort(codes, kind="stable")
    begin = np.cumsum(np.concatenate([[0], np.bincount(codes)]))
    starts = np.concatenate([[0], np.cumsum(sizes)])
    for a in range(leaders):
        if (label == label[0]).all():
            break
        mine = codes[starts[a] : starts[a + 1]]
        low, n = begin[mine], begin[mine + 1] - begin[mine]
        at = np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum())
        common = np.bincount(owner[by_code[at]], minlength=len(sets))
        near = np.flatnonzero(enough(common, sizes, sizes[a]) & (label != label[a]))
        merge(label, np.full(len(near), a), near)
    return label


def near_copies(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of each (doc_id, text); the component is its smallest doc_id."""
    keyed = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    keyed = keyed.withColumn("row_key", F.xxhash64("doc_id", "text"))
    schema = "doc_id long, row_key long, node long, size long, keys array<long>"
    hashed = written_once(keyed.mapInArrow(_sketched, schema), "min-max-sketches")
    full = hashed.where("node IS NOT NULL")
    nodes = full.groupBy("node").agg(
        F.min("doc_id").alias("first"), F.min("row_key").alias("row_key"), F.min("size").alias("size"), F.first("keys").alias("keys")
    )
    nodes = written_once(nodes, "distinct-sets")
    met = meetings(nodes)
    chosen = met.select("node").distinct().join(nodes.select("node", "row_key"), "node")
    chosen = written_once(chosen, "candidates")
    texts = keyed.join(_few(chosen), "row_key").groupBy("node").agg(F.min("text").alias("text"))
    sets = written_once(texts.mapInArrow(_sets, "node long, shingles binary"), "shingle-sets")
    links = written_once(hub_links(met, sets), "hub-links")
    more = written_once(rest_links(met, components(links), sets), "other-links")
    labels = components(links.unionByName(more))
    rooted = nodes.select("node", "first").join(_few(labels), "node", "left")
    rooted = written_once(rooted.select("node", "first", F.coalesce("label", "node").alias("label")), "rooted-sets")
    smallest = written_once(rooted.groupBy("label").agg(F.min("first").alias("component_id")), "components")
    named = written_once(rooted.join(smallest, "label").select("node", "component_id"), "named-sets")
    alone = hashed.where("node IS NULL").select("doc_id", "size", F.col("doc_id").alias("component_id"))
    found = full.join(named, "node").select("doc_id", "size", "component_id").unionByName(alone)
    kept = F.col("doc_id").eqNullSafe(F.col("component_id"))
    return found.select("doc_id", F.col("size").alias("n_shingles"), "component_id", kept.alias("kept"))
