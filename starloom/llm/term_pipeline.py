"""Ranked lexical search over term-partitioned postings, through which bundles of items are passed.

The terms of all items are dealt to owners by a hash. The texts of a task are numbered in blocks of bounded size; a
posting row has a block's documents with one term. A bundle is a block's share of the search for some items: it
carries, for each item, the scores of the documents met so far, and only of those. Bundles pass one owner after the
other. In each stage a cogroup brings a bundle together with the owner's postings of its block, whose contributions,
whole numbers throughout, are added. After the last owner a bundle gives its best documents of each item, and of these
the best of all blocks are chosen.

A block bounds what a task holds, whatever the number of documents that have a term; a bundle has at most
``ITEMS`` items, so more items are more bundles.

Defined cases: a null or empty text has no term, is not counted and not found; an item without terms, or without a
document of a score above 0, gives no rows; rows of one doc_id are ranked each, a null id last among equal scores;
items of equal id and text are one item, those of equal id and other texts are ranked each; an empty table gives no
rows. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from starloom.llm.words import chunks, filled, split_words
from starloom.session import written_once

TOP, OWNERS, ITEMS = 10, 4, 256
# Documents and text of a block.
BLOCK_ROWS, BLOCK_BYTES = 4096, 4 << 20
# Terms of items that are broadcast; more are joined by a shuffle. Their text is bounded by the length.
BROADCAST_TERMS, BROADCAST_LENGTH = 200_000, 200
# What stands between terms becomes a blank, and A-Z become a-z; bytes above 127 stay.
SEPARATORS = "[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
BYTES = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in range(256)).lower()
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

BUNDLE = "block long, bundle long, ids array<long>, norms array<long>, keys binary, scores binary"


def plain_terms(texts: pa.Array) -> pa.Array:
    """The texts with blanks for all that is no term, and with A-Z lower-cased."""
    texts = filled(texts).cast(pa.large_string())
    _, edges, data = texts.buffers()
    edges = np.frombuffer(edges, np.int64, len(texts) + 1, 8 * texts.offset)
    held = data.slice(int(edges[0]), int(edges[-1] - edges[0])).to_pybytes() if edges[-1] > edges[0] else b""
    buffers = [None, pa.py_buffer(edges - edges[0]), pa.py_buffer(held.translate(BYTES))]
    return pa.Array.from_buffers(pa.large_string(), len(texts), buffers)


def postings(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """A written table: per block and one of ``terms`` the places of its documents and their occurrences; per block,
    with a null term, the ids and sizes of its documents."""

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for chunk in chunks(batches, max_bytes=BLOCK_BYTES):
            for at in range(0, chunk.num_rows, BLOCK_ROWS):
                yield from _block(chunk.slice(at, BLOCK_ROWS), block)
                block += 1

    named = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    schema = "block long, term string, places binary, times binary, ids array<long>, sizes array<long>"
    rows, small = named.mapInArrow(listed, schema), few(terms)
    if not small:
        rows = written_once(rows, "all-postings")
    wanted = terms.select("term", F.lit(True).alias("wanted"))
    met = rows.join(F.broadcast(wanted) if small else wanted, "term", "left")
    return written_once(met.where("term IS NULL OR wanted").drop("wanted"), "term-postings")


def _block(rows: pa.RecordBatch, block: int) -> Iterator[pa.RecordBatch]:
    words = split_words(plain_terms(rows.column("text")))
    n_terms = len(words.dictionary)
    pairs, times = np.unique(words.codes.astype(np.int64) * rows.num_rows + words.owner, return_counts=True)
    term, place = np.divmod(pairs, rows.num_rows)
    starts = np.searchsorted(term, np.arange(n_terms + 1))
    used = np.flatnonzero(np.diff(starts))
    lists = lambda values: pa.array([values[a:b].tobytes() for a, b in zip(starts[used], starts[used + 1], strict=True)], pa.binary())
    none = lambda n: pa.nulls(n, pa.list_(pa.int64()))
    names = ["block", "term", "places", "times", "ids", "sizes"]
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(np.full(len(used), block)),
            words.dictionary.cast(pa.string()).take(pa.array(used)),
            lists(place.astype(np.uint16)),
            lists(times.astype(np.uint32)),
            none(len(used)),
            none(len(used)),
        ],
        names,
    )
    whole = [pa.array([column.to_pylist()], pa.list_(pa.int64())) for column in (rows.column("doc_id"), pa.array(words.counts))]
    yield pa.RecordBatch.from_arrays(
        [pa.array([block]), *(pa.nulls(1, kind) for kind in (pa.string(), pa.binary(), pa.binary())), *whole], names
    )


def item_terms(items: DataFrame) -> DataFrame:
    """(item, item_id, bundle, place, term): the terms of each item once; ``place`` numbers a bundle's items."""
    distinct = items.select(F.col("item_id").cast("long"), F.col("text").cast("string")).distinct()
    terms = F.array_remove(F.split(F.coalesce("text", F.lit("")), SEPARATORS), "")
    terms = F.array_distinct(F.transform(terms, lambda t: F.translate(t, UPPER, LOWER)))
    keyed = distinct.select("item_id", F.xxhash64("item_id", "text").alias("item"), terms.alias("terms"))
    # Numbered without one task for all: by a hash, and in the order of the hash in each.
    shares = F.pmod("item", F.lit(256))
    numbered = keyed.where(F.size("terms") > 0).withColumn("share", shares)
    number = F.row_number().over(Window.partitionBy("share").orderBy("item")) - 1
    sizes = numbered.groupBy("share").count()
    before = F.sum("count").over(Window.orderBy("share").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("share", F.coalesce(before, F.lit(0)).alias("start"))  # 256 rows
    placed = numbered.withColumn("number", number).join(F.broadcast(starts), "share")
    number = (F.col("start") + F.col("number")).alias("number")
    placed = placed.select("item", "item_id", number, "terms")
    return placed.select(
        "item",
        "item_id",
        F.expr(f"number div {ITEMS}").alias("bundle"),
        (F.col("number") % ITEMS).cast("int").alias("place"),
        F.explode("terms").alias("term"),
    )


def few(terms: DataFrame) -> bool:
    """Whether rows of ``term`` are few and short enough to be broadcast."""
    size = terms.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.max(F.length("term")), F.lit(0)).alias("longest")).first()
    return size.n <= BROADCAST_TERMS and size.longest <= BROADCAST_LENGTH


def search(docs: DataFrame, items: DataFrame, top: int = TOP, owners: int = OWNERS) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` documents of each item, of scores above 0."""
    asked = written_once(item_terms(items), "item-terms")
    index = postings(docs, written_once(asked.select("term").distinct(), "wanted-terms"))
    blocks = index.where("term IS NULL").select("block", "ids", "sizes")
    n_docs, n_terms = blocks.select(F.explode("sizes").alias("n")).agg(F.count_if(F.col("n") > 0), F.sum("n")).first()
    lists = written_once(asking(index, asked, n_docs, owners), "asked-postings")
    n_bundles = (asked.agg(F.max("bundle")).first()[0] or 0) + 1
    norm = F.expr(f"transform(sizes, n -> 10L + (90L * n * {n_docs}L) div {max(n_terms or 0, 1)}L)")
    bundles = blocks.select(
        "block",
        F.explode(F.expr(f"sequence(0L, {n_bundles - 1}L)")).alias("bundle"),
        "ids",
        norm.alias("norms"),
        *(F.unhex(F.lit("")).alias(c) for c in ("keys", "scores")),
    )
    for owner in range(owners):
        owned = lists.where(F.col("owner") == owner).select("block", "bundle", "places", "times", "askers")
        bundles = bundles.groupBy("block", "bundle").cogroup(owned.groupBy("block", "bundle"))
        bundles = bundles.applyInArrow(added, BUNDLE)
    found = bundles.mapInArrow(lambda batches: best(batches, top), "bundle long, place int, doc_id long, score long")
    order = Window.partitionBy("bundle", "place").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    names = asked.select("bundle", "place", "item_id").distinct()
    return names.join(ranked, ["bundle", "place"]).select("item_id", "rank", "doc_id", "score")


def asking(index: DataFrame, asked: DataFrame, n_docs: int, owners: int) -> DataFrame:
    """(block, bundle, owner, places, times, askers): postings and who asks for their term, at most ``ITEMS`` a row."""
    held = index.where("term IS NOT NULL").select("block", "term", "places", "times")
    frequency = held.groupBy("term").agg(F.sum(F.octet_length("places") / 2).cast("long").alias("df"))
    weight = F.floor(1000 * F.ln((2 * n_docs + 2) / (2 * F.col("df") + 1))).cast("long")
    askers = (
        asked.join(frequency, "term")
        .groupBy("term", "bundle")
        .agg(F.first(weight).alias("weight"), F.sort_array(F.collect_list("place")).alias("askers"))
        .withColumn("owner", F.pmod(F.xxhash64("term"), F.lit(owners)).cast("int"))
    )
    askers = written_once(askers, "term-askers")
    return held.join(F.broadcast(askers) if few(askers) else askers, "term").drop("term").withColumn(
        "askers", F.struct("weight", "askers")
    )


def added(bundle: pa.Table, owned: pa.Table) -> pa.Table:
    """A bundle after an owner: its scores and the contributions of the owner's postings."""
    if not owned.num_rows or not bundle.num_rows:
        return bundle
    norms = np.array(bundle.column("norms")[0].as_py(), np.int64)
    keys = np.frombuffer(bundle.column("keys")[0].as_py(), np.uint32)
    askers = owned.column("askers").combine_chunks()
    weights, lists = askers.field("weight").to_pylist(), askers.field("askers")
    n_items = int(max(pc.max(lists.flatten()).as_py(), keys[-1] >> 16 if len(keys) else 0)) + 1
    held = np.zeros((n_items, len(norms)), np.int64)
    held[keys >> 16, keys & 0xFFFF] = np.frombuffer(bundle.column("scores")[0].as_py(), np.int64)
    rows = zip(owned.column("places").to_pylist(), owned.column("times").to_pylist(), weights, lists.to_pylist(), strict=True)
    for places, times, weight, who in rows:
        at, tf = np.frombuffer(places, np.uint16), np.frombuffer(times, np.uint32).astype(np.int64)
        held[np.ix_(who, at)] += weight * (1_000_000_000 * tf // (1000 * tf + 8 * norms[at]))
    item, at = np.nonzero(held)
    keys = (item.astype(np.uint32) << 16 | at.astype(np.uint32)).tobytes()
    found = {"keys": keys, "scores": held[item, at].tobytes()}
    for name, value in found.items():
        bundle = bundle.set_column(bundle.schema.get_field_index(name), name, pa.array([value], pa.binary()))
    return bundle


def best(batches: Iterator[pa.RecordBatch], top: int) -> Iterator[pa.RecordBatch]:
    """The ``top`` documents of each item in each bundle."""
    for batch in batches:
        for row in range(batch.num_rows):
            keys = np.frombuffer(batch.column("keys")[row].as_py(), np.uint32)
            scores = np.frombuffer(batch.column("scores")[row].as_py(), np.int64)
            ids = batch.column("ids")[row].values
            item, at = keys >> 16, keys & 0xFFFF
            missing = np.asarray(ids.is_null())[at]
            known = pc.fill_null(ids, 0).to_numpy()[at]
            order = np.lexsort((known, missing, -scores, item))
            rank = np.arange(len(order)) - np.searchsorted(item[order], item[order])
            chosen = order[rank < top]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(chosen), batch.column("bundle")[row].as_py(), np.int64)),
                    pa.array(item[chosen].astype(np.int32)),
                    ids.take(pa.array(at[chosen])),
                    pa.array(scores[chosen]),
                ],
                ["bundle", "place", "doc_id", "score"],
            )
