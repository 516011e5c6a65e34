"""Language identification by prediction by partial matching.

Each language has context trees over bytes, of orders 0 to 3, with the counts of its training texts. A
symbol that a context has seen c times among n has probability c / (n + q), where q is the number of its
different symbols; with q / (n + q) the model escapes to the next shorter context, whose probabilities
are divided by what its symbols not seen here hold together (exclusion). So the probabilities of a
context sum to one, and the summed code lengths are those of an exact coder with frozen statistics.

Statistics are counted over all training texts. A context is kept where it holds at least ``MIN_SHARE``
of its language's bytes, which bounds a tree by 1 / MIN_SHARE contexts an order at any corpus size; texts
in a context that is not kept are predicted from the longest kept one.

Any number of languages is learned. Where their tables together would be larger than ``TABLE_BYTES``, the
languages are split into groups, each with tables and a pass over the texts of its own; a language's code
lengths do not depend on its group, and each text keeps the shortest of all.

Defined cases: null texts and texts without a letter are ``und`` with score 0; ids may repeat; null
languages teach nothing; without any training text all is ``und``; ties go to the first language by name.
Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from starloom.llm.words import chunks, filled
from starloom.operators.bounded import small_side
from starloom.session import written_once

ORDER = 3
MIN_SHARE = 1e-4
# Of the code lengths of a group of languages, which the driver makes and each task holds.
TABLE_BYTES = 128 << 20
PAD = b" " * ORDER
CHUNK = 2 << 20


class Trees(NamedTuple):
    """``symbol``: class of each byte. ``row``: of each three classes, the row of ``bits`` that predicts
    what follows. ``bits``: code length by row * classes + class and language."""

    languages: list[str]
    symbol: np.ndarray
    row: np.ndarray
    bits: np.ndarray


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of some texts, each text after three blanks, and where each text's blanks begin."""
    joined = pa.array([PAD + t for t in filled(texts).cast(pa.binary()).to_pylist()], pa.large_binary())
    offsets = np.frombuffer(joined.buffers()[1], np.int64)[: len(joined) + 1]
    return np.frombuffer(joined.buffers()[2] or b"", np.uint8)[: offsets[-1]], offsets


def grams(data: np.ndarray) -> np.ndarray:
    """The four bytes up to and with each byte, from the fourth byte on, as one number."""
    wide = data.astype(np.uint32)
    return wide[:-3] << 24 | wide[1:-2] << 16 | wide[2:-1] << 8 | wide[3:]


def count_contexts(texts: DataFrame) -> DataFrame:
    """(lang, gram, n) over (lang, text): the four bytes as a long, counted within each task first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        for chunk in chunks(batches, max_bytes=4 * CHUNK):
            names = np.array(chunk.column("lang").to_pylist(), dtype=object)
            for name in sorted(set(names)):
                data, offsets = text_bytes(chunk.column("text").filter(pa.array(names == name)))
                found = grams(data)
                inside = np.ones(len(found), bool)
                for back in range(1, ORDER + 1):  # not those across two texts
                    inside[offsets[1:-1] - back] = False
                held.setdefault(name, []).append(np.unique(found[inside], return_counts=True))
                if len(held[name]) >= 16:
                    held[name] = [_merged(held[name])]
        for name, parts in held.items():
            gram, n = _merged(parts)
            for at in range(0, len(gram), 50_000):
                part = slice(at, at + 50_000)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(gram[part])), pa.array(gram[part].astype(np.int64)), pa.array(n[part])],
                    ["lang", "gram", "n"],
                )

    counted = texts.mapInArrow(count, "lang string, gram long, n long")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    gram, inverse = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    return gram, np.bincount(inverse, np.concatenate([p[1] for p in parts])).astype(np.int64)


def kept_counts(counts: DataFrame, min_share: float = MIN_SHARE) -> DataFrame:
    """(lang, depth, context, symbols) of the contexts of all orders that are kept. ``counts`` is read twice
    and should be a written table."""
    orders = F.explode(F.sequence(F.lit(0), F.lit(ORDER)))
    context = F.expr("(gram div 256) % shiftleft(1L, 8 * depth)")
    every = (
        counts.withColumn("depth", orders)
        .groupBy("lang", "depth", context.alias("context"), (F.col("gram") % 256).alias("symbol"))
        .agg(F.sum("n").alias("n"))
    )
    # A context has 256 symbols at most.
    totals = every.groupBy("lang", "depth", "context").agg(
        F.sum("n").alias("total"), F.collect_list(F.struct("symbol", "n")).alias("symbols")
    )
    sizes, _ = small_side(counts.groupBy("lang").agg(F.sum("n").alias("size")))
    return totals.join(sizes, "lang").where(F.col("total") >= min_share * F.col("size")).select(
        "lang", "depth", "context", "symbols"
    )


def groups(contexts: dict[str, int], classes: int, table_bytes: int = TABLE_BYTES) -> list[list[str]]:
    """Languages by name in groups whose tables are within ``table_bytes``, or of one language, from the number of
    contexts of each."""
    found: list[list[str]] = []
    held = 0
    for name in sorted(contexts):
        held += contexts[name]
        if not found or 4 * held * classes * (len(found[-1]) + 1) > table_bytes:
            found.append([])
            held = contexts[name]
        found[-1].append(name)
    return found


def build(kept: list[tuple[str, int, int, list[tuple[int, int]]]], symbols_seen: Iterable[int]) -> Trees:
    """Tables of code lengths from rows of ``kept_counts`` of some languages; ``symbols_seen`` are the bytes that
    any language has."""
    languages = sorted({row[0] for row in kept})
    seen = sorted({*symbols_seen, PAD[0]})
    classes = len(seen) + 1  # class 0: bytes never seen in a kept context
    symbol = np.zeros(256, np.int64)
    symbol[seen] = np.arange(1, classes)
    trees: dict[tuple[int, tuple[int, ...]], dict[int, np.ndarray]] = {}
    for name, depth, context, symbols in kept:
        path = tuple(int(symbol[context >> 8 * back & 255]) for back in reversed(range(depth)))
        n = np.zeros(classes)
        for s, count in symbols:
            n[symbol[s]] = count
        trees.setdefault((depth, path), {})[languages.index(name)] = n
    row = np.zeros((classes,) * ORDER, np.int32)
    chances = {(-1, ()): np.full((classes, len(languages)), 1 / classes)}
    table: list[np.ndarray] = []
    for depth, path in sorted(trees):
        # The longest shorter context that is kept, or the even chances below order 0.
        shorter = [(d, path[depth - d :]) for d in range(depth - 1, -1, -1)] + [(-1, ())]
        back = next(k for k in shorter if k in chances)
        below = chances[back].copy()
        for language, n in trees[depth, path].items():
            total, new = n.sum(), n == 0
            kinds = classes - new.sum()
            rest = below[new, language].sum()
            here = n / (total + kinds)
            here[new] = below[new, language] / rest * kinds / (total + kinds)
            below[:, language] = here
        chances[depth, path] = below
        row[(slice(None),) * (ORDER - depth) + path] = len(table)
        bits = -np.log2(below)
        bits[0] += np.log2(max(1, 256 - len(seen)))  # which of the bytes never seen
        table.append(bits)
    found = np.concatenate(table) if table else np.zeros((0, 0))
    return Trees(languages, symbol, row.reshape(-1), found.astype(np.float32))


def learn(docs: DataFrame, min_share: float = MIN_SHARE, table_bytes: int = TABLE_BYTES) -> list[Trees]:
    """Trees from the texts of (text, lang), for each group of languages."""
    known = docs.where("lang IS NOT NULL AND text IS NOT NULL").select(
        F.col("lang").cast("string"), F.col("text").cast("string")
    )
    counts = written_once(count_contexts(known), "contexts")
    kept = written_once(kept_counts(counts, min_share), "kept-contexts")
    contexts = {r[0]: r[1] for r in kept.groupBy("lang").agg(F.count(F.lit(1))).collect()}
    seen = [r[0] for r in kept.where("depth = 0").select(F.explode("symbols.symbol")).distinct().collect()]
    return [
        build([tuple(r) for r in kept.where(F.col("lang").isin(names)).collect()], seen)
        for names in groups(contexts, len(seen) + 2, table_bytes)
    ]


def code_lengths(trees: Trees, texts: pa.Array) -> np.ndarray:
    """Bits of each text in each language."""
    data, offsets = text_bytes(texts)
    classes = int(trees.symbol.max()) + 1
    code = trees.symbol[data]
    if len(code) <= ORDER:
        return np.zeros((len(texts), len(trees.languages)))
    context = (code[:-3] * classes + code[1:-2]) * classes + code[2:-1]
    bits = trees.bits[trees.row[context] * classes + code[3:]]
    # Position p of ``bits`` codes byte p + 3, so text i has offsets[i] to offsets[i + 1] - 3.
    sizes = np.diff(offsets) - ORDER
    total = np.zeros((len(texts), len(trees.languages)))
    filled_ = np.flatnonzero(sizes > 0)
    if len(filled_):
        edges = np.column_stack([offsets[filled_], offsets[filled_] + sizes[filled_]]).reshape(-1)
        padded = np.concatenate([bits, np.zeros((1, bits.shape[1]), np.float32)])
        total[filled_] = np.add.reduceat(padded, edges, dtype=np.float64)[::2]
    return total


def shortest(docs: DataFrame, trees: Trees) -> DataFrame:
    """Rows of (doc_id, text, key, lettered) without the text, and with the language of the shortest code, its bits
    and the summed probability of all languages in shares of that of this one (mass)."""
    shared = docs.sparkSession.sparkContext.broadcast(trees)
    kept = ["doc_id", "key", "lettered"]

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = shared.value
        names = np.array(trees.languages, dtype=object)
        for chunk in chunks(batches, max_bytes=CHUNK):
            bits = code_lengths(trees, chunk.column("text"))
            least = bits.min(axis=1)
            mass = np.exp2(np.maximum(-1000, least[:, None] - bits)).sum(axis=1)
            found = [pa.array(names[bits.argmin(axis=1)], pa.string()), pa.array(least), pa.array(mass)]
            yield pa.RecordBatch.from_arrays(
                [*(chunk.column(c) for c in kept), *found], [*kept, "lang", "bits", "mass"]
            )

    fields = "doc_id long, key string, lettered boolean, lang string, bits double, mass double"
    return docs.mapInArrow(coded, fields)


def predict(docs: DataFrame, trees: list[Trees]) -> DataFrame:
    """(doc_id, lang_pred, score); the score is the language's share of the probability of the text."""
    lettered = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    # With one group of languages a row is done where it is read, and needs no key.
    key = F.sha2("text", 256) if len(trees) > 1 else F.lit(None).cast("string")
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).select(
        "doc_id", "text", key.alias("key"), lettered.alias("lettered")
    )
    if not trees:
        judged = rows.withColumns({"lang": F.lit("und"), "mass": F.lit(1.0), "lettered": F.lit(False)})
    elif len(trees) == 1:
        judged = shortest(rows, trees[0])
    else:
        judged = rows.drop("text").join(written_once(_over_groups(rows, trees), "shortest"), "key", "left")
    return judged.select(
        "doc_id",
        F.when(F.col("lettered"), F.col("lang")).otherwise("und").alias("lang_pred"),
        F.when(F.col("lettered"), 1 / F.col("mass")).otherwise(0.0).alias("score"),
    )


def _over_groups(rows: DataFrame, trees: list[Trees]) -> DataFrame:
    """(key, lang, mass) of each different lettered text over all groups, one row a text."""
    texts = rows.where("lettered")
    passes = [shortest(texts, group).withColumn("group", F.lit(i)) for i, group in enumerate(trees)]
    code = F.min(F.struct("bits", "group", "lang", "mass")).alias("code")
    each = reduce(DataFrame.unionByName, passes).groupBy("key", "group").agg(code)
    best = each.groupBy("key").agg(F.min("code").alias("best"), F.array_sort(F.collect_list("code")).alias("codes"))
    mass = F.aggregate(
        "codes",
        F.lit(0.0),
        lambda total, c: total + c["mass"] * F.pow(F.lit(2.0), F.greatest(F.lit(-1000.0), F.col("best.bits") - c["bits"])),
    )
    return best.select("key", F.col("best.lang").alias("lang"), mass.alias("mass"))
