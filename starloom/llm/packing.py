"""Best-fit packing of token sequences, bettered by a swap-based local search.

What a packing depends on is how many pieces there are of each length. That table has at most
``capacity`` rows at any corpus size, so bins are planned on it: best fit by decreasing length, over kinds
of bins with a number of copies, then a local search between underfull kinds which moves a piece, or
exchanges one for one or two for one, whenever that raises the sum of squared fills, until bins are empty.
Spark cuts and counts the pieces, ranks them within their length without gathering a length in one task,
and deals them to the planned places.

Defined cases: a null or empty text is a document of one token, its end; repeated ids are packed as they
are, each row on its own; an empty table gives no rows. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from starloom.llm.tokens import encoder
from starloom.llm.words import chunks
from starloom.session import written_once

CAPACITY = 4096
# Pairs of kinds of bins that the local search looks at; it stops earlier where no bin can be saved.
TRIALS = 50_000
# Text that one step encodes.
STEP_BYTES = 2 << 20

PIECES = "doc_id long, piece int, start long, length long, ids binary, part int, rank long"


def cut(docs: DataFrame, tokenizer: str, end: int, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of at most ``capacity`` ids of each (doc_id, text), which ends with the id ``end``.

    ``ids`` are little-endian unsigned 32-bit numbers; ``part`` and ``rank`` number the pieces of a
    length within their task. To be written before it is read twice.
    """

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for chunk in chunks(batches, max_bytes=STEP_BYTES):
            ids, starts = encoder(tokenizer).encode(chunk.column("text"), end)
            counts = -(-np.diff(starts) // capacity)
            owner = np.repeat(np.arange(len(counts)), counts)
            piece = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
            first = starts[owner] + piece * capacity
            edges = np.append(first, starts[-1])
            length = np.diff(edges)
            order = np.argsort(length, kind="stable")
            ordered = length[order]
            rank = np.empty(len(owner), np.int64)
            rank[order] = np.arange(len(owner)) - np.searchsorted(ordered, ordered) + before[ordered]
            before += np.bincount(length, minlength=capacity + 1)
            held = pa.Array.from_buffers(
                pa.large_binary(), len(owner), [None, pa.py_buffer(4 * edges), pa.py_buffer(ids.astype("<u4"))]
            ).cast(pa.binary())
            yield pa.RecordBatch.from_arrays(
                [
                    chunk.column("doc_id").take(pa.array(owner)),
                    pa.array(piece.astype(np.int32)),
                    pa.array(piece * capacity),
                    pa.array(length),
                    held,
                    pa.array(np.full(len(owner), part, np.int32)),
                    pa.array(rank),
                ],
                ["doc_id", "piece", "start", "length", "ids", "part", "rank"],
            )
        encoder(tokenizer).forget()

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(pieces, PIECES)


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (a written table) without part and rank, with sequence_id and offset (long)."""
    counts = pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = written_once(
        counts.withColumn("base", F.coalesce(F.sum("n").over(earlier), F.lit(0))), "packing-bases"
    )
    histogram = {r[0]: r[1] for r in bases.groupBy("length").agg(F.sum("n")).collect()}
    places = pieces.sparkSession.sparkContext.broadcast(Places(plan(histogram, capacity)))
    ranked = pieces.join(bases.drop("n"), ["part", "length"]).withColumn("rank", F.col("rank") + F.col("base"))
    ranked = ranked.select(*(c for c in pieces.columns if c != "part"))
    kept = [f for f in ranked.schema.fields if f.name != "rank"]
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = places.value.of(np.asarray(batch.column("length")), np.asarray(batch.column("rank")))
            names = [f.name for f in kept]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in names), *map(pa.array, found)], [*names, "sequence_id", "offset"]
            )

    return ranked.mapInArrow(dealt, f"{fields}, sequence_id long, offset long")


class Places:
    """Where the r-th piece of a length goes. Kinds of bins hold runs of equal lengths, so the table has
    a row for each run of each kind."""

    def __init__(self, kinds: list[tuple[Counter, int]]):
        used: Counter = Counter()
        rows, base = [], 0
        for held, copies in kinds:
            offset = 0
            for length, times in sorted(held.items(), reverse=True):
                rows.append((length, used[length], times, base, offset))
                used[length] += times * copies
                offset += times * length
            base += copies
        table = np.array(sorted(rows), np.int64).reshape(-1, 5)
        self.length, self.first, self.times, self.base, self.offset = table.T
        self.lengths = np.unique(self.length)

    def of(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        run = np.empty(len(length), np.int64)
        for each in np.unique(length):
            low = np.searchsorted(self.length, each)
            high = np.searchsorted(self.length, each, side="right")
            here = length == each
            run[here] = low + np.searchsorted(self.first[low:high], rank[here], side="right") - 1
        copy, nth = np.divmod(rank - self.first[run], self.times[run])
        return self.base[run] + copy, self.offset[run] + nth * length


def plan(histogram: dict[int, int], capacity: int = CAPACITY, trials: int = TRIALS) -> list[tuple[Counter, int]]:
    """Kinds of bins as (lengths, copies) that hold ``histogram``: number of pieces by length."""
    kinds = best_fit(histogram, capacity)
    least = -(-sum(k * n for k, n in histogram.items()) // capacity)
    return local_search(kinds, capacity, least, trials)


def best_fit(histogram: dict[int, int], capacity: int) -> list[tuple[Counter, int]]:
    """Best fit decreasing: each piece goes where it leaves the least room, all copies of a kind at once."""
    open_: dict[int, list[tuple[Counter, int]]] = {}
    frees: list[int] = []  # sorted keys of ``open_``
    full: list[tuple[Counter, int]] = []

    def put(held: Counter, copies: int, free: int) -> None:
        if not copies:
            return
        if not free:
            full.append((held, copies))
        elif free in open_:
            open_[free].append((held, copies))
        else:
            open_[free] = [(held, copies)]
            insort(frees, free)

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            at = bisect_left(frees, length)
            if at < len(frees):
                free = frees[at]
                held, copies = open_[free].pop()
                if not open_[free]:
                    del open_[free], frees[at]
            else:
                held, copies, free = Counter(), left, capacity
            times = free // length
            filled = min(copies, left // times)
            put(held + Counter({length: times}), filled, free - times * length)
            copies, left = copies - filled, left - filled * times
            if copies and left:  # fewer than ``times`` are left, for one bin
                put(held + Counter({length: left}), 1, free - left * length)
                copies, left = copies - 1, 0
            if held:
                put(held, copies, free)
    return full + [kind for kinds in open_.values() for kind in kinds]


def local_search(
    kinds: list[tuple[Counter, int]], capacity: int, least: int, trials: int = TRIALS
) -> list[tuple[Counter, int]]:
    """Exchanges between underfull kinds, the emptiest giving first, as long as bins may be saved."""
    fill = lambda held: sum(k * n for k, n in held.items())
    done = [k for k in kinds if fill(k[0]) == capacity]
    under = sorted((k for k in kinds if fill(k[0]) < capacity), key=lambda k: fill(k[0]))
    total = sum(n for _, n in kinds)
    giver = 0
    while giver < len(under) and total > least and trials > 0:
        held, copies = under[giver]
        change = None
        for other in range(len(under) - 1, -1, -1):
            trials -= 1
            if other == giver and copies < 2:
                continue
            taker, there = under[other]
            change = exchange(taker, held, capacity - fill(taker), fill(taker) - fill(held))
            if change or trials <= 0:
                break
        if not change:
            giver += 1
            continue
        give, back = change
        at_once = copies // 2 if other == giver else min(copies, there)
        after = [(taker + give - back, at_once), (held - give + back, at_once)]
        if other == giver:
            after.append((held, copies - 2 * at_once))
        else:
            after += [(held, copies - at_once), (taker, there - at_once)]
        for gone in sorted({giver, other}, reverse=True):
            del under[gone]
        for kind, n in after:
            if n and not kind:
                total -= n
            elif n and fill(kind) == capacity:
                done.append((kind, n))
            elif n:
                insort(under, (kind, n), key=lambda k: fill(k[0]))
        giver = 0
    return done + under


def exchange(taker: Counter, giver: Counter, free: int, ahead: int) -> tuple[Counter, Counter] | None:
    """What goes to ``taker`` and what comes back, so that it gains the most but no more than ``free``.

    With ``ahead`` more in the taker than in the giver, the sum of squares rises by
    2 * gain * (ahead + gain), so any gain does where ``ahead`` is not negative.
    """
    mine = sorted(giver)
    best, found = max(0, -ahead), None
    singles = [(x, Counter({x: 1})) for x in mine]
    at = bisect_right(mine, free) - 1
    if at >= 0 and mine[at] > best:
        best, found = mine[at], (singles[at][1], Counter())
    for back in taker:
        at = bisect_right(mine, back + free) - 1
        if at >= 0 and mine[at] - back > best:
            best, found = mine[at] - back, (singles[at][1], Counter({back: 1}))
        for x in mine:
            at = bisect_right(mine, back + free - x) - 1
            if at >= 0 and mine[at] == x and giver[x] < 2:
                at -= 1
            if at >= 0 and x + mine[at] - back > best:
                best = x + mine[at] - back
                found = (Counter({x: 1}) + Counter({mine[at]: 1}), Counter({back: 1}))
        if best == free:
            break
    return found
