"""CSV records of files that many tasks read, line breaks inside quoted fields included.

A file is read as lines in blocks. Whether a line begins a record depends on all quotes before it, so each line is
taken as a function from the state it begins in (outside or inside a quoted field) to the state it ends in. A task
composes the functions of a block, a scan over the blocks' compositions gives the state each block begins in, and a
second pass then cuts each block into records on its own. What a block begins or ends with of a record that spans
blocks is a fragment, at most two a block, and fragments are put together by a small shuffle. Lines are never shuffled.

A quote opens a field only where the field begins; elsewhere in an unquoted field it is a character. Inside quotes
two quotes are one. Lines end with a line feed; in a file whose first line ends with a carriage return before it, that
is part of every line end, also within fields.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from starloom.operators.bounded import small_side
from starloom.session import written_once

# States within a line: at the beginning of a field, in an unquoted field, inside quotes, after a quote inside quotes.
BEGIN, PLAIN, INSIDE, CLOSED = range(4)
AT = ["file", "start"]
RECORD = "file string, start long, number long, head boolean, tail boolean, record string"
BLOCK = "file string, start long, outside boolean, inside boolean, starts_outside long, starts_inside long, first string"


def lines(spark: SparkSession, path: str) -> DataFrame:
    """(line, blank, file, start, from_outside, from_inside): the lines of all files in blocks, and whether each ends
    inside quotes if it begins outside or inside of them."""
    found = spark.read.option("lineSep", "\n").text(path).select(
        F.col("value").alias("line"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
    )
    quoted = F.contains("line", F.lit('"'))
    return found.withColumns(
        {
            "blank": F.col("line").isin("", "\r"),
            "from_outside": F.when(quoted, _ends_inside("line", BEGIN)).otherwise(False),
            "from_inside": F.when(quoted, _ends_inside("line", INSIDE)).otherwise(True),
        }
    )


def _ends_inside(line: str, state: int) -> Column:
    """Whether a line that begins in ``state`` ends inside quotes, by the pieces between its quotes."""
    pieces = F.split(line, '"', -1)
    quote = lambda s: (
        F.when(s == BEGIN, INSIDE).when(s == INSIDE, CLOSED).when(s == CLOSED, INSIDE).otherwise(PLAIN)
    )
    piece = lambda s, p: (
        F.when((p == "") | (s == INSIDE), s).when(p.endswith(","), BEGIN).otherwise(PLAIN)
    )
    first = piece(F.lit(state), pieces[0])
    rest = F.slice(pieces, 2, F.size(pieces))
    return F.aggregate(rest, first, lambda s, p: piece(quote(s), p)) == INSIDE


def begun_inside(outside: np.ndarray, inside: np.ndarray, state: bool) -> tuple[np.ndarray, bool]:
    """Whether each line begins inside quotes if the first one begins in ``state``, and the state after the last.

    ``outside`` and ``inside`` tell how a line ends that begins so. A line that ends alike either way sets the state;
    of the others one turns it and one keeps it, so what counts is the number of turns since the last that sets it.
    """
    n = len(outside)
    sets, turns = outside == inside, outside & ~inside
    place = np.where(sets, np.arange(n), -1)
    last = np.maximum.accumulate(place) if n else place
    turned = np.concatenate([[0], np.cumsum(turns)])
    base = np.where(last >= 0, outside[last], state)
    since = turned[1:] - np.where(last >= 0, turned[last + 1], 0)
    after = base ^ (since % 2 == 1)
    return np.concatenate([[state], after[:-1]])[:n].astype(bool), bool(after[-1]) if n else state


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[str, int], pa.RecordBatch]]:
    """Stretches of rows of one block."""
    starts, files = np.asarray(batch.column("start")), batch.column("file").dictionary_encode().indices.to_numpy()
    cut = np.flatnonzero((starts[1:] != starts[:-1]) | (files[1:] != files[:-1])) + 1
    for low, high in zip([0, *cut.tolist()], [*cut.tolist(), len(starts)], strict=True):
        if high > low:
            yield (batch.column("file")[low].as_py(), int(starts[low])), batch.slice(low, high - low)


def _flags(rows: pa.RecordBatch, name: str) -> np.ndarray:
    return rows.column(name).to_numpy(zero_copy_only=False).astype(bool)


def _composed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each block, how it ends and how many records begin in it, if it begins outside or inside quotes; and its
    first line that is not blank, where it begins a file."""
    found: dict[tuple[str, int], list] = {}
    for batch in batches:
        for at, rows in _runs(batch):
            held = found.setdefault(at, [False, True, 0, 0, None])
            full = ~_flags(rows, "blank")
            for i in (0, 1):
                begun, held[i] = begun_inside(_flags(rows, "from_outside"), _flags(rows, "from_inside"), held[i])
                held[2 + i] += int((full & ~begun).sum())
            if at[1] == 0 and held[4] is None and full.any():
                held[4] = rows.column("line")[int(full.argmax())].as_py()
    schema = pa.schema(
        [("file", pa.string()), ("start", pa.int64()), ("outside", pa.bool_()), ("inside", pa.bool_()),
         ("starts_outside", pa.int64()), ("starts_inside", pa.int64()), ("first", pa.string())]
    )
    rows = [dict(zip(schema.names, (*at, *held), strict=True)) for at, held in found.items()]
    yield pa.RecordBatch.from_pylist(rows, schema)


def blocks_of(found: DataFrame) -> DataFrame:
    """(file, start, begins_inside, place, has_header, returns, first) of each block, a row for each 128 MB or so of input;
    ``place`` is the number of data records before the block, by file name and then by place in the file, ``returns`` whether the file's lines end with one."""
    # Only the first line of a file is needed whole.
    line = F.when(F.col("start") == 0, F.col("line")).alias("line")
    states = found.select("file", "start", "from_outside", "from_inside", "blank", line)
    blocks = written_once(states.mapInArrow(_composed, BLOCK), "csv-blocks")
    in_file = Window.partitionBy("file").orderBy("start")
    earlier = in_file.rowsBetween(Window.unboundedPreceding, -1)
    # The same scan over blocks as over the lines of a block: turns since the last block that sets the state.
    sets = F.col("outside") == F.col("inside")
    turn = F.when(sets, 0).otherwise(F.col("outside").cast("int"))
    turned = blocks.withColumn("turns", F.sum(turn).over(in_file.rowsBetween(Window.unboundedPreceding, 0)))
    base = F.last(F.when(sets, F.struct("turns", F.col("outside").alias("state"))), ignorenulls=True).over(earlier)
    turned = turned.withColumns({"base": base, "before": F.coalesce(F.lag("turns").over(in_file), F.lit(0))})
    odd = (F.col("before") - F.coalesce("base.turns", F.lit(0))) % 2 == 1
    begins = F.coalesce("base.state", F.lit(False)) != odd
    starts = F.when(F.col("begins_inside"), F.col("starts_inside")).otherwise(F.col("starts_outside"))
    counted = turned.withColumn("begins_inside", begins).withColumn("starts", starts)
    in_front = F.coalesce(F.sum("starts").over(earlier), F.lit(0)) == 0
    counted = counted.withColumn("has_header", in_front & (F.col("starts") > 0))
    rows = F.col("starts") - F.col("has_header").cast("long")
    all_earlier = Window.orderBy("file", "start").rowsBetween(Window.unboundedPreceding, -1)
    place = F.coalesce(F.sum(rows).over(all_earlier), F.lit(0))
    returns = F.coalesce(F.max(F.endswith("first", F.lit("\r"))).over(Window.partitionBy("file")), F.lit(False))
    return counted.select(*AT, "begins_inside", place.alias("place"), "has_header", returns.alias("returns"), "first")


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records and fragments of each block, whose rows come one after the other; records are numbered from 0."""
    at, inside, tail, number, held = None, False, False, 0, []
    for batch in batches:
        for here, rows in _runs(batch):
            if here != at:
                if held:
                    yield _rows(at, [number], ["\n".join(held)], head=inside, tail=tail)
                at, number, held = here, 0, []
                inside = tail = rows.column("begins_inside")[0].as_py()
            begun, inside = begun_inside(_flags(rows, "from_outside"), _flags(rows, "from_inside"), inside)
            # Blank lines between records are none.
            kept = begun | ~_flags(rows, "blank")
            texts, firsts = rows.column("line").filter(pa.array(kept)), np.flatnonzero(~begun[kept])
            if not len(firsts):
                held += texts.to_pylist()
                continue
            held += texts.slice(0, int(firsts[0])).to_pylist()
            if held:
                yield _rows(at, [number], ["\n".join(held)], tail=tail)
                number += not tail  # a tail is numbered where it begins
            tail = False
            sizes = np.diff(firsts)
            alone = texts.take(pa.array(firsts[:-1][sizes == 1]))
            yield _rows(at, number + np.flatnonzero(sizes == 1), alone)
            several = np.flatnonzero(sizes > 1)
            joined = ["\n".join(texts.slice(int(firsts[i]), int(sizes[i])).to_pylist()) for i in several]
            yield _rows(at, number + several, joined)
            number += len(sizes)
            held = texts.slice(int(firsts[-1])).to_pylist()  # may go on in the next batch
    if held:
        yield _rows(at, [number], ["\n".join(held)], head=inside, tail=tail)


def _rows(at: tuple[str, int], numbers, records, head: bool = False, tail: bool = False) -> pa.RecordBatch:
    n = len(numbers)
    columns = [
        pa.array([at[0]] * n, pa.string()),
        pa.array([at[1]] * n, pa.int64()),
        pa.array(np.asarray(numbers, np.int64)),
        pa.array([head] * n, pa.bool_()),
        pa.array([tail] * n, pa.bool_()),
        records if isinstance(records, pa.Array) else pa.array(records, pa.string()),
    ]
    return pa.RecordBatch.from_arrays(columns, ["file", "start", "number", "head", "tail", "record"])


def records(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(record, place) of the data records of all files under ``path``, and the first lines of the files."""
    found = lines(spark, path)
    blocks = written_once(blocks_of(found), "csv-block-states")
    small, _ = small_side(blocks.drop("first"))
    # A broadcast join keeps the order of the lines, on which cutting rests; the states of many blocks are split by file.
    known = found.join(F.broadcast(small), AT).select(*AT, "line", "blank", "from_outside", "from_inside", "begins_inside")
    cut = known.mapInArrow(_cut, RECORD)
    whole = cut.where("NOT head AND NOT tail").select(*AT, "number", "record")
    parts = written_once(cut.where("head OR tail"), "csv-fragments")
    order = Window.partitionBy("file").orderBy("start", "head")
    opened = F.sum((F.col("head") & ~F.col("tail")).cast("int")).over(order)
    joined = parts.withColumn("opened", opened).groupBy("file", "opened").agg(
        F.min(F.struct("start", "head", "number")).alias("first"),
        F.sort_array(F.collect_list(F.struct("start", "head", "record"))).alias("pieces"),
    )
    stitched = joined.select(
        "file", F.col("first.start").alias("start"), F.col("first.number").alias("number"),
        F.array_join(F.col("pieces.record"), "\n").alias("record"),
    )
    numbered = whole.unionByName(stitched).join(F.broadcast(small.drop("begins_inside")), AT)
    data = numbered.where(~(F.col("has_header") & (F.col("number") == 0)))
    place = F.col("place") + F.col("number") - F.col("has_header").cast("long")
    feeds = F.replace("record", F.lit("\r\n"), F.lit("\n"))
    feeds = F.when(F.endswith(feeds, F.lit("\r")), F.substring(feeds, F.lit(1), F.length(feeds) - 1)).otherwise(feeds)
    record = F.when(F.col("returns"), feeds).otherwise(F.col("record")).alias("record")
    return data.select(record, place.alias("place")), blocks.select("first").where("first IS NOT NULL")
