"""Token counts of documents in flat token files, by a scan for the end-of-document id.

A token file is a row of little-endian unsigned numbers without header or index. It is read in blocks;
each block finds its separators with one vectorised comparison, and a prefix scan over the blocks'
summaries (number of separators, last separator) stitches documents that span blocks. The scan has two
levels, blocks within stretches and stretches within a file, so that no task gets all blocks of a file.

Defined cases: an empty document has 0 tokens; tokens after the last separator are a document that is
not ``terminated``; an empty file has none; a file that is no multiple of the token width raises.
Writing takes null texts as empty ones, keeps repeated rows, and ignores other columns.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from starloom.llm.tokens import encoder
from starloom.llm.words import chunks
from starloom.session import written_once

BLOCK_BYTES = 8 << 20
STRETCH = 1024
BLOCKS_A_TASK = 4


def write_token_files(docs: DataFrame, path: str, tokenizer: str, separator: int) -> None:
    """Ids of each (text) as unsigned 16-bit numbers, each text closed by ``separator``; a file a task.

    Spark's text writer puts the separator's bytes after each row, so its commit protocol keeps files of
    failed or repeated tasks out.
    """

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches):
            ids, starts = encoder(tokenizer, special=False).encode(chunk.column("text"), separator)
            packed = ids.astype("<u2")
            rows = [packed[a : b - 1].tobytes() for a, b in zip(starts[:-1], starts[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], ["ids"])

    rows = docs.select(F.col("text").cast("string")).mapInArrow(encoded, "ids binary")
    closing = int(separator).to_bytes(2, "little").decode("latin-1")
    rows.select(F.col("ids").cast("string")).write.option("encoding", "ISO-8859-1").option(
        "lineSep", closing
    ).text(path)


def document_lengths(
    spark: SparkSession, path: str, separator: int, width: int = 2, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """(path, document, start, n_tokens, terminated): documents of each file in order, from 0."""
    files = spark.read.format("binaryFile").load(path).select("path", "length")  # no content is read
    size = files.agg(F.coalesce(F.sum("length"), F.lit(0)), F.max(F.col("length") % width)).first()
    if size[1]:
        raise ValueError(f"a file under {path} is no multiple of {width} bytes")
    block = block_bytes // width * width
    tasks = max(spark.sparkContext.defaultParallelism, size[0] // (BLOCKS_A_TASK * block) + 1)
    blocks = files.where("length > 0").select(
        "path", "length", F.explode(F.expr(f"sequence(0L, (length - 1) div {block}L)")).alias("block")
    )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow.fs import FileSystem

        for batch in batches:
            for name, length, number in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                system, inner = FileSystem.from_uri(name)
                with system.open_input_file(inner) as file:
                    first = number * block
                    ids = np.frombuffer(file.read_at(min(block, length - first), first), f"<u{width}")
                found = np.flatnonzero(ids == separator) + first // width
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([name]),
                        pa.array([number]),
                        pa.array([length // width]),
                        pa.array([found], pa.list_(pa.int64())),
                    ],
                    ["path", "block", "tokens", "separators"],
                )

    scanned = written_once(
        blocks.repartition(int(tasks), "path", "block").mapInArrow(
            scan, "path string, block long, tokens long, separators array<long>"
        ),
        "separators",
    )
    summaries = scanned.select(
        "path",
        "block",
        F.size("separators").cast("long").alias("n"),
        F.array_max("separators").alias("last"),
        F.expr(f"block div {STRETCH}").alias("stretch"),
    )
    stretches = summaries.groupBy("path", "stretch").agg(F.sum("n").alias("n"), F.max("last").alias("last"))
    scanned = scanned.join(
        _prefix(summaries, ["path", "stretch"], "block", "n_here", "last_here").drop("n", "last"), ["path", "block"]
    ).join(_prefix(stretches, ["path"], "stretch", "n_before", "last_before").drop("n", "last"), ["path", "stretch"])
    previous = F.coalesce("last_here", "last_before", F.lit(-1))
    base = F.col("n_here") + F.col("n_before")
    ended = scanned.select(
        "path", base.alias("base"), previous.alias("previous"), "separators", F.posexplode("separators").alias("i", "end")
    ).select(
        "path",
        (F.col("base") + F.col("i")).alias("document"),
        F.when(F.col("i") == 0, F.col("previous")).otherwise(F.expr("separators[i - 1]")).alias("before"),
        "end",
        F.lit(True).alias("terminated"),
    )
    rest = (
        scanned.where(F.expr(f"block = (tokens * {width} - 1) div {block}"))
        .select(
            "path",
            (base + F.size("separators")).alias("document"),
            F.coalesce(F.array_max("separators"), previous).alias("before"),
            F.col("tokens").alias("end"),
            F.lit(False).alias("terminated"),
        )
        .where("end - before > 1")
    )
    return ended.unionByName(rest).select(
        "path", "document", (F.col("before") + 1).alias("start"), (F.col("end") - F.col("before") - 1).alias("n_tokens"), "terminated"
    )


def _prefix(rows: DataFrame, keys: list[str], order: str, n: str, last: str) -> DataFrame:
    """Exclusive running sum of n and running maximum of last, within ``keys``."""
    earlier = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn(n, F.coalesce(F.sum("n").over(earlier), F.lit(0))).withColumn(last, F.max("last").over(earlier))
