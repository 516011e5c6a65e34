"""White-space words of Arrow text columns, as integer codes."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

CHUNK_BYTES = 8 << 20


class Words(NamedTuple):
    """Words of some texts: ``codes`` index ``dictionary``; text i has codes[starts[i]:starts[i + 1]]."""

    codes: np.ndarray
    starts: np.ndarray
    dictionary: pa.Array

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.starts)

    @property
    def owner(self) -> np.ndarray:
        """The text that each word is in."""
        return np.repeat(np.arange(len(self.starts) - 1), self.counts)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: str | Column = "doc_id", folds: int = 5) -> Column:
    """The fold of a document: crc32 of its id as text, modulo ``folds``; null ids are in fold 0."""
    text = F.coalesce(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id, F.lit(""))
    return F.pmod(F.crc32(text), F.lit(folds))


def chunks(
    batches: Iterator[pa.RecordBatch], text: str = "text", max_bytes: int = CHUNK_BYTES
) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in slices of at most ``max_bytes`` of text, or of one longer row."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        first, held = 0, 0
        for row, size in enumerate(sizes.tolist()):
            if held and held + size > max_bytes:
                yield batch.slice(first, row - first)
                first, held = row, 0
            held += size
        if first < batch.num_rows:
            yield batch.slice(first)


def filled(texts: pa.Array) -> pa.Array:
    """Nulls as empty texts."""
    return pc.fill_null(texts, "")


def split_words(texts: pa.Array, lower: bool = False) -> Words:
    """Words ``[^\\x20\\x09-\\x0D]+`` of each text; ``lower`` folds A-Z only. A null has none."""
    texts = filled(texts)
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts) if lower else texts)
    starts = lists.offsets.to_numpy().astype(np.int64)
    encoded = lists.flatten().dictionary_encode()
    codes, dictionary = encoded.indices.to_numpy(), encoded.dictionary
    blank = pc.index(dictionary, pa.scalar("", dictionary.type)).as_py()
    if blank >= 0:
        real = codes != blank
        starts = np.concatenate([[0], np.cumsum(real)])[starts]
        codes = codes[real]
    return Words(codes, starts, dictionary)


def sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sum of each slice values[starts[i]:starts[i + 1]], of rows where ``values`` has two axes."""
    first = np.zeros((1, *values.shape[1:]), dtype=np.result_type(values.dtype, np.int64))
    total = np.concatenate([first, np.cumsum(values, axis=0, dtype=first.dtype)])
    return total[starts[1:]] - total[starts[:-1]]
