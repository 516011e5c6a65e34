"""Small sides of joins, behind a check of their size."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.storagelevel import StorageLevel

from starloom.functions.columns import named
from starloom.session import written_once

MAX_ROWS = 50_000
MAX_LISTED = 1_000
MAX_BYTES = 32 * 1024 * 1024


def small_side(
    df: DataFrame, max_rows: int = MAX_ROWS, max_bytes: int = MAX_BYTES
) -> tuple[DataFrame, pa.Table | None]:
    """``df`` as a broadcast table when it is within both bounds, else as a table in scratch.

    Rows and text bytes are counted on the cluster, over no more than ``max_rows + 1`` rows, before
    anything comes to the driver. Beyond the bounds the join is planned without a hint, as a shuffle
    join. Adaptive execution splits the partition of a hot key there, but only if both sides of the
    join are bare shuffles, which the scan of a table gives and an aggregate on the key does not.
    The rows come along when they are within the bounds, so that a check of them needs no job.
    """
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    bytes_ = F.lit(0).cast("long")
    for name in texts:
        bytes_ = bytes_ + F.coalesce(F.octet_length(F.col(f"`{name}`")), F.lit(0))
    first = df.limit(max_rows + 1).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        size = first.agg(F.count(F.lit(1)).alias("rows"), F.sum(bytes_).alias("bytes")).first()
        if size["rows"] > max_rows or (size["bytes"] or 0) > max_bytes:
            return written_once(df, "large-side"), None
        rows = first.toArrow()
    finally:
        first.unpersist()
    return F.broadcast(df.sparkSession.createDataFrame(rows, schema=df.schema)), rows


def only_listed(df: DataFrame, column: str, side: DataFrame, rows: pa.Table | None) -> DataFrame:
    """Rows of ``df`` whose value is in the same column of a side from ``small_side``.

    A short list becomes a filter on its values, which reaches the scan and lets it skip files and
    row groups; a longer one is a semi join.
    """
    if rows is not None and rows.num_rows <= MAX_LISTED:
        return df.where(named(column).isin(*set(rows[column].to_pylist())))
    return df.join(side.select(named(column)), column, "left_semi")
