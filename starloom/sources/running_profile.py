"""Profiles that grow with each batch: rows and nulls are exact, distinct values are estimated from sketches that merge.

A batch leaves one row for each column, with a sketch of a few kilobytes at most, whatever its size. It counts once, as
in ``running_stats``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from starloom.functions.columns import named
from starloom.sources.running_stats import add_counts, stored

SCHEMA = "`column` string, rows long, non_null long, sketch binary"
LG_SIZE = 12  # 2 ** 12 registers: a standard error of some 1.6 percent


def add_profile(df: DataFrame, path: str, batch: str, columns: Sequence[str] | None = None) -> bool:
    """Profile ``batch``; False, and nothing changes, if it is there already.

    One aggregate without a key: each task sends a sketch for each column. Values are sketched by their text, so that
    batches may differ in type. Columns that a batch lacks are not counted for it.
    """
    columns = list(columns or df.columns)
    parts = [F.count(F.lit(1)).alias("rows")]
    for i, name in enumerate(columns):
        parts += [F.count(named(name)).alias(f"n{i}"), F.hll_sketch_agg(named(name).cast("string"), F.lit(LG_SIZE)).alias(f"s{i}")]
    cells = [
        F.struct(F.lit(name).alias("column"), "rows", F.col(f"n{i}").alias("non_null"), F.col(f"s{i}").alias("sketch"))
        for i, name in enumerate(columns)
    ]
    return add_counts(df.agg(*parts).select(F.inline(F.array(*cells))), path, batch)


def running_profile(spark: SparkSession, path: str) -> DataFrame:
    """(column, rows, nulls, distinct_estimate) over all batches."""
    return stored(spark, path, SCHEMA).groupBy("column").agg(
        F.sum("rows").alias("rows"),
        F.sum(F.col("rows") - F.col("non_null")).alias("nulls"),
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("distinct_estimate"),
    )
