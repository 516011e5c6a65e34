"""Exact top-k inside groups, of which one may hold a large share of all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from starloom.functions.columns import named


SLICES = 256


def first_k(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[Column],
    k: int,
    position: str,
    sliced: bool = False,
) -> DataFrame:
    """Keep the first ``k`` rows of each group in ``order`` and number them from 1.

    Up to the session's window-group-limit threshold Spark itself cuts every partition to ``k`` rows
    per group before the shuffle. Above it, or if ``sliced`` is set for an input of very many partitions,
    a first round ranks each group in ``SLICES`` slices by input partition, so that the second round sees
    at most ``k * SLICES`` rows of a group, and the first one a share of them.
    """
    if k < 0:
        raise ValueError("k must not be negative")
    threshold = int(
        df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000")
    )
    if sliced or k > threshold:
        slices = df.withColumn("_slice", F.pmod(F.spark_partition_id(), F.lit(SLICES)))
        df = _ranked(slices, [*group, "_slice"], order, k, position).drop("_slice", position)
    return _ranked(df, group, order, k, position)


def _ranked(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int, position: str
) -> DataFrame:
    window = Window.partitionBy(*[named(g) for g in group]).orderBy(*order)
    return df.withColumn(position, F.row_number().over(window)).where(F.col(position) <= k)
