"""Frequencies, shares, distinct values, null counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from starloom.fixed_values import CATEGORIES, META, PRIMARY, SENTIMENT
from starloom.functions.columns import named


def _frequencies(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.groupBy(*[named(c) for c in columns]).agg(F.count(F.lit(1)).alias("count"))


def _most_frequent_first(columns: Sequence[str]) -> list[Column]:
    return [F.desc("count"), *[named(c).asc() for c in columns]]


def value_counts(df: DataFrame, *columns: str) -> DataFrame:
    """Rows per value, or per combination of values; rows with a null in any of them are left out."""
    for column in columns:
        df = df.where(named(column).isNotNull())
    return _frequencies(df, columns).orderBy(*_most_frequent_first(columns))


def class_shares(df: DataFrame, column: str = SENTIMENT) -> DataFrame:
    """``value_counts`` with the percentage of all rows, null ones included, to two decimals."""
    groups = _frequencies(df, [column])
    # The total is summed from the groups: Spark reuses their shuffle and scans once.
    total = groups.agg(F.sum("count")).scalar().cast("double")
    share = F.bround(F.lit(100.0).cast("double") * F.col("count") / total, 2)
    # The null class leaves by its share: a filter on the column would sink into one of the two
    # scans and keep Spark from sharing them.
    return (
        groups.withColumn("percent", F.when(named(column).isNotNull(), share))
        .where(F.col("percent").isNotNull())
        .orderBy(*_most_frequent_first([column]))
    )


def category_crosstab(
    df: DataFrame, columns: Sequence[str] = (CATEGORIES, PRIMARY, META)
) -> DataFrame:
    """Raw category against the source's own category against the mapped one."""
    return value_counts(df, *columns)


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Distinct values; null counts as one."""
    return df.select(named(column)).distinct()


def distinct_counts(df: DataFrame, *columns: str, approximate: bool = False) -> DataFrame:
    """Number of distinct non-null values, one row per column.

    Each column's values are made distinct by a shuffle on the value before they are counted. For
    columns with billions of values ``approximate`` counts in one pass with fixed memory instead.
    """
    if approximate:
        counts = [F.approx_count_distinct(named(c)).alias(c) for c in columns]
    else:
        counts = [F.count_distinct(named(c)).alias(c) for c in columns]
    return _one_row_per_column(df.agg(*counts), {c: {"n_distinct": named(c)} for c in columns})


def class_sizes(df: DataFrame, column: str) -> DataFrame:
    """Rows per class, null class included."""
    return _frequencies(df, [column])


def smallest_class(df: DataFrame, column: str = SENTIMENT) -> DataFrame:
    """One row with the size of the smallest non-null class."""
    groups = _frequencies(df.where(named(column).isNotNull()), [column])
    return groups.agg(F.min("count").alias("count"))


def null_counts(df: DataFrame) -> DataFrame:
    """Nulls per column, from one pass over the table."""
    return table_profile(df).select("column", "nulls")


def table_profile(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type, rows of the table, non-null and null rows."""
    present = [F.count(named(name)).alias(f"_{i}") for i, name in enumerate(df.columns)]
    counted = df.agg(F.count(F.lit(1)).alias("_rows"), *present)
    cells = {}
    for i, field in enumerate(df.schema.fields):
        cells[field.name] = {
            "position": F.lit(i),
            "dtype": F.lit(field.dataType.simpleString()),
            "rows": F.col("_rows"),
            "non_null": F.col(f"_{i}"),
            "nulls": F.col("_rows") - F.col(f"_{i}"),
        }
    return _one_row_per_column(counted, cells)


def _one_row_per_column(single: DataFrame, cells: dict[str, dict[str, Column]]) -> DataFrame:
    structs = [
        F.struct(F.lit(name).alias("column"), *[c.alias(label) for label, c in columns.items()])
        for name, columns in cells.items()
    ]
    return single.select(F.inline(F.array(*structs)))
