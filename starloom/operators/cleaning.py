"""Headers: lower-casing, dropping unused columns, dotted and plain names."""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence

from pyspark.sql import DataFrame

from starloom.fixed_values import UNUSED_COLUMNS


def lower_columns(df: DataFrame) -> DataFrame:
    """Lower-case all column names; names that differ only in case are an error."""
    lowered = [name.lower() for name in df.columns]
    refuse_collisions(df.columns)
    return df.toDF(*lowered)


def refuse_collisions(names: Sequence[str]) -> None:
    counts = Counter(name.lower() for name in names)
    clashing = [name for name in names if counts[name.lower()] > 1]
    if clashing:
        raise ValueError(f"columns that differ only in case: {', '.join(clashing)}")


def clean_columns(df: DataFrame, drop: Sequence[str] | None = None) -> DataFrame:
    """Lower-case the header, then drop the listed columns that are there.

    ``None`` drops the columns that the review data leaves mostly empty, an empty list none.
    """
    lowered = lower_columns(df)
    unwanted = UNUSED_COLUMNS if drop is None else drop
    # Spark's own drop ignores case, the list does not.
    return lowered.drop(*[name for name in lowered.columns if name in set(unwanted)])


def plain_names(df: DataFrame) -> DataFrame:
    """``reviews.rating`` becomes ``reviews_rating``, for SQL without back-ticks."""
    plain = [name.replace(".", "_") for name in df.columns]
    refuse_collisions(plain)
    return df.toDF(*plain)


def dotted_names(df: DataFrame, prefix: str = "reviews") -> DataFrame:
    """The way back: ``reviews_rating`` becomes ``reviews.rating``."""
    return df.toDF(
        *[
            f"{prefix}.{name[len(prefix) + 1:]}" if name.startswith(f"{prefix}_") else name
            for name in df.columns
        ]
    )
