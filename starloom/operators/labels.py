"""Sentiment labels from stars, their integer codes, and model labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from starloom.fixed_values import ACTUAL, PREDICTED, RATING, SENTIMENT
from starloom.functions.columns import (
    decode_sentiment,
    encode_sentiment,
    model_label_sentiment,
    named,
    sentiment_of,
)


def assign_sentiment_labels(
    df: DataFrame, rating_col: str = RATING, cast: bool = False
) -> DataFrame:
    """Add ``rating_sentiment``: 1-2 negative, 3 neutral, 4-5 positive, anything else null.

    A text column holds no number and so gives null, unless ``cast`` asks for its numbers.
    """
    rating = named(rating_col)
    if isinstance(df.schema[rating_col].dataType, T.StringType):
        rating = rating.try_cast("double") if cast else F.lit(None).cast("double")
    return df.withColumn(SENTIMENT, sentiment_of(rating))


def encode_labels(df: DataFrame, label_col: str = SENTIMENT) -> DataFrame:
    """Add the integer code as ``actual_sentiment``."""
    return df.withColumn(ACTUAL, encode_sentiment(label_col))


def decode_labels(df: DataFrame, code_col: str, to: str = PREDICTED) -> DataFrame:
    return df.withColumn(to, decode_sentiment(code_col))


def attach_model_labels(df: DataFrame, model_label_col: str, strict: bool = True) -> DataFrame:
    """Add ``predicted_sentiment`` from a model's ``LABEL_0..2`` in the same row."""
    return df.withColumn(PREDICTED, model_label_sentiment(model_label_col, strict))
