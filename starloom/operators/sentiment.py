"""Sentiment of a text: a word-list scorer in the JVM, and a hook for a real model."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import Column, DataFrame, functions as F, types as T

from starloom.fixed_values import PREDICTED, TEXT
from starloom.functions.columns import model_label_sentiment, named, truncate_tokens

# Default word lists, replaced by the caller for another language or domain.
NEGATIVE_WORDS = (
    "awful bad broke broken cheap defective die died disappointed disappointing fail failed flimsy"
    " garbage hate horrible junk leak leaks never poor refund return returned slow stopped terrible"
    " useless waste weak worse worst wrong"
).split()
POSITIVE_WORDS = (
    "amazing awesome beautiful best bright comfortable durable easy enjoy excellent fantastic fast"
    " good great happy helpful love loved loves nice perfect pleased quality recommend reliable solid"
    " sturdy super well wonderful works"
).split()

Labels = Callable[[np.ndarray], np.ndarray]


def words_of(text: str | Column) -> Column:
    """Lower-case runs of letters and digits."""
    return F.split(F.lower(named(text)), r"[^\p{L}\p{N}]+")


def word_list_label(
    text: str | Column,
    negative: Sequence[str] = NEGATIVE_WORDS,
    positive: Sequence[str] = POSITIVE_WORDS,
) -> Column:
    """``LABEL_0`` when negative words outnumber positive ones, ``LABEL_2`` the other way round."""
    balance = F.aggregate(
        words_of(text),
        F.lit(0),
        lambda sum_, word: sum_
        + F.when(word.isin(*positive), 1).otherwise(0)
        - F.when(word.isin(*negative), 1).otherwise(0),
    )
    # The sign picks the label, so that the text is split once; no text is no verdict.
    place = F.coalesce(F.signum(balance), F.lit(0)).cast("int") + 2
    return F.element_at(F.array(*[F.lit(f"LABEL_{i}") for i in range(3)]), place)


def baseline_sentiment(
    df: DataFrame,
    text_col: str = TEXT,
    load_model: Callable[[], Labels] | None = None,
    max_length: int | None = None,
    batch_size: int = 256,
    negative: Sequence[str] = NEGATIVE_WORDS,
    positive: Sequence[str] = POSITIVE_WORDS,
) -> DataFrame:
    """Add ``predicted_sentiment`` to every row.

    ``load_model`` runs once per Python worker and returns a function from an array of texts to an
    array of ``LABEL_0..2``. A model with a limited window sets ``max_length`` in tokens; the
    word-list scorer that is used without a model reads whole texts.
    """
    text = named(text_col)
    if max_length is not None:
        text = truncate_tokens(text, max_length)
    if load_model is None:
        label = word_list_label(text, negative, positive)
    else:
        label = predict_batch_udf(load_model, return_type=T.StringType(), batch_size=batch_size)(
            F.coalesce(text, F.lit(""))
        )
    # A column of its own keeps the translation from computing the label once per branch.
    labelled = df.withColumn("_model_label", label)
    return labelled.withColumn(PREDICTED, model_label_sentiment("_model_label")).drop("_model_label")
