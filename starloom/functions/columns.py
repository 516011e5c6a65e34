"""Row-local column expressions. All stay inside the JVM and also work on a stream."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, functions as F

from starloom.fixed_values import (
    CODE_BY_SENTIMENT,
    SENTIMENT_BY_CODE,
    SENTIMENT_BY_MODEL_LABEL,
    SENTIMENT_BY_RATING,
)


def named(column: str | Column) -> Column:
    """A column by its literal name, so that the dot in ``reviews.rating`` is part of the name."""
    return column if isinstance(column, Column) else F.col(f"`{column}`")


def look_up(column: str | Column, table: Mapping, strict: bool = False) -> Column:
    """Dictionary lookup as one CASE expression: unknown gives null, or an error when ``strict``."""
    key = named(column)
    keys_by_value: dict = {}
    for k, v in table.items():
        keys_by_value.setdefault(v, []).append(k)
    found = F.when(F.lit(False), None)
    for value, keys in keys_by_value.items():
        found = found.when(key.isin(keys), F.lit(value))
    if not strict:
        return found
    shown = F.coalesce(key.cast("string"), F.lit("null"))
    return found.otherwise(F.raise_error(F.concat(F.lit("no entry for key: "), shown)))


def sentiment_of(rating: str | Column) -> Column:
    """Stars to sentiment; anything but a whole number from 1 to 5 gives null."""
    return look_up(rating, SENTIMENT_BY_RATING)


def encode_sentiment(label: str | Column) -> Column:
    return look_up(label, CODE_BY_SENTIMENT)


def decode_sentiment(code: str | Column) -> Column:
    return look_up(code, SENTIMENT_BY_CODE)


def model_label_sentiment(label: str | Column, strict: bool = True) -> Column:
    """``LABEL_0..2`` to sentiment; an unknown label is an error unless ``strict`` is off."""
    return look_up(label, SENTIMENT_BY_MODEL_LABEL, strict)


def category_key(category: str | Column) -> Column:
    """``Health & Beauty`` to ``health_beauty``."""
    key = F.lower(named(category))
    for joiner in (" & ", "&", " "):
        key = F.replace(key, F.lit(joiner), F.lit("_"))
    return key


def short_name(name: str | Column, length: int = 40) -> Column:
    """The first characters and an ellipsis, which short names get as well."""
    return F.concat(F.substring(named(name), 1, length), F.lit("..."))


def strip(text: str | Column) -> Column:
    """Trim all white space; Spark's ``trim`` knows the blank only."""
    return F.btrim(named(text), F.lit(" \t\r\n\f\v"))


def two_decimals(number: str | Column) -> Column:
    """Two decimals, exact ties to even."""
    return F.call_function("format_number", named(number), F.lit("0.00"))


def thousands(count: str | Column) -> Column:
    return F.format_number(named(count), 0)


def truncate_tokens(text: str | Column, max_length: int = 512) -> Column:
    """The first ``max_length`` white-space tokens; stands in for a model's own tokenizer."""
    tokens = F.split(strip(text), r"\s+", max_length + 1)
    return F.array_join(F.slice(tokens, 1, max_length), " ")


def argmax(scores: str | Column) -> Column:
    """Index of the highest score in an array, the first one on a tie."""
    values = named(scores)
    return (F.array_position(values, F.array_max(values)) - 1).cast("int")


def seeded_hash(purpose: str, seed: int, id_column: str | Column) -> Column:
    """A hex digest per row that depends on nothing but purpose, seed and id.

    The purpose keeps a sample and a later split of that sample independent under one seed. A
    missing id has a digest as well, so that no row falls out of both parts of a split.
    """
    key = F.coalesce(named(id_column).cast("string"), F.lit(""))
    return F.md5(F.concat(F.lit(f"{purpose}|{seed}|"), key))
