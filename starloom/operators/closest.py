"""A model's answers held to the options it was given: each becomes the option closest to it, or null."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from starloom.fixed_values import META
from starloom.functions.columns import named
from starloom.operators.bounded import small_side

DISTANCE = 2


def plain_form(text: str | Column) -> Column:
    """Lower case, with one blank for all that is neither letter nor digit."""
    return F.trim(F.regexp_replace(F.lower(named(text)), r"[^\p{L}\p{N}]+", " "))


def deletions(text: Column, most: int) -> Column:
    """All texts that are left of ``text`` without up to ``most`` of its characters."""

    def without_one(word: Column) -> Column:
        places = F.when(F.length(word) > 0, F.sequence(F.lit(1), F.length(word))).otherwise(F.array().cast("array<int>"))
        return F.transform(places, lambda i: F.concat(F.substr(word, F.lit(1), i - 1), F.substr(word, i + 1)))

    found = last = F.array(text)
    for _ in range(most):
        last = F.array_distinct(F.flatten(F.transform(last, without_one)))
        found = F.array_union(found, last)
    return found


def closest_options(answers: DataFrame, options: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """(answer, option, distance) for each distinct ``answer`` that has one closest ``option`` within ``distance``.

    Distances are edits between plain forms. Two texts within a distance have a text in common that both become by no
    more deletions than that, so the tables meet on those texts, and only what meets is measured. Answers that are
    longer or shorter than all options by more than the distance are left out before. Where different options are
    equally close there is no answer.
    """
    listed = options.select("option", plain_form("option").alias("known")).where("option IS NOT NULL").distinct()
    lengths = listed.agg(F.min(F.length("known")).alias("shortest"), F.max(F.length("known")).alias("longest")).first()
    asked = answers.select("answer", plain_form("answer").alias("given")).where("answer IS NOT NULL").distinct()
    if lengths["longest"] is None:
        lengths = {"shortest": 0, "longest": -distance - 1}  # no option, no answer
    asked = asked.where(F.length("given").between(lengths["shortest"] - distance, lengths["longest"] + distance))
    keys = lambda text: F.explode(deletions(F.col(text), distance)).alias("key")
    met = asked.select("*", keys("given")).join(listed.select("*", keys("known")), "key")
    pairs = met.select("answer", "given", "option", "known").distinct()
    measured = pairs.withColumn("distance", F.levenshtein("given", "known", distance)).where("distance >= 0")
    near = measured.groupBy("answer", "distance").agg(F.count(F.lit(1)).alias("n"), F.min("option").alias("option"))
    best = near.groupBy("answer").agg(F.min(F.struct("distance", "n", "option")).alias("best"))
    return best.where("best.n = 1").select("answer", "best.option", "best.distance")


def hold_to_options(
    mapping: DataFrame, options: Sequence[str] | DataFrame, distance: int = DISTANCE, column: str = META
) -> DataFrame:
    """``mapping`` with ``column`` replaced by the closest option, null where there is none; ``answer`` keeps what was said.

    ``options`` is a list, or a table with a column ``option``. Each distinct answer is matched once. Every row stays.
    """
    if not isinstance(options, DataFrame):
        options = mapping.sparkSession.createDataFrame([(o,) for o in options], "option string")
    said = mapping.withColumnRenamed(column, "answer")
    held, _ = small_side(closest_options(said.select("answer").distinct(), options, distance).select(F.col("answer").alias("_said"), "option"))
    return said.join(held, F.col("answer") == F.col("_said"), "left").drop("_said").withColumnRenamed("option", column)
