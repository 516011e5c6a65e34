"""Product statistics that grow with each batch of reviews, without the earlier reviews being read again.

A batch is stored as the number of its reviews per category, product and rating, in a folder of its own, and counts
from the moment its name is committed. A name is committed once, so a batch that is sent again, or by two writers at
once, counts once. Ratings are kept apart, so means, counts, sentiment and top lists all come from the store.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from starloom.fixed_values import AVG, COUNT, META, NAME, RATING
from starloom.functions.columns import named, sentiment_of
from starloom.sources import commits

COMMITS = "_batches"
SCHEMA = f"`{META}` string, `{NAME}` string, rating double, reviews long"


def _name(batch: str) -> str:
    """The file name of a batch, whatever characters its id has and however long it is."""
    return f"batch-{hashlib.sha256(batch.encode()).hexdigest()}"


def add_batch(reviews: DataFrame, path: str, batch: str, rating_col: str = RATING) -> bool:
    """Count the reviews of ``batch``; False, and nothing changes, if the batch is there already.

    One aggregate that combines in each partition first. Reviews without a category or product count nowhere, those
    without a rating are kept as such.
    """
    kept = reviews.where(named(META).isNotNull() & named(NAME).isNotNull())
    keys = [named(META).cast("string").alias(META), named(NAME).cast("string").alias(NAME)]
    counts = kept.groupBy(*keys, named(rating_col).cast("double").alias("rating")).agg(F.count(F.lit(1)).alias("reviews"))
    return add_counts(counts, path, batch)


def add_counts(counts: DataFrame, path: str, batch: str) -> bool:
    """Store what was counted of a batch; False, without counting, if the batch is there already."""
    spark = counts.sparkSession
    if _name(batch) in commits.claimed(spark, f"{path}/{COMMITS}"):
        return False
    folder = f"counts-{uuid.uuid4().hex}"
    counts.write.parquet(f"{path}/{folder}")
    if commits.claim(spark, f"{path}/{COMMITS}", _name(batch), folder):
        return True
    commits.remove(spark, f"{path}/{folder}")
    return False


def rating_counts(spark: SparkSession, path: str) -> DataFrame:
    """(meta_category, name, rating, reviews) over all batches; a row for each of them in each batch."""
    return stored(spark, path, SCHEMA)


def stored(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The rows of all committed batches."""
    names = commits.claimed(spark, f"{path}/{COMMITS}")
    if not names:
        return spark.createDataFrame([], schema)
    folders = spark.read.text([f"{path}/{COMMITS}/{name}" for name in names]).collect()  # a row per batch
    return spark.read.schema(schema).parquet(*(f"{path}/{row[0]}" for row in folders))


def running_stats(spark: SparkSession, path: str) -> DataFrame:
    """What ``product_stats`` gives over all reviews of the batches; a product without a rating has no mean."""
    rated = F.when(F.col("rating").isNotNull(), F.col("reviews"))
    return rating_counts(spark, path).groupBy(META, NAME).agg(
        (F.sum(F.col("rating") * F.col("reviews")) / F.sum(rated)).alias(AVG),
        F.coalesce(F.sum(rated), F.lit(0)).alias(COUNT),
    )


def running_sentiment(spark: SparkSession, path: str) -> DataFrame:
    """(meta_category, sentiment, reviews): how often each sentiment was given in each category."""
    labelled = rating_counts(spark, path).withColumn("sentiment", sentiment_of("rating"))
    return labelled.where("sentiment IS NOT NULL").groupBy(META, "sentiment").agg(F.sum("reviews").alias("reviews"))
