"""Review-shaped views over the supplied star-schema and text tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def reviews(spark: SparkSession, folder: str, nulls: bool = False) -> DataFrame:
    """One review per order line: the part is the product, the quantity sets the stars.

    With ``nulls`` lines numbered 6 have no name and lines numbered 7 no rating.
    The join has no hint: parts are broadcast while Catalyst's size estimate allows, else adaptive
    execution splits the partition of a part that most lines name.
    """
    key = [F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")]
    stars = F.least(F.lit(5), 1 + F.floor(F.sqrt(F.col("l_quantity") / 2))).cast("int")
    name = F.col("p_name")
    if nulls:
        name = F.when(F.col("l_linenumber") != 6, name)
        stars = F.when(F.col("l_linenumber") != 7, stars)
    flag = F.col("l_returnflag")
    label = F.when(flag == "A", "LABEL_0").when(flag == "N", "LABEL_1").otherwise("LABEL_2")
    lines, parts = table(spark, folder, "lineitem"), table(spark, folder, "part")
    return lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).select(
        F.concat_ws("-", *key).alias("review_id"),
        name.alias("name"),
        F.concat("p_type", F.lit(","), "p_brand").alias("categories"),
        F.col("p_brand").alias("primarycategories"),
        F.col("p_type").alias("meta_category"),
        stars.alias("reviews.rating"),
        label.alias("model_label"),
    )


def text_reviews(spark: SparkSession, folder: str) -> DataFrame:
    """One review per document: the source is the product, the language the category."""
    return table(spark, folder, "documents").select(
        F.col("doc_id").alias("review_id"),
        F.col("source").alias("name"),
        F.col("lang").alias("meta_category"),
        (1 + F.col("n_chars") % 5).cast("int").alias("reviews.rating"),
        F.col("text").alias("reviews.text"),
    )


def labelled_texts(spark: SparkSession, folder: str) -> DataFrame:
    """The documents that have a quality label, with that label as text."""
    documents, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    return documents.join(labels, "doc_id").select(
        F.col("doc_id").alias("review_id"),
        F.col("text").alias("reviews.text"),
        F.when(F.col("quality") == 1, "good").otherwise("bad").alias("label"),
    )
