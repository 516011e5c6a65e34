"""All reviews of a product, however many, dealt into blocks of a bounded size in the order of their ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from starloom.fixed_values import NAME, RATING, REVIEW_ID, TEXT
from starloom.functions.columns import named
from starloom.operators.evidence import reviews_of_products
from starloom.session import written_once

BUDGET = 12_000
ORDER = ["id", "rating", "content", "row", "part"]


def product_blocks(
    reviews: DataFrame,
    products: DataFrame,
    budget: int = BUDGET,
    rating_col: str = RATING,
    text_col: str = TEXT,
    id_col: str = REVIEW_ID,
) -> DataFrame:
    """(name, block, reviews, chars, texts, ratings) with every review of the listed products in one block.

    Reviews go by id, null first, and those of one id by rating and content. A text counts its characters and one
    more. A block takes those that begin in the next half of ``budget``, so with a longest text of half the budget none
    holds more than the whole; a longer one is cut into parts that follow each other, and counts as a review where it
    begins. A missing text stays null.

    Places are sums over ids and lengths alone: the rows are put in order over many tasks, summed within each, and
    the few sums of tasks carry on from one to the next. No task sees all reviews of a product.
    """
    half = budget // 2
    if half < 2:
        raise ValueError("a block needs a budget of 4 characters or more")
    parts = written_once(_parts(reviews_of_products(reviews, products), half - 1, rating_col, text_col, id_col), "review-parts")
    slices = int(reviews.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Equal bounds keep a slice's rows together and in order; as a table its places are not drawn a second time.
    ranged = parts.select(NAME, *ORDER, "size").repartitionByRange(slices, NAME, *ORDER)
    ranged = written_once(ranged.withColumn("slice", F.spark_partition_id()), "review-places")
    earlier = Window.rowsBetween(Window.unboundedPreceding, -1)
    sums = ranged.groupBy(NAME, "slice").agg(F.sum("size").alias("size"))
    before = sums.select(NAME, "slice", F.sum("size").over(earlier.partitionBy(NAME).orderBy("slice")).alias("before"))
    inside = F.sum("size").over(earlier.partitionBy(NAME, "slice").orderBy(*ORDER))
    begins = F.coalesce(F.col("inside"), F.lit(0)) + F.coalesce(F.col("before"), F.lit(0))
    placed = ranged.withColumn("inside", inside).join(before, [NAME, "slice"])
    block = F.floor(begins / half).cast("long").alias("block")
    entry = F.struct(*ORDER, "piece")
    return (
        parts.join(placed.select("row", "part", block), ["row", "part"])
        .groupBy(NAME, "block")
        .agg(
            F.count_if(F.col("part") == 0).alias("reviews"),
            F.sum("size").alias("chars"),
            F.array_sort(F.collect_list(entry)).alias("_entries"),
        )
        .select(NAME, "block", "reviews", "chars", F.col("_entries.piece").alias("texts"), F.col("_entries.rating").alias("ratings"))
    )


def _parts(reviews: DataFrame, longest: int, rating_col: str, text_col: str, id_col: str) -> DataFrame:
    text = F.col("text")
    count = F.greatest(F.lit(1), F.ceil(F.coalesce(F.char_length(text), F.lit(0)) / longest))
    starts = F.sequence(F.lit(0).cast("long"), count - 1)
    pieces = F.when(F.char_length(text) <= longest, F.array(text)).otherwise(
        F.transform(starts, lambda i: F.substr(text, (i * longest + 1).cast("int"), F.lit(longest)))
    )
    held = reviews.select(
        named(NAME).alias(NAME), named(id_col).alias("id"), named(rating_col).alias("rating"), named(text_col).cast("string").alias("text")
    )
    held = held.select(NAME, "id", "rating", F.xxhash64("text").alias("content"), F.monotonically_increasing_id().alias("row"), pieces.alias("pieces"))
    cut = held.select(NAME, "id", "rating", "content", "row", F.posexplode("pieces").alias("part", "piece"))
    return cut.withColumn("size", 1 + F.coalesce(F.char_length("piece"), F.lit(0)).cast("long"))
