"""The review texts behind the top and worst products of each category."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from starloom.fixed_values import AVG, COUNT, META, NAME, RATING, REVIEW_ID, TEXT
from starloom.functions.columns import named
from starloom.operators.bounded import only_listed, small_side
from starloom.operators.products import in_category, picked_products, product_stats
from starloom.operators.ranking import first_k

PICK_KEY = [META, "role", "rank", NAME]


def reviews_of_products(reviews: DataFrame, products: DataFrame) -> DataFrame:
    """All reviews of the named products, of whatever category, filtered where they are read."""
    return only_listed(reviews, NAME, *small_side(products))


def first_reviews(
    reviews: DataFrame, products: DataFrame, k: int, id_col: str = REVIEW_ID
) -> DataFrame:
    """The first ``k`` reviews of each listed product by id, numbered in ``pos``."""
    return _first_reviews(reviews, *small_side(products), k, id_col)


def _first_reviews(
    reviews: DataFrame, listed: DataFrame, rows: pa.Table | None, k: int, id_col: str
) -> DataFrame:
    """Ids alone are ranked first; the texts of the chosen ids are fetched in a second pass.

    The long column is so neither sorted nor shuffled for reviews that are not used. Where ids follow
    the order of the files, most of it is not even read: no chosen id is above their maximum.
    """
    by_id = [named(id_col).asc()]
    if rows is None:
        # A join of two plain tables, in which the partition of a hot name can be split; ranking follows
        # in slices of a name.
        of_products = reviews.select(NAME, named(id_col)).join(listed.select(named(NAME)), NAME, "left_semi")
    else:
        reviews = only_listed(reviews, NAME, listed, rows)
        of_products = reviews.select(NAME, named(id_col))
    ids = first_k(of_products, [NAME], by_id, k, "pos", sliced=True)
    wanted, chosen = small_side(
        ids.select(named(NAME).alias("_name"), named(id_col).alias("_id")).distinct()
    )
    if chosen is not None:
        present = [key for key in chosen["_id"].to_pylist() if key is not None]
        in_reach = named(id_col).isNull()
        if present:
            in_reach = in_reach | (named(id_col) <= F.lit(max(present)))
        reviews = reviews.where(in_reach)
    # An id that more than one review carries can bring in too many rows: number them again.
    same = (named(NAME) == F.col("_name")) & named(id_col).eqNullSafe(F.col("_id"))
    return first_k(reviews.join(wanted, same, "left_semi"), [NAME], by_id, k, "pos")


def article_evidence(
    reviews: DataFrame,
    n_top: int = 3,
    max_reviews_per_product: int | None = 30,
    rating_col: str = RATING,
    text_col: str = TEXT,
    id_col: str = REVIEW_ID,
    category: str | None = None,
) -> DataFrame:
    """One row per category, role, product and review, with the product's statistics.

    Products are picked inside their category, but their reviews are matched by name alone, so
    those that stand in another category come along. ``None`` lifts the cap on reviews; the
    rows then carry no position, as their order is that of the id.
    """
    rated = reviews if category is None else in_category(reviews, category)
    picks, rows = small_side(picked_products(product_stats(rated, rating_col=rating_col), n_top))
    texts = reviews.select(
        NAME,
        named(id_col).alias(REVIEW_ID),
        named(rating_col).alias("rating"),
        named(text_col).alias("text"),
    )
    if max_reviews_per_product is None:
        # The join with the picks below filters by name; a semi join before it would keep it from
        # splitting the partition of a hot name.
        used = texts if rows is None else only_listed(texts, NAME, picks, rows)
        used = used.withColumn("pos", F.lit(None).cast("int"))
    else:
        used = _first_reviews(texts, picks, rows, max_reviews_per_product, REVIEW_ID)
    return used.join(picks, NAME).select(
        *PICK_KEY, AVG, COUNT, "pos", REVIEW_ID, "rating", "text"
    )


def review_blocks(evidence: DataFrame) -> DataFrame:
    """Texts per picked product in review order, a missing text kept as null.

    The cap of the evidence bounds what is gathered into one row; evidence without one is refused, and
    ``text_blocks.product_blocks`` deals all reviews into blocks.
    """
    no_cap = F.raise_error(F.lit("review blocks need evidence with a cap on reviews"))
    pos = F.when(F.col("pos").isNull(), no_cap.cast("int")).otherwise(F.col("pos"))
    entry = F.struct(pos.alias("pos"), "rating", "text")
    return (
        evidence.groupBy(*PICK_KEY, AVG, COUNT)
        .agg(F.sort_array(F.collect_list(entry)).alias("_entries"))
        .withColumn("texts", F.col("_entries.text"))
        .withColumn("ratings", F.col("_entries.rating"))
        .drop("_entries")
    )
