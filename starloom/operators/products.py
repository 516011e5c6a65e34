"""Product statistics, top lists and worst products."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from starloom.fixed_values import AVG, COUNT, META, NAME, RATING, REPORT_NAMES
from starloom.functions.columns import named, short_name
from starloom.operators.ranking import first_k


def most_reviewed_first() -> list[Column]:
    """Ties go by name, so that a result does not depend on how the rows are spread."""
    return [F.desc(COUNT), F.asc(NAME)]


def worst_first() -> list[Column]:
    """A product without any rating has no mean and comes last."""
    return [F.asc_nulls_last(AVG), F.asc(NAME)]


def in_category(df: DataFrame, category: str, category_col: str = META) -> DataFrame:
    return df.where(named(category_col) == F.lit(category))


def product_stats(
    reviews: DataFrame, keys: Sequence[str] = (META, NAME), rating_col: str = RATING
) -> DataFrame:
    """Mean and number of the ratings per product; rows without a key count nowhere.

    One aggregate that combines in each partition first, so a product that holds a third of all
    reviews sends one row per partition through the shuffle.
    """
    rating = named(rating_col)
    for key in keys:
        reviews = reviews.where(named(key).isNotNull())
    return reviews.groupBy(*[named(key) for key in keys]).agg(
        F.avg(rating).alias(AVG), F.count(rating).alias(COUNT)
    )


def product_means(reviews: DataFrame, rating_col: str = RATING) -> DataFrame:
    """Mean rating of every product in every category, lowest first."""
    stats = product_stats(reviews, rating_col=rating_col)
    return stats.select(META, NAME, AVG).orderBy(*worst_first(), META)


def as_report(stats: DataFrame) -> DataFrame:
    return stats.withColumnsRenamed(REPORT_NAMES)


def get_top_n(
    reviews: DataFrame, category: str, n: int = 3, rating_col: str = RATING
) -> DataFrame:
    """The ``n`` products of a category with the most reviews."""
    return top_of(product_stats(in_category(reviews, category), [NAME], rating_col), n)


def get_worst(reviews: DataFrame, category: str, rating_col: str = RATING) -> DataFrame:
    """The product of a category with the lowest mean; no row for an empty category."""
    return worst_of(product_stats(in_category(reviews, category), [NAME], rating_col))


def rating_chart(
    reviews: DataFrame, category: str, n: int = 10, rating_col: str = RATING
) -> DataFrame:
    """Rows of the rating chart: the most reviewed products with a name that fits an axis."""
    return chart_of(product_stats(in_category(reviews, category), [NAME], rating_col), n)


def top_of(stats: DataFrame, n: int = 3) -> DataFrame:
    """``get_top_n`` from the product statistics of one category."""
    return as_report(stats.orderBy(*most_reviewed_first()).limit(n))


def worst_of(stats: DataFrame) -> DataFrame:
    return as_report(stats.orderBy(*worst_first()).limit(1))


def chart_of(stats: DataFrame, n: int = 10) -> DataFrame:
    return stats.orderBy(*most_reviewed_first()).limit(n).withColumn("short_name", short_name(NAME))


def top_per_category(stats: DataFrame, n: int = 3) -> DataFrame:
    """``get_top_n`` for all categories at once, from product statistics."""
    return first_k(stats, [META], most_reviewed_first(), n, "rank")


def worst_per_category(stats: DataFrame, n: int = 1) -> DataFrame:
    return first_k(stats, [META], worst_first(), n, "rank")


def picked_products(stats: DataFrame, n_top: int = 3) -> DataFrame:
    """Top and worst products of every category; a product may be both, once in each role."""
    top = top_per_category(stats, n_top).withColumn("role", F.lit("top"))
    worst = worst_per_category(stats).withColumn("role", F.lit("worst"))
    return top.unionByName(worst)
