"""The tables a review dashboard shows for one category."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from pyspark.storagelevel import StorageLevel

from starloom.fixed_values import META, NAME, RATING, SENTIMENT
from starloom.operators.products import chart_of, in_category, product_stats, top_of, worst_of
from starloom.operators.profile import value_counts
from starloom.sources.summaries import summaries_for


def sentiment_distribution(
    reviews: DataFrame, category: str, label_col: str = SENTIMENT
) -> DataFrame:
    """Reviews of a category per sentiment, largest first."""
    counts = value_counts(in_category(reviews, category), label_col)
    return counts.withColumnsRenamed({label_col: "Sentiment", "count": "Count"})


def review_count(reviews: DataFrame, category: str) -> DataFrame:
    """One row: how many reviews a category has."""
    return in_category(reviews, category).agg(F.count(F.lit(1)).alias("num_reviews"))


def category_sizes(reviews: DataFrame) -> DataFrame:
    """``review_count`` for all categories from one pass; reviews without a category stay out."""
    present = reviews.where(F.col(META).isNotNull())
    return present.groupBy(META).agg(F.count(F.lit(1)).alias("num_reviews"))


def dashboard(
    reviews: DataFrame,
    category: str,
    summaries: DataFrame | None = None,
    n_top: int = 3,
    rating_col: str = RATING,
) -> dict[str, DataFrame]:
    """All tables of one category page.

    The filter on the category reaches the scan, where a table that was saved by category reads that
    one folder. Chart, top and worst come from one aggregate, which is kept (a row per product of the
    category, spilling to disk) as long as the session holds it.
    """
    stats = product_stats(in_category(reviews, category), [NAME], rating_col)
    stats = stats.persist(StorageLevel.MEMORY_AND_DISK)
    page = {
        "review_count": review_count(reviews, category),
        "rating_chart": chart_of(stats),
        "sentiment_distribution": sentiment_distribution(reviews, category),
        "top_products": top_of(stats, n_top),
        "worst_product": worst_of(stats),
    }
    if summaries is not None:
        page["summary"] = stored_summary(reviews.sparkSession, summaries, category)
    return page


def stored_summary(spark: SparkSession, summaries: DataFrame, category: str) -> DataFrame:
    """The saved article of one category, an empty text when there is none."""
    return summaries_for(spark, summaries, [category])
