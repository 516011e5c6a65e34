"""Category articles: evidence, what the writer is given, and the written text."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from starloom.fixed_values import AVG, COUNT, META, NAME, RATING, REVIEW_ID, TEXT
from starloom.functions.columns import category_key, two_decimals
from starloom.operators.evidence import article_evidence, review_blocks
from starloom.session import written_once

# Takes one prompt, gives the article.
Write = Callable[[str], str]

LOW_RATING = 2


def product_line() -> Column:
    return F.concat(
        F.col("rank").cast("string"),
        F.lit(". "),
        F.col(NAME),
        F.lit(" (average "),
        F.coalesce(two_decimals(AVG), F.lit("-")),
        F.lit(" from "),
        F.col(COUNT).cast("string"),
        F.lit(" ratings)"),
    )


def product_heading() -> Column:
    return F.concat(
        F.lit("Reviews of "), F.col(NAME), F.lit(" (place "), F.col("rank").cast("string"), F.lit(")\n")
    )


def listed(texts: Column) -> Column:
    """A bullet per text; one that is missing leaves an empty bullet."""
    bullets = F.transform(texts, lambda t: F.concat(F.lit("- "), F.coalesce(t, F.lit(""))))
    return F.array_join(bullets, "\n")


def _joined(role: str, part: str, separator: str) -> Column:
    """The parts of one role's products in rank order; bounded by the number of picks."""
    of_role = F.when(F.col("role") == role, F.struct("rank", part))
    ordered = F.sort_array(F.collect_list(of_role))
    return F.array_join(F.transform(ordered, lambda entry: entry[part]), separator)


def article_inputs(
    evidence: DataFrame, complaints: int | None = None, low_rating: float = LOW_RATING
) -> DataFrame:
    """One row per category with everything an article needs.

    ``top_table`` and ``worst_table`` list the products with their figures, ``top_reviews`` and
    ``worst_reviews`` hold the texts of each product, ``complaints`` those rated ``low_rating`` or less: the
    first ones of each product, or all of its evidence with None.
    Evidence with a cap on reviews bounds the size of a row.
    """
    low = F.filter(
        F.arrays_zip(F.col("texts").alias("text"), F.col("ratings").alias("rating")),
        lambda r: (r["rating"] <= low_rating) & r["text"].isNotNull(),
    )
    if complaints is not None:
        low = F.slice(low, 1, complaints)
    low = F.transform(low, lambda r: r["text"])
    blocks = review_blocks(evidence).select(
        META,
        "role",
        "rank",
        product_line().alias("line"),
        F.concat(product_heading(), listed(F.col("texts"))).alias("block"),
        F.when(
            F.size(low) > 0, F.concat(F.col(NAME), F.lit(":\n"), listed(low))
        ).alias("complaint"),
    )
    return assembled(blocks)


def assembled(blocks: DataFrame) -> DataFrame:
    """One row per category from rows of products: their ``line``, ``block`` and ``complaint`` by role and rank."""
    return (
        blocks.groupBy(META)
        .agg(
            _joined("top", "line", "\n").alias("top_table"),
            _joined("top", "block", "\n\n").alias("top_reviews"),
            _joined("top", "complaint", "\n").alias("complaints"),
            _joined("worst", "line", "\n").alias("worst_table"),
            _joined("worst", "block", "\n\n").alias("worst_reviews"),
        )
        .withColumn("category_key", category_key(META))
    )


def article_prompt() -> Column:
    """The request to a writing model, over the columns of ``article_inputs``."""
    return F.concat(
        F.lit("Write a short blog post about the product category "),
        F.col(META),
        F.lit(".\n\nCompare the products with the most reviews:\n"),
        F.col("top_table"),
        F.lit("\n\nTell what their reviewers say and complain about most:\n\n"),
        F.col("top_reviews"),
        F.lit("\n\nAlso warn of the product with the lowest rating, and say why:\n"),
        F.col("worst_table"),
        F.lit("\n\n"),
        F.col("worst_reviews"),
    )


def article_from_template() -> Column:
    """An article without a model: every product and complaint in it comes from the evidence."""
    none = F.lit("None among the reviews read.")
    return F.concat(
        F.lit("# "),
        F.col(META),
        F.lit("\n\n## Most reviewed\n\n"),
        F.col("top_table"),
        F.lit("\n\n## Complaints\n\n"),
        F.when(F.col("complaints") == "", none).otherwise(F.col("complaints")),
        F.lit("\n\n## Avoid\n\n"),
        F.col("worst_table"),
        F.lit("\n"),
    )


def write_articles(
    inputs: DataFrame,
    load_model: Callable[[], Write] | None = None,
    calls: int | None = None,
    prompt: Column | None = None,
) -> DataFrame:
    """``category_key, summary``, ready for the summary store.

    ``load_model`` runs once per task and returns a function from prompt to article. The categories are
    spread over ``calls`` tasks, so that slow generation runs side by side, and the articles are
    written to the shared scratch folder, so that each is generated once. ``prompt`` replaces the
    request by an expression of your own over the columns of ``article_inputs``.
    """
    if load_model is None:
        return inputs.select("category_key", article_from_template().alias("summary"))

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = None
        for batch in batches:
            model = model or load_model()
            texts = [model(prompt) for prompt in batch["prompt"]]
            yield pd.DataFrame({"category_key": batch["category_key"], "summary": texts})

    calls = calls or inputs.sparkSession.sparkContext.defaultParallelism
    prompt = article_prompt() if prompt is None else prompt
    asked = inputs.select("category_key", prompt.alias("prompt")).repartition(calls)
    written = asked.mapInPandas(write, "category_key string, summary string")
    return written_once(written, "articles")


def generate_category_blogs(
    reviews: DataFrame,
    category: str | None = None,
    load_model: Callable[[], Write] | None = None,
    n_top: int = 3,
    max_reviews_per_product: int = 30,
    rating_col: str = RATING,
    text_col: str = TEXT,
    id_col: str = REVIEW_ID,
    complaints: int | None = None,
    low_rating: float = LOW_RATING,
) -> DataFrame:
    """Articles for all categories, or for one of them."""
    evidence = article_evidence(
        reviews, n_top, max_reviews_per_product, rating_col, text_col, id_col, category
    )
    return write_articles(article_inputs(evidence, complaints, low_rating), load_model)
