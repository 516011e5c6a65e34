"""Articles from all reviews of their products: blocks are summed up, and the answers again, as a tree."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from starloom.fixed_values import AVG, COUNT, META, NAME, RATING, REVIEW_ID, TEXT
from starloom.operators.bounded import small_side
from starloom.operators.evidence import PICK_KEY
from starloom.operators.products import in_category, picked_products, product_stats
from starloom.operators.text_blocks import BUDGET, product_blocks
from starloom.plans import articles
from starloom.session import written_once

FAN = 8


def block_prompt() -> Column:
    """The request for one block, over the columns of ``product_blocks``."""
    return F.concat(
        F.lit("Sum up in a few sentences what these reviews of "),
        F.col(NAME),
        F.lit(" praise and what they complain about:\n"),
        articles.listed(F.col("texts")),
    )


def merge_prompt() -> Column:
    """The request to make one summary of several, over ``name`` and ``answers``."""
    return F.concat(
        F.lit("Make one summary of these summaries of reviews of "),
        F.col(NAME),
        F.lit(":\n"),
        articles.listed(F.col("answers")),
    )


def digest_blocks(
    blocks: DataFrame,
    load_model: Callable[[], articles.Write],
    fan: int = FAN,
    budget: int = BUDGET,
    calls: int | None = None,
) -> DataFrame:
    """(name, digest, blocks): one text for each product from the answers to all its blocks.

    Up to ``fan`` answers that follow each other become one, and so on until one is left; a single one is not asked
    about again. An answer may have ``budget / fan`` characters and is cut there, which bounds every request. Each
    round is written to the shared scratch folder, so that nothing is asked twice.
    """
    if fan < 2:
        raise ValueError("a tree needs a fan of 2 or more")
    calls = calls or blocks.sparkSession.sparkContext.defaultParallelism
    share = budget // fan
    asked = blocks.select(NAME, F.col("block").alias("node"), F.lit(1).cast("long").alias("blocks"), block_prompt().alias("prompt"))
    answers = _answered(asked, load_model, share, calls)
    while (answers.agg(F.max("node")).first()[0] or 0) > 0:
        entry = F.struct("node", "answer")
        nodes = answers.groupBy(NAME, F.floor(F.col("node") / fan).cast("long").alias("node")).agg(
            F.sum("blocks").alias("blocks"), F.array_sort(F.collect_list(entry))["answer"].alias("answers")
        )
        nodes = written_once(nodes, "digest-nodes")
        several = nodes.where(F.size("answers") > 1).select(NAME, "node", "blocks", merge_prompt().alias("prompt"))
        single = nodes.where(F.size("answers") == 1).select(NAME, "node", "blocks", F.col("answers")[0].alias("answer"))
        answers = _answered(several, load_model, share, calls).unionByName(single)
    return answers.select(NAME, F.col("answer").alias("digest"), "blocks")


def _answered(asked: DataFrame, load_model: Callable[[], articles.Write], share: int, calls: int) -> DataFrame:
    def answer(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = None
        for batch in batches:
            model = model or load_model()
            texts = [model(prompt) for prompt in batch["prompt"]]
            yield batch[[NAME, "node", "blocks"]].assign(answer=[None if t is None else t[:share] for t in texts])

    answered = asked.repartition(calls).mapInPandas(answer, f"`{NAME}` string, node long, blocks long, answer string")
    return written_once(answered, "digests")


def digest_inputs(
    reviews: DataFrame,
    load_model: Callable[[], articles.Write],
    category: str | None = None,
    n_top: int = 3,
    rating_col: str = RATING,
    text_col: str = TEXT,
    id_col: str = REVIEW_ID,
    budget: int = BUDGET,
    fan: int = FAN,
) -> DataFrame:
    """What ``article_inputs`` gives, with a digest of all reviews in place of the first ones.

    A product that stands in several places is digested once. Complaints are part of the digests.
    """
    rated = reviews if category is None else in_category(reviews, category)
    picks, _ = small_side(picked_products(product_stats(rated, rating_col=rating_col), n_top))
    blocks = product_blocks(reviews, picks.select(NAME).distinct(), budget, rating_col, text_col, id_col)
    digests = digest_blocks(blocks, load_model, fan, budget).select(NAME, "digest")
    products = picks.join(digests, NAME, "left").select(*PICK_KEY, AVG, COUNT, "digest")
    return articles.assembled(
        products.select(
            META,
            "role",
            "rank",
            articles.product_line().alias("line"),
            F.concat(articles.product_heading(), F.coalesce("digest", F.lit(""))).alias("block"),
            F.lit(None).cast("string").alias("complaint"),
        )
    )


def generate_whole_blogs(
    reviews: DataFrame, load_model: Callable[[], articles.Write], category: str | None = None, **options
) -> DataFrame:
    """Articles as of ``generate_category_blogs``, written from all reviews; ``options`` are those of ``digest_inputs``."""
    return articles.write_articles(digest_inputs(reviews, load_model, category, **options), load_model)
