"""Raw category strings to meta-categories: classify each string once, join the answer back."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from starloom.fixed_values import CATEGORIES, META, META_CATEGORIES, PRIMARY
from starloom.functions.columns import named, strip
from starloom.functions.prompts import CATEGORY_TEMPLATE, category_prompt
from starloom.operators.bounded import small_side
from starloom.operators.profile import category_crosstab
from starloom.session import written_once

# Words that decide a category, the first entry with a match wins. The first two entries restate
# the rules that the model is given in its question.
DEFAULT_RULES = [
    ("Health & Beauty", ["health & beauty", "health and beauty"]),
    ("Pet Supplies", ["litter box"]),
    ("Pet Supplies", ["pet suppl", "pet product", "dog", "cat litter", "litter"]),
    ("Tablets & E-readers", ["tablet", "e-reader", "ereader", "ebook reader", "kindle"]),
    ("Office Supplies", ["office", "laptop stand", "desk"]),
    ("Home & Kitchen", ["kitchen", "home & garden", "household", "storage", "appliance"]),
    ("Health & Beauty", ["batter", "personal care", "health"]),
    ("Electronics", ["electronic", "audio", "video", "smart home", "camera", "computer", "cable"]),
]

# Takes the questions of one batch, gives an answer for each.
Answer = Callable[[list[str]], list[str]]


def category_by_rules(
    category: str | Column, rules: Sequence[tuple[str, Sequence[str]]] = DEFAULT_RULES
) -> Column:
    """The meta-category of the first rule that has a word of the category; null when none has."""
    lowered = F.lower(named(category))
    found = None
    for answer, words in rules:
        hit = F.contains(lowered, F.lit(words[0].lower()))
        for word in words[1:]:
            hit = hit | F.contains(lowered, F.lit(word.lower()))
        found = (F if found is None else found).when(hit, F.lit(answer))
    return F.lit(None).cast("string") if found is None else found


def distinct_categories(reviews: DataFrame, category_col: str = CATEGORIES) -> DataFrame:
    """Each raw category string once. This is all the classifier gets to see."""
    return (
        reviews.select(named(category_col).alias(CATEGORIES))
        .where(F.col(CATEGORIES).isNotNull())
        .distinct()
    )


def classify_categories(
    raw: DataFrame,
    options: Sequence[str] | None = None,
    rules: Sequence[tuple[str, Sequence[str]]] | None = None,
    load_model: Callable[[], Answer] | None = None,
    template: str = CATEGORY_TEMPLATE,
    calls: int | None = None,
) -> DataFrame:
    """The mapping ``categories -> meta_category`` for a table of distinct category strings.

    With ``load_model`` each string becomes a question to a model, which is loaded once per task. The
    strings are spread over ``calls`` tasks, since a call costs far more than moving the string,
    and the answers are written to the shared scratch folder, so that no string is asked again.
    They are stripped and kept even if they are not among the options; ``mapping_audit`` counts
    those. Without a model the keyword rules decide, in the JVM.
    """
    options = list(options or META_CATEGORIES)
    if load_model is None:
        if rules is None:
            rules = DEFAULT_RULES
        known = [rule for rule in rules if rule[0] in options]
        return raw.select(CATEGORIES, category_by_rules(CATEGORIES, known).alias(META))

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = None
        for batch in batches:
            model = model or load_model()
            answers = model(batch["question"].tolist())
            yield pd.DataFrame({CATEGORIES: batch[CATEGORIES], META: answers})

    calls = calls or raw.sparkSession.sparkContext.defaultParallelism
    asked = raw.select(
        CATEGORIES, category_prompt(CATEGORIES, options, template).alias("question")
    ).repartition(calls)
    answered = asked.mapInPandas(ask, f"{CATEGORIES} string, {META} string")
    return written_once(answered.withColumn(META, strip(META)), "category-mapping")


def mapping_table(spark, mapping: Mapping[str, str]) -> DataFrame:
    """A dictionary as a mapping table."""
    return spark.createDataFrame(list(mapping.items()), f"{CATEGORIES} string, {META} string")


def join_mapping(
    reviews: DataFrame, mapping: DataFrame, category_col: str = CATEGORIES
) -> DataFrame:
    """Add ``meta_category``; every review stays, with null where the mapping has no entry.

    The mapping must name each string once, which is counted on the cluster whatever its size. It is
    broadcast when it is small.
    """
    side = mapping.select(F.col(CATEGORIES).alias("_raw"), META)
    named_ = side.where(F.col("_raw").isNotNull()).groupBy("_raw").agg(F.count(F.lit(1)).alias("n"))
    twice = named_.where("n > 1").first()
    if twice is not None:
        raise ValueError(f"the mapping names a category more than once: {twice['_raw']}")
    side, _ = small_side(side)
    return reviews.join(side, named(category_col) == F.col("_raw"), "left").drop("_raw")


def with_meta_category(
    reviews: DataFrame,
    rules: Sequence[tuple[str, Sequence[str]]] = DEFAULT_RULES,
    category_col: str = CATEGORIES,
    options: Sequence[str] | None = None,
) -> DataFrame:
    """The rules straight on the reviews: the same result as mapping and join, with no shuffle."""
    known = [rule for rule in rules if options is None or rule[0] in options]
    return reviews.withColumn(META, category_by_rules(category_col, known))


def mapping_audit(
    reviews: DataFrame,
    options: Sequence[str] | None = None,
    columns: Sequence[str] = (CATEGORIES, PRIMARY, META),
) -> DataFrame:
    """The cross-tab of raw, source and mapped category, with a flag for answers off the list."""
    options = list(options or META_CATEGORIES)
    return category_crosstab(reviews, columns).withColumn(
        "off_list", ~named(columns[-1]).isin(*options)
    )


def mapping_summary(
    reviews: DataFrame, options: Sequence[str] | None = None, meta_col: str = META
) -> DataFrame:
    """One row: reviews with an answer on the list, off the list, and with none."""
    options = list(options or META_CATEGORIES)
    meta = named(meta_col)
    return reviews.agg(
        F.count_if(meta.isin(*options)).alias("on_list"),
        F.count_if(~meta.isin(*options)).alias("off_list"),
        F.count_if(meta.isNull()).alias("unmapped"),
    )
