
from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession, functions as F

from starloom.fixed_values import NULL_TOKENS
from starloom.functions import columns as fn
from starloom.functions.prompts import category_prompt
from starloom.operators import (
    categories,
    cleaning,
    closest,
    clusters,
    count_model,
    evidence,
    labels,
    metrics,
    products,
    profile,
    sampling,
    sentiment,
    steady_clusters,
    text_blocks,
    text_model,
    token_cut,
)
from starloom.plans import articles, digests, reports
from starloom.session import scratch_path, written_once
from starloom.sources import running_profile, running_stats, summaries, views
from starloom.sources import reviews as review_files

try:
    import corpus_pipeline
    from starloom.llm import queries as llm
except ModuleNotFoundError as missing:
    # Only the subpackage itself may be absent; a library that it needs may not.
    if missing.name not in ("corpus_pipeline", "starloom.llm"):
        raise
    corpus_pipeline = llm = None

CATEGORY = "PROMO"
# Meta-category rules for the review view: some brands first, then the type in the raw string. No
# rule names LARGE, so some strings stay unmapped.
VIEW_OPTIONS = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
VIEW_RULES = [
    ("PROMO", ["brand#13", "Brand#21"]),
    ("ECONOMY", ["economy"]),
    ("MEDIUM", ["medium"]),
    ("SMALL", ["small"]),
    ("STANDARD", ["standard"]),
    ("PROMO", ["promo"]),
]
AUDIT_OPTIONS = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL"]
# Words that occur in the invented languages of the documents.
NEGATIVE_WORDS = ["the", "le", "der", "el", "un", "la"]
POSITIVE_WORDS = ["and", "de", "und", "en", "that", "qui", "que", "des", "ich", "los", "avec"]
# Languages whose stored summary is replaced.
REWRITTEN = ["de", "en"]


def entry(spark: SparkSession) -> DataFrame:
    """The three most reviewed products of every category."""
    return top3_per_category(spark, "/root/testdata/sf0.001")


# Products -----------------------------------------------------------------------------------------


def _stats(spark: SparkSession, sf: str) -> DataFrame:
    return products.product_stats(views.reviews(spark, sf))


def _ranked(picked: DataFrame) -> DataFrame:
    return picked.select("meta_category", "rank", "name", "avg_rating", "num_reviews")


def top3_per_category(spark: SparkSession, sf: str) -> DataFrame:
    return _ranked(products.top_per_category(_stats(spark, sf), 3))


def worst_per_category(spark: SparkSession, sf: str) -> DataFrame:
    return _ranked(products.worst_per_category(_stats(spark, sf)))


def picked_products(spark: SparkSession, sf: str) -> DataFrame:
    picked = products.picked_products(_stats(spark, sf), 3)
    return picked.select("meta_category", "role", "rank", "name", "avg_rating", "num_reviews")


def product_stats(spark: SparkSession, sf: str) -> DataFrame:
    return _stats(spark, sf)


def product_stats_nulls(spark: SparkSession, sf: str) -> DataFrame:
    return products.product_stats(views.reviews(spark, sf, nulls=True))


def product_means(spark: SparkSession, sf: str) -> DataFrame:
    return products.product_means(views.reviews(spark, sf))


def top_n_one_category(spark: SparkSession, sf: str) -> DataFrame:
    return products.get_top_n(views.reviews(spark, sf), CATEGORY, 3)


def worst_one_category(spark: SparkSession, sf: str) -> DataFrame:
    return products.get_worst(views.reviews(spark, sf), CATEGORY)


def rating_chart(spark: SparkSession, sf: str) -> DataFrame:
    return products.rating_chart(views.reviews(spark, sf), CATEGORY)


def display_formats(spark: SparkSession, sf: str) -> DataFrame:
    return _stats(spark, sf).select(
        "meta_category",
        "name",
        fn.short_name("name", 6).alias("short"),
        fn.two_decimals("avg_rating").alias("avg_text"),
        fn.thousands("num_reviews").alias("count_text"),
    )


# Labels -------------------------------------------------------------------------------------------


def _labelled(spark: SparkSession, sf: str) -> DataFrame:
    return labels.assign_sentiment_labels(views.reviews(spark, sf))


def _predicted(spark: SparkSession, sf: str) -> DataFrame:
    return labels.attach_model_labels(_labelled(spark, sf), "model_label")


def clean_columns(spark: SparkSession, sf: str) -> DataFrame:
    raw = views.reviews(spark, sf).withColumnsRenamed(
        {"name": "Name", "primarycategories": "primaryCategories", "model_label": "reviews.id"}
    )
    return cleaning.plain_names(cleaning.clean_columns(raw))


def sentiment_labels(spark: SparkSession, sf: str) -> DataFrame:
    nulls = labels.assign_sentiment_labels(
        views.reviews(spark, sf, nulls=True)
    )
    return cleaning.plain_names(nulls.select("review_id", "`reviews.rating`", "rating_sentiment"))


def label_codes(spark: SparkSession, sf: str) -> DataFrame:
    coded = labels.encode_labels(_labelled(spark, sf))
    coded = labels.decode_labels(coded, "actual_sentiment", "decoded")
    return coded.select("review_id", "rating_sentiment", "actual_sentiment", "decoded")


def model_label_map(spark: SparkSession, sf: str) -> DataFrame:
    return _predicted(spark, sf).select("review_id", "model_label", "predicted_sentiment")


def category_keys(spark: SparkSession, sf: str) -> DataFrame:
    named = views.reviews(spark, sf).withColumn(
        "label", F.concat_ws(" & ", "meta_category", "name", F.concat("meta_category", F.lit("&x")))
    )
    return named.select("label").distinct().withColumn("key", fn.category_key("label"))


# Profiles -----------------------------------------------------------------------------------------


def rating_counts(spark: SparkSession, sf: str) -> DataFrame:
    counts = profile.value_counts(views.reviews(spark, sf, nulls=True), "reviews.rating")
    return cleaning.plain_names(counts)


def sentiment_share(spark: SparkSession, sf: str) -> DataFrame:
    nulls = labels.assign_sentiment_labels(
        views.reviews(spark, sf, nulls=True)
    )
    return profile.class_shares(nulls)


def category_crosstab(spark: SparkSession, sf: str) -> DataFrame:
    return profile.category_crosstab(views.reviews(spark, sf))


def distinct_categories(spark: SparkSession, sf: str) -> DataFrame:
    return profile.distinct_values(views.reviews(spark, sf, nulls=True), "name")


def distinct_counts(spark: SparkSession, sf: str) -> DataFrame:
    nulls = views.reviews(spark, sf, nulls=True)
    return profile.distinct_counts(nulls, "categories", "name", "meta_category")


def null_profile(spark: SparkSession, sf: str) -> DataFrame:
    return profile.null_counts(views.reviews(spark, sf, nulls=True))


def table_profile(spark: SparkSession, sf: str) -> DataFrame:
    return profile.table_profile(views.reviews(spark, sf, nulls=True))


def smallest_class(spark: SparkSession, sf: str) -> DataFrame:
    return profile.smallest_class(_labelled(spark, sf))


def sentiment_distribution(spark: SparkSession, sf: str) -> DataFrame:
    return reports.sentiment_distribution(_labelled(spark, sf), CATEGORY)


def category_sizes(spark: SparkSession, sf: str) -> DataFrame:
    return reports.category_sizes(views.reviews(spark, sf))


def category_review_count(spark: SparkSession, sf: str) -> DataFrame:
    return reports.review_count(views.reviews(spark, sf), CATEGORY)


def class_slice(spark: SparkSession, sf: str) -> DataFrame:
    neutral = _labelled(spark, sf).where(F.col("rating_sentiment") == "neutral")
    return neutral.select("review_id", "name", "rating_sentiment")


def primary_category_slice(spark: SparkSession, sf: str) -> DataFrame:
    reviews = views.reviews(spark, sf).where(F.col("primarycategories") == "Brand#7")
    return reviews.select("review_id", "primarycategories", "name")


def preview(spark: SparkSession, sf: str) -> DataFrame:
    first = views.reviews(spark, sf).select("review_id", "name", "categories")
    return first.orderBy("review_id").limit(10)


# Samples ------------------------------------------------------------------------------------------


def balanced_sample_default(spark: SparkSession, sf: str) -> DataFrame:
    sample = sampling.balance_classes(_labelled(spark, sf))
    return sample.select("review_id", "name", "rating_sentiment")


def balanced_sample_1206(spark: SparkSession, sf: str) -> DataFrame:
    sample = sampling.balance_classes(_labelled(spark, sf), n_per_class=1206)
    return sample.select("review_id", "name", "rating_sentiment")


def balanced_sample_null_ids(spark: SparkSession, sf: str) -> DataFrame:
    """Sizes of a sample from a table of which a third has no id, and whether it holds its share of those."""
    linenumber = F.split("review_id", "-")[1].cast("int")
    some = _labelled(spark, sf).withColumn("line", F.col("review_id"))
    some = some.withColumn("review_id", F.when(linenumber % 3 != 0, F.col("review_id")))
    found = sampling.balance_classes(some).groupBy("rating_sentiment").agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.col("review_id").isNull().cast("int")).alias("share")
    )
    return found.select("rating_sentiment", "n", F.col("share").between(0.2, 0.4).alias("share_without_id"))


def hash_split(spark: SparkSession, sf: str) -> DataFrame:
    part = F.when(sampling.in_test_split(0.3), "test").otherwise("train")
    return views.reviews(spark, sf).select("review_id", part.alias("part"))


def concat_tables(spark: SparkSession, sf: str) -> DataFrame:
    """Two review tables with different columns, stacked."""
    texts = views.text_reviews(spark, sf).drop("reviews.text")
    both = sampling.concat(
        views.reviews(spark, sf).drop("model_label", "primarycategories"),
        texts.withColumn("review_id", F.col("review_id").cast("string")),
    )
    return cleaning.plain_names(both)


# Metrics ------------------------------------------------------------------------------------------


def classification_report(spark: SparkSession, sf: str) -> DataFrame:
    report = metrics.classification_report(_predicted(spark, sf))
    rounded = {c: F.round(c, 9) for c in ("precision", "recall", "f1_score")}
    return report.withColumns(rounded)


def confusion_matrix(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.confusion_matrix(_predicted(spark, sf), others=None)


def _with_gaps(spark: SparkSession, sf: str) -> DataFrame:
    """No prediction for four stars, and a label off the list for one star."""
    rating = F.col("`reviews.rating`")
    said = F.when(rating == 1, "unsure").when(rating != 4, F.col("predicted_sentiment"))
    return _predicted(spark, sf).withColumn("predicted_sentiment", said)


def report_with_gaps(spark: SparkSession, sf: str) -> DataFrame:
    report = metrics.classification_report(_with_gaps(spark, sf))
    return report.withColumns({c: F.round(c, 9) for c in ("precision", "recall", "f1_score")})


def confusion_off_list(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.confusion_matrix(_with_gaps(spark, sf), labels=["negative", "positive"])


# Category mapping ---------------------------------------------------------------------------------


def _mapping(reviews: DataFrame) -> DataFrame:
    raw = categories.distinct_categories(reviews)
    return categories.classify_categories(raw, VIEW_OPTIONS, VIEW_RULES)


def _mapped(spark: SparkSession, sf: str) -> DataFrame:
    reviews = views.reviews(spark, sf).drop("meta_category")
    return categories.join_mapping(reviews, _mapping(reviews))


def category_mapping(spark: SparkSession, sf: str) -> DataFrame:
    return _mapping(views.reviews(spark, sf))


def reviews_with_meta(spark: SparkSession, sf: str) -> DataFrame:
    return _mapped(spark, sf).select("review_id", "categories", "meta_category")


def reviews_with_meta_rules(spark: SparkSession, sf: str) -> DataFrame:
    mapped = categories.with_meta_category(views.reviews(spark, sf), VIEW_RULES)
    return mapped.select("review_id", "categories", "meta_category")


def category_mapping_own_options(spark: SparkSession, sf: str) -> DataFrame:
    """Options that some rules do not name, and options that no rule names."""
    raw = categories.distinct_categories(views.reviews(spark, sf))
    some = categories.classify_categories(raw, ["SMALL", "Toys"], VIEW_RULES)
    none = categories.classify_categories(raw, ["Toys", "Garden"], VIEW_RULES)
    return some.join(none.withColumnRenamed("meta_category", "without_rule"), "categories")


def category_mapping_hook(spark: SparkSession, sf: str) -> DataFrame:
    """Answers of a model that tells the length of its question; each distinct string is asked once."""

    def load():
        return lambda questions: [f" option {len(question) % 3}\n" for question in questions]

    raw = categories.distinct_categories(views.reviews(spark, sf))
    template = "Which of {options} is '{cat}'? Answer with one name."
    return categories.classify_categories(raw, VIEW_OPTIONS, load_model=load, template=template)


def answers_held(spark: SparkSession, sf: str) -> DataFrame:
    """Misspelt answers, two edits away and more, held to the types that parts have."""
    said = F.lower(F.split("categories", ",")[0])
    at = (1 + F.length("categories") % 9).cast("int")
    misspelt = F.concat(F.substr(said, F.lit(1), at - 1), F.substr(said, at + 1), F.when(F.length(said) % 4 == 0, "xyz").otherwise("x"))
    mapping = categories.distinct_categories(views.reviews(spark, sf)).withColumn("meta_category", misspelt)
    types = views.table(spark, sf, "part").select(F.col("p_type").alias("option")).distinct()
    return closest.hold_to_options(mapping, types)


def mapping_audit(spark: SparkSession, sf: str) -> DataFrame:
    return categories.mapping_audit(_mapped(spark, sf), AUDIT_OPTIONS)


def mapping_summary(spark: SparkSession, sf: str) -> DataFrame:
    return categories.mapping_summary(_mapped(spark, sf), AUDIT_OPTIONS)


def category_prompts(spark: SparkSession, sf: str) -> DataFrame:
    raw = categories.distinct_categories(views.reviews(spark, sf))
    template = "Which of {options} is '{cat}'? Answer with one name."
    return raw.select(
        "categories", category_prompt("categories", VIEW_OPTIONS, template).alias("prompt")
    )


# Articles -----------------------------------------------------------------------------------------


def _evidence(spark: SparkSession, sf: str, cap: int | None = 30) -> DataFrame:
    return evidence.article_evidence(views.text_reviews(spark, sf), 3, cap)


def _articles(spark: SparkSession, sf: str) -> DataFrame:
    return articles.write_articles(articles.article_inputs(_evidence(spark, sf), complaints=3))


def product_reviews(spark: SparkSession, sf: str) -> DataFrame:
    """Reviews of every top and worst product, matched by name across categories."""
    reviews = views.reviews(spark, sf)
    picked = products.picked_products(products.product_stats(reviews), 3)
    found = evidence.reviews_of_products(reviews, picked)
    return found.select("review_id", "name", "meta_category")


def article_evidence(spark: SparkSession, sf: str) -> DataFrame:
    return _evidence(spark, sf).withColumn("text", F.md5("text"))


def article_evidence_uncapped(spark: SparkSession, sf: str) -> DataFrame:
    return _evidence(spark, sf, None).drop("pos").withColumn("text", F.md5("text"))


def review_blocks(spark: SparkSession, sf: str) -> DataFrame:
    return evidence.review_blocks(_evidence(spark, sf)).select(
        "meta_category",
        "role",
        "rank",
        "name",
        F.size("texts").alias("n_texts"),
        F.md5(F.array_join("texts", "\n")).alias("texts_md5"),
    )


def _whole_blocks(spark: SparkSession, sf: str) -> DataFrame:
    reviews = views.text_reviews(spark, sf)
    picked = products.picked_products(products.product_stats(reviews), 3)
    return text_blocks.product_blocks(reviews, picked.select("name").distinct(), 2000)


def whole_review_blocks(spark: SparkSession, sf: str) -> DataFrame:
    """All reviews of the picked products in blocks of at most 2,000 characters."""
    texts = F.md5(F.array_join("texts", "\n"))
    return _whole_blocks(spark, sf).select("name", "block", "reviews", "chars", texts.alias("texts_md5"))


def review_digests(spark: SparkSession, sf: str) -> DataFrame:
    """A tree over the blocks, by a model that adds up the lengths of what it was shown."""

    def load():
        def answer(prompt: str) -> str:
            if prompt.startswith("Sum up"):
                return str(len(prompt))
            return str(sum(int(line[2:]) for line in prompt.split("\n")[1:]))

        return answer

    return digests.digest_blocks(_whole_blocks(spark, sf), load, fan=4)


def article_prompt(spark: SparkSession, sf: str) -> DataFrame:
    inputs = articles.article_inputs(_evidence(spark, sf))
    prompt = articles.article_prompt()
    return inputs.select("category_key", F.length(prompt).alias("n"), F.md5(prompt).alias("md5"))


def article_text(spark: SparkSession, sf: str) -> DataFrame:
    return _articles(spark, sf)


def article_text_hook(spark: SparkSession, sf: str) -> DataFrame:
    """Articles of a model that tells the length of what it was asked."""

    def load():
        return lambda prompt: f"{len(prompt)} characters"

    inputs = articles.article_inputs(_evidence(spark, sf), complaints=3)
    return articles.write_articles(inputs, load_model=load)


def summaries_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """A stored summary per language is replaced by its article for some languages."""
    path = scratch_path(spark, "summaries")
    written = _articles(spark, sf).persist()
    short = F.concat(F.lit("article of "), F.length("summary"), F.lit(" characters"))
    summaries.save_summaries(written.withColumn("summary", short), path)
    changed = written.where(F.col("category_key").isin(*REWRITTEN))
    summaries.upsert_summaries(changed, path)
    written.unpersist()
    return summaries.load_summaries(spark, path)


def summaries_emptied(spark: SparkSession, sf: str) -> DataFrame:
    """Versions of a store that is filled, emptied, and set anew for one key of the review texts."""
    path = scratch_path(spark, "summaries-emptied")
    keys = views.text_reviews(spark, sf).select(F.col("meta_category").alias("category_key")).distinct()
    full = keys.withColumn("summary", F.concat(F.lit("about "), F.col("category_key")))
    found = None
    for step, content in enumerate([full, full.limit(0), full.where("category_key = 'en'")], 1):
        summaries.save_summaries(content, path)
        stored = written_once(summaries.load_summaries(spark, path), "stored").withColumn("step", F.lit(step))
        found = stored if found is None else found.unionByName(stored)
    return found


def summaries_json(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "summaries-json")
    summaries.save_summaries_json(_articles(spark, sf), path)
    return summaries.load_summaries_json(spark, path)


def summaries_of_writers(spark: SparkSession, sf: str) -> DataFrame:
    """A store to which a writer for each language adds at the same time."""
    path = scratch_path(spark, "shared-summaries")
    languages = views.table(spark, sf, "documents").where("lang IS NOT NULL").groupBy("lang").count()

    def add(lang: str) -> None:
        own = languages.where(F.col("lang") == lang)
        text = F.concat(F.col("count").cast("string"), F.lit(" texts")).alias("summary")
        summaries.upsert_summaries(own.select(F.col("lang").alias("category_key"), text), path)

    names = [r["lang"] for r in languages.select("lang").collect()]
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(add, names))
    return summaries.load_summaries(spark, path)


def summary_lookup(spark: SparkSession, sf: str) -> DataFrame:
    stored = _articles(spark, sf).where(F.col("category_key") != "en")
    return summaries.summaries_for(spark, stored, ["en", "DE", "fr", "Pet Supplies"])


# Texts and models ---------------------------------------------------------------------------------


def stripped_texts(spark: SparkSession, sf: str) -> DataFrame:
    padded = F.concat(F.lit(" \t\r\n"), F.col("`reviews.text`"), F.lit("\n \f\t"))
    texts = views.text_reviews(spark, sf)
    return texts.select("review_id", F.md5(fn.strip(padded)).alias("text_md5"))


def truncate_tokens(spark: SparkSession, sf: str) -> DataFrame:
    cut = fn.truncate_tokens("reviews.text", 512)
    texts = views.text_reviews(spark, sf)
    return texts.select("review_id", F.length(cut).alias("n"), F.md5(cut).alias("text_md5"))


def baseline_sentiment_wordlist(spark: SparkSession, sf: str) -> DataFrame:
    scored = sentiment.baseline_sentiment(
        views.text_reviews(spark, sf), negative=NEGATIVE_WORDS, positive=POSITIVE_WORDS
    )
    return scored.select("review_id", "predicted_sentiment")


def baseline_sentiment_hook(spark: SparkSession, sf: str) -> DataFrame:
    """Labels of a model that goes by the length of the text."""

    def load():
        import numpy as np

        return lambda texts: np.array([f"LABEL_{len(text) % 3}" for text in texts])

    scored = sentiment.baseline_sentiment(views.text_reviews(spark, sf), load_model=load)
    return scored.select("review_id", "predicted_sentiment")


def argmax_scores(spark: SparkSession, sf: str) -> DataFrame:
    vectors = views.table(spark, sf, "embeddings")
    return vectors.select("vec_id", fn.argmax("embedding").alias("best"))


def text_tokens(spark: SparkSession, sf: str) -> DataFrame:
    tokens = text_model.tokenize(views.text_reviews(spark, sf))
    return tokens.select(
        "review_id",
        F.size("tokens").alias("n_tokens"),
        F.md5(F.array_join("tokens", " ")).alias("tokens_md5"),
    )


def _trained(spark: SparkSession, sf: str, path: str | None = None):
    balanced = sampling.balance_classes(views.labelled_texts(spark, sf), "label")
    return text_model.train_sentiment(
        balanced, path, label_col="label", classes=["bad", "good"], max_iter=20
    )


def train_report(spark: SparkSession, sf: str) -> DataFrame:
    return _trained(spark, sf)[1]


def reloaded_model_predictions(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "model")
    _trained(spark, sf, path)
    model = text_model.load_model(path)
    texts = views.labelled_texts(spark, sf)
    scored = text_model.predict_sentiment(model, texts, classes=["bad", "good"])
    return scored.select("review_id", "label", "predicted_sentiment")


def reloaded_model_agreement(spark: SparkSession, sf: str) -> DataFrame:
    """Rows scored by the fitted and by the reloaded model, and how many of them differ."""
    path = scratch_path(spark, "model-agreement")
    fitted, _ = _trained(spark, sf, path)
    texts = views.labelled_texts(spark, sf)
    one, two = (
        text_model.predict_sentiment(model, texts, classes=["bad", "good"]).select(
            "review_id", F.col("predicted_sentiment").alias(name)
        )
        for name, model in (("fitted", fitted), ("reloaded", text_model.load_model(path)))
    )
    differs = ~F.col("fitted").eqNullSafe(F.col("reloaded"))
    return one.join(two, "review_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(differs).alias("n_different")
    )


def count_model_terms(spark: SparkSession, sf: str) -> DataFrame:
    """The weights of a model of the training part, in closed form."""
    train, _ = sampling.train_test_split(views.labelled_texts(spark, sf))
    model = count_model.fit_counts(train, label_col="label", classes=["bad", "good"])
    return model.terms.select("term", *[F.col("weights")[i].alias(c) for i, c in enumerate(["bad", "good"])])


def count_model_report(spark: SparkSession, sf: str) -> DataFrame:
    """The report on the part that training does not see."""
    texts = views.labelled_texts(spark, sf)
    _, report = count_model.train_counts(texts, label_col="label", classes=["bad", "good"])
    return report.withColumns({c: F.round(c, 9) for c in ("precision", "recall", "f1_score")})


def count_model_predictions(spark: SparkSession, sf: str) -> DataFrame:
    """All documents by a model that was saved and loaded again."""
    path = scratch_path(spark, "count-model")
    count_model.train_counts(views.labelled_texts(spark, sf), path, label_col="label", classes=["bad", "good"])
    scored = count_model.predict_counts(count_model.load_counts(spark, path), views.text_reviews(spark, sf))
    return scored.select("review_id", "predicted_sentiment")


def kmeans_facts(spark: SparkSession, sf: str) -> DataFrame:
    """For each number of clusters: rows assigned, and rows for which another centre is nearer."""
    vectors = views.table(spark, sf, "embeddings")
    found = None
    for k in (2, 4, 6):
        model = clusters.fit_clusters(vectors, k)
        centres = F.array(*[F.array(*[F.lit(float(x)) for x in c]) for c in model.clusterCenters()])
        distances = F.transform(
            centres,
            lambda c: F.aggregate(
                F.zip_with(c, "embedding", lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, d: s + d
            ),
        )
        # A tie up to rounding is no nearer centre.
        off = F.element_at(distances, F.col("cluster") + 1) > F.array_min(distances) * (1 + 1e-9) + 1e-9
        facts = clusters.assign_clusters(model, vectors).agg(
            F.lit(k).alias("k"), F.count("cluster").alias("n_rows"), F.count_if(off).alias("n_not_nearest")
        )
        found = facts if found is None else found.unionByName(facts)
    return found


def kmeans_sweep(spark: SparkSession, sf: str) -> DataFrame:
    return clusters.cluster_sweep(views.table(spark, sf, "embeddings"), [2, 4, 6, 8])[1]


def kmeans_sizes(spark: SparkSession, sf: str) -> DataFrame:
    vectors = views.table(spark, sf, "embeddings")
    model = clusters.fit_clusters(vectors, 6)
    return profile.class_sizes(clusters.assign_clusters(model, vectors), "cluster")


def _running(spark: SparkSession, sf: str) -> str:
    """A store of three batches of reviews, one of which is sent twice."""
    path = scratch_path(spark, "running-stats")
    reviews = views.reviews(spark, sf, nulls=True)
    batch = F.pmod(F.crc32("review_id"), F.lit(3))
    for number in (0, 1, 0, 2):
        running_stats.add_batch(reviews.where(batch == number), path, f"batch {number}")
    return path


def running_product_stats(spark: SparkSession, sf: str) -> DataFrame:
    stats = running_stats.running_stats(spark, _running(spark, sf))
    return stats.withColumn("avg_rating", F.round("avg_rating", 9))


def running_sentiment(spark: SparkSession, sf: str) -> DataFrame:
    return running_stats.running_sentiment(spark, _running(spark, sf))


NAME_KS, VECTOR_K, STEPS = [2, 4, 6], 6, 3


def running_profiles(spark: SparkSession, sf: str) -> DataFrame:
    """Profiles of three batches, one of which is sent twice; estimates are held against exact counts."""
    path = scratch_path(spark, "running-profile")
    reviews = views.reviews(spark, sf, nulls=True).withColumnRenamed("reviews.rating", "rating")
    for batch in (0, 1, 1, 2):
        part = reviews.where(F.pmod(F.hash("review_id"), F.lit(3)) == batch)
        running_profile.add_profile(part, path, str(batch))
    exact = profile.distinct_counts(reviews, *reviews.columns)
    off = F.abs(F.col("distinct_estimate") - F.col("n_distinct"))
    merged = running_profile.running_profile(spark, path).join(exact, "column")
    return merged.select("column", "rows", "nulls", "n_distinct", (off <= F.col("n_distinct") * 0.08).alias("close"))


def _name_points(spark: SparkSession, sf: str) -> DataFrame:
    names = views.table(spark, sf, "part").select(F.col("p_name").alias("name")).distinct()
    return steady_clusters.whole_points(names.withColumn("embedding", clusters.embed_names("name")), "name", "embedding")


def name_cluster_sweep(spark: SparkSession, sf: str) -> DataFrame:
    """Sizes and costs of clusters of product names, for several numbers of clusters."""
    return steady_clusters.steady_sweep(_name_points(spark, sf), NAME_KS, STEPS)


def name_clusters(spark: SparkSession, sf: str) -> DataFrame:
    points = _name_points(spark, sf)
    found = steady_clusters.assigned(points, steady_clusters.steady_clusters(points, NAME_KS[-1], STEPS))
    return found.select(F.col("key").alias("name"), "cluster")


def vector_clusters(spark: SparkSession, sf: str) -> DataFrame:
    points = steady_clusters.whole_points(views.table(spark, sf, "embeddings"), "vec_id", "embedding")
    found = steady_clusters.assigned(points, steady_clusters.steady_clusters(points, VECTOR_K, STEPS))
    return found.select(F.col("key").alias("vec_id"), "cluster")


# Files --------------------------------------------------------------------------------------------


def csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "csv")
    review_files.save_csv(views.table(spark, sf, "documents"), path)
    numbers = {"doc_id": "bigint", "n_chars": "bigint"}
    back = review_files.load_reviews(spark, path, numbers, with_id=False)
    return back.withColumns({"text": F.md5("text"), "n": F.length("text")})


def truncate_model_tokens(spark: SparkSession, sf: str) -> DataFrame:
    """Documents cut after 512 tokens of a public tokenizer."""
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    cut = token_cut.truncate_by_tokenizer(views.text_reviews(spark, sf), path)
    text = F.col("`reviews.text`")
    return cut.select("review_id", F.length(text).alias("n"), F.md5(text).alias("text_md5"))


def csv_ids(spark: SparkSession, sf: str) -> DataFrame:
    """Places of rows in several CSV files, read in tasks of two sizes."""
    path = scratch_path(spark, "csv-ids")
    ordered = views.table(spark, sf, "documents").select("doc_id", "n_chars").repartitionByRange(4, "doc_id")
    review_files.save_csv(ordered.sortWithinPartitions("doc_id"), path)
    setting, found = "spark.sql.files.maxPartitionBytes", None
    usual = spark.conf.get(setting)
    for size in ("128m", "2k"):
        spark.conf.set(setting, size)
        try:
            rows = review_files.load_reviews(spark, path, {"doc_id": "bigint"}, multi_line=False)
            rows = written_once(rows.select("doc_id", "review_id"), "csv-places").withColumn("size", F.lit(size))
        finally:
            spark.conf.set(setting, usual)
        found = rows if found is None else found.unionByName(rows)
    return found


def csv_blocks(spark: SparkSession, sf: str) -> DataFrame:
    """CSV files of documents, with line breaks and quotes in their fields, each read by many tasks."""
    path = scratch_path(spark, "csv-blocks")
    texts = views.table(spark, sf, "documents").select(
        "doc_id", F.concat(F.lit('said: "'), "text", F.lit('",\n\n"'), "lang").alias("text"), "source"
    )
    # Files hold ranges of ids in the order of their names, so rows have the places they would have in one file.
    review_files.save_csv(texts.repartitionByRange("doc_id").sortWithinPartitions("doc_id"), path)
    setting = "spark.sql.files.maxPartitionBytes"
    usual = spark.conf.get(setting)
    spark.conf.set(setting, "256k")
    try:
        rows = review_files.load_reviews(spark, path, {"doc_id": "bigint"})
        rows = rows.select("doc_id", "review_id", F.md5("text").alias("text_md5"), "source")
        return written_once(rows, "csv-block-rows")
    finally:
        spark.conf.set(setting, usual)


def csv_evidence(spark: SparkSession, sf: str) -> DataFrame:
    """The evidence of reviews that were saved as CSV and read again."""
    path = scratch_path(spark, "csv-evidence")
    review_files.save_csv(views.text_reviews(spark, sf), path)
    found = evidence.article_evidence(review_files.load_reviews(spark, path), 3, 30)
    return found.withColumns({"text": F.md5("text"), "rating": F.col("rating").cast("int")})


def category_table(spark: SparkSession, sf: str) -> DataFrame:
    """Reviews written by category, of which one category is read back."""
    path = scratch_path(spark, "by-category")
    review_files.save_table(cleaning.plain_names(_labelled(spark, sf)), path, by_category=True)
    kept = products.in_category(review_files.load_table(spark, path), CATEGORY)
    return kept.select("review_id", "name", "reviews_rating", "rating_sentiment", "meta_category")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [
        top3_per_category,
        worst_per_category,
        picked_products,
        product_stats,
        product_stats_nulls,
        running_product_stats,
        running_sentiment,
        running_profiles,
        product_means,
        top_n_one_category,
        worst_one_category,
        rating_chart,
        display_formats,
        clean_columns,
        sentiment_labels,
        label_codes,
        model_label_map,
        category_keys,
        rating_counts,
        sentiment_share,
        category_crosstab,
        distinct_categories,
        distinct_counts,
        null_profile,
        table_profile,
        smallest_class,
        sentiment_distribution,
        category_sizes,
        category_review_count,
        class_slice,
        primary_category_slice,
        preview,
        balanced_sample_default,
        balanced_sample_1206,
        balanced_sample_null_ids,
        hash_split,
        concat_tables,
        classification_report,
        confusion_matrix,
        report_with_gaps,
        confusion_off_list,
        category_mapping,
        category_mapping_own_options,
        reviews_with_meta,
        reviews_with_meta_rules,
        category_mapping_hook,
        answers_held,
        mapping_audit,
        mapping_summary,
        category_prompts,
        product_reviews,
        article_evidence,
        article_evidence_uncapped,
        review_blocks,
        whole_review_blocks,
        review_digests,
        article_prompt,
        article_text,
        article_text_hook,
        summaries_upsert,
        summaries_emptied,
        summaries_json,
        summary_lookup,
        summaries_of_writers,
        stripped_texts,
        truncate_tokens,
        baseline_sentiment_wordlist,
        baseline_sentiment_hook,
        argmax_scores,
        text_tokens,
        train_report,
        reloaded_model_predictions,
        reloaded_model_agreement,
        count_model_terms,
        count_model_report,
        count_model_predictions,
        kmeans_sweep,
        kmeans_sizes,
        kmeans_facts,
        name_cluster_sweep,
        name_clusters,
        vector_clusters,
        truncate_model_tokens,
        csv_roundtrip,
        category_table,
        csv_ids,
        csv_blocks,
        csv_evidence,
    ]
    registered = {query.__name__: query for query in found}
    return registered | llm.queries() | {"pipeline": corpus_pipeline.run} if llm else registered


def _clusters_sql(points: str, ks: list[int], steps: int, result: str) -> str:
    """Farthest-first starts and steps of means over ``points`` (key, v), all distances; whole numbers in doubles."""
    far = "list_inner_product(v, v) - 2 * list_inner_product(v, c) + list_inner_product(c, c)"
    parts = [points, "hashed AS MATERIALIZED (SELECT key, v, md5(CAST(key AS VARCHAR)) AS h FROM points)"]
    parts.append("s0 AS MATERIALIZED (SELECT 0 AS i, v AS c FROM hashed ORDER BY h, v LIMIT 1)")
    for i in range(1, max(ks)):
        parts.append(f"""s{i} AS MATERIALIZED (
              SELECT * FROM s{i - 1} UNION ALL SELECT * FROM (
                SELECT {i} AS i, v AS c FROM (
                  SELECT key, v, h, min({far}) AS near FROM hashed, s{i - 1} GROUP BY ALL)
                WHERE near > 0 ORDER BY near DESC, h, v LIMIT 1))""")
    for k in ks:
        parts.append(f"c{k}_0 AS (SELECT * FROM s{k - 1})")
        for r in range(steps + 1):
            parts.append(f"""a{k}_{r} AS MATERIALIZED (
              SELECT key, v, min(struct_pack(far := {far}, i := i)) AS best FROM hashed, c{k}_{r} GROUP BY key, v)""")
            if r < steps:
                parts.append(f"""m{k}_{r} AS (
              SELECT i, list(mean ORDER BY d) AS c FROM (
                SELECT best.i AS i, d, floor(sum(v[d]) / count(*)) AS mean
                FROM (SELECT *, unnest(range(1, len(v) + 1)) AS d FROM a{k}_{r}) GROUP BY ALL) GROUP BY i),
            c{k}_{r + 1} AS MATERIALIZED (
              SELECT i, coalesce(m{k}_{r}.c, c{k}_{r}.c) AS c FROM c{k}_{r} LEFT JOIN m{k}_{r} USING (i))""")
    return "WITH " + ", ".join(parts) + " " + result


# Oracles ------------------------------------------------------------------------------------------

NAME_POINTS = """places AS (
              SELECT name, list_transform(range(1, length(name) + 1), lambda i:
                CAST('0x' || left(md5(substr(' ' || lower(name) || ' ', i, 3)), 8) AS BIGINT) % 32) AS p
              FROM (SELECT DISTINCT p_name AS name FROM part)),
            points AS (
              SELECT name AS key, list_transform(range(32), lambda d:
                CAST(1024 * len(list_filter(p, lambda x: x = d)) AS DOUBLE)) AS v FROM places)"""
REVIEWS = """reviews AS (
  SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS review_id,
         p_name AS name, p_type || ',' || p_brand AS categories, p_brand AS primarycategories,
         p_type AS meta_category,
         CAST(least(5, 1 + floor(sqrt(l_quantity / 2))) AS INTEGER) AS rating,
         CASE l_returnflag WHEN 'A' THEN 'LABEL_0' WHEN 'N' THEN 'LABEL_1' ELSE 'LABEL_2' END
           AS model_label
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""
NULLS = """nulls AS (
  SELECT review_id, categories, primarycategories, meta_category, model_label,
         CASE WHEN split_part(review_id, '-', 2) <> '6' THEN name END AS name,
         CASE WHEN split_part(review_id, '-', 2) <> '7' THEN rating END AS rating
  FROM reviews)"""
SENTIMENT = """CASE WHEN rating IN (1, 2) THEN 'negative' WHEN rating = 3 THEN 'neutral'
         WHEN rating IN (4, 5) THEN 'positive' END"""
LABELLED = f"labelled AS (SELECT *, {SENTIMENT} AS rating_sentiment FROM reviews)"
PREDICTED = """predicted AS (
  SELECT rating_sentiment AS actual,
         CASE model_label WHEN 'LABEL_0' THEN 'negative' WHEN 'LABEL_1' THEN 'neutral'
           ELSE 'positive' END AS predicted
  FROM labelled)"""
PREDICTED_WITH_GAPS = """predicted AS (
  SELECT rating_sentiment AS actual,
         CASE WHEN rating = 1 THEN 'unsure' WHEN rating = 4 THEN NULL
           WHEN model_label = 'LABEL_0' THEN 'negative' WHEN model_label = 'LABEL_1' THEN 'neutral'
           ELSE 'positive' END AS predicted
  FROM labelled)"""
STATS = """stats AS (
  SELECT meta_category, name, avg(rating) AS avg_rating, count(rating) AS num_reviews
  FROM reviews WHERE meta_category IS NOT NULL AND name IS NOT NULL GROUP BY ALL)"""
RANKS = """ranks AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY meta_category
                   ORDER BY num_reviews DESC, name) AS INTEGER) AS top_rank,
         CAST(row_number() OVER (PARTITION BY meta_category
                ORDER BY avg_rating ASC NULLS LAST, name) AS INTEGER) AS worst_rank
  FROM stats)"""
PICKS = """picks AS (
  SELECT meta_category, 'top' AS role, top_rank AS rank, name, avg_rating, num_reviews
  FROM ranks WHERE top_rank <= 3
  UNION ALL
  SELECT meta_category, 'worst', worst_rank, name, avg_rating, num_reviews
  FROM ranks WHERE worst_rank = 1)"""
ONE_CATEGORY = f"""one AS (
  SELECT name AS "Product", avg(rating) AS "Avg Rating", count(rating) AS "# Reviews"
  FROM reviews WHERE meta_category = '{CATEGORY}' AND name IS NOT NULL GROUP BY name)"""
MAPPED_CASE = """CASE WHEN lower(categories) LIKE '%brand#13%' OR lower(categories) LIKE '%brand#21%'
           THEN 'PROMO'
         WHEN lower(categories) LIKE '%economy%' THEN 'ECONOMY'
         WHEN lower(categories) LIKE '%medium%' THEN 'MEDIUM'
         WHEN lower(categories) LIKE '%small%' THEN 'SMALL'
         WHEN lower(categories) LIKE '%standard%' THEN 'STANDARD'
         WHEN lower(categories) LIKE '%promo%' THEN 'PROMO' END"""
MAPPED = f"""mapped AS (
  SELECT review_id, categories, primarycategories, {MAPPED_CASE} AS meta_category FROM reviews)"""
TEXTS = """reviews AS (
  SELECT doc_id AS review_id, source AS name, lang AS meta_category,
         CAST(1 + n_chars % 5 AS INTEGER) AS rating, text FROM documents)"""
NUMBERED = """numbered AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY name ORDER BY review_id) AS INTEGER) AS pos
  FROM reviews)"""
EVIDENCE = """evidence AS (
  SELECT meta_category, role, rank, picks.name, avg_rating, num_reviews, pos, review_id, rating, text
  FROM (SELECT review_id, name, rating, text, pos FROM numbered WHERE pos <= 30) AS n
  JOIN picks USING (name))"""
EVIDENCE_CTES = ", ".join([TEXTS, STATS, RANKS, PICKS, NUMBERED, EVIDENCE])
INPUTS = """low AS (
  SELECT *, row_number() OVER (PARTITION BY meta_category, role, rank, name ORDER BY pos) AS low_pos
  FROM evidence WHERE rating <= 2 AND text IS NOT NULL),
complaint AS (
  SELECT meta_category, role, rank, name,
         name || ':' || chr(10) || string_agg('- ' || text, chr(10) ORDER BY pos) AS complaint
  FROM low WHERE low_pos <= 3 GROUP BY meta_category, role, rank, name),
blocks AS (
  SELECT meta_category, role, rank, name,
         rank || '. ' || name || ' (average ' || printf('%.2f', avg_rating) || ' from '
           || num_reviews || ' ratings)' AS line,
         'Reviews of ' || name || ' (place ' || rank || ')' || chr(10)
           || string_agg('- ' || coalesce(text, ''), chr(10) ORDER BY pos) AS block
  FROM evidence GROUP BY meta_category, role, rank, name, avg_rating, num_reviews),
inputs AS (
  SELECT meta_category,
         string_agg(line, chr(10) ORDER BY rank) FILTER (role = 'top') AS top_table,
         string_agg(block, chr(10) || chr(10) ORDER BY rank) FILTER (role = 'top') AS top_reviews,
         coalesce(string_agg(complaint, chr(10) ORDER BY rank) FILTER (role = 'top'), '')
           AS complaints,
         string_agg(line, chr(10) ORDER BY rank) FILTER (role = 'worst') AS worst_table,
         string_agg(block, chr(10) || chr(10) ORDER BY rank) FILTER (role = 'worst')
           AS worst_reviews
  FROM blocks LEFT JOIN complaint USING (meta_category, role, rank, name) GROUP BY meta_category)"""
ARTICLES = """articles AS (
  SELECT replace(replace(replace(lower(meta_category), ' & ', '_'), '&', '_'), ' ', '_')
           AS category_key,
         '# ' || meta_category || e'\\n\\n## Most reviewed\\n\\n' || top_table
           || e'\\n\\n## Complaints\\n\\n'
           || CASE WHEN complaints = '' THEN 'None among the reviews read.' ELSE complaints END
           || e'\\n\\n## Avoid\\n\\n' || worst_table || e'\\n' AS summary
  FROM inputs)"""
ARTICLE_CTES = ", ".join([EVIDENCE_CTES, INPUTS, ARTICLES])
WHOLE_BLOCKS = f"""{TEXTS}, {STATS}, {RANKS}, {PICKS}, parts AS (
  SELECT name, review_id, part, substr(text, 999 * part + 1, 999) AS piece
  FROM (SELECT *, unnest(range(greatest(1, CAST(ceil(coalesce(length(text), 0) / 999) AS BIGINT)))) AS part
        FROM reviews WHERE name IN (SELECT name FROM picks))),
placed AS (
  SELECT *, 1 + coalesce(length(piece), 0) AS size, CAST(coalesce(sum(1 + coalesce(length(piece), 0)) OVER (
           PARTITION BY name ORDER BY review_id NULLS FIRST, part
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) // 1000 AS block
  FROM parts)"""
BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def _sample_sql(n: str) -> str:
    return f"""WITH {REVIEWS}, {LABELLED}, placed AS (
      SELECT *, row_number() OVER (PARTITION BY rating_sentiment
                  ORDER BY md5('sample|42|' || review_id), review_id) AS place
      FROM labelled WHERE rating_sentiment IS NOT NULL)
    SELECT review_id, name, rating_sentiment FROM placed WHERE place <= {n}"""


def _words_sql(words: list[str]) -> str:
    listed = ", ".join(f"'{word}'" for word in words)
    return f"len(list_filter(words, lambda w: w IN ({listed})))"


def oracle_sql() -> dict[str, str]:
    top_or_worst = "SELECT meta_category, {0}_rank AS rank, name, avg_rating, num_reviews FROM ranks"
    profile_columns = [
        ("review_id", "review_id", "string"),
        ("name", "name", "string"),
        ("categories", "categories", "string"),
        ("primarycategories", "primarycategories", "string"),
        ("meta_category", "meta_category", "string"),
        ("reviews.rating", "rating", "int"),
        ("model_label", "model_label", "string"),
    ]
    options = ", ".join(f"'{o}'" for o in AUDIT_OPTIONS)
    prompt_options = ", ".join(f"''{o}''" for o in VIEW_OPTIONS)
    tokens = ", ".join(f"'{t}'" for t in NULL_TOKENS)
    scores = "precision, recall, f1_score"
    prompts = """prompts AS (
              SELECT lower(meta_category) AS category_key,
                'Write a short blog post about the product category ' || meta_category
                || e'.\\n\\nCompare the products with the most reviews:\\n' || top_table
                || e'\\n\\nTell what their reviewers say and complain about most:\\n\\n' || top_reviews
                || e'\\n\\nAlso warn of the product with the lowest rating, and say why:\\n'
                || worst_table || e'\\n\\n' || worst_reviews AS prompt
              FROM inputs)"""
    tokens_of = "list_filter(string_split_regex(lower(coalesce(text, '')), '[^\\p{L}\\p{N}]+'), lambda w: w <> '')"
    counted = f"""labelled AS (
              SELECT row_number() OVER () AS row_id, {tokens_of} AS tokens,
                     CASE WHEN quality = 1 THEN 'good' ELSE 'bad' END AS label,
                     CASE WHEN CAST('0x' || left(md5('split|42|' || doc_id), 8) AS BIGINT)
                       < {round(0.3 * 2**32)} THEN 'test' ELSE 'train' END AS part
              FROM documents JOIN labels USING (doc_id)),
            token_counts AS (
              SELECT term, count(*) FILTER (label = 'bad') AS n0, count(*) FILTER (label = 'good') AS n1
              FROM (SELECT label, unnest(tokens) AS term FROM labelled WHERE part = 'train') GROUP BY term),
            totals AS (SELECT count(*) AS v, sum(n0) AS t0, sum(n1) AS t1 FROM token_counts),
            weights AS (
              SELECT term, CAST(floor(1000000 * ln((n0 + 1) / (t0 + v))) AS BIGINT) AS bad,
                     CAST(floor(1000000 * ln((n1 + 1) / (t1 + v))) AS BIGINT) AS good
              FROM token_counts, totals),
            priors AS (
              SELECT CAST(floor(1000000 * ln((count(*) FILTER (label = 'bad') + 1) / (count(*) + 2))) AS BIGINT) AS bad,
                     CAST(floor(1000000 * ln((count(*) FILTER (label = 'good') + 1) / (count(*) + 2))) AS BIGINT) AS good
              FROM labelled WHERE part = 'train'),
            rated AS (
              SELECT row_id, any_value(label) AS label, any_value(part) AS part,
                     any_value(priors.bad) + coalesce(sum(weights.bad), 0) AS bad,
                     any_value(priors.good) + coalesce(sum(weights.good), 0) AS good
              FROM priors, labelled LEFT JOIN (
                SELECT row_id, unnest(tokens) AS term FROM labelled) AS spoken USING (row_id)
              LEFT JOIN weights USING (term) GROUP BY row_id)"""
    report = f"""
            classes AS (
              SELECT label, CAST(sum(hits) AS BIGINT) AS hits, CAST(sum(guessed) AS BIGINT) AS guessed,
                     CAST(sum(support) AS BIGINT) AS support
              FROM (SELECT actual AS label, CAST(actual = predicted AS INTEGER) AS hits, 0 AS guessed,
                           1 AS support FROM predicted
                    UNION ALL SELECT predicted, 0, 1, 0 FROM predicted)
              WHERE label IS NOT NULL GROUP BY label),
            scored AS (
              SELECT label, CASE WHEN guessed > 0 THEN hits / guessed ELSE 0 END AS precision,
                     CASE WHEN support > 0 THEN hits / support ELSE 0 END AS recall,
                     CASE WHEN guessed + support > 0 THEN 2 * hits / (guessed + support) ELSE 0 END
                       AS f1_score,
                     support, hits
              FROM classes),
            report AS (
              SELECT label, {scores}, support FROM scored
              UNION ALL SELECT 'accuracy', NULL, NULL, sum(hits) / sum(support), sum(support)
              FROM scored
              UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1_score), sum(support)
              FROM scored
              UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support),
                sum(recall * support) / sum(support), sum(f1_score * support) / sum(support),
                sum(support) FROM scored)
            SELECT label, round(precision, 9) AS precision, round(recall, 9) AS recall,
                   round(f1_score, 9) AS f1_score, CAST(support AS BIGINT) AS support FROM report"""
    return (llm.oracle_sql() if llm else {}) | {
        "top3_per_category": f"WITH {REVIEWS}, {STATS}, {RANKS} "
        + top_or_worst.format("top") + " WHERE top_rank <= 3",
        "worst_per_category": f"WITH {REVIEWS}, {STATS}, {RANKS} "
        + top_or_worst.format("worst") + " WHERE worst_rank = 1",
        "picked_products": f"WITH {REVIEWS}, {STATS}, {RANKS}, {PICKS} SELECT * FROM picks",
        "product_stats": f"WITH {REVIEWS}, {STATS} SELECT * FROM stats",
        "product_stats_nulls": f"""WITH {REVIEWS}, {NULLS}
            SELECT meta_category, name, avg(rating) AS avg_rating, count(rating) AS num_reviews
            FROM nulls WHERE name IS NOT NULL GROUP BY ALL""",
        "product_means": f"WITH {REVIEWS}, {STATS} SELECT meta_category, name, avg_rating FROM stats",
        "top_n_one_category": f"""WITH {REVIEWS}, {ONE_CATEGORY}
            SELECT * FROM one ORDER BY "# Reviews" DESC, "Product" LIMIT 3""",
        "worst_one_category": f"""WITH {REVIEWS}, {ONE_CATEGORY}
            SELECT * FROM one ORDER BY "Avg Rating" NULLS LAST, "Product" LIMIT 1""",
        "rating_chart": f"""WITH {REVIEWS}, {ONE_CATEGORY}
            SELECT "Product" AS name, "Avg Rating" AS avg_rating, "# Reviews" AS num_reviews,
                   left("Product", 40) || '...' AS short_name
            FROM one ORDER BY "# Reviews" DESC, "Product" LIMIT 10""",
        "display_formats": f"""WITH {REVIEWS}, {STATS}
            SELECT meta_category, name, left(name, 6) || '...' AS short,
                   printf('%.2f', avg_rating) AS avg_text, format('{{:,}}', num_reviews) AS count_text
            FROM stats""",
        "clean_columns": f"""WITH {REVIEWS}
            SELECT review_id, name, categories, primarycategories, meta_category,
                   rating AS reviews_rating FROM reviews""",
        "sentiment_labels": f"""WITH {REVIEWS}, {NULLS}
            SELECT review_id, rating AS reviews_rating, {SENTIMENT} AS rating_sentiment FROM nulls""",
        "label_codes": f"""WITH {REVIEWS}, {LABELLED}
            SELECT review_id, rating_sentiment,
                   CASE rating_sentiment WHEN 'negative' THEN 0 WHEN 'neutral' THEN 1
                     WHEN 'positive' THEN 2 END AS actual_sentiment,
                   rating_sentiment AS decoded
            FROM labelled""",
        "model_label_map": f"""WITH {REVIEWS}
            SELECT review_id, model_label,
                   CASE model_label WHEN 'LABEL_0' THEN 'negative' WHEN 'LABEL_1' THEN 'neutral'
                     WHEN 'LABEL_2' THEN 'positive' END AS predicted_sentiment
            FROM reviews""",
        "category_keys": f"""WITH {REVIEWS}, named AS (
              SELECT DISTINCT concat_ws(' & ', meta_category, name, meta_category || '&x') AS label
              FROM reviews)
            SELECT label, replace(replace(replace(lower(label), ' & ', '_'), '&', '_'), ' ', '_')
              AS key FROM named""",
        "rating_counts": f"""WITH {REVIEWS}, {NULLS}
            SELECT rating AS reviews_rating, count(*) AS count FROM nulls
            WHERE rating IS NOT NULL GROUP BY rating""",
        "sentiment_share": f"""WITH {REVIEWS}, {NULLS}
            SELECT rating_sentiment, count,
                   round_even(CAST(100.0 AS DOUBLE) * count / (SELECT count(*) FROM nulls), 2)
                     AS percent
            FROM (SELECT {SENTIMENT} AS rating_sentiment, count(*) AS count FROM nulls GROUP BY 1)
            WHERE rating_sentiment IS NOT NULL""",
        "category_crosstab": f"""WITH {REVIEWS}
            SELECT categories, primarycategories, meta_category, count(*) AS count
            FROM reviews GROUP BY ALL""",
        "distinct_categories": f"WITH {REVIEWS}, {NULLS} SELECT DISTINCT name FROM nulls",
        "distinct_counts": " UNION ALL ".join(
            [f"""WITH {REVIEWS}, {NULLS}
            SELECT 'categories' AS "column", count(DISTINCT categories) AS n_distinct FROM nulls"""]
            + [f"SELECT '{c}', count(DISTINCT {c}) FROM nulls" for c in ("name", "meta_category")]
        ),
        "null_profile": f"WITH {REVIEWS}, {NULLS} " + " UNION ALL ".join(
            f"""SELECT '{shown}' AS "column", count(*) - count({c}) AS nulls FROM nulls"""
            for shown, c, _ in profile_columns
        ),
        "running_profiles": f"WITH {REVIEWS}, {NULLS} " + " UNION ALL ".join(
            f"""SELECT '{c}' AS "column", count(*) AS rows, count(*) - count({c}) AS nulls,
                count(DISTINCT {c}) AS n_distinct, true AS close FROM nulls"""
            for _, c, _ in profile_columns
        ),
        "table_profile": f"WITH {REVIEWS}, {NULLS} " + " UNION ALL ".join(
            f"""SELECT '{shown}' AS "column", {i} AS position, '{kind}' AS dtype,
                count(*) AS rows, count({c}) AS non_null, count(*) - count({c}) AS nulls
                FROM nulls"""
            for i, (shown, c, kind) in enumerate(profile_columns)
        ),
        "smallest_class": f"""WITH {REVIEWS}, {LABELLED}
            SELECT min(count) AS count FROM (
              SELECT count(*) AS count FROM labelled WHERE rating_sentiment IS NOT NULL
              GROUP BY rating_sentiment)""",
        "sentiment_distribution": f"""WITH {REVIEWS}, {LABELLED}
            SELECT rating_sentiment AS "Sentiment", count(*) AS "Count" FROM labelled
            WHERE meta_category = '{CATEGORY}' AND rating_sentiment IS NOT NULL GROUP BY 1""",
        "category_sizes": f"""WITH {REVIEWS}
            SELECT meta_category, count(*) AS num_reviews FROM reviews
            WHERE meta_category IS NOT NULL GROUP BY 1""",
        "category_review_count": f"""WITH {REVIEWS}
            SELECT count(*) AS num_reviews FROM reviews WHERE meta_category = '{CATEGORY}'""",
        "class_slice": f"""WITH {REVIEWS}, {LABELLED}
            SELECT review_id, name, rating_sentiment FROM labelled
            WHERE rating_sentiment = 'neutral'""",
        "primary_category_slice": f"""WITH {REVIEWS}
            SELECT review_id, primarycategories, name FROM reviews
            WHERE primarycategories = 'Brand#7'""",
        "preview": f"""WITH {REVIEWS}
            SELECT review_id, name, categories FROM reviews ORDER BY review_id LIMIT 10""",
        "balanced_sample_default": _sample_sql(
            "(SELECT min(n) FROM (SELECT count(*) AS n FROM placed GROUP BY rating_sentiment))"
        ),
        "balanced_sample_1206": _sample_sql("1206"),
        "balanced_sample_null_ids": f"""WITH {REVIEWS}, {LABELLED},
            sizes AS (SELECT rating_sentiment, count(*) AS size FROM labelled
                      WHERE rating_sentiment IS NOT NULL GROUP BY ALL)
            SELECT rating_sentiment, (SELECT min(size) FROM sizes) AS n, true AS share_without_id
            FROM sizes""",
        "hash_split": f"""WITH {REVIEWS}
            SELECT review_id,
                   CASE WHEN CAST('0x' || left(md5('split|42|' || review_id), 8) AS BIGINT)
                     < {round(0.3 * 2**32)} THEN 'test' ELSE 'train' END AS part
            FROM reviews""",
        "concat_tables": f"""WITH {REVIEWS}
            SELECT review_id, name, categories, meta_category, rating AS reviews_rating FROM reviews
            UNION ALL
            SELECT CAST(doc_id AS VARCHAR), source, NULL, lang, CAST(1 + n_chars % 5 AS INTEGER)
            FROM documents""",
        "classification_report": f"WITH {REVIEWS}, {LABELLED}, {PREDICTED}, {report}",
        "report_with_gaps": f"WITH {REVIEWS}, {LABELLED}, {PREDICTED_WITH_GAPS}, {report}",
        "confusion_off_list": f"""WITH {REVIEWS}, {LABELLED}, {PREDICTED_WITH_GAPS},
            placed AS (
              SELECT CASE WHEN actual IN ('negative', 'positive') THEN actual ELSE 'other' END AS actual,
                     CASE WHEN predicted IN ('negative', 'positive') THEN predicted ELSE 'other' END
                       AS predicted
              FROM predicted WHERE actual IS NOT NULL)
            SELECT actual, count(*) FILTER (predicted = 'negative') AS negative,
                   count(*) FILTER (predicted = 'positive') AS positive,
                   count(*) FILTER (predicted = 'other') AS other
            FROM placed GROUP BY actual""",
        "category_mapping_own_options": f"""WITH {REVIEWS}
            SELECT DISTINCT categories,
                   CASE WHEN lower(categories) LIKE '%small%' THEN 'SMALL' END AS meta_category,
                   CAST(NULL AS VARCHAR) AS without_rule FROM reviews""",
        "summaries_emptied": """WITH keys AS (SELECT DISTINCT lang FROM documents WHERE lang IS NOT NULL)
            SELECT lang AS category_key, 'about ' || lang AS summary, 1 AS step FROM keys
            UNION ALL SELECT lang, 'about ' || lang, 3 FROM keys WHERE lang = 'en'""",
        "confusion_matrix": f"""WITH {REVIEWS}, {LABELLED}, {PREDICTED}
            SELECT actual, count(*) FILTER (predicted = 'negative') AS negative,
                   count(*) FILTER (predicted = 'neutral') AS neutral,
                   count(*) FILTER (predicted = 'positive') AS positive
            FROM predicted WHERE actual IS NOT NULL GROUP BY actual""",
        "category_mapping": f"""WITH {REVIEWS}, {MAPPED}
            SELECT DISTINCT categories, meta_category FROM mapped""",
        "reviews_with_meta": f"""WITH {REVIEWS}, {MAPPED}
            SELECT review_id, categories, meta_category FROM mapped""",
        "reviews_with_meta_rules": f"""WITH {REVIEWS}, {MAPPED}
            SELECT review_id, categories, meta_category FROM mapped""",
        "mapping_audit": f"""WITH {REVIEWS}, {MAPPED}
            SELECT categories, primarycategories, meta_category, count(*) AS count,
                   meta_category NOT IN ({options}) AS off_list
            FROM mapped WHERE meta_category IS NOT NULL GROUP BY ALL""",
        "mapping_summary": f"""WITH {REVIEWS}, {MAPPED}
            SELECT count(*) FILTER (meta_category IN ({options})) AS on_list,
                   count(*) FILTER (meta_category NOT IN ({options})) AS off_list,
                   count(*) FILTER (meta_category IS NULL) AS unmapped
            FROM mapped""",
        "category_prompts": f"""WITH {REVIEWS}
            SELECT DISTINCT categories, 'Which of {prompt_options} is ''' || categories
              || '''? Answer with one name.' AS prompt FROM reviews""",
        "product_reviews": f"""WITH {REVIEWS}, {STATS}, {RANKS}, {PICKS}
            SELECT review_id, name, meta_category FROM reviews
            WHERE name IN (SELECT name FROM picks)""",
        "article_evidence": f"WITH {EVIDENCE_CTES} SELECT * REPLACE (md5(text) AS text) FROM evidence",
        "article_evidence_uncapped": f"""WITH {TEXTS}, {STATS}, {RANKS}, {PICKS}
            SELECT picks.*, review_id, rating, md5(text) AS text
            FROM picks JOIN reviews ON reviews.name = picks.name""",
        "review_blocks": f"""WITH {EVIDENCE_CTES}
            SELECT meta_category, role, rank, name, CAST(count(*) AS INTEGER) AS n_texts,
                   md5(string_agg(text, chr(10) ORDER BY pos)) AS texts_md5
            FROM evidence GROUP BY ALL""",
        "answers_held": f"""WITH {REVIEWS}, said AS (
              SELECT DISTINCT categories, lower(split_part(categories, ',', 1)) AS said, 1 + length(categories) % 9 AS place
              FROM reviews),
            answers AS (
              SELECT categories, substr(said, 1, place - 1) || substr(said, place + 1)
                || CASE WHEN length(said) % 4 = 0 THEN 'xyz' ELSE 'x' END AS answer FROM said),
            near AS (
              SELECT answer, p_type, levenshtein(regexp_replace(answer, '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'),
                       regexp_replace(lower(p_type), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')) AS d
              FROM (SELECT DISTINCT answer FROM answers), (SELECT DISTINCT p_type FROM part)),
            best AS (
              SELECT answer, min(p_type) AS meta_category
              FROM (SELECT *, min(d) OVER (PARTITION BY answer) AS least FROM near)
              WHERE d = least AND d <= 2 GROUP BY answer HAVING count(*) = 1)
            SELECT categories, answer, meta_category FROM answers LEFT JOIN best USING (answer)""",
        "whole_review_blocks": f"""WITH {WHOLE_BLOCKS}
            SELECT name, block, count(*) FILTER (part = 0) AS reviews, CAST(sum(size) AS BIGINT) AS chars,
                   md5(string_agg(piece, chr(10) ORDER BY review_id NULLS FIRST, part)) AS texts_md5
            FROM placed GROUP BY name, block""",
        "review_digests": f"""WITH {WHOLE_BLOCKS}, asked AS (
              SELECT name, 'Sum up in a few sentences what these reviews of ' || name
                || ' praise and what they complain about:' || chr(10)
                || string_agg('- ' || coalesce(piece, ''), chr(10) ORDER BY review_id NULLS FIRST, part) AS prompt
              FROM placed GROUP BY name, block)
            SELECT name, CAST(CAST(sum(length(prompt)) AS BIGINT) AS VARCHAR) AS digest, count(*) AS blocks
            FROM asked GROUP BY name""",
        "category_mapping_hook": f"""WITH {REVIEWS}, asked AS (
              SELECT DISTINCT categories, 'Which of {prompt_options} is ''' || categories
                || '''? Answer with one name.' AS prompt FROM reviews)
            SELECT categories, 'option ' || length(prompt) % 3 AS meta_category FROM asked""",
        "baseline_sentiment_hook": """
            SELECT doc_id AS review_id, CASE length(coalesce(text, '')) % 3 WHEN 0 THEN 'negative'
              WHEN 1 THEN 'neutral' ELSE 'positive' END AS predicted_sentiment FROM documents""",
        "count_model_terms": f"WITH {counted} SELECT term, bad, good FROM weights",
        "count_model_report": f"""WITH {counted},
            predicted AS (
              SELECT label AS actual, CASE WHEN bad >= good THEN 'bad' ELSE 'good' END AS predicted
              FROM rated WHERE part = 'test'),
            {report}""",
        "count_model_predictions": f"""WITH {counted}
            SELECT doc_id AS review_id, CASE WHEN any_value(priors.bad) + coalesce(sum(weights.bad), 0)
              >= any_value(priors.good) + coalesce(sum(weights.good), 0) THEN 'bad' ELSE 'good' END
              AS predicted_sentiment
            FROM priors, documents LEFT JOIN (
              SELECT doc_id, unnest({tokens_of}) AS term FROM documents) AS spoken USING (doc_id)
            LEFT JOIN weights USING (term) GROUP BY doc_id""",
        "reloaded_model_agreement": """
            SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS n_different
            FROM documents JOIN labels USING (doc_id)""",
        "kmeans_facts": """
            SELECT CAST(k AS INTEGER) AS k, count(*) AS n_rows, CAST(0 AS BIGINT) AS n_not_nearest
            FROM embeddings, (VALUES (2), (4), (6)) AS ks(k) GROUP BY k""",
        "running_product_stats": f"""WITH {REVIEWS}, {NULLS}
            SELECT meta_category, name, round(avg(rating), 9) AS avg_rating, count(rating) AS num_reviews
            FROM nulls WHERE name IS NOT NULL AND meta_category IS NOT NULL GROUP BY meta_category, name""",
        "running_sentiment": f"""WITH {REVIEWS}, {NULLS}
            SELECT meta_category, {SENTIMENT} AS sentiment, count(*) AS reviews
            FROM nulls WHERE name IS NOT NULL AND meta_category IS NOT NULL AND rating IS NOT NULL GROUP BY ALL""",
        "name_cluster_sweep": _clusters_sql(
            NAME_POINTS, NAME_KS, STEPS,
            " UNION ALL ".join(
                f"""SELECT {k} AS k, best.i AS cluster, count(*) AS size, CAST(sum(best.far) AS BIGINT) AS cost
                FROM a{k}_{STEPS} GROUP BY best.i"""
                for k in NAME_KS
            ),
        ),
        "name_clusters": _clusters_sql(
            NAME_POINTS, NAME_KS[-1:], STEPS,
            f"SELECT key AS name, best.i AS cluster FROM a{NAME_KS[-1]}_{STEPS}",
        ),
        "vector_clusters": _clusters_sql(
            """points AS (
              SELECT vec_id AS key, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v
              FROM embeddings)""",
            [VECTOR_K], STEPS, f"SELECT key AS vec_id, best.i AS cluster FROM a{VECTOR_K}_{STEPS}",
        ),
        "csv_ids": """
            SELECT doc_id, row_number() OVER (PARTITION BY size ORDER BY doc_id) - 1 AS review_id, size
            FROM documents, (VALUES ('128m'), ('2k')) AS sizes(size)""",
        "csv_blocks": """
            SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS review_id,
                   md5('said: "' || text || '",' || chr(10) || chr(10) || '"' || lang) AS text_md5, source
            FROM documents""",
        "csv_evidence": f"WITH {EVIDENCE_CTES} SELECT * REPLACE (md5(text) AS text) FROM evidence",
        "article_text_hook": f"""WITH {ARTICLE_CTES}, {prompts}
            SELECT category_key, length(prompt) || ' characters' AS summary FROM prompts""",
        "article_prompt": f"""WITH {ARTICLE_CTES}, {prompts}
            SELECT category_key, CAST(length(prompt) AS INTEGER) AS n, md5(prompt) AS md5
            FROM prompts""",
        "article_text": f"WITH {ARTICLE_CTES} SELECT * FROM articles",
        "summaries_upsert": f"""WITH {ARTICLE_CTES}
            SELECT category_key, CASE WHEN category_key IN ('de', 'en') THEN summary
              ELSE 'article of ' || length(summary) || ' characters' END AS summary
            FROM articles""",
        "summaries_of_writers": """
            SELECT lang AS category_key, count(*) || ' texts' AS summary
            FROM documents WHERE lang IS NOT NULL GROUP BY lang""",
        "summaries_json": f"WITH {ARTICLE_CTES} SELECT * FROM articles",
        "summary_lookup": f"""WITH {ARTICLE_CTES}, wanted (meta_category, category_key) AS (
              VALUES ('en', 'en'), ('DE', 'de'), ('fr', 'fr'), ('Pet Supplies', 'pet_supplies'))
            SELECT meta_category, category_key, coalesce(summary, '') AS summary
            FROM wanted LEFT JOIN (SELECT * FROM articles WHERE category_key <> 'en')
              USING (category_key)""",
        "stripped_texts": f"""
            SELECT doc_id AS review_id, md5(trim(text, {BLANKS})) AS text_md5 FROM documents""",
        "truncate_tokens": f"""WITH cut AS (
              SELECT doc_id AS review_id, array_to_string(list_slice(
                string_split_regex(trim(text, {BLANKS}), '[ \\t\\n\\x0B\\f\\r]+'), 1, 512), ' ') AS text
              FROM documents)
            SELECT review_id, CAST(length(text) AS INTEGER) AS n, md5(text) AS text_md5 FROM cut""",
        "baseline_sentiment_wordlist": f"""WITH split AS (
              SELECT doc_id, string_split_regex(lower(text), '[^\\p{{L}}\\p{{N}}]+') AS words
              FROM documents),
            scored AS (
              SELECT doc_id, {_words_sql(NEGATIVE_WORDS)} AS bad, {_words_sql(POSITIVE_WORDS)} AS good
              FROM split)
            SELECT doc_id AS review_id, CASE WHEN bad > good THEN 'negative'
              WHEN good > bad THEN 'positive' ELSE 'neutral' END AS predicted_sentiment
            FROM scored""",
        "argmax_scores": """
            SELECT vec_id, CAST(list_position(embedding, list_max(embedding)) - 1 AS INTEGER) AS best
            FROM embeddings""",
        "text_tokens": """WITH split AS (
              SELECT doc_id, list_filter(string_split_regex(lower(text), '[^\\p{L}\\p{N}]+'),
                                         lambda w: w <> '') AS tokens
              FROM documents)
            SELECT doc_id AS review_id, CAST(len(tokens) AS INTEGER) AS n_tokens,
                   md5(array_to_string(tokens, ' ')) AS tokens_md5
            FROM split""",
        "csv_roundtrip": f"""
            WITH kept AS (SELECT * REPLACE (CASE WHEN text NOT IN ({tokens}) THEN text END AS text)
                          FROM documents)
            SELECT doc_id, md5(text) AS text, lang, source, n_chars,
                   CAST(length(text) AS INTEGER) AS n FROM kept""",
        "category_table": f"""WITH {REVIEWS}, {LABELLED}
            SELECT review_id, name, rating AS reviews_rating, rating_sentiment, meta_category
            FROM labelled WHERE meta_category = '{CATEGORY}'""",
    }
