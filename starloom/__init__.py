"""Product-review analytics as Spark DataFrame jobs."""

from starloom.operators.categories import (
    classify_categories,
    distinct_categories,
    join_mapping,
    mapping_audit,
    mapping_summary,
)
from starloom.operators.cleaning import clean_columns
from starloom.operators.closest import hold_to_options
from starloom.operators.clusters import assign_clusters, cluster_sweep
from starloom.operators.count_model import load_counts, predict_counts, train_counts
from starloom.operators.evidence import article_evidence, reviews_of_products
from starloom.operators.labels import assign_sentiment_labels, encode_labels
from starloom.operators.metrics import classification_report, confusion_matrix
from starloom.operators.products import (
    get_top_n,
    get_worst,
    picked_products,
    product_means,
    product_stats,
    rating_chart,
    top_per_category,
    worst_per_category,
)
from starloom.operators.profile import (
    class_shares,
    distinct_counts,
    null_counts,
    table_profile,
    value_counts,
)
from starloom.operators.sampling import balance_classes, train_test_split
from starloom.operators.sentiment import baseline_sentiment
from starloom.operators.steady_clusters import steady_clusters, steady_sweep
from starloom.operators.text_blocks import product_blocks
from starloom.operators.text_model import load_model, predict_sentiment, train_sentiment
from starloom.operators.token_cut import truncate_by_tokenizer
from starloom.plans.articles import generate_category_blogs
from starloom.plans.digests import generate_whole_blogs
from starloom.plans.reports import dashboard
from starloom.session import build_session, remove_scratch
from starloom.sources.reviews import load_reviews, load_table, save_csv, save_table
from starloom.sources.running_profile import add_profile, running_profile
from starloom.sources.running_stats import add_batch, running_sentiment, running_stats
from starloom.sources.summaries import (
    load_summaries,
    load_summaries_json,
    save_summaries,
    save_summaries_json,
    upsert_summaries,
)

__all__ = [
    "add_batch",
    "add_profile",
    "article_evidence",
    "assign_clusters",
    "assign_sentiment_labels",
    "balance_classes",
    "baseline_sentiment",
    "build_session",
    "class_shares",
    "classification_report",
    "classify_categories",
    "clean_columns",
    "cluster_sweep",
    "confusion_matrix",
    "dashboard",
    "distinct_categories",
    "distinct_counts",
    "encode_labels",
    "generate_category_blogs",
    "generate_whole_blogs",
    "get_top_n",
    "get_worst",
    "hold_to_options",
    "join_mapping",
    "load_counts",
    "load_model",
    "load_reviews",
    "load_summaries",
    "load_summaries_json",
    "load_table",
    "mapping_audit",
    "mapping_summary",
    "null_counts",
    "picked_products",
    "predict_counts",
    "predict_sentiment",
    "product_blocks",
    "product_means",
    "product_stats",
    "rating_chart",
    "remove_scratch",
    "reviews_of_products",
    "running_profile",
    "running_sentiment",
    "running_stats",
    "save_csv",
    "save_summaries",
    "save_summaries_json",
    "save_table",
    "steady_clusters",
    "steady_sweep",
    "table_profile",
    "top_per_category",
    "train_counts",
    "train_sentiment",
    "train_test_split",
    "truncate_by_tokenizer",
    "upsert_summaries",
    "value_counts",
    "worst_per_category",
]
