"""Values that results depend on: labels, codes, category names, null tokens."""

from __future__ import annotations

# Fixed values.
SENTIMENT_BY_RATING = {1: "negative", 2: "negative", 3: "neutral", 4: "positive", 5: "positive"}
CODE_BY_SENTIMENT = {"negative": 0, "neutral": 1, "positive": 2}
SENTIMENT_BY_CODE = {0: "negative", 1: "neutral", 2: "positive"}
SENTIMENT_BY_MODEL_LABEL = {"LABEL_0": "negative", "LABEL_1": "neutral", "LABEL_2": "positive"}
SENTIMENTS = ["negative", "neutral", "positive"]
META_CATEGORIES = [
    "Electronics",
    "Tablets & E-readers",
    "Health & Beauty",
    "Home & Kitchen",
    "Office Supplies",
    "Pet Supplies",
]
UNUSED_COLUMNS = [
    "reviews.didpurchase",
    "reviews.id",
    "reviews.numhelpful",
    "reviews.dorecommend",
]
# Strings that a CSV reader takes for a missing value, after pandas.
NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]
REPORT_NAMES = {"name": "Product", "avg_rating": "Avg Rating", "num_reviews": "# Reviews"}

# Column names used by default throughout.
REVIEW_ID = "review_id"
NAME = "name"
CATEGORIES = "categories"
PRIMARY = "primarycategories"
META = "meta_category"
RATING = "reviews.rating"
TEXT = "reviews.text"
AVG = "avg_rating"
COUNT = "num_reviews"
SENTIMENT = "rating_sentiment"
ACTUAL = "actual_sentiment"
PREDICTED = "predicted_sentiment"
