import glob
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from starloom.fixed_values import NULL_TOKENS, UNUSED_COLUMNS
from starloom.operators import cleaning, labels, sampling
from starloom.session import shuffle_partitions
from starloom.sources import reviews as files


@pytest.fixture(scope="module")
def raw(spark, review_csv):
    return files.load_reviews(spark, review_csv, {"id": "bigint", "reviews.rating": "double"}).cache()


@pytest.fixture(scope="module")
def labelled(raw):
    return labels.assign_sentiment_labels(cleaning.clean_columns(raw)).cache()


def column(df, name):
    return [row[0] for row in df.select(F.col(f"`{name}`")).collect()]


def test_reads_all_rows_and_keeps_the_header(raw):
    assert raw.count() == 15
    assert raw.columns[3:5] == ["Reviews.Rating", "primaryCategories"]


def test_quotes_and_line_breaks_inside_a_field(raw):
    assert 'He wrote "meh" and\nsent it back' in column(raw, "reviews.text")
    assert "Boils fast, burns hot" in column(raw, "reviews.text")


def test_missing_value_tokens_are_null(raw):
    texts = dict(zip(column(raw, "id"), column(raw, "reviews.text")))
    assert texts[9] is None and texts[10] is None
    assert column(raw, "reviews.id") == [None] * 15


def test_number_columns_are_found_by_name(raw):
    assert dict(raw.dtypes)["Reviews.Rating"] == "double"
    assert dict(raw.dtypes)["id"] == "bigint"


def test_ids_that_are_text_stay_text(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,reviews.rating,n,x\nAVq1,5,1,1.5\nAVq2,4.5,,2\n")
    rows = files.load_reviews(spark, str(tmp_path / "a.csv"), with_id=False).collect()
    assert [tuple(r) for r in rows] == [("AVq1", 5.0, "1", "1.5"), ("AVq2", 4.5, None, "2")]
    inferred = files.load_reviews(spark, str(tmp_path / "a.csv"), "infer", with_id=False)
    assert [kind for _, kind in inferred.dtypes] == ["string", "double", "bigint", "double"]


def test_columns_are_matched_by_name_not_place(spark, tmp_path):
    (tmp_path / "a.csv").write_text("reviews.rating,name\n4,x\nbad,y\nNA,None\n")
    rows = files.load_reviews(spark, str(tmp_path / "a.csv")).collect()
    assert [tuple(r) for r in rows] == [(4.0, "x", 0), (None, "y", 1), (None, None, 2)]


def test_repeated_header_is_numbered_and_case_clash_is_refused(spark, tmp_path):
    (tmp_path / "a.csv").write_text("name,name\nx,y\n")
    numbered = files.load_reviews(spark, str(tmp_path / "a.csv"), with_id=False)
    assert numbered.columns == ["name", "name.1"]
    assert [tuple(r) for r in numbered.collect()] == [("x", "y")]
    (tmp_path / "b.csv").write_text("Name,name\nx,y\n")
    with pytest.raises(ValueError, match="Name, name"):
        files.load_reviews(spark, str(tmp_path / "b.csv"))


def test_files_with_another_header_are_refused(spark, tmp_path):
    (tmp_path / "a.csv").write_text("name,reviews.rating\nx,1\n")
    (tmp_path / "b.csv").write_text("reviews.rating,name\n1,x\n")
    with pytest.raises(Exception, match="(?i)header"):
        files.load_reviews(spark, str(tmp_path)).collect()
    (tmp_path / "same").mkdir()
    (tmp_path / "same" / "a.csv").write_text("name,name\nx,1\n")
    (tmp_path / "same" / "b.csv").write_text("name,other\nx,1\n")
    with pytest.raises(Exception, match="(?i)header"):
        files.load_reviews(spark, str(tmp_path / "same")).collect()
    (tmp_path / "empty").mkdir()
    (tmp_path / "empty" / "c.csv").write_text("")
    with pytest.raises(ValueError, match="no header"):
        files.load_reviews(spark, str(tmp_path / "empty"))


def test_ids_follow_the_input_order(spark, review_csv):
    rows = files.load_reviews(spark, review_csv).orderBy("review_id")
    assert column(rows, "id") == [str(i) for i in range(1, 16)]


@pytest.mark.parametrize("partitions", ["1", "7"])
def test_ids_are_places_however_files_are_packed(spark, tmp_path, partitions):
    (tmp_path / "a.csv").write_text("name\n" + "".join(f"a{i}\n" for i in range(5)))
    (tmp_path / "b.csv").write_text("name\n" + "".join(f"b{i} {'x' * 50}\n" for i in range(40)))
    (tmp_path / "c.csv").write_text("name\n")
    spark.conf.set("spark.sql.files.minPartitionNum", partitions)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "500")
    try:
        found = files.load_reviews(spark, str(tmp_path), multi_line=False).collect()
    finally:
        spark.conf.unset("spark.sql.files.minPartitionNum")
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    places = {r["review_id"]: r["name"].split(" ")[0] for r in found}
    assert places == dict(enumerate([f"a{i}" for i in range(5)] + [f"b{i}" for i in range(40)]))


@pytest.mark.parametrize("ids, kind", [([3, 20, 100], "bigint"), (["3", "b", "c"], "string")])
def test_stored_ids_keep_their_type(spark, tmp_path, ids, kind):
    path = str(tmp_path / "out")
    files.save_csv(spark.createDataFrame([(i,) for i in ids], f"review_id {kind}"), path)
    assert files.load_reviews(spark, path).dtypes == [("review_id", kind)]


def test_csv_folder_reads_back_unchanged(spark, tmp_path):
    texts = [' padded "x" ', "a,b\nc", "\ttab", "back\\slash", "'", "é", "line\r\nend", None]
    df = spark.createDataFrame(list(enumerate(texts)), "n bigint, `reviews.text` string")
    path = str(tmp_path / "out")
    files.save_csv(df, path)
    back = files.load_reviews(spark, path, {"n": "bigint"}, with_id=False)
    assert sorted(back.collect()) == sorted(df.collect())


def test_random_texts_survive_the_round_trip(spark, tmp_path):
    """pandas reads the files to the same values."""
    random_ = random.Random(1)
    letters = '",\n\r\\ \'aé\t#;| x0'
    texts = ["".join(random_.choices(letters, k=random_.randint(0, 8))) for _ in range(2000)]
    texts += NULL_TOKENS
    path = str(tmp_path / "out")
    files.save_csv(spark.createDataFrame(list(enumerate(texts)), "n bigint, t string"), path)
    expected = {i: None if t in NULL_TOKENS else t for i, t in enumerate(texts)}
    back = files.load_reviews(spark, path, {"n": "bigint"}, with_id=False)
    assert dict(map(tuple, back.collect())) == expected
    parts = pd.concat(map(pd.read_csv, glob.glob(f"{path}/*.csv")))
    assert {n: None if pd.isna(t) else t for n, t in zip(parts.n, parts.t)} == expected


def test_category_filter_prunes_the_folders_of_a_table(spark, tmp_path, ranked_reviews):
    path = str(tmp_path / "t")
    files.save_table(ranked_reviews, path, by_category=True)
    kept = files.load_table(spark, path).where("meta_category = 'Office'")
    assert kept.count() == 4
    assert "PartitionFilters: [isnotnull(meta_category" in plan(kept)


def test_rebalanced_table_has_the_same_rows(spark, tmp_path, ranked_reviews):
    path = str(tmp_path / "t")
    files.save_table(ranked_reviews.repartition(6), path, by_category=True, rebalance=True)
    stored = files.load_table(spark, path)
    columns = [f"`{name}`" for name in ranked_reviews.columns]
    assert sorted(stored.select(*columns).collect()) == sorted(ranked_reviews.collect())
    assert len(stored.inputFiles()) == 2


def test_shuffle_partitions():
    assert shuffle_partitions(0) == 200
    assert shuffle_partitions(10 * 1024**4) == 81920


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_clean_columns_lowers_and_drops_the_defaults(raw):
    cleaned = cleaning.clean_columns(raw)
    assert all(c == c.lower() for c in cleaned.columns)
    assert not set(UNUSED_COLUMNS) & set(cleaned.columns)
    assert "Reviews.Rating" in raw.columns


def test_clean_columns_with_own_list(raw):
    cleaned = cleaning.clean_columns(raw, ["categories", "NAME", "no such"])
    assert "categories" not in cleaned.columns
    assert {"reviews.id", "name"} <= set(cleaned.columns)
    assert len(cleaning.clean_columns(raw, []).columns) == len(raw.columns)


def test_clean_columns_refuses_names_that_collide(spark):
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        df = spark.createDataFrame([(1, 2)], "a int, A int")
        with pytest.raises(ValueError, match="a, A"):
            cleaning.clean_columns(df)
    finally:
        spark.conf.unset("spark.sql.caseSensitive")


def test_plain_and_dotted_names(raw):
    cleaned = cleaning.clean_columns(raw)
    plain = cleaning.plain_names(cleaned)
    assert "reviews_rating" in plain.columns
    assert cleaning.dotted_names(plain).columns == cleaned.columns


def test_each_rating_gets_its_label(labelled):
    expected = {1: "negative", 2: "negative", 3: "neutral", 4: "positive", 5: "positive", None: None}
    for row in labelled.collect():
        assert row["rating_sentiment"] == expected[row["reviews.rating"]]
    counts = dict(labelled.groupBy("rating_sentiment").count().collect())
    assert counts == {"positive": 6, "negative": 4, "neutral": 4, None: 1}


def test_other_ratings_have_no_label(spark):
    df = spark.createDataFrame([(4.5,), (None,), (0.0,), (6.0,)], "`reviews.rating` double")
    assert column(labels.assign_sentiment_labels(df), "rating_sentiment") == [None] * 4


def test_text_ratings_have_no_label_unless_cast(spark):
    df = spark.createDataFrame([("5",), ("abc",)], "r string")
    assert column(labels.assign_sentiment_labels(df, "r"), "rating_sentiment") == [None, None]
    cast = labels.assign_sentiment_labels(df, "r", cast=True)
    assert column(cast, "rating_sentiment") == ["positive", None]


def test_codes_and_back(labelled):
    coded = labels.decode_labels(labels.encode_labels(labelled), "actual_sentiment")
    assert dict(coded.dtypes)["actual_sentiment"] == "int"
    pairs = {tuple(r) for r in coded.select("rating_sentiment", "actual_sentiment").collect()}
    assert pairs == {("negative", 0), ("neutral", 1), ("positive", 2), (None, None)}
    assert coded.where("predicted_sentiment <> rating_sentiment").isEmpty()


def test_model_labels_strict_and_lenient(spark):
    df = spark.createDataFrame([("LABEL_0",), ("LABEL_2",)], "m string")
    assert column(labels.attach_model_labels(df, "m"), "predicted_sentiment") == [
        "negative",
        "positive",
    ]
    odd = spark.createDataFrame([("LABEL_9",)], "m string")
    lenient = labels.attach_model_labels(odd, "m", strict=False)
    assert column(lenient, "predicted_sentiment") == [None]
    with pytest.raises(Exception, match="LABEL_9"):
        labels.attach_model_labels(odd, "m").collect()


def test_balancing_the_fixture(labelled):
    def sizes(**options):
        sample = sampling.balance_classes(labelled, **options)
        return dict(sample.groupBy("rating_sentiment").count().collect())

    assert sizes() == {"positive": 4, "negative": 4, "neutral": 4}
    assert sizes(n_per_class=5) == {"positive": 5, "negative": 4, "neutral": 4}
    assert sizes(n_per_class=1, seed=0) == {"positive": 1, "negative": 1, "neutral": 1}
    assert sizes(n_per_class=0) == {}
