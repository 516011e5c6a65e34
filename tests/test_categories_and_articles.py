import pytest
from pyspark.sql import functions as F

from starloom.functions.prompts import category_prompt
from starloom.operators import bounded, categories, evidence
from starloom.plans import articles
from starloom.sources import summaries


def rows(df):
    return [tuple(r) for r in df.collect()]


def executed(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.fixture(scope="module")
def raw(spark):
    strings = [
        "AA,Health & Beauty,Electronics",
        "Batteries,Health and Beauty",
        "Litter Boxes,Home & Kitchen",
        "Fire Tablets,Computers",
        "Audio,Speakers",
        "Dog Crates",
        "Unheard of",
        None,
    ]
    data = [(i, s) for i, s in enumerate(strings * 3)]
    return spark.createDataFrame(data, "review_id long, categories string")


def test_each_string_is_classified_once(raw):
    distinct = categories.distinct_categories(raw)
    found = dict(rows(categories.classify_categories(distinct)))
    assert found == {
        "AA,Health & Beauty,Electronics": "Health & Beauty",
        "Batteries,Health and Beauty": "Health & Beauty",
        "Litter Boxes,Home & Kitchen": "Pet Supplies",
        "Fire Tablets,Computers": "Tablets & E-readers",
        "Audio,Speakers": "Electronics",
        "Dog Crates": "Pet Supplies",
        "Unheard of": None,
    }


def test_mapping_keeps_all_reviews_and_is_broadcast(raw):
    mapping = categories.classify_categories(categories.distinct_categories(raw))
    mapped = categories.join_mapping(raw, mapping)
    assert mapped.count() == raw.count()
    assert mapped.where("categories IS NULL AND meta_category IS NULL").count() == 3
    plan = executed(mapped)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    direct = categories.with_meta_category(raw)
    assert sorted(map(str, rows(direct))) == sorted(map(str, rows(mapped)))
    assert "Exchange" not in executed(direct)


def test_large_mapping_is_joined_by_a_shuffle(spark, raw, monkeypatch):
    mapping = categories.mapping_table(spark, {"Dog Crates": "Pet Supplies", "other": "x"})
    small = rows(categories.join_mapping(raw, mapping))
    monkeypatch.setattr(categories, "small_side", lambda df: bounded.small_side(df, max_rows=1))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = categories.join_mapping(raw, mapping)
        assert "SortMergeJoin" in executed(joined)
        assert sorted(map(str, rows(joined))) == sorted(map(str, small))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_mapping_must_be_unique(spark, raw):
    twice = spark.createDataFrame([("a", "x"), ("a", "y")], "categories string, meta_category string")
    with pytest.raises(ValueError, match="more than once"):
        categories.join_mapping(raw, twice)


def test_mapping_must_be_unique_above_the_broadcast_bound(spark, raw, monkeypatch):
    monkeypatch.setattr(categories, "small_side", lambda df: bounded.small_side(df, max_rows=1))
    rows_ = [("a", "x"), ("b", "x"), ("b", "y"), ("c", "z")]
    with pytest.raises(ValueError, match="more than once: b"):
        categories.join_mapping(raw, spark.createDataFrame(rows_, "categories string, meta_category string"))


def test_options_without_any_rule(spark):
    raw = spark.createDataFrame([("Dog toys",), (None,)], "categories string")
    found = categories.classify_categories(raw, options=["Toys", "Garden"])
    assert [r["meta_category"] for r in found.collect()] == [None, None]
    some = categories.classify_categories(raw, options=["Pet Supplies"]).collect()
    straight = categories.with_meta_category(raw, options=["Pet Supplies"]).collect()
    assert [r["meta_category"] for r in some] == [r["meta_category"] for r in straight] == ["Pet Supplies", None]


def test_model_hook_sees_distinct_strings_and_its_answers_are_kept(spark, raw):
    calls = spark.sparkContext.accumulator(0)

    def load():
        def answer(questions):
            calls.add(len(questions))
            return [" Pets\n" if "Dog" in q else "Made Up" for q in questions]

        return answer

    distinct = categories.distinct_categories(raw)
    mapping = categories.classify_categories(distinct, load_model=load, calls=3)
    assert calls.value == 7
    found = dict(rows(mapping))
    assert found["Dog Crates"] == "Pets" and found["Audio,Speakers"] == "Made Up"
    assert len(found) == 7
    mapped = categories.join_mapping(raw, mapping)
    assert mapped.count() == raw.count() and calls.value == 7
    assert rows(categories.mapping_summary(mapped, ["Pets"])) == [(3, 18, 3)]
    audit = categories.mapping_audit(mapped, ["Pets"], ["categories", "meta_category"])
    assert {r["off_list"] for r in audit.where("categories = 'Dog Crates'").collect()} == {False}
    assert audit.where("off_list").count() == 6


def test_category_prompt(spark):
    df = spark.createDataFrame([("a {x} 'b'",)], "c string")
    text = df.select(category_prompt("c", ["P", "Q"], "{cat} of {options}; {cat}")).first()[0]
    assert text == "a {x} 'b' of 'P', 'Q'; a {x} 'b'"
    default = df.select(category_prompt("c")).first()[0]
    assert "'Pet Supplies'" in default and "a {x} 'b'" in default


@pytest.fixture(scope="module")
def reviews(spark):
    """``Both`` is reviewed in two categories; half of all reviews are of one product."""
    data = [(i, "Toys", "Hot", 5.0, f"hot {i}") for i in range(100)]
    data += [(200 + i, "Toys", "Both", 1.0, f"both {i}") for i in range(3)]
    data += [(300, "Games", "Both", 4.0, "from games"), (301, "Games", "Solo", 2.0, None)]
    data += [(400, "Toys", "Few", 2.0, "meh")]
    data += [(401, "Toys", "Two", 4.0, "a"), (402, "Toys", "Two", 4.0, "b")]
    return spark.createDataFrame(
        data,
        "review_id long, meta_category string, name string, `reviews.rating` double,"
        " `reviews.text` string",
    ).repartition(5)


def test_evidence_joins_on_the_name_alone(reviews):
    found = evidence.article_evidence(reviews, n_top=2, max_reviews_per_product=30)
    games = found.where("meta_category = 'Games' AND role = 'top' AND name = 'Both'")
    assert [r["text"] for r in games.orderBy("pos").collect()] == [
        "both 0",
        "both 1",
        "both 2",
        "from games",
    ]
    # Top and worst at once: evidence under both roles.
    roles = {r["role"] for r in found.where("meta_category = 'Toys' AND name = 'Both'").collect()}
    assert roles == {"top", "worst"}


def test_evidence_cap_and_order(reviews):
    found = evidence.article_evidence(reviews, n_top=1, max_reviews_per_product=30)
    hot = found.where("name = 'Hot'").orderBy("pos").collect()
    assert [r["review_id"] for r in hot] == list(range(30))
    whole = evidence.article_evidence(reviews, n_top=1, max_reviews_per_product=None)
    assert whole.where("name = 'Hot'").count() == 100
    assert "Window" not in executed(whole)


def test_texts_are_read_only_where_chosen_ids_can_be(spark, tmp_path):
    """Ids follow the file order here, so the scan can skip all later row groups."""
    rows = spark.range(0, 4000, 1, 4).select(
        F.col("id").alias("review_id"),
        F.lit("c").alias("meta_category"),
        F.when(F.col("id") % 3 == 0, "hot")
        .otherwise(F.concat(F.lit("p"), F.col("id") % 50))
        .alias("name"),
        (F.col("id") % 5 + 1).cast("double").alias("reviews.rating"),
        F.concat(F.lit("text "), F.col("id")).alias("reviews.text"),
    )
    rows.write.parquet(str(tmp_path / "t"))
    found = evidence.article_evidence(spark.read.parquet(str(tmp_path / "t")), 1, 30)
    top = found.where("role = 'top'").orderBy("pos").collect()
    assert [r["review_id"] for r in top] == list(range(0, 90, 3))
    plan = executed(found)
    assert "LessThanOrEqual(review_id," in plan and "In(name, [" in plan


def test_no_reviews_give_no_evidence(reviews):
    nothing = reviews.where("name = 'absent'")
    assert evidence.article_evidence(nothing).isEmpty()
    assert evidence.article_evidence(nothing, max_reviews_per_product=None).isEmpty()
    assert articles.generate_category_blogs(reviews, "Absent").isEmpty()


def test_evidence_of_many_products_uses_joins(reviews, monkeypatch):
    expected = sorted(map(str, rows(evidence.article_evidence(reviews, 2, 30))))
    monkeypatch.setattr(bounded, "MAX_LISTED", 0)
    assert sorted(map(str, rows(evidence.article_evidence(reviews, 2, 30)))) == expected
    monkeypatch.setattr(evidence, "small_side", lambda df: bounded.small_side(df, max_rows=1))
    assert sorted(map(str, rows(evidence.article_evidence(reviews, 2, 30)))) == expected


def test_evidence_with_copies_of_one_id(spark):
    data = [(7, "c", "p", 3.0, "same")] * 50 + [(i, "c", "p", 3.0, "t") for i in range(5)]
    df = spark.createDataFrame(
        data, "review_id long, meta_category string, name string, `reviews.rating` double,"
        " `reviews.text` string"
    )
    found = evidence.article_evidence(df, 1, 10).where("role = 'top'").orderBy("pos").collect()
    assert [r["review_id"] for r in found] == [0, 1, 2, 3, 4, 7, 7, 7, 7, 7]


def test_evidence_keeps_reviews_without_an_id(spark):
    data = [(None, "c", "p", 3.0, "no id"), (1, "c", "p", 3.0, "one")]
    df = spark.createDataFrame(
        data, "review_id long, meta_category string, name string, `reviews.rating` double,"
        " `reviews.text` string"
    )
    found = evidence.article_evidence(df, 1, 10).where("role = 'top'").orderBy("pos")
    assert [r["text"] for r in found.collect()] == ["no id", "one"]


def test_blocks_of_uncapped_evidence_are_refused(reviews):
    whole = evidence.article_evidence(reviews, max_reviews_per_product=None)
    with pytest.raises(Exception, match="cap on reviews"):
        evidence.review_blocks(whole).collect()


def test_evidence_of_one_category_uses_the_whole_table_for_texts(reviews):
    found = evidence.article_evidence(reviews, 1, 30, category="Games")
    assert {r["meta_category"] for r in found.collect()} == {"Games"}
    assert found.where("role = 'top'").count() == 4


def test_null_texts_stay_in_the_block(reviews):
    blocks = evidence.review_blocks(evidence.article_evidence(reviews, n_top=2))
    solo = blocks.where("name = 'Solo' AND role = 'worst'").first()
    assert solo["texts"] == [None] and solo["ratings"] == [2.0]


def test_article_names_only_evidence(reviews):
    made = dict(rows(articles.generate_category_blogs(reviews, n_top=2)))
    assert set(made) == {"toys", "games"}
    assert "1. Hot (average 5.00 from 100 ratings)" in made["toys"]
    assert "Both:\n- both 0\n- both 1\n- both 2" in made["toys"]
    assert made["toys"].endswith("## Avoid\n\n1. Both (average 1.00 from 3 ratings)\n")
    one = dict(rows(articles.generate_category_blogs(reviews, "Games")))
    assert set(one) == {"games"}


def test_writing_hook_gets_the_prompt(reviews):
    def load():
        return lambda prompt: prompt.upper()

    made = dict(rows(articles.generate_category_blogs(reviews, load_model=load, n_top=2)))
    assert "REVIEWS OF HOT (PLACE 1)\n- HOT 0\n- HOT 1\n" in made["toys"]
    assert made["toys"].count("- HOT ") == 30
    inputs = articles.article_inputs(evidence.article_evidence(reviews))
    own = articles.write_articles(inputs, load, calls=2, prompt=F.concat(F.lit("on "), "meta_category"))
    assert dict(rows(own)) == {"toys": "ON TOYS", "games": "ON GAMES"}


def test_summary_store(spark, tmp_path):
    path = str(tmp_path / "store")
    schema = "category_key string, summary string"
    assert rows(summaries.load_summaries(spark, path)) == []
    summaries.save_summaries(spark.createDataFrame([("a", "1"), ("b", "2")], schema), path)
    summaries.upsert_summaries(spark.createDataFrame([("b", "3"), ("c", "4")], schema), path)
    assert sorted(rows(summaries.load_summaries(spark, path))) == [("a", "1"), ("b", "3"), ("c", "4")]
    # Saving replaces, also when the new content comes from the store.
    summaries.save_summaries(summaries.load_summaries(spark, path).where("category_key = 'c'"), path)
    assert rows(summaries.load_summaries(spark, path)) == [("c", "4")]
    # So does an empty table.
    summaries.save_summaries(spark.createDataFrame([], schema), path)
    assert rows(summaries.load_summaries(spark, path)) == []
    assert len(list((tmp_path / "store").glob("version=*"))) == 2


@pytest.mark.parametrize("keys", [["a", "b", "b"], ["a", None]])
def test_summary_keys_must_be_unique(spark, tmp_path, keys):
    path = str(tmp_path / "store")
    schema = "category_key string, summary string"
    summaries.save_summaries(spark.createDataFrame([("a", "old")], schema), path)
    with pytest.raises(ValueError, match="have the key"):
        summaries.upsert_summaries(spark.createDataFrame([(k, "new") for k in keys], schema), path)
    assert rows(summaries.load_summaries(spark, path)) == [("a", "old")]


def test_summaries_as_json(spark, tmp_path):
    schema = "category_key string, summary string"
    stored = spark.createDataFrame([("a", 'x "q"\né'), ("b", "2")], schema)
    path = str(tmp_path / "json")
    summaries.save_summaries_json(stored, path)
    assert sorted(rows(summaries.load_summaries_json(spark, path))) == sorted(rows(stored))
    assert rows(summaries.load_summaries_json(spark, str(tmp_path / "none"))) == []
    many = spark.range(60_000).selectExpr("string(id) AS category_key", "'' AS summary")
    with pytest.raises(ValueError, match="too many"):
        summaries.save_summaries_json(many, path, max_rows=1000)
    (tmp_path / "broken.json").write_text('{"a": "1", "b"')
    with pytest.raises(Exception, match="(?i)malformed|parse"):
        summaries.load_summaries_json(spark, str(tmp_path / "broken.json")).collect()
    (tmp_path / "one.json").write_text('{\n  "k": "v"\n}')
    assert rows(summaries.load_summaries_json(spark, str(tmp_path / "one.json"))) == [("k", "v")]


def test_lookup_gives_an_empty_text(spark):
    stored = spark.createDataFrame([("pet_supplies", "t")], "category_key string, summary string")
    found = summaries.summaries_for(spark, stored, ["Pet Supplies", "Electronics"])
    assert sorted(rows(found)) == [
        ("Electronics", "electronics", ""),
        ("Pet Supplies", "pet_supplies", "t"),
    ]


def test_small_side_respects_rows_and_bytes(spark):
    df = spark.range(10).withColumn("t", F.lit("x" * 100))
    assert bounded.small_side(df)[1].num_rows == 10
    for bound in ({"max_rows": 9}, {"max_bytes": 500}):
        side, held = bounded.small_side(df, **bound)
        assert held is None
        assert sorted(rows(side)) == sorted(rows(df))
        assert "FileScan parquet" in executed(side)
