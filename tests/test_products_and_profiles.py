import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from starloom.functions import columns as fn
from starloom.operators import metrics, products, profile, ranking
from starloom.plans import reports


def rows(df):
    return [tuple(r) for r in df.collect()]


def executed(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_top_n(ranked_reviews):
    top = products.get_top_n(ranked_reviews, "Bike")
    assert top.columns == ["Product", "Avg Rating", "# Reviews"]
    assert rows(top) == [("Helmet", 4.0, 4), ("Bell", 2.5, 2), ("Lock", 5.0, 2)]
    assert len(rows(products.get_top_n(ranked_reviews, "Office", n=5))) == 2
    assert [r[0] for r in rows(products.get_top_n(ranked_reviews, "Bike", n=1))] == ["Helmet"]


def test_worst(ranked_reviews):
    worst = products.get_worst(ranked_reviews, "Bike")
    assert worst.columns == ["Product", "Avg Rating", "# Reviews"]
    assert rows(worst) == [("Pump", 1.0, 1)]
    assert rows(products.get_worst(ranked_reviews, "Office")) == [("Chair", 2.0, 1)]
    assert rows(products.get_worst(ranked_reviews, "Nowhere")) == []


def test_top_n_is_planned_as_a_bounded_sort(ranked_reviews):
    assert "TakeOrderedAndProject" in executed(products.get_top_n(ranked_reviews, "Bike"))


def test_null_names_and_ratings(spark):
    df = spark.createDataFrame(
        [("c", "a", None), ("c", "a", None), ("c", "b", 2.0), ("c", "b", None), ("c", None, 1.0)],
        "meta_category string, name string, `reviews.rating` double",
    )
    stats = {r["name"]: tuple(r)[2:] for r in products.product_stats(df).collect()}
    assert stats == {"a": (None, 0), "b": (2.0, 1)}
    # The product without a rating comes after all that have one.
    assert rows(products.get_worst(df, "c")) == [("b", 2.0, 1)]
    assert [r[1] for r in rows(products.product_means(df))] == ["b", "a"]


def test_all_categories_at_once_agree_with_each_alone(ranked_reviews):
    stats = products.product_stats(ranked_reviews)
    for category in ("Bike", "Office"):
        top = products.top_per_category(stats, 2).where(F.col("meta_category") == category)
        alone = products.get_top_n(ranked_reviews, category, 2)
        assert [r["name"] for r in top.orderBy("rank").collect()] == [r[0] for r in rows(alone)]
    assert sorted(r["name"] for r in products.worst_per_category(stats).collect()) == [
        "Chair",
        "Pump",
    ]


def test_a_product_can_be_top_and_worst(ranked_reviews):
    picked = products.picked_products(products.product_stats(ranked_reviews), 3)
    roles = sorted((r["role"], r["rank"]) for r in picked.where("name = 'Chair'").collect())
    assert roles == [("top", 2), ("worst", 1)]


def test_picks_share_one_aggregate_and_cut_before_the_shuffle(ranked_reviews):
    plan = executed(products.picked_products(products.product_stats(ranked_reviews), 3))
    assert "ReusedExchange" in plan
    assert "row_number(), 3, Partial" in plan


@pytest.mark.parametrize("threshold", ["1000", "5"])
def test_first_k_is_exact_on_both_sides_of_the_threshold(spark, threshold):
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 > 0, 0).otherwise(F.col("id") % 7).alias("g"),
        ((F.col("id") * 7919) % 3001).alias("v"),
    ).repartition(6)
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", threshold)
    try:
        found = rows(ranking.first_k(df, ["g"], [F.col("v").asc()], 20, "pos"))
    finally:
        spark.conf.unset("spark.sql.optimizer.windowGroupLimitThreshold")
    groups = {}
    for g, v in rows(df):
        groups.setdefault(g, []).append(v)
    expected = [(g, v, i) for g, vs in groups.items() for i, v in enumerate(sorted(vs)[:20], 1)]
    assert sorted(found) == sorted(expected)


def test_rating_chart_names(ranked_reviews):
    chart = products.rating_chart(ranked_reviews, "Bike", 1)
    assert rows(chart) == [("Helmet", 4.0, 4, "Helmet...")]


def test_dashboard_tables(spark, ranked_reviews):
    from starloom.operators.labels import assign_sentiment_labels

    stored = spark.createDataFrame([("bike", "text")], "category_key string, summary string")
    page = reports.dashboard(assign_sentiment_labels(ranked_reviews), "Bike", stored)
    assert rows(page["review_count"]) == [(9,)]
    assert rows(page["sentiment_distribution"]) == [("positive", 5), ("negative", 2), ("neutral", 2)]
    assert page["sentiment_distribution"].columns == ["Sentiment", "Count"]
    assert rows(page["summary"]) == [("Bike", "bike", "text")]
    assert len(rows(page["top_products"])) == 3 and len(rows(page["worst_product"])) == 1
    assert sorted(rows(reports.category_sizes(ranked_reviews))) == [("Bike", 9), ("Office", 4)]


def test_category_filter_reaches_the_scan(spark, tmp_path, ranked_reviews):
    ranked_reviews.write.parquet(str(tmp_path / "t"))
    plan = executed(products.get_worst(spark.read.parquet(str(tmp_path / "t")), "Office"))
    assert "EqualTo(meta_category,Office)" in plan


@pytest.fixture(scope="module")
def holes(spark):
    return spark.createDataFrame(
        [("x", 1), ("x", 2), ("y", None), (None, 3), ("x", None), (None, None), ("z", 1), ("z", 1)],
        "k string, `v.w` int",
    )


def test_value_counts_leave_nulls_out(holes):
    assert rows(profile.value_counts(holes, "k")) == [("x", 3), ("z", 2), ("y", 1)]
    assert rows(profile.value_counts(holes, "v.w")) == [(1, 3), (2, 1), (3, 1)]
    assert rows(profile.value_counts(holes, "k", "v.w")) == [("z", 1, 2), ("x", 1, 1), ("x", 2, 1)]


def test_shares_divide_by_all_rows(holes, spark):
    assert rows(profile.class_shares(holes, "k")) == [
        ("x", 3, 37.5),
        ("z", 2, 25.0),
        ("y", 1, 12.5),
    ]
    # 1/800 is 0.125 percent: half to even.
    even = spark.range(800).select(F.when(F.col("id") == 0, "a").otherwise("b").alias("k"))
    assert dict((k, p) for k, _, p in rows(profile.class_shares(even, "k")))["a"] == 0.12


def test_shares_scan_once(holes, spark, tmp_path):
    holes.write.parquet(str(tmp_path / "t"))
    plan = executed(profile.class_shares(spark.read.parquet(str(tmp_path / "t")), "k"))
    assert "ReusedExchange" in plan


def test_profile(holes):
    assert rows(profile.table_profile(holes)) == [
        ("k", 0, "string", 8, 6, 2),
        ("v.w", 1, "int", 8, 5, 3),
    ]
    assert rows(profile.null_counts(holes)) == [("k", 2), ("v.w", 3)]
    assert rows(profile.distinct_counts(holes, "k", "v.w")) == [("k", 3), ("v.w", 3)]
    assert rows(profile.distinct_counts(holes, "k", approximate=True)) == [("k", 3)]
    assert {r[0] for r in rows(profile.distinct_values(holes, "k"))} == {"x", "y", "z", None}
    assert rows(profile.smallest_class(holes, "k")) == [(1,)]
    assert dict(rows(profile.class_sizes(holes, "k"))) == {"x": 3, "y": 1, "z": 2, None: 2}


def report(spark, pairs):
    df = spark.createDataFrame(pairs, "rating_sentiment string, predicted_sentiment string")
    return df, {r["label"]: tuple(r)[1:] for r in metrics.classification_report(df).collect()}


def test_classification_report_by_hand(spark):
    pairs = (
        [("negative", "negative")] * 3
        + [("negative", "positive")] * 1
        + [("neutral", "negative")] * 2
        + [("positive", "positive")] * 4
        + [(None, "positive"), ("positive", None)]
    )
    df, found = report(spark, pairs)
    assert found["negative"] == pytest.approx((3 / 5, 3 / 4, 2 / 3, 4))
    # Never predicted: no precision to divide, so zero.
    assert found["neutral"] == (0.0, 0.0, 0.0, 2)
    # The positive row without a prediction is a miss.
    assert found["positive"] == pytest.approx((4 / 5, 4 / 5, 4 / 5, 5))
    assert found["accuracy"] == (None, None, pytest.approx(7 / 11), 11)
    macro = ((3 / 5 + 4 / 5) / 3, (3 / 4 + 4 / 5) / 3, (2 / 3 + 4 / 5) / 3)
    assert found["macro avg"] == pytest.approx((*macro, 11))
    weighted = ((12 / 5 + 4) / 11, 7 / 11, (8 / 3 + 4) / 11)
    assert found["weighted avg"] == pytest.approx((*weighted, 11))
    assert set(found) == {"negative", "neutral", "positive", "accuracy", "macro avg", "weighted avg"}
    matrix = {r["actual"]: tuple(r)[1:] for r in metrics.confusion_matrix(df).collect()}
    assert matrix == {
        "negative": (3, 0, 1, 0),
        "neutral": (2, 0, 0, 0),
        "positive": (0, 0, 4, 1),
        "other": (0, 0, 0, 0),
    }


def test_labels_off_the_list_are_counted_or_refused(spark):
    pairs = [("a", "a"), ("a", "c"), ("c", "a"), ("b", None), (None, "a")]
    df = spark.createDataFrame(pairs, "rating_sentiment string, predicted_sentiment string")
    found = metrics.confusion_matrix(df, labels=["a", "b"], others="rest")
    matrix = {r["actual"]: tuple(r)[1:] for r in found.collect()}
    assert matrix == {"a": (1, 0, 1), "b": (0, 0, 1), "rest": (1, 0, 0)}
    with pytest.raises(Exception, match="not on the list"):
        metrics.confusion_matrix(df, labels=["a", "b"], others=None).collect()


def test_report_agrees_with_spark_ml(spark):
    names = ["negative", "neutral", "positive"]
    codes = [(i * 7 % 3, (i * i) % 3 if i % 4 else i * 7 % 3) for i in range(200)]
    df, found = report(spark, [(names[a], names[p]) for a, p in codes])
    doubles = [(float(a), float(p)) for a, p in codes]
    coded = spark.createDataFrame(doubles, "label double, prediction double")

    def metric(name, label=0.0):
        judge = MulticlassClassificationEvaluator(metricName=name, metricLabel=label)
        return pytest.approx(judge.evaluate(coded))

    assert found["accuracy"][2] == metric("accuracy")
    assert found["weighted avg"][2] == metric("f1")
    for code, name in enumerate(names):
        assert found[name][0] == metric("precisionByLabel", float(code))
        assert found[name][1] == metric("recallByLabel", float(code))
        assert found[name][2] == metric("fMeasureByLabel", float(code))


def test_report_has_classes_that_are_only_predicted(spark):
    df, found = report(spark, [("negative", "neutral")])
    assert found["neutral"] == (0.0, 0.0, 0.0, 0)
    matrix = {r["actual"]: tuple(r)[1:] for r in metrics.confusion_matrix(df).collect()}
    assert matrix == {
        "negative": (0, 1, 0, 0),
        "neutral": (0, 0, 0, 0),
        "positive": (0, 0, 0, 0),
        "other": (0, 0, 0, 0),
    }


def evaluate(spark, expression, value, kind):
    return spark.createDataFrame([(value,)], f"v {kind}").select(expression).first()[0]


@pytest.mark.parametrize(
    "label, key",
    [
        ("Garden & Patio", "garden_patio"),
        ("Salt&Pepper", "salt_pepper"),
        ("Car  Parts", "car__parts"),
        ("TOOLS", "tools"),
        ("Wi-Fi & Cables", "wi-fi_cables"),
    ],
)
def test_category_key(spark, label, key):
    assert evaluate(spark, fn.category_key("v"), label, "string") == key


@pytest.mark.parametrize("number", [0.125, 2.675, 1.005, 3.125, 2.5, 1234.5, 4.666666])
def test_two_decimals_agree_with_python(spark, number):
    assert evaluate(spark, fn.two_decimals("v"), number, "double") == f"{number:.2f}"


def test_small_column_functions(spark):
    assert evaluate(spark, fn.thousands("v"), 1234567, "long") == "1,234,567"
    assert evaluate(spark, fn.strip("v"), " \t\r\n a b \f\v\n", "string") == "a b"
    assert evaluate(spark, fn.short_name("v"), "n" * 50, "string") == "n" * 40 + "..."
    assert evaluate(spark, fn.short_name("v"), "n", "string") == "n..."
    assert evaluate(spark, fn.truncate_tokens("v", 2), " a\n b  c ", "string") == "a b"
    assert evaluate(spark, fn.argmax("v"), [1.0, 3.0, 3.0], "array<double>") == 1
