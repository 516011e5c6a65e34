"""Blocks of all reviews of a product against a plain walk, and the tree of answers over them."""

import pytest
from pyspark.sql import functions as F

from starloom.operators.text_blocks import product_blocks
from starloom.plans.digests import digest_blocks, generate_whole_blogs

SCHEMA = "meta_category string, name string, `reviews.rating` double, `reviews.text` string, review_id string"


def plain_blocks(rows, wanted, budget):
    """Block of each part of each text: name -> block -> [(text, rating)]."""
    half, out = budget // 2, {}
    for name in wanted:
        own = sorted((r for r in rows if r[1] == name), key=lambda r: (r[4] is not None, r[4] or ""))
        at = 0
        for _, _, rating, text, _ in own:
            parts = [text] if not text else [text[i : i + half - 1] for i in range(0, len(text), half - 1)]
            for part in parts:
                out.setdefault((name, at // half), []).append((part, rating))
                at += 1 + len(part or "")
    return out


def found(blocks):
    return {(r["name"], r["block"]): list(zip(r["texts"], r["ratings"], strict=True)) for r in blocks.collect()}


def test_blocks_are_those_of_a_plain_walk(spark):
    texts = ["good", "", None, "ä" * 75, "x" * 18, "y" * 19, "z" * 20, "\U0001f600" * 19]
    rows = [("Bike", f"p{i % 3}", float(i % 5), texts[i * 7 % len(texts)], f"{i * 37 % 1000:04}") for i in range(300)]
    rows += [("Bike", "p0", 1.0, "no id", None), ("Bike", None, 1.0, "no name", "0"), ("Bike", "other", 1.0, "not asked for", "1")]
    reviews = spark.createDataFrame(rows, SCHEMA).repartition(5)
    wanted = spark.createDataFrame([("p0",), ("p1",), ("p2",), ("none",)], "name string")
    blocks = product_blocks(reviews, wanted, 40)
    assert found(blocks) == plain_blocks(rows, ["p0", "p1", "p2"], 40)
    sums = blocks.agg(F.max("chars").alias("most"), F.sum("reviews").alias("reviews")).first()
    assert sums["most"] < 40 and sums["reviews"] == 301


def test_hot_product_with_equal_rows_and_no_ids(spark):
    """100,000 reviews of one product, all equal and without an id: every block but the last is full."""
    reviews = spark.range(100_000).select(
        F.lit("Bike").alias("meta_category"), F.lit("hot").alias("name"), F.lit(3.0).alias("reviews.rating"),
        F.lit("same text").alias("reviews.text"), F.lit(None).cast("string").alias("review_id"),
    )
    blocks = product_blocks(reviews, spark.createDataFrame([("hot",)], "name string"), 2000).persist()
    sizes = [r["reviews"] for r in blocks.orderBy("block").collect()]
    assert sizes == [100] * 1000
    assert blocks.select(F.max("chars")).first()[0] == 1000


def test_places_need_no_task_with_all_reviews(spark):
    """Sums run within a product's slice, never over the whole product, but for one row of each slice."""
    reviews = spark.range(10).select(F.lit("a").alias("name"), F.lit(1.0).alias("reviews.rating"), F.lit("t").alias("reviews.text"), F.col("id").alias("review_id"))
    plan = product_blocks(reviews, reviews.select("name").distinct(), 100)._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert len(windows) == 2
    assert sum("[name" in line and "slice" in line.split("], [")[1] for line in windows) == 1


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    blocks = product_blocks(none, spark.createDataFrame([("a",)], "name string"))
    assert blocks.count() == 0
    assert digest_blocks(blocks, lambda: str.upper).count() == 0
    assert generate_whole_blogs(none, lambda: str.upper).count() == 0


def numbers_model():
    """A model that names the reviews it was shown, and joins such names in order."""

    def answer(prompt):
        return " ".join(line[2:] for line in prompt.split("\n")[1:])

    return answer


@pytest.mark.parametrize("fan, n", [(2, 1), (2, 23), (3, 27), (8, 9)])
def test_the_tree_keeps_all_answers_in_order(spark, fan, n):
    rows = [("Bike", "p", 1.0, f"r{i:02}", f"{i:03}") for i in range(n)] + [("Bike", "q", 1.0, "alone", "0")]
    blocks = product_blocks(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame([("p",), ("q",)], "name string"), 8)
    assert blocks.count() == n + 2  # "alone" has two parts
    answers = {r["name"]: (r["digest"], r["blocks"]) for r in digest_blocks(blocks, numbers_model, fan, 10_000).collect()}
    assert answers == {"p": (" ".join(f"r{i:02}" for i in range(n)), n), "q": ("alo ne", 2)}


def test_answers_are_bounded(spark):
    rows = [("Bike", "p", 1.0, "t" * 9, str(i)) for i in range(5)]
    blocks = product_blocks(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame([("p",)], "name string"), 20)
    longest = digest_blocks(blocks, lambda: lambda prompt: "a" * 1000, 4, 100).first()["digest"]
    assert longest == "a" * 25


def test_articles_of_all_reviews(spark):
    """Every review of a picked product is in its article's request, also beyond a cap, and those of other categories."""
    rows = [("Bike", "p", 4.0, f"p{i:03}.", f"{i:03}") for i in range(100)] + [("Bike", "q", 1.0, "q000.", "500"), ("Office", "q", 1.0, "q001.", "501")]
    reviews = spark.createDataFrame(rows, SCHEMA)

    def load():
        def answer(prompt):
            return prompt if prompt.startswith("Write") else numbers_model()(prompt)

        return answer

    written = {r["category_key"]: r["summary"] for r in generate_whole_blogs(reviews, load, budget=4000, fan=2).collect()}
    assert set(written) == {"bike", "office"}
    assert all(f"p{i:03}." in written["bike"] for i in range(100))
    assert "q000. q001." in written["office"] and "p000" not in written["office"]
    one = generate_whole_blogs(reviews, load, "Office", budget=4000, fan=2).collect()
    assert [r["category_key"] for r in one] == ["office"]
