"""Statistics by batches against those of all reviews at once."""

from collections import Counter
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from starloom.operators.products import product_stats
from starloom.sources import commits, running_stats as rs

SCHEMA = "meta_category string, name string, `reviews.rating` double, n int"
ROWS = [
    ("Bike", "Pump", 1.0, 0), ("Bike", "Pump", 4.5, 1), ("Bike", "Pump", None, 1), ("Bike", "Lock", None, 0),
    ("Bike", "Lock", None, 2), ("Office", "Pump", 3.0, 2), (None, "Pump", 3.0, 0), ("Bike", None, 5.0, 1),
    ("Office", "Lamp", 5.0, 1), ("Office", "Lamp", 5.0, 1), ("Office", "Lamp", 2.0, 2), ("", "", 4.0, 0),
]


@pytest.fixture(scope="module")
def reviews(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3)


def rows(df):
    return Counter(map(tuple, df.select("meta_category", "name", "avg_rating", "num_reviews").collect()))


def test_batches_add_up_and_repeated_ones_count_once(spark, reviews, tmp_path):
    path = str(tmp_path / "stats")
    assert rs.running_stats(spark, path).count() == 0
    for batch, expected in (("0", True), ("1", True), ("0", False), ("2", True), ("1", False)):
        assert rs.add_batch(reviews.where(F.col("n") == int(batch)), path, batch) == expected
    assert rows(rs.running_stats(spark, path)) == rows(product_stats(reviews))
    sentiments = {tuple(r) for r in rs.running_sentiment(spark, path).collect()}
    assert sentiments == {("Bike", "negative", 1), ("Office", "neutral", 1), ("Office", "positive", 2), ("Office", "negative", 1), ("", "positive", 1)}


def test_names_of_batches(spark, reviews, tmp_path):
    """Ids with any characters, of which none is taken for another."""
    path = str(tmp_path / "stats")
    names = ["2024-01-01T00:00", "a/b", "a%2Fb", "..", ".hidden", "é", "a b", "A", "{x}"]
    for name in names:
        assert rs.add_batch(reviews.limit(0), path, name)
        assert not rs.add_batch(reviews, path, name)
    assert len(commits.claimed(spark, f"{path}/_batches")) == len(names)
    assert rs.running_stats(spark, path).count() == 0


def test_writers_of_one_batch(spark, reviews, tmp_path):
    """One of several writers of the same batch counts, and other batches at the same time are not lost."""
    path = str(tmp_path / "stats")
    with ThreadPoolExecutor(4) as pool:
        done = list(pool.map(lambda i: rs.add_batch(reviews.where(F.col("n") == i % 3), path, str(i % 3)), range(6)))
    assert sum(done) == 3
    assert rows(rs.running_stats(spark, path)) == rows(product_stats(reviews))


def test_a_failed_batch_counts_nothing_and_can_be_sent_again(spark, reviews, tmp_path):
    path = str(tmp_path / "stats")
    broken = reviews.withColumn("name", F.raise_error(F.lit("no")).cast("string"))
    with pytest.raises(Exception, match="no"):
        rs.add_batch(broken, path, "x")
    assert rs.running_stats(spark, path).count() == 0
    assert rs.add_batch(reviews, path, "x")
    assert rows(rs.running_stats(spark, path)) == rows(product_stats(reviews))
