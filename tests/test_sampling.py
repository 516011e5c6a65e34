import hashlib
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from starloom.operators import sampling


def digest(purpose, seed, key):
    return hashlib.md5(f"{purpose}|{seed}|{key}".encode()).hexdigest()


@pytest.fixture(scope="module")
def uneven(spark):
    """4,000 rows, of which one class has nearly all; some without a label."""
    label = (
        F.when(F.col("id") % 100 == 0, "rare")
        .when(F.col("id") % 10 == 1, "some")
        .when(F.col("id") % 10 == 2, None)
        .otherwise("most")
    )
    return spark.range(4000).select(F.col("id").alias("review_id"), label.alias("label")).cache()


def brute_force(rows, n, seed=42):
    classes = defaultdict(list)
    for row in rows:
        if row["label"] is not None:
            classes[row["label"]].append((digest("sample", seed, row["review_id"]), row["review_id"]))
    if n is None:
        n = min(map(len, classes.values()))
    return {key for found in classes.values() for _, key in sorted(found)[:n]}


def ids(df):
    found = [row["review_id"] for row in df.collect()]
    assert len(found) == len(set(found))
    return set(found)


@pytest.mark.parametrize("n", [None, 1, 40, 41, 1206, 5000])
@pytest.mark.parametrize("edge_rows", [1_000_000, 0])
def test_takes_the_smallest_hashes_of_each_class(uneven, n, edge_rows):
    sample = sampling.balance_classes(uneven, "label", n, edge_rows=edge_rows)
    assert sample.columns == uneven.columns
    assert ids(sample) == brute_force(uneven.collect(), n)


def test_sample_ignores_partitioning_and_follows_the_seed(uneven):
    first = ids(sampling.balance_classes(uneven, "label", 30, seed=1))
    again = ids(sampling.balance_classes(uneven.repartition(13, "label"), "label", 30, seed=1))
    other = ids(sampling.balance_classes(uneven, "label", 30, seed=2))
    assert first == again != other


def test_whole_rows_are_not_shuffled_for_the_sample(uneven):
    plan = sampling.balance_classes(uneven, "label", 30)._jdf.queryExecution().executedPlan()
    assert "BroadcastHashJoin" in plan.toString()
    assert "Exchange hashpartitioning" not in plan.toString()


def test_a_third_of_the_rows_under_one_id(spark):
    """Copies of one row, and the cut of the class falls among them."""
    single = spark.range(200).select(F.col("id").alias("review_id"), F.lit("x").alias("body"))
    copies = spark.range(100).select(F.lit(7).cast("long").alias("review_id"), F.lit("c").alias("body"))
    df = single.where("review_id <> 7").unionByName(copies).withColumn("label", F.lit("a"))
    place = sorted(digest("sample", 42, key) for key in range(200)).index(digest("sample", 42, 7))
    n = place + 60
    rows = [tuple(r) for r in sampling.balance_classes(df, "label", n).collect()]
    assert len(rows) == n
    counts = Counter(rows)
    assert counts.pop((7, "c", "a")) == 60
    assert set(counts.values()) == {1}
    all_rows = sampling.balance_classes(df, "label", 1000)
    assert all_rows.count() == 299


def test_rows_without_an_id_take_part(spark):
    df = spark.range(90).select(
        F.when(F.col("id") >= 30, F.col("id")).alias("review_id"), F.lit("a").alias("label")
    )
    for n in (0, 1, 25, 40, 70, 90, 100):
        sample = sampling.balance_classes(df, "label", n).collect()
        assert len(sample) == min(n, 90)
    train, test = sampling.train_test_split(df)
    assert train.count() + test.count() == 90


def test_rows_without_an_id_go_to_both_parts(spark):
    rows = spark.range(1000).select(F.lit(None).cast("long").alias("review_id"), F.col("id").alias("n"))
    train, test = sampling.train_test_split(rows)
    assert train.count() + test.count() == 1000
    assert 230 < test.count() < 370


def test_bad_arguments(spark, uneven):
    with pytest.raises(ValueError, match="negative"):
        sampling.balance_classes(uneven, "label", -1)
    with pytest.raises(ValueError, match="no row has a label"):
        sampling.balance_classes(uneven.where("label IS NULL"), "label")
    with pytest.raises(ValueError, match="test_size"):
        sampling.train_test_split(uneven, 1.5)


def test_more_classes_than_are_broadcast(uneven, monkeypatch):
    """Beyond the bound the same cuts are joined by a shuffle."""
    expected = ids(sampling.balance_classes(uneven, "label", 30))
    monkeypatch.setattr(sampling, "small_side", lambda df: (df, None))
    assert ids(sampling.balance_classes(uneven, "label", 30)) == expected


def test_split_parts_the_table(uneven):
    train, test = sampling.train_test_split(uneven, 0.3)
    assert ids(train) | ids(test) == set(range(4000))
    expected = {k for k in range(4000) if int(digest("split", 42, k)[:8], 16) < round(0.3 * 2**32)}
    assert ids(test) == expected
    assert 1100 < len(expected) < 1300
    assert sampling.train_test_split(uneven, 0.0)[1].isEmpty()
    assert sampling.train_test_split(uneven, 1.0)[0].isEmpty()


def test_split_of_a_sample_is_independent_of_the_sample(uneven):
    sample = sampling.balance_classes(uneven, "label", 1000)
    test = sampling.train_test_split(sample, 0.3)[1]
    share = test.where("label = 'most'").count() / sample.where("label = 'most'").count()
    assert 0.25 < share < 0.35


def test_concat_fills_missing_columns(spark):
    a, b = spark.createDataFrame([(1, "x")], "i int, t string"), spark.createDataFrame([(2,)], "i int")
    assert sorted(map(tuple, sampling.concat(a, b).collect())) == [(1, "x"), (2, None)]


def scanned(df):
    return re.findall(r"ReadSchema: struct<([^>]*)>", df._jdf.queryExecution().executedPlan().toString())


def test_counting_passes_read_label_and_id_only(spark, tmp_path):
    """Rows without an id are the only ones read whole, and the split reads what is asked of it."""
    rows = spark.range(200).selectExpr("id AS review_id", "concat('class ', id % 3) AS label", "repeat('x', 50) AS text")
    missing = rows.where("review_id % 50 = 0").selectExpr("CAST(null AS long) AS review_id", "label", "concat(text, review_id) AS text")
    for table, all_have_ids in ((rows, True), (rows.unionByName(missing), False)):
        path = str(tmp_path / f"rows-{all_have_ids}")
        table.write.parquet(path)
        held = spark.read.parquet(path)
        assert sampling.has_missing(held, "review_id") != all_have_ids
        schemas = scanned(sampling._keyed(held, "label", 42, "review_id", not all_have_ids).drop("_hash"))
        narrow, wide = "review_id:bigint,label:string", "review_id:bigint,label:string,text:string"
        assert schemas == [narrow] if all_have_ids else sorted(schemas) == [narrow, wide]
        sample = sampling.balance_classes(held, "label", 40)
        assert sorted(r["count"] for r in sample.groupBy("label").count().collect()) == [40, 40, 40]
        train, test = sampling.train_test_split(held)
        assert train.count() + test.count() == held.count() and test.count() > 0
        assert scanned(train.select("label")) == [narrow if all_have_ids else wide]
