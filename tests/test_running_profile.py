"""Profiles by batches against those of the whole table."""

import pytest
from pyspark.sql import functions as F

from starloom.operators.profile import distinct_counts, table_profile
from starloom.sources import running_profile as rp


@pytest.fixture(scope="module")
def table(spark):
    return spark.range(30_000).select(
        (F.col("id") % 3).alias("n"), F.col("id").cast("string").alias("a.b"), F.when(F.col("id") % 4 > 0, F.col("id") % 17).alias("few"),
        F.lit(None).cast("string").alias("none"), (F.col("id") % 7000 / 3).alias("many"),
    )


def test_batches_merge_and_repeated_ones_count_once(spark, table, tmp_path):
    path = str(tmp_path / "profile")
    assert rp.running_profile(spark, path).count() == 0
    for batch, expected in (("0", True), ("1", True), ("0", False), ("2", True)):
        assert rp.add_profile(table.where(F.col("n") == int(batch)), path, batch) == expected
    found = {r["column"]: r for r in rp.running_profile(spark, path).collect()}
    whole = {r["column"]: (r["rows"], r["nulls"]) for r in table_profile(table).collect()}
    assert {c: (r["rows"], r["nulls"]) for c, r in found.items()} == whole
    for row in distinct_counts(table, *table.columns).collect():
        estimate = found[row["column"]]["distinct_estimate"]
        assert abs(estimate - row["n_distinct"]) <= 0.08 * row["n_distinct"]


def test_batches_without_rows_or_columns(spark, table, tmp_path):
    path = str(tmp_path / "profile")
    assert rp.add_profile(table.limit(0), path, "empty")
    assert rp.add_profile(table.limit(10), path, "one column", ["few"])
    found = {r["column"]: (r["rows"], r["distinct_estimate"]) for r in rp.running_profile(spark, path).collect()}
    assert found["few"][0] == 10 and found["a.b"] == (0, 0) and found["none"] == (0, 0)
