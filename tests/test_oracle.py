"""Every registered query against its SQL in DuckDB, on the smallest tables."""

import os
import re

import pytest

import __spark_entry__ as spark_entry
from tests.oracle_check import differences, duck

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")

# Queries of the llm subpackage have their own tests.
QUERIES = [name for name in spark_entry.queries() if not re.match(r"op\d+_|pipeline$", name)]

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables not there")


@pytest.fixture(scope="module")
def connection():
    return duck(FOLDER)


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_its_sql(spark, connection, name):
    assert differences(spark, connection, FOLDER, name) == []


def test_only_models_go_without_sql():
    assert set(QUERIES) - set(spark_entry.oracle_sql()) == {
        "train_report",
        "reloaded_model_predictions",
        "kmeans_sweep",
        "kmeans_sizes",
        "truncate_model_tokens",
    }


def test_entry_runs(spark):
    assert spark_entry.entry(spark).count() > 0
