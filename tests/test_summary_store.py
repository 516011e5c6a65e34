"""Several writers of one summary store."""

import os
from concurrent.futures import ThreadPoolExecutor

import pytest

from starloom.sources import summaries


def table(spark, **texts):
    return spark.createDataFrame(list(texts.items()), summaries.SCHEMA)


def stored(spark, path):
    rows = [tuple(r) for r in summaries.load_summaries(spark, path).collect()]
    assert len(rows) == len(dict(rows))
    return dict(rows)


@pytest.fixture
def store(spark, tmp_path):
    path = str(tmp_path / "store")
    summaries.save_summaries(table(spark, a="1", b="2"), path)
    return path


def between(monkeypatch, *writes):
    """Runs ``writes`` after a writer has written its rows and before it commits them."""
    left, commit = list(writes), summaries._commit

    def late(*arguments):
        if left:
            left.pop(0)()
        return commit(*arguments)

    monkeypatch.setattr(summaries, "_commit", late)


def test_interleaved_upserts_lose_and_double_no_key(spark, store, monkeypatch):
    between(monkeypatch, lambda: summaries.upsert_summaries(table(spark, b="other", c="3"), store))
    summaries.upsert_summaries(table(spark, a="mine", d="4"), store)
    assert stored(spark, store) == {"a": "mine", "b": "other", "c": "3", "d": "4"}


def test_same_key_is_the_last_commit(spark, store, monkeypatch):
    between(monkeypatch, lambda: summaries.upsert_summaries(table(spark, a="first"), store))
    summaries.upsert_summaries(table(spark, a="last"), store)
    assert stored(spark, store) == {"a": "last", "b": "2"}


def test_replacing_after_an_upsert_between(spark, store, monkeypatch):
    between(monkeypatch, lambda: summaries.upsert_summaries(table(spark, c="3"), store))
    summaries.save_summaries(table(spark, z="only"), store)
    assert stored(spark, store) == {"z": "only"}


def test_base_that_is_gone(spark, store, monkeypatch):
    """Others commit so often before the rows are written that the version they come from is dropped."""
    merge = summaries.merged
    left = [1]

    def late(old, new):
        if left:
            left.pop()
            for i in range(4):
                summaries.upsert_summaries(table(spark, **{f"k{i}": "x"}), store)
        return merge(old, new)

    monkeypatch.setattr(summaries, "merged", late)
    summaries.upsert_summaries(table(spark, mine="y"), store)
    assert stored(spark, store) == {"a": "1", "b": "2", "k0": "x", "k1": "x", "k2": "x", "k3": "x", "mine": "y"}


def test_writers_at_once(spark, store):
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda i: summaries.upsert_summaries(table(spark, **{f"k{i}": str(i)}), store), range(8)))
    assert stored(spark, store) == {"a": "1", "b": "2"} | {f"k{i}": str(i) for i in range(8)}
    # Two versions stay, and nothing of the attempts that were too late.
    assert len([n for n in os.listdir(store) if n.startswith("version=")]) <= 2
    assert len([n for n in os.listdir(f"{store}/_commits") if n.isdigit()]) == 2


def test_a_failure_commits_nothing(spark, store):
    broken = spark.range(1).selectExpr("'a' AS category_key", "CAST(raise_error('no') AS string) AS summary")
    with pytest.raises(Exception, match="no"):
        summaries.upsert_summaries(broken, store)
    assert stored(spark, store) == {"a": "1", "b": "2"}


def test_too_many_others(spark, store, monkeypatch):
    monkeypatch.setattr(summaries, "ATTEMPTS", 2)
    monkeypatch.setattr(summaries, "_commit", lambda *_: False)
    with pytest.raises(RuntimeError, match="committed first"):
        summaries.upsert_summaries(table(spark, a="x"), store)
