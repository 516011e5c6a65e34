import re
from collections import Counter

import numpy as np
import pyarrow as pa
from hypothesis import given, settings, strategies as st

from starloom.llm import rule_forest as rf
from starloom.llm.queries import op7_rule_forest
from starloom.llm.words import table


def plain_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in range(i, i + 3)}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
    }


@settings(deadline=None, max_examples=150)
@given(st.lists(st.one_of(st.none(), st.text(st.sampled_from("ab é#|\n \t"), max_size=40)), min_size=1, max_size=5))
def test_counts_by_hand(texts):
    found = rf.text_counts(pa.array(texts, pa.string()))
    for i, text in enumerate(texts):
        assert {k: int(found[k][i]) for k in plain_counts(text)} == plain_counts(text)


def test_many_kinds_of_words_take_the_other_way():
    codes = np.array([0, 1, 2, 0, 1, 2, 5])
    owner = np.zeros(7, int)
    assert rf._repeated(codes, owner, 1 << 22).tolist() == rf._repeated(codes, owner, 6).tolist() == [1] * 6 + [0]


def test_forest_sets_far_rows_apart():
    random = np.random.default_rng(1)
    rows = np.concatenate([random.normal(0, 1, (500, 3)), [[9, 9, 9]]])
    scores = rf.Forest(rows).scores(rows)
    assert scores.argmax() == 500
    assert (scores > 0).all() and (scores < 1).all()
    # Path lengths agree with a walk down each tree.
    walked = 0
    forest = rf.Forest(rows)
    for feature, cut, left, depth in forest.trees:
        node = 0
        while feature[node] >= 0:
            node = left[node] + int(rows[7, feature[node]] >= cut[node])
        walked += depth[node]
    expected = 2 ** (-walked / len(forest.trees) / float(rf._expected(forest.size)))
    assert abs(forest.scores(rows[7:8])[0] - expected) < 1e-12


def test_equal_rows_are_one_leaf():
    scores = rf.Forest(np.ones((300, 2))).scores(np.ones((2, 2)))
    assert scores[0] == scores[1]


def test_threshold_loses_few_good_rows():
    histogram = [(1000, 990, 0), (1500, 9, 40), (1800, 1, 50)]
    assert rf.calibrated(histogram, 0.002) == 1800 / rf.BINS
    assert rf.calibrated(histogram, 0.02) == 1500 / rf.BINS
    assert rf.calibrated([], 0.1) == 2.0


def test_odd_rows(spark, odd, label_rows):
    judged = rf.judge(rf.rule_statistics(odd), label_rows).collect()
    assert len(judged) == odd.count()
    assert all(not row.kept for row in judged if row.n_words < 50)


def test_empty_tables(spark, empty, odd, label_rows):
    assert rf.judge(rf.rule_statistics(empty), label_rows).count() == 0
    judged = rf.judge(rf.rule_statistics(odd), label_rows.limit(0)).collect()
    assert all(row.kept != row.base_failed for row in judged)


def test_query_on_the_test_tables(spark, small):
    texts = dict(table(spark, small, "documents").select("doc_id", "text").collect())
    quality = {r.doc_id: r.quality for r in table(spark, small, "labels").collect()}
    rows = op7_rule_forest(spark, small).collect()
    assert len(rows) == len(texts)
    for row in rows:
        expected = plain_counts(texts[row.doc_id])
        assert {k: row[k] for k in expected} == expected
        failed = row.n_words < 50 or 100 * row.n_repeat_words > 50 * row.n_words
        assert row.base_failed == failed
        assert not (failed and row.kept)
    good = [row.kept for row in rows if quality.get(row.doc_id) == 1 and not row.base_failed]
    assert np.mean(good) > 0.95


def test_statistics_are_taken_in_small_steps(monkeypatch):
    """Steps of 8 MB took much of an executor's memory; counts do not depend on the steps."""
    texts = [f"word{i} again and again, {i}! " * 5_000 for i in range(30)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(30), pa.int64()), pa.array(texts)], ["doc_id", "text"])
    steps, whole = [], rf.text_counts(pa.array(texts))
    count = rf.text_counts
    monkeypatch.setattr(rf, "text_counts", lambda part: steps.append(part.nbytes) or count(part))
    found = pa.Table.from_batches(rf._statistics(iter([batch])))
    assert len(steps) > 3 and max(steps) < 1.1 * (1 << 20)
    assert all(found.column(c).to_pylist() == whole[c].tolist() for c in rf.COUNTS)
