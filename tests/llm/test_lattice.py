import math
import re
import zlib
from collections import Counter
from itertools import product

import numpy as np
import public_tokenizers
from hypothesis import given, settings, strategies as st

from starloom.llm import lattice
from starloom.llm.queries import op3_subword_lattice
from starloom.llm.words import fold, table

MODEL = public_tokenizers.path("piece_bpe_32k.model")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def every_segmentation(spelled, scores):
    """Sum over all ways to cut, one by one."""
    total = 0.0
    for cuts in product([False, True], repeat=len(spelled) - 1):
        edges = [0, *(i + 1 for i, c in enumerate(cuts) if c), len(spelled)]
        parts = [spelled[a:b] for a, b in zip(edges, edges[1:], strict=False)]
        if all(p in scores for p in parts):
            total += 10 ** sum(scores[p] for p in parts)
    return math.log10(total) if total else -math.inf


@settings(deadline=None, max_examples=60)
@given(
    st.dictionaries(st.text("ab", min_size=1, max_size=3), st.floats(-5, -0.1), max_size=8),
    st.lists(st.text("abc", max_size=7), min_size=1, max_size=5),
)
def test_all_segmentations_are_summed(pieces, words):
    scores = {p.encode(): s for p, s in pieces.items()} | {lattice.MARK.encode(): -1.0, (lattice.MARK + "a").encode(): -0.7}
    found = lattice.log10_words(words, lattice.vocabulary(scores))
    for word, value in zip(words, found, strict=True):
        expected = every_segmentation((lattice.MARK + word).encode(), scores)
        assert value == expected or abs(value - expected) < 1e-9


def test_long_words_stay_finite():
    scores = {bytes([b]): -2.0 for b in range(256)}
    found = lattice.log10_words(["a" * 5000, "é"], lattice.vocabulary(scores))
    assert np.allclose(found, [-2.0 * 5003, -2.0 * 5])


def test_every_byte_has_a_piece():
    spelled = lattice.piece_bytes(MODEL)
    assert {bytes([b]) for b in range(256)} <= set(spelled)
    assert spelled.count(b"") == 3


def expected_rows(texts):
    """n_tokens, n_known, N and base score of (doc_id, text, train) rows."""
    words = [re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOW)) for _, t, _ in texts]
    c = Counter(w for ws, (_, _, train) in zip(words, texts, strict=True) if train for w in ws)
    ends = sum(bool(train) for *_, train in texts)
    n, v = sum(c.values()) + ends, len(c) + bool(ends)
    score = lambda k: math.log10((k + 0.5) / (n + 0.5 * (v + 1)))
    return Counter(
        (i, len(ws) + 1, sum(c[w] > 0 for w in ws) + bool(ends), n, round(sum(score(c[w]) for w in ws) + score(ends), 4))
        for ws, (i, _, _) in zip(words, texts, strict=True)
    )


def found_rows(rows):
    return Counter((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in rows)


def test_query_on_the_test_tables(spark, small):
    rows = op3_subword_lattice(spark, small).collect()
    docs = [
        (r.doc_id, r.text, zlib.crc32(str(r.doc_id).encode()) % 5 != 1)
        for r in table(spark, small, "documents").select("doc_id", "text").collect()
    ]
    assert found_rows(rows) == expected_rows(docs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 1) for r in rows)
    assert all(r.score < 0 for r in rows)


def test_score_is_the_sum_over_words(spark, small, documents):
    docs = documents.withColumn("train", fold() != 1)
    scored = {r.doc_id: r.score for r in lattice.score(docs, MODEL).collect()}
    rows = docs.collect()
    counts = Counter(w for r in rows if r.train for w in re.findall(r"[^\x20\x09-\x0D]+", r.text.translate(LOW)))
    known = spark.createDataFrame(list(counts.items()), "word string, c long")
    scores = lattice.segmented_scores(known, MODEL, sum(r.train for r in rows))
    end = scores.pop(b"")
    pieces = lattice.vocabulary(scores)
    for row in rows[:20]:
        words = re.findall(r"[^\x20\x09-\x0D]+", row.text.translate(LOW))
        assert abs(lattice.log10_words(words, pieces).sum() + end - scored[row.doc_id]) < 1e-6
    # Chances of all pieces and the end make one.
    assert abs(sum(10**s for s in scores.values()) + 10**end - 1) < 1e-3


def test_blocks_do_not_change_the_result(spark, odd, monkeypatch):
    docs = odd.withColumn("train", fold() != 1)
    whole = lattice.score(docs, MODEL).collect()
    monkeypatch.setattr(lattice.word_blocks, "__defaults__", (100,))
    cut = lattice.score(docs, MODEL).collect()
    texts = [(r.doc_id, r.text, r.train) for r in docs.select("doc_id", "text", "train").collect()]
    assert found_rows(whole) == found_rows(cut) == expected_rows(texts)
    key = lambda rows: sorted((r.n_tokens, round(r.score, 6)) for r in rows)
    assert key(whole) == key(cut)


def test_empty_tables(spark, empty, odd):
    assert lattice.score(empty.withColumn("train", fold() != 1), MODEL).count() == 0
    untrained = odd.withColumn("train", fold() > 9)
    rows = lattice.score(untrained, MODEL).collect()
    assert len(rows) == odd.count() and all(r.n_known == 0 and np.isfinite(r.score) for r in rows)


def test_tasks_follow_the_number_of_blocks(spark, documents, monkeypatch):
    docs = documents.select("doc_id", "text", (fold() != 1).alias("train")).repartition(8, "doc_id")
    expected = lattice.score(docs, MODEL)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    monkeypatch.setattr(lattice, "TASK_BLOCKS", 1)
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "2")
        found = lattice.score(docs, MODEL)
        plan = found._jdf.queryExecution().executedPlan().toString()
        rows = found.collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    # Texts and words meet in the shuffles that were asked for, and in no others.
    met = re.findall(r"hashpartitioning\((?:of_)?block#\w+, (\d+)\), (\w+)", plan)
    assert met == [("8", "REPARTITION_BY_NUM")] * 2
    key = lambda r: (r.doc_id, r.n_tokens)
    for one, other in zip(sorted(rows, key=key), sorted(expected.collect(), key=key), strict=True):
        assert one[:5] == other[:5] and np.allclose(one[5:], other[5:], rtol=1e-9)
