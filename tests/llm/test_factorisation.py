import zlib

import numpy as np
import pyarrow as pa

from starloom.llm import factorisation as fm, rule_forest
from starloom.llm.queries import op10_factorisation_machine
from starloom.llm.words import fold, table


def rows_of(texts):
    batch = pa.RecordBatch.from_pydict({"text": pa.array(texts, pa.string()), "n_chars": pa.array([1] * len(texts))})
    return fm.featurise(batch, ["n_chars"])


def test_margin_is_the_sum_over_pairs():
    rows = rows_of(["a b c b", None, "", "x y"])
    random = np.random.default_rng(3)
    width = rows.dense.shape[1]
    size = fm.BUCKETS + width
    model = fm.Model(0.3, random.normal(size=size), random.normal(size=(size, 4)), np.zeros(width), np.ones(width))
    rows = fm.with_statistics(rows, model.centre, model.scale)
    for i, found in enumerate(fm.margins(model, rows)):
        part = slice(rows.starts[i], rows.starts[i + 1])
        index, value = rows.index[part], rows.value[part]
        expected = model.bias + model.weights[index] @ value
        for a in range(len(index)):
            for b in range(a):
                expected += model.factors[index[a]] @ model.factors[index[b]] * value[a] * value[b]
        assert abs(found - expected) < 1e-9


def test_hashed_words_have_unit_length():
    rows = rows_of(["One one TWO"])
    assert abs((rows.value**2).sum() - 1) < 1e-12
    assert set(rows.index.tolist()) == {zlib.crc32(w) % fm.BUCKETS for w in (b"one", b"two")}


def test_pairs_are_learned():
    """Neither word tells alone; the two together do."""
    texts = ["aa bb", "cc dd", "aa dd", "cc bb"] * 100
    labels = np.array([1, 1, 0, 0] * 100)
    rows = rows_of(texts)
    model = fm.fit(rows, labels, seed=2)
    odds = fm.margins(model, fm.with_statistics(rows, model.centre, model.scale))
    assert ((odds > 0) == (labels == 1)).all()


def test_one_class_gives_its_share():
    model = fm.fit(rows_of(["a", "b", "c"]), np.array([1, 1, 1]))
    batch = pa.RecordBatch.from_pydict({"text": ["q", None], "n_chars": pa.array([None, None], pa.int64())})
    assert np.allclose(fm.scores(model, batch, ["n_chars"]), 4 / 5)


def test_odd_rows(spark, odd, label_rows):
    labelled = rule_forest.clean_labels(label_rows)
    assert {tuple(r) for r in labelled.collect()} == {(1, 0), (2, 1), (3, 0), (6, 0), (99, 1)}
    model = fm.train(odd, labelled, ["n_chars"])
    scored = fm.score(odd, model, ["n_chars"]).collect()
    assert len(scored) == odd.count()
    assert all(0 <= r.score <= 1 for r in scored)
    kept = fm.accepted(odd, model, ["n_chars"], 0.0)
    assert kept.schema == odd.schema and kept.count() == odd.count()


def test_empty_tables(spark, empty, odd, label_rows):
    model = fm.train(empty, rule_forest.clean_labels(label_rows), ["n_chars"])
    assert fm.score(empty, model, ["n_chars"]).count() == 0
    assert fm.score(odd, model, ["n_chars"]).count() == odd.count()


def test_the_row_bound_holds(spark, documents, small):
    labelled = rule_forest.clean_labels(table(spark, small, "labels"))
    one, two = (fm.train(documents, labelled, [], max_rows=30) for _ in range(2))
    assert one.bias == two.bias and np.array_equal(one.factors, two.factors)


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    quality = {r.doc_id: r.quality for r in table(spark, sf, "labels").collect()}
    rows = op10_factorisation_machine(spark, sf).collect()
    assert len(rows) == table(spark, sf, "documents").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(r.predicted == (r.score >= 0.3) for r in rows)
    right = [r.predicted == quality[r.doc_id] for r in rows if r.held_out and r.doc_id in quality]
    assert np.mean(right) > 0.93
    assert all(r.predicted for r in rows if r.held_out and quality.get(r.doc_id) == 1)


def test_labels_of_held_out_rows_are_not_read(spark, documents, small):
    labels = rule_forest.clean_labels(table(spark, small, "labels"))
    flipped = labels.withColumn("label", 1 - labels.label).where(fold() == 0).unionByName(labels.where(fold() != 0))
    one, two = (fm.train(documents, rows.where(fold() != 0), []) for rows in (labels, flipped))
    assert np.array_equal(one.weights, two.weights)
