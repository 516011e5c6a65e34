"""Vector codes against plain Python, and the trie against all distances."""

import hashlib
import math

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from starloom.llm import part_trie as pt
from starloom.llm.queries import op11_part_trie, oracle_sql
from tests.oracle_check import duck


def plain(rows, n_parts, n_entries, rounds):
    """Codes, errors and codebooks of (vec_id, label, components), one part and entry at a time."""
    kept = [(i, label, [math.floor(1024 * x) for x in v]) for i, label, v in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    width = len(kept[0][2]) // n_parts
    parts = [[v[p * width : (p + 1) * width] for p in range(n_parts)] for _, _, v in kept]
    books = [[parts[i][p] for i in range(min(n_entries, len(kept)))] for p in range(n_parts)]

    def assign():
        found = []
        for own in parts:
            row = []
            for p in range(n_parts):
                far = [sum((a - b) ** 2 for a, b in zip(own[p], c, strict=True)) for c in books[p]]
                row.append((min(far), far.index(min(far))))
            found.append(row)
        return found

    for _ in range(rounds):
        found = assign()
        for p in range(n_parts):
            for k in range(len(books[p])):
                mine = [parts[i][p] for i, row in enumerate(found) if row[p][1] == k]
                if mine:
                    books[p][k] = [sum(column) // len(mine) for column in zip(*mine, strict=True)]
    found = assign()
    errors = [sum(far for far, _ in row) for row in found]
    by_label = {}
    for (_, label, _), e in zip(kept, errors, strict=True):
        by_label[label] = by_label.get(label, 0) + e
    sha = hashlib.sha256(",".join(str(x) for b in books for c in b for x in c).encode()).hexdigest()
    return [
        (i, label, "".join(f"{k:02x}" for _, k in row), e, by_label[label], sha)
        for (i, label, _), row, e in zip(kept, found, errors, strict=True)
    ]


def same(found, rows, *shape):
    key = lambda r: (r[0] is None, r[0] or 0, r[2])
    assert sorted(map(tuple, found.collect()), key=key) == sorted(plain(rows, *shape), key=key)


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>").repartition(3)


@pytest.mark.parametrize("shared", [2, 32])
def test_codes_are_those_of_plain_python(spark, monkeypatch, shared):
    """Parts with common leading dimensions, copies, negative components and labels without a value."""
    monkeypatch.setattr(pt, "SHARED", shared)
    random = np.random.default_rng(5)
    values = random.integers(-3, 4, (300, 12)) / 512 + random.integers(0, 2, (300, 12)) / 2048
    rows = [(i, None if i % 7 == 0 else i % 4, v.tolist()) for i, v in enumerate(values)]
    rows += [(1000 + i, 1, rows[5][2]) for i in range(100)] + [(5, 2, rows[6][2]), (None, 3, rows[9][2])]
    same(pt.compressed(vectors(spark, rows), 4, 16, 4), rows, 4, 16, 4)


def test_dropped_and_odd_vectors(spark):
    good = [0.5, -0.25, 0.125, 1.0]
    rows = [(1, 1, good), (2, None, [x + 1 for x in good]), (2, None, [x + 1 for x in good]), (None, 4, good)]
    bad = [(3, 1, None), (4, 1, []), (5, 1, [None, 1.0, 1.0, 1.0]), (6, 1, [float("nan")] * 4), (7, 1, [1.0, float("inf"), 0.0, 0.0])]
    table = vectors(spark, rows + bad)
    for name in ("position", "part", "codes", "error", "of", "lead"):
        table = table.selectExpr("*", f"'x' AS {name}")
    same(pt.compressed(table), rows, 4, 256, 4)
    with pytest.raises(ValueError, match="equal parts"):
        pt.compressed(vectors(spark, [(1, 1, good), (2, 1, good * 2)]))
    with pytest.raises(ValueError, match="equal parts"):
        pt.compressed(vectors(spark, [(1, 1, good + good[:1])]))


def test_no_vectors(spark):
    for rows in ([], [(1, 1, None)]):
        found = pt.compressed(vectors(spark, rows))
        assert found.count() == 0 and found.columns[2] == "code"


def test_many_labels_and_large_components(spark, monkeypatch):
    monkeypatch.setattr(pt, "BROADCAST_LABELS", 2)
    random = np.random.default_rng(1)
    rows = [(i, i % 9 or None, (random.normal(0, 1, 8) * 1e5).astype(np.float32).tolist()) for i in range(60)]
    same(pt.compressed(vectors(spark, rows), 4, 8, 2), rows, 4, 8, 2)


@settings(deadline=None, max_examples=200)
@given(st.data())
def test_trie_finds_the_nearest_entry(data):
    width, n = data.draw(st.integers(1, 5)), data.draw(st.integers(1, 120))
    top = data.draw(st.sampled_from([1, 3, 1 << 24]))
    random = np.random.default_rng(data.draw(st.integers(0, 1000)))
    rows = np.unique(random.integers(-top, top + 1, (n, width)), axis=0)
    entries = random.integers(-top, top + 1, (data.draw(st.integers(1, 9)), width))
    best, error = pt.nearest(rows, entries)
    far = ((rows[:, None].astype(object) - entries[None].astype(object)) ** 2).sum(axis=2)
    assert error.tolist() == far.min(axis=1).tolist()
    assert best.tolist() == [row.tolist().index(min(row)) for row in far]


def test_order_of_packed_parts():
    rows = np.array([[1, -5], [0, 9], [-1, 3], [1, -5], [-(1 << 30), 0], [1 << 30, 0]])
    found, place, copies = pt.distinct_parts(rows)
    assert pt.unpacked(found, 2).tolist() == [[-(1 << 30), 0], [-1, 3], [0, 9], [1, -5], [1 << 30, 0]]
    assert place.tolist() == [3, 2, 1, 3, 0, 4] and copies.tolist() == [1, 1, 1, 2, 1]


def test_query_matches_its_sql(spark):
    folder = "/root/testdata/sf0.01"
    found = op11_part_trie(spark, folder)
    cursor = duck(folder).execute(oracle_sql()["op11_part_trie"])
    columns = [c[0] for c in cursor.description]
    assert sorted(columns) == sorted(found.columns)
    assert sorted(map(tuple, found.select(*columns).collect())) == sorted(cursor.fetchall())
