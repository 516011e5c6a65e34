import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from xxhash import xxh64_intdigest

from starloom.llm import simhash as sh
from starloom.llm.components import components
from starloom.llm.queries import op8_pigeonring
from starloom.llm.words import table

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_fingerprint(text, shingle=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(fps):
    """(fp -> smallest fp reachable) by all pairs."""
    fps = sorted(set(fps))
    label = {f: f for f in fps}
    changed = True
    while changed:
        changed = False
        for a in fps:
            for b in fps:
                if (a ^ b).bit_count() <= 4 and label[a] != label[b]:
                    label[a] = label[b] = min(label[a], label[b])
                    changed = True
    return label


@settings(deadline=None, max_examples=100)
@given(st.lists(st.one_of(st.none(), st.text(st.sampled_from("aB c\n\té"), max_size=40)), min_size=1, max_size=4))
def test_fingerprints_by_hand(texts):
    found = sh.text_fingerprints(pa.array(texts, pa.string()))
    assert found.tolist() == [plain_fingerprint(t) for t in texts]


@settings(deadline=None, max_examples=300)
@given(st.integers(0, 2**64 - 1), st.lists(st.integers(0, 63), max_size=6, unique=True))
def test_pairs_within_the_distance_meet_and_hold_the_chain(fp, flipped):
    other = fp
    for bit in flipped:
        other ^= 1 << bit
    def entries(value):
        batch = pa.RecordBatch.from_pydict({"fp": np.array([value], np.uint64).view(np.int64)})
        return [(k, o) for b in sh._entries(iter([batch])) for k, o in zip(b.column("key").to_pylist(), b.column("own").to_pylist(), strict=True)]

    shared = [k for k, own in entries(fp) if own and k in {k2 for k2, _ in entries(other)}]
    good = bool(shared) and sh.within(
        np.array([fp] * len(shared), np.uint64), np.array([other] * len(shared), np.uint64), np.array(shared)
    ).any()
    assert good == (len(flipped) <= 4)


def signed(values):
    return np.array(values, np.uint64).view(np.int64).tolist()


@pytest.mark.parametrize("cell", [2, 4096])
def test_links_connect_what_all_pairs_connect(spark, monkeypatch, cell):
    """A dense ball, chains of four-bit steps, and fingerprints of their own; in cells of two as well."""
    monkeypatch.setattr(sh, "CELL", cell)
    monkeypatch.setattr(sh, "PAIRS_AT_ONCE", 50)
    random = np.random.default_rng(8)
    fps = {0, 2**64 - 1}
    centre = int(random.integers(0, 2**63))
    for _ in range(60):
        flips = random.choice(64, random.integers(0, 4), replace=False)
        fps.add(centre ^ sum(1 << int(b) for b in flips))
    step = int(random.integers(0, 2**63))
    for _ in range(10):
        step ^= sum(1 << int(b) for b in random.choice(64, 4, replace=False))
        fps.add(step)
    fps |= {int(random.integers(0, 2**63)) for _ in range(30)}
    rows = spark.createDataFrame([(f,) for f in signed(sorted(fps))], "fp long")
    found = sh.links(rows).collect()
    assert len(found) < 80 * len(fps)
    as_unsigned = lambda v: v % 2**64
    label = {f: f for f in fps}
    pairs = [(as_unsigned(r.a), as_unsigned(r.b)) for r in found]
    for _ in range(len(fps)):
        for a, b in pairs:
            label[a] = label[b] = min(label[a], label[b])
    assert label == plain_components(fps)


def test_components_of_paths_rings_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 140)] + [(7, 3), (3, 5), (5, 7)] + [(1000, 1000 + i) for i in range(1, 50)]
    edges += [(1, 1), (7, 3)]
    rows = components(spark.createDataFrame(edges, "a long, b long")).collect()
    labels = {r.node: r.label for r in rows}
    assert len(rows) == len(labels)
    expected = {i: 100 for i in range(100, 141)} | {3: 3, 5: 3, 7: 3} | {1000 + i: 1000 for i in range(50)}
    assert labels == expected


def test_no_edges(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_odd_rows(odd):
    rows = sh.near_duplicates(odd).collect()
    assert len(rows) == odd.count()
    by_id = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert by_id[1].component_id == by_id[2].component_id == 1
    assert by_id[3].component_id == by_id[4].component_id == by_id[5].component_id == 3
    assert by_id[3].fp == 0
    assert {r.component_id for r in rows if r.doc_id is None} == {1, 3}


def test_rows_without_any_id(spark):
    rows = spark.createDataFrame([(None, "a b c d e"), (None, "a b c d e")], "doc_id long, text string")
    assert [r.component_id for r in sh.near_duplicates(rows).collect()] == [None, None]


def test_empty_table(empty):
    assert sh.near_duplicates(empty).count() == 0


def test_query_on_the_test_tables(spark):
    sf = "/root/testdata/sf0.01"
    texts = dict(table(spark, sf, "documents").select("doc_id", "text").collect())
    fps = {i: plain_fingerprint(t) for i, t in texts.items()}
    label = plain_components(fps.values())
    smallest = {}
    for i in sorted(fps):
        smallest.setdefault(label[fps[i]], i)
    rows = op8_pigeonring(spark, sf).collect()
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in rows} == {
        (i, f"{fp:016x}", smallest[label[fp]]) for i, fp in fps.items()
    }
