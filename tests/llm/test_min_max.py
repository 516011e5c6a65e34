"""Near copies against the similarity of all pairs, and the recall of the candidates."""

import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from starloom.llm import min_max as mm
from starloom.llm.queries import op12_min_max, oracle_sql
from tests.llm.test_simhash import LOW
from tests.oracle_check import duck


def plain_shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
    return {" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))} if words else set()


def plain_groups(texts):
    """The smallest index that each text is connected with, by all pairs of a similarity of 0.85 and more."""
    sets, met, label = [plain_shingles(t) for t in texts], defaultdict(list), list(range(len(texts)))
    for b, mine in enumerate(sets):
        common = Counter(a for s in mine for a in met[s])
        for s in mine:
            met[s].append(b)
        for a, n in common.items():
            if 100 * n >= 85 * (len(sets[a]) + len(mine) - n):
                old, new = max(label[a], label[b]), min(label[a], label[b])
                label = [new if x == old else x for x in label]
    return label


def edited(random, words, edits):
    words = list(words)
    for at in random.choice(len(words), edits, replace=False):
        words[at] = f"edit{random.integers(1 << 40)}"
    return " ".join(words)


@pytest.fixture(scope="module")
def copies():
    """Groups of 300-word texts with words changed, around the bound of similarity; chains; template texts."""
    random = np.random.default_rng(11)
    texts = []
    for _ in range(40):
        base = [f"w{x}" for x in random.integers(0, 5000, 300)]
        texts += [" ".join(base), *(edited(random, base, n) for n in (1, 3, 7, 8, 9, 10, 25))]
    words = [f"c{x}" for x in random.integers(0, 5000, 300)]
    for step in range(30):  # each text is a copy of the one before it only
        words[10 * step : 10 * step + 5] = [f"step{step}.{k}" for k in range(5)]
        texts.append(" ".join(words))
    template = [f"t{x}" for x in range(200)]
    texts += [" ".join(template + [f"own{i}.{k}" for k in range(25)]) for i in range(40)]  # 0.79 alike
    return texts + ["one two", "One  two", "one three", "one two three", "", None, " \n", "solo"]


def near(spark, rows):
    found = mm.near_copies(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert len(found) == len(rows)
    return found


@pytest.mark.parametrize("part,rows", [(2, 0), (2048, 200_000)])
def test_groups_are_those_of_all_pairs(spark, monkeypatch, copies, part, rows):
    monkeypatch.setattr(mm, "PART", part)
    monkeypatch.setattr(mm, "BROADCAST_ROWS", rows)
    found = near(spark, list(enumerate(copies)))
    assert {r.doc_id: r.component_id for r in found} == dict(enumerate(plain_groups(copies)))
    assert {r.doc_id: r.n_shingles for r in found} == {i: len(plain_shingles(t)) for i, t in enumerate(copies)}
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)


def test_cells_compare_what_is_not_connected(copies):
    copies = [t for t in copies if plain_shingles(t)]
    sets = mm.shingle_sets(pa.array(copies))
    groups = plain_groups(copies)
    assert mm.connected(sets, len(sets), np.arange(len(sets))).tolist() == groups
    assert mm.connected(sets, len(sets), np.array(groups)).tolist() == groups


def test_recall_of_the_keys():
    """Of 20,000 pairs of similarity 0.85, small sets among them, all share a key; of those at 0.3, few."""
    random = np.random.default_rng(3)

    def met(s, size):
        n = 0
        for _ in range(20):
            union, sets = random.integers(0, 2**64, (1000, size), dtype=np.uint64), []
            own = round(size * (1 - s) / 2)
            for row in union:
                sets += [row[own:], row[: size - own]]
            keys = mm.band_keys(sets)
            n += int((keys[0::2] == keys[1::2]).any(axis=1).sum())
        return n / 20_000

    assert met(0.85, 200) == met(0.85, 40) == 1
    assert met(0.3, 200) < 0.04


def test_values_are_unbiased_and_vary_less_than_minima():
    """The share of equal minima and maxima estimates the similarity."""
    random = np.random.default_rng(4)
    shares, low_shares = [], []
    for _ in range(400):
        union = random.integers(0, 2**64, 100, dtype=np.uint64)
        a, b = union[:80], union[20:]
        lows = [(a * f).min() == (b * f).min() for f in mm.FACTORS[:30]]
        highs = [(a * f).max() == (b * f).max() for f in mm.FACTORS[:30]]
        low_shares.append(np.mean(lows))
        shares.append(np.mean(lows + highs))
    assert abs(np.mean(shares) - 0.6) < 0.02
    assert np.var(shares) < 0.7 * np.var(low_shares)


def test_odd_rows(spark, odd, empty):
    rows = mm.near_copies(odd).collect()
    assert len(rows) == odd.count()
    by_id = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert by_id[1].component_id == by_id[2].component_id == 1 and not by_id[2].kept
    assert all(by_id[i].component_id == i and by_id[i].n_shingles == 0 and by_id[i].kept for i in (3, 4, 5))
    assert by_id[6].n_shingles == 1 and by_id[7].n_shingles == 2
    missing = {(r.component_id, r.n_shingles > 0, r.kept) for r in rows if r.doc_id is None}
    assert missing == {(1, True, False), (None, False, True)}
    assert mm.near_copies(empty).count() == 0


def test_rows_without_any_id(spark):
    found = near(spark, [(None, "a b c d e"), (None, "a b c d e")])
    assert [(r.component_id, r.kept) for r in found] == [(None, True)] * 2


def test_query_matches_its_sql(spark):
    folder = "/root/testdata/sf0.01"
    found = op12_min_max(spark, folder)
    cursor = duck(folder).execute(oracle_sql()["op12_min_max"])
    assert [c[0] for c in cursor.description] == found.columns
    rows = Counter(tuple(r) for r in found.collect())
    assert rows == Counter(cursor.fetchall()) and any(not r[3] for r in rows)
