import hashlib
import re
from collections import Counter

import pytest

from starloom.llm import phrase_index as px
from starloom.llm.queries import op9_positional_index, oracle_sql
from tests.oracle_check import duck

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOW))


def plain(text, items, window):
    """Hit words and found items of one document, window by window."""
    said, hit, found = words(text), set(), set()
    for item_id, item in items:
        asked = words(item)
        size = min(window, len(asked))
        for s in range(len(asked) - size + 1) if asked else ():
            for at in range(len(said) - size + 1):
                if said[at : at + size] == asked[s : s + size]:
                    hit.update(range(at, at + size))
                    found |= {item_id} if item_id is not None else set()
    return len(said), len(hit), sorted(map(str, found)), len(hit) > 0 and 20 * len(hit) >= len(said)


DOCS = [
    (1, "One two three four five six seven."),
    (2, "two three-FOUR 'five' x one two three four"),
    (3, "a a a a a b"),
    (4, None),
    (5, ""),
    (6, "filler " * 200 + "one two three four"),
    (7, "É é one TWO three é"),
    (7, "É é one TWO three é"),
    (8, "five four three two one"),
    (None, "one two three four"),
    (9, "solo"),
    (10, "four three two one zero"),
]
ITEMS = [
    (10, "one two three four five"),
    (10, "one two three four five"),
    (9, "a a a"),
    (2, "é one two three"),
    (3, "solo"),
    (4, None),
    (5, "... !"),
    (None, "two three four"),
    (11, "never said before now"),
    (12, "a b a a"),
]


@pytest.fixture(scope="module")
def tables(spark):
    docs = spark.createDataFrame([(*d, "clash") for d in DOCS], "doc_id long, text string, key string").repartition(3)
    return docs, spark.createDataFrame([(*i, "clash") for i in ITEMS], "item_id long, text string, words string")


@pytest.mark.parametrize("window", [2, 3, 4])
@pytest.mark.parametrize("bound", [0, 200_000])
def test_contamination_by_hand(tables, monkeypatch, window, bound):
    monkeypatch.setattr(px, "BROADCAST_TERMS", bound)
    found = px.contamination(*tables, window=window).collect()
    expected = Counter((i, *map(str, plain(text, ITEMS, window))) for i, text in DOCS)
    assert Counter((r.doc_id, str(r.n_words), str(r.n_hit), str(r.item_ids), str(r.contaminated)) for r in found) == expected
    assert all(r.n_items == len(r.item_ids) for r in found)


def plain_near(text, window):
    """Items with a window whose words stand together in whatever order."""
    said, found = words(text), set()
    for item_id, item in ITEMS + LONGER:
        asked = words(item)
        size = min(window, len(asked))
        for s in range(len(asked) - size + 1) if asked else ():
            bag = Counter(asked[s : s + size])
            if item_id is not None and any(Counter(said[at : at + size]) == bag for at in range(len(said) - size + 1)):
                found.add(str(item_id))
    return found


# Words in another order: of the middle of a long item, with one twice, and with one missing.
LONGER = [(20, " ".join(f"item{chr(97 + i)}" for i in range(26)) + " again again")]
SCRAMBLED = [
    (30, "x itemn itemj itemk iteml itemm y"),
    (31, "x itemn itemj itemk iteml y"),
    (32, "again itemz again itemy itemx"),
    (33, "again itemz itemy itemx itemx"),
    (34, "itemc itemb"),
]


@pytest.mark.parametrize("window", [2, 4, 5, 13])
def test_proximity_is_a_window_in_any_order(spark, tables, window):
    docs, items = tables
    docs = docs.unionByName(spark.createDataFrame([(*d, "clash") for d in SCRAMBLED], docs.schema))
    items = items.unionByName(spark.createDataFrame([(*i, "clash") for i in LONGER], items.schema))
    keys = {r.key: (r.doc_id, r.text) for r in docs.select(px.document_key().alias("key"), "doc_id", "text").collect()}
    found = px.matches(docs, items, window).collect()
    for r in found:
        if not r.exact:  # the stretch has the words of a window
            said = words(keys[r.key][1])[r.first : r.last + 1]
            item = [words(t) for i, t in ITEMS + LONGER if str(i) == str(r.item_id) and t]
            assert any(Counter(w[s : s + len(said)]) == Counter(said) for w in item for s in range(len(w)))
    judged = px.contamination(docs, items, window, proximity=True).collect()
    expected = Counter((i, len(plain_near(text, window))) for i, text in DOCS + SCRAMBLED)
    assert Counter((r.doc_id, r.n_near) for r in judged) == expected
    assert all(r.n_near >= r.n_items for r in judged)


def test_empty_tables(tables):
    docs, items = tables
    assert px.contamination(docs.limit(0), items).count() == 0
    rows = px.contamination(docs, items.limit(0)).collect()
    assert len(rows) == len(DOCS) and not any(r.contaminated or r.n_hit for r in rows)


def test_odd_rows(odd, tables):
    rows = px.contamination(odd, tables[1]).collect()
    assert len(rows) == odd.count()


def test_only_sql_functions_run(tables):
    plan = px.contamination(*tables)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_query_against_its_sql(spark, small):
    rows = Counter(tuple(r) for r in op9_positional_index(spark, small).collect())
    cursor = duck(small).execute(oracle_sql()["op9_positional_index"])
    names = [c[0] for c in cursor.description]
    assert names == ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "n_near"]
    assert rows == Counter(cursor.fetchall())


def test_the_digest_of_no_items(spark, small):
    clean = [r for r in op9_positional_index(spark, small).collect() if not r.n_items]
    assert {r.items_sha256 for r in clean} == {hashlib.sha256(b"").hexdigest()}
