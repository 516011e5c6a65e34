import itertools
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from starloom.llm import url_rules as ur
from starloom.llm.queries import op4_association_rules
from starloom.llm.words import table

URLS = [
    (1, "http://A.Example.NET/en/5?x=1"),
    (2, "https://m.example.net/de/5#t"),
    (3, "http://example.net/en"),
    (4, "HTTP://sub.example.COM/de/1"),
    (5, "http://notexample.com/de/1"),
    (6, "http://x.org/fr/"),
    (7, "http://x.org/FR/"),
    (8, None),
    (9, ""),
    (10, "no scheme/net/"),
    (11, "http://net/"),
    (12, "http://net"),
    (13, "http://a.b://c.net/en/"),
    (14, "//example.net/en/"),
    (14, "http://example.com?/de/"),
    (None, "http://ÄB.net/\nen/"),
]


def plain(url):
    """Host, path, rule and verdict by string search."""
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.split("[/?#]", rest, maxsplit=1)[0]
        path = re.split("[?#]", rest[len(host) :], maxsplit=1)[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [
        r for r in ur.STATED if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)
    ]
    best = max(fits, key=lambda r: len(r.text), default=None)
    return host, path, best and best.text, best.verdict if best else "allow"


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame(URLS, "page_id long, url string").withColumn("tokens", F.lit("clash"))


def no_labels(spark):
    return spark.createDataFrame([], "page_id long, label int")


def test_stated_rules(spark, pages):
    rows = ur.judge(pages, no_labels(spark)).collect()
    expected = sorted((str(i), *map(str, plain(url))) for i, url in URLS)
    assert sorted((str(r.page_id), r.host, r.path, str(r.rule), r.verdict) for r in rows) == expected


def spam(spark, n=400):
    """Neither host word nor section tells alone, the two together do."""
    rows = [
        (i, f"http://{'cheap' if i % 2 else 'good'}{i % 7}.shop.info/{'pills' if i % 3 == 0 else 'shoes'}/{i}", 0 if i % 6 == 3 else 1)
        for i in range(n)
    ]
    return spark.createDataFrame(rows, "page_id long, url string, label int")


def test_combinations_are_mined_and_matched(spark):
    rows = spam(spark)
    judged = ur.judge(rows.select("page_id", "url"), rows.where("page_id < 300").select("page_id", "label")).collect()
    truth = {r.page_id: r.label for r in rows.collect()}
    assert all((r.verdict == "block") == (truth[r.page_id] == 0) for r in judged)
    assert all(r.rule is None for r in judged)
    mined = {tuple(r.mined) for r in judged if r.mined}
    assert all("path:pills" in rule and "word:cheap" in rule for rule in mined)


def test_rules_are_those_of_all_combinations(spark):
    """Support and confidence of mined rules against counting; shorter rules win."""
    rows = spam(spark, 240)
    split = rows.select(ur.tokens_of(ur.host_of(F.col("url")), ur.path_of(F.col("url"))).alias("tokens"), (F.col("label") == 0).alias("blocked"))
    baskets = [(set(r.tokens), r.blocked) for r in split.collect()]
    found = ur.mine(split, min_support=0.01, min_confidence=0.9).collect()
    assert found
    kept = {frozenset(r.tokens): r for r in found}
    for tokens, rule in kept.items():
        held = [b for t, b in baskets if tokens <= t]
        assert abs(rule.confidence - sum(held) / len(held)) < 1e-9 and rule.confidence >= 0.9
        assert abs(rule.support - sum(held) / len(baskets)) < 1e-9
        assert not any(tokens - {t} in kept and kept[tokens - {t}].confidence >= rule.confidence for t in tokens)


def plain_rules(baskets, min_count, min_confidence):
    """Rules of all combinations of items, where tokens of the same URLs are one item."""
    where = {}
    for i, (tokens, _) in enumerate(baskets):
        for t in tokens:
            where.setdefault(t, set()).add(i)
    groups = {}
    for t, rows in where.items():
        if len(rows) >= min_count:
            groups.setdefault(frozenset(rows), set()).add(t)
    items = [(rows, frozenset(tokens)) for rows, tokens in groups.items()]
    found = {}
    for size in range(1, len(items) + 1):
        for chosen in itertools.combinations(items, size):
            rows = frozenset.intersection(*(r for r, _ in chosen))
            hits = sum(baskets[i][1] for i in rows)
            if hits >= min_count and hits >= min_confidence * len(rows):
                found[frozenset(t for _, t in chosen)] = (hits, len(rows))
    sure = lambda rule: found[rule][0] / found[rule][1]
    return {
        (frozenset().union(*rule), *found[rule])
        for rule in found
        if not any(rule - {t} in found and sure(rule - {t}) >= sure(rule) for t in rule)
    }


def mined(spark, urls, **more):
    rows = spark.createDataFrame(urls, "url string, blocked boolean")
    split = rows.select(ur.tokens_of(ur.host_of(F.col("url")), ur.path_of(F.col("url"))).alias("tokens"), "blocked")
    baskets = [(set(r.tokens), r.blocked) for r in split.collect()]
    found = ur.mine(split, **more).collect()
    return {(frozenset(r.tokens), round(r.support * len(urls)), round(r.support * len(urls) / r.confidence)) for r in found}, baskets


def test_long_url_that_many_labelled_pages_share(spark):
    """One bad URL of 40 segments on 40 of 400 pages: its tokens are one item, so there is little to combine."""
    bad = "http://spam.shop.info/" + "/".join(f"s{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(40))
    urls = [(bad, True)] * 40 + [(f"http://h{i % 3}.shop.info/{'ab'[i % 2]}", i % 9 == 0) for i in range(360)]
    found, baskets = mined(spark, urls)
    assert found == plain_rules(baskets, 20, 0.9) and len(found) == 1
    assert len(next(iter(found))[0]) > 40


def test_nested_paths_of_a_crawler_trap(spark):
    """Thirty nested paths with 20 pages each: all items differ, and combinations stay bounded."""
    path = [f"s{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(30)]
    urls = [("http://trap.info/" + "/".join(path[: depth + 1]), depth >= 15) for depth in range(30) for _ in range(20)]
    found, baskets = mined(spark, urls)
    assert found
    for tokens, hits, held in found:
        rows = [b for t, b in baskets if tokens <= t]
        assert (sum(rows), len(rows)) == (hits, held) and hits >= 0.9 * held
    caught = [any(tokens <= t for tokens, _, _ in found) for t, _ in baskets]
    assert all(c for c, (_, b) in zip(caught, baskets, strict=True) if b)


def test_mined_rules_are_those_of_counting(spark):
    random = np.random.default_rng(6)
    for _ in range(3):
        urls = []
        for _ in range(300):
            a, b, c = random.integers(0, 3, 3)
            urls.append((f"http://{'xyz'[a]}aa.{'uvw'[b]}bb.info/{'pqr'[c]}", bool((a + b == 1) and random.random() < 0.95)))
        found, baskets = mined(spark, urls)
        assert found == plain_rules(baskets, 20, 0.9)


@pytest.mark.parametrize("bound", [0, 100_000])
def test_index_finds_every_rule_that_is_held(spark, monkeypatch, bound):
    monkeypatch.setattr(ur, "BROADCAST_RULES", bound)
    rules = [["a"], ["a", "b"], ["b", "c", "d"], ["z"]]
    urls = {1: ["a", "b"], 2: ["b", "c", "d", "e"], 3: [], 4: ["c", "d"], 5: ["a", "b", "c", "d"]}
    found = ur.matches(
        spark.createDataFrame(list(urls.items()), "id int, tokens array<string>"),
        spark.createDataFrame([(r, 1.0) for r in rules], "tokens array<string>, confidence double"),
        "id",
    )
    expected = sorted((i, tuple(r)) for i, t in urls.items() for r in rules if set(r) <= set(t))
    assert sorted((r.id, tuple(r.tokens)) for r in found.collect()) == expected


def test_empty_tables(spark, pages):
    assert ur.judge(pages.limit(0), no_labels(spark)).count() == 0


def test_query_on_the_test_tables(spark, small):
    urls = dict(table(spark, small, "pages").select("page_id", "url").collect())
    rows = op4_association_rules(spark, small).collect()
    assert len(rows) == len(urls)
    for r in rows:
        host, path, rule, verdict = plain(urls[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert rule is None or r.verdict == verdict


@pytest.mark.parametrize("longest", [1, 3])
def test_items_beyond_the_rarest_are_mined_too(spark, monkeypatch, longest):
    """URLs with more items than FP-growth takes: the rules are those of all combinations."""
    monkeypatch.setattr(ur, "LONGEST", longest)
    random = np.random.default_rng(longest)
    urls = []
    for _ in range(400):
        a, b, c, d = random.integers(0, 2, 4)
        blocked = bool(a + b == 2 or (c and not d and random.random() < 0.93))
        urls.append((f"http://{'xyz'[a]}aa.{'uvw'[b]}bb.info/{'pqr'[c]}/{'mno'[d]}", blocked))
    found, baskets = mined(spark, urls)
    assert found == plain_rules(baskets, 20, 0.9) and any(len(tokens) > 1 for tokens, _, _ in found)


def test_rule_of_common_items_of_long_urls(spark):
    """Two common tokens block together; each URL has 13 rarer ones, of which none tells."""
    random = np.random.default_rng(3)
    urls = []
    for i in range(1000):
        words = [f"{'pqrstuvwxyzab'[j]}{'cdefgh'[random.integers(0, 6)]}" for j in range(13)]
        both = [w for w, held in zip(("cheap", "pills"), (i % 2, i // 2 % 2), strict=True) if held]
        urls.append(("http://a.info/" + "/".join(words + both), i % 4 == 3))
    rows = spark.createDataFrame(urls, "url string, blocked boolean")
    split = rows.select(ur.tokens_of(ur.host_of(F.col("url")), ur.path_of(F.col("url"))).alias("tokens"), "blocked")
    rules = [set(r.tokens) for r in ur.mine(split, min_count=100).collect()]
    assert rules == [{"path:cheap", "path:pills"}]
