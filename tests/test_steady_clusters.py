"""Clusters against plain Python, and names by their common parts."""

import hashlib
import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from starloom.operators import steady_clusters as sc
from starloom.operators.clusters import embed_names


def plain(points, k, steps):
    """Centres of (key, point), by all distances."""
    by_hash = sorted((hashlib.md5(str(key).encode()).hexdigest(), p) for key, p in points)
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    centres = [by_hash[0][1]]
    while len(centres) < k:
        near, _, point = min((-min(far(p, c) for c in centres), h, p) for h, p in by_hash)
        if near == 0:
            break
        centres.append(point)
    label = lambda p: min(range(len(centres)), key=lambda i: (far(p, centres[i]), i))
    for _ in range(steps):
        groups = [[p for _, p in points if label(p) == i] for i in range(len(centres))]
        centres = [[sum(x) // len(g) for x in zip(*g, strict=True)] if g else c for g, c in zip(groups, centres, strict=True)]
    return centres, Counter(label(p) for _, p in points), {i: sum(far(p, centres[i]) for _, p in points if label(p) == i) for i in range(len(centres))}


def vectors(spark, rows):
    return spark.createDataFrame(rows, "id long, embedding array<double>").repartition(3)


@pytest.mark.parametrize("k,steps", [(1, 2), (3, 0), (5, 4)])
def test_centres_are_those_of_plain_python(spark, k, steps):
    random = np.random.default_rng(k)
    rows = [(i, (random.normal(0, 1, 6) + 4 * (i % 3)).tolist()) for i in range(80)]
    rows += [(i, rows[0][1]) for i in range(100, 110)]  # copies, and ties between them
    points = sc.whole_points(vectors(spark, rows + rows[:5]), "id", "embedding")
    whole = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows]
    assert sc.steady_clusters(points, k, steps) == plain(whole, k, steps)[0]


def test_sweep(spark):
    random = np.random.default_rng(9)
    rows = [(i, random.normal(0, 1, 3).tolist()) for i in range(40)]
    points = sc.whole_points(vectors(spark, rows), "id", "embedding")
    whole = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows]
    expected = set()
    for k in (2, 4):
        _, sizes, costs = plain(whole, k, 3)
        expected |= {(k, i, sizes[i], costs[i]) for i in sizes}
    assert {tuple(r) for r in sc.steady_sweep(points, [2, 4]).collect()} == expected


def test_odd_points(spark):
    rows = [(1, [1.0, 2.0]), (2, None), (None, [1.0, 2.0]), (3, [float("nan"), 1.0]), (4, [None, 1.0]), (5, [1.0, 2.0])]
    points = sc.whole_points(vectors(spark, rows), "id", "embedding")
    assert sorted(r.key for r in points.collect()) == [1, 5]
    assert sc.steady_clusters(points, 4) == [[1024, 2048]]
    assert sc.steady_sweep(points.limit(0), [2]).count() == 0 and sc.steady_clusters(points.limit(0), 2) == []


def test_names_with_common_parts_are_near(spark):
    names = [f"Echo Dot {i}" for i in range(6)] + [f"Litter Box {i}" for i in range(6)]
    df = spark.createDataFrame([(n,) for n in [*names, None]], "name string").withColumn("embedding", embed_names("name"))
    for r in df.collect():
        if r["name"] is None:
            assert r["embedding"] is None
            continue
        padded = f" {r['name'].lower()} "
        places = [int(hashlib.md5(padded[i : i + 3].encode()).hexdigest()[:8], 16) % 32 for i in range(len(padded) - 2)]
        assert r["embedding"] == [places.count(d) for d in range(32)]
    points = sc.whole_points(df, "name", "embedding")
    found = {r.key: r.cluster for r in sc.assigned(points, sc.steady_clusters(points, 2)).collect()}
    assert len({found[n] for n in names[:6]}) == len({found[n] for n in names[6:]}) == 1
    assert found[names[0]] != found[names[6]]
    assert df.select(F.size(embed_names(F.lit("a")))).first()[0] == 32


def test_distances_and_name_vectors_are_no_nested_lambdas(spark):
    """Those ran over all hashes of a name for each dimension, and over all numbers of a point a call at a time."""
    names = spark.createDataFrame([("lamp",), ("lamp",), ("",), (None,)], "name string")
    points = spark.createDataFrame([(1, [1, 2]), (2, [5]), (3, []), (4, [4, 6])], "key int, point array<long>")
    vectors, far = names.select("name", embed_names("name").alias("v")), points.select("key", sc.distances([[1, 2], [7]]).alias("far"))
    for df in (vectors, far):
        assert "lambda" not in df._jdf.queryExecution().optimizedPlan().toString()
    assert {r.name: r.v and sum(r.v) for r in vectors.collect()} == {"lamp": 4, "": 1, None: None}
    assert {r.key: r.far for r in far.collect()} == {1: [0, None], 2: [None, 4], 3: [None, None], 4: [25, None]}


def test_distances_beyond_long(spark):
    points = spark.createDataFrame([(1, [2**31, 5]), (2, [-(2**31), 5])], "key int, point array<long>")
    near = points.where("key = 1").select(sc.distances([[2**30, 5]]).alias("far"))
    assert near.first().far == [2**60]
    with pytest.raises(Exception, match="(?i)overflow|too large|too big"):
        points.select(sc.distances([[2**62, 5]]).alias("far")).collect()
