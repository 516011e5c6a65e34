"""K-means without chance: the same clusters for the same points, on whole numbers.

The first centre is the point with the smallest hash; each next one is the point farthest from those chosen, so the
starts for fewer clusters are the first of those for more. Steps of assignment and mean follow, each an aggregate over
the points that returns a row per cluster. Distances and sums are whole numbers and means are rounded down, so nothing
depends on the order of rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from starloom.functions.columns import named
from starloom.session import written_once

SCALE = 1024
DIMENSIONS, GRAM = 32, 3
# Numbers that one step of distances takes.
STEP = 1 << 20
Centres = list[list[int]]


@lru_cache(1 << 16)
def _hash(part: str) -> int:
    return int(hashlib.md5(part.encode()).hexdigest()[:8], 16)


def hashed_ngrams(name: str | Column, dimensions: int = DIMENSIONS, gram: int = GRAM) -> Column:
    """How many of a name's runs of ``gram`` characters, in lower case and with a blank at both ends, fall to each of
    ``dimensions`` by a hash. Names with common parts are near each other; a null name has no vector."""

    def counted(names: pa.Array) -> pa.Array:
        found = names.dictionary_encode()  # a repeated name is taken once
        rows = np.zeros((len(found.dictionary), dimensions))
        for i, text in enumerate(found.dictionary.to_pylist()):
            places = [_hash(text[at : at + gram]) % dimensions for at in range(max(len(text) - gram + 1, 1))]
            rows[i] = np.bincount(places, minlength=dimensions)
        offsets = np.arange(len(rows) + 1, dtype=np.int32) * dimensions
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(rows.reshape(-1))).take(found.indices)

    padded = F.concat(F.lit(" "), F.lower(named(name)), F.lit(" "))
    return F.arrow_udf(counted, "array<double>")(padded)


def whole_points(df: DataFrame, key_col: str, vector_col: str, scale: int = SCALE) -> DataFrame:
    """A written table (key, hash, point) of the rows with a key and a whole vector: floor(scale * x) of each component.
    Rows of equal key and vector are one point."""
    vector = named(vector_col).cast("array<double>")
    infinite = F.lit(float("inf"))
    whole = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < infinite))
    kept = df.where(named(key_col).isNotNull() & vector.isNotNull() & whole)
    point = F.transform(vector, lambda x: F.floor(x * scale).cast("long"))
    rows = kept.select(named(key_col).alias("key"), F.md5(named(key_col).cast("string")).alias("hash"), point.alias("point"))
    return written_once(rows.distinct(), "points")


def distances(centres: Centres) -> Column:
    """Squared distances of ``point`` to each centre; null where their lengths differ."""

    def measured(points: pa.Array) -> pa.Array:
        sizes = points.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
        far = np.full((len(sizes), len(centres)), -1)
        for size in {len(c) for c in centres}:
            places = [i for i, c in enumerate(centres) if len(c) == size]
            for at in np.array_split(np.flatnonzero(sizes == size), len(sizes) * size // STEP + 1):
                block = points.take(pa.array(at)).flatten().to_numpy().reshape(len(at), size)
                for i in places:
                    far[at, i] = _squares(block, centres[i])
        offsets = np.arange(len(sizes) + 1, dtype=np.int32) * len(centres)
        flat = far.reshape(-1)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, mask=flat < 0))

    return F.arrow_udf(measured, "array<long>")("point")


def _squares(block: np.ndarray, centre: list[int]) -> np.ndarray:
    """Squared distances of the rows of ``block`` to ``centre``; numbers that do not fit raise an error."""
    if not block.size:
        return np.zeros(len(block), np.int64)
    most = max(int(block.max()), -int(block.min()), *map(abs, centre))
    kind = np.int64 if 4 * most * most * len(centre) < 1 << 63 else object
    off = block.astype(kind, copy=False) - np.array(centre, kind)
    return np.array((off * off).sum(axis=1).tolist(), np.int64) if kind is object else np.einsum("ij,ij->i", off, off)


def farthest_first(points: DataFrame, k: int) -> Centres:
    """Up to ``k`` centres, fewer only where there are fewer different points; a pass over the points for each."""
    first = points.agg(F.min(F.struct("hash", "point")).alias("best")).first()["best"]
    if first is None:
        return []
    chosen = [list(first["point"])]
    while len(chosen) < k:
        far = F.array_min(distances(chosen))
        best = points.agg(F.min(F.struct((-far).alias("near"), "hash", "point")).alias("best")).first()["best"]
        if best["near"] == 0:
            break
        chosen.append(list(best["point"]))
    return chosen


def assigned(points: DataFrame, centres: Centres) -> DataFrame:
    """(key, point, cluster, distance): the nearest centre of each point, the first on a tie."""
    measured = points.withColumn("_far", distances(centres))
    least = F.array_min("_far")
    return measured.select(
        "key", "point", (F.array_position("_far", least) - 1).cast("int").alias("cluster"), least.alias("distance")
    )


def step(points: DataFrame, centres: Centres) -> Centres:
    """The means of the clusters, rounded down; a centre without points stays."""
    width = len(centres[0])
    sums = [F.sum(F.col("point")[i]) for i in range(width)]
    found = assigned(points, centres).groupBy("cluster").agg(F.count(F.lit(1)), *sums)
    after = list(centres)
    for row in found.collect():  # a row per cluster
        after[row[0]] = [total // row[1] for total in row[2:]]
    return after


def steady_clusters(points: DataFrame, k: int, steps: int = 3, start: Centres | None = None) -> Centres:
    """Centres of ``points`` (a table of ``whole_points``) after ``steps`` steps; none without points."""
    centres = (farthest_first(points, k) if start is None else start)[:k]
    for _ in range(steps if centres else 0):
        centres = step(points, centres)
    return centres


def steady_sweep(points: DataFrame, ks: Sequence[int], steps: int = 3) -> DataFrame:
    """(k, cluster, size, cost) for each number of clusters; ``cost`` is the sum of squared distances."""
    start = farthest_first(points, max(ks))
    found = None
    for k in ks:
        if not start:
            break
        rows = assigned(points, steady_clusters(points, k, steps, start)).groupBy("cluster")
        rows = rows.agg(F.count(F.lit(1)).alias("size"), F.sum("distance").alias("cost"))
        rows = rows.select(F.lit(k).alias("k"), "cluster", "size", "cost")
        found = rows if found is None else found.unionByName(rows)
    if found is None:
        return points.sparkSession.createDataFrame([], "k int, cluster int, size long, cost long")
    return found
