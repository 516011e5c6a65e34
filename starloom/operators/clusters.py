"""K-means over embeddings, with a sweep over the number of clusters."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector, predict_batch_udf
from pyspark.sql import Column, DataFrame, types as T
from pyspark.storagelevel import StorageLevel

from starloom.functions.columns import named
from starloom.operators.steady_clusters import hashed_ngrams

FEATURES = "_features"


def embed_names(
    name: str | Column, load_model: Callable[[], Callable[[np.ndarray], np.ndarray]] | None = None,
    batch_size: int = 256,
) -> Column:
    """Embeddings of product names by a sentence model that is loaded once per Python worker; without a model, the
    numbers of their hashed runs of characters."""
    if load_model is None:
        return hashed_ngrams(name)
    embed = predict_batch_udf(
        load_model, return_type=T.ArrayType(T.FloatType()), batch_size=batch_size
    )
    return embed(named(name))


def fit_clusters(
    vectors: DataFrame, k: int, embedding_col: str = "embedding", seed: int = 42
) -> KMeansModel:
    """One model, without the silhouette that a sweep measures."""
    rows = vectors.select(array_to_vector(named(embedding_col)).alias(FEATURES))
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return KMeans(k=k, seed=seed, featuresCol=FEATURES, predictionCol="cluster").fit(rows)
    finally:
        rows.unpersist()


def cluster_sweep(
    vectors: DataFrame, ks: Sequence[int], embedding_col: str = "embedding", seed: int = 42
) -> tuple[dict[int, KMeansModel], DataFrame]:
    """A model per ``k``, and a table with cost and silhouette of each."""
    rows = vectors.select(array_to_vector(named(embedding_col)).alias(FEATURES))
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    models, scores = {}, []
    try:
        for k in ks:
            means = KMeans(k=k, seed=seed, featuresCol=FEATURES, predictionCol="cluster")
            model = means.fit(rows)
            score = ClusteringEvaluator(featuresCol=FEATURES, predictionCol="cluster")
            silhouette = score.evaluate(model.transform(rows))
            models[k] = model
            scores.append((k, float(model.summary.trainingCost), float(silhouette)))
    finally:
        rows.unpersist()
    table = vectors.sparkSession.createDataFrame(scores, "k int, cost double, silhouette double")
    return models, table


def assign_clusters(
    model: KMeansModel, vectors: DataFrame, embedding_col: str = "embedding"
) -> DataFrame:
    """Add the index of the nearest centre as ``cluster``."""
    ready = vectors.withColumn(FEATURES, array_to_vector(named(embedding_col)))
    return model.transform(ready).drop(FEATURES)
