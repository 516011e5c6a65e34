"""A trained sentiment model: tokens, term weights and logistic regression, all in Spark ML."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, HashingTF, RegexTokenizer
from pyspark.sql import DataFrame, functions as F
from pyspark.storagelevel import StorageLevel

from starloom.fixed_values import ACTUAL, PREDICTED, REVIEW_ID, SENTIMENT, SENTIMENTS, TEXT
from starloom.functions.columns import look_up, named
from starloom.operators.metrics import classification_report
from starloom.operators.sampling import train_test_split
from starloom.session import written_once

# Working columns of the model, which do not clash with those of a review table.
INPUT = "_text"
FEATURES = "_features"
PLACE = "_place"


def text_features(num_features: int = 1 << 18) -> list:
    """Stages from the input text to weighted term counts."""
    tokens = RegexTokenizer(
        inputCol=INPUT, outputCol="_words", pattern=r"[^\p{L}\p{N}]+", toLowercase=True
    )
    counts = HashingTF(inputCol="_words", outputCol="_counts", numFeatures=num_features)
    return [tokens, counts, IDF(inputCol="_counts", outputCol=FEATURES)]


def tokenize(df: DataFrame, text_col: str = TEXT) -> DataFrame:
    """Add the ``tokens`` that the model counts: lower-case runs of letters and digits."""
    tokenizer = text_features()[0].setOutputCol("tokens")
    ready = df.withColumn(INPUT, F.coalesce(named(text_col), F.lit("")))
    return tokenizer.transform(ready).drop(INPUT)


def train_sentiment(
    balanced: DataFrame,
    output_dir: str | None = None,
    text_col: str = TEXT,
    label_col: str = SENTIMENT,
    classes: Sequence[str] = SENTIMENTS,
    test_size: float = 0.3,
    seed: int = 42,
    id_col: str = REVIEW_ID,
    num_features: int = 1 << 18,
    max_iter: int = 30,
) -> tuple[PipelineModel, DataFrame]:
    """Fit on one part of a labelled table, report on the other.

    What the table is made of is computed once and written to the scratch folder. The features of the
    training part are kept, spilling to disk, for the passes of the optimiser; each of these is one
    distributed aggregate over them.
    """
    code = {name: i for i, name in enumerate(classes)}
    table = balanced.select(
        named(id_col).alias(REVIEW_ID),
        F.coalesce(named(text_col), F.lit("")).alias(INPUT),
        named(label_col).alias(label_col),
        look_up(label_col, code).cast("double").alias(ACTUAL),
    ).where(F.col(ACTUAL).isNotNull())
    train, test = train_test_split(written_once(table, "training"), test_size, seed, REVIEW_ID)

    features = Pipeline(stages=text_features(num_features)).fit(train)
    rows = features.transform(train).select(ACTUAL, FEATURES)
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        regression = LogisticRegression(
            featuresCol=FEATURES,
            labelCol=ACTUAL,
            predictionCol=PLACE,
            rawPredictionCol="_scores",
            probabilityCol="_probability",
            maxIter=max_iter,
            regParam=0.01,
        ).fit(rows)
    finally:
        rows.unpersist()
    model = PipelineModel(stages=[*features.stages, regression])
    if output_dir is not None:
        save_model(model, output_dir)
    scored = predict_sentiment(model, test, INPUT, classes)
    return model, classification_report(scored, label_col, PREDICTED)


def predict_sentiment(
    model: PipelineModel,
    df: DataFrame,
    text_col: str = TEXT,
    classes: Sequence[str] = SENTIMENTS,
) -> DataFrame:
    """Add ``predicted_sentiment``: the class with the highest score, in the same row."""
    scored = model.transform(df.withColumn(INPUT, F.coalesce(named(text_col), F.lit(""))))
    names = dict(enumerate(classes))
    predicted = look_up(F.col(PLACE).cast("int"), names).alias(PREDICTED)
    kept = [named(c) for c in df.columns if c != PREDICTED]
    return scored.select(*kept, predicted)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
