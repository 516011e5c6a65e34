"""Classification report and confusion matrix."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from starloom.fixed_values import PREDICTED, SENTIMENT, SENTIMENTS
from starloom.functions.columns import named


def _ratio(part: Column, whole: Column) -> Column:
    """Zero when there is nothing to divide by."""
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0).cast("double"))


def _pairs(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    return (
        df.select(named(actual).alias("actual"), named(predicted).alias("predicted"))
        .where(F.col("actual").isNotNull())
        .groupBy("actual", "predicted")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def classification_report(
    df: DataFrame, actual: str = SENTIMENT, predicted: str = PREDICTED
) -> DataFrame:
    """Precision, recall, F1 and support per class, then accuracy and the two averages.

    Every class that occurs as actual or predicted gets a row. A row without a prediction is a miss: it
    counts against recall and accuracy of its class. Rows without an actual label are no cases.
    Accuracy stands in ``f1_score`` of its row, which has no precision or recall. All of it comes
    from the counts per (actual, predicted), so the data is read once.
    """
    # Each pair adds to the support of its actual and to the predictions of its predicted class.
    both_sides = _pairs(df, actual, predicted).select(
        F.inline(
            F.array(
                F.struct(
                    F.col("actual").alias("label"),
                    F.col("n").alias("support"),
                    F.lit(0).cast("long").alias("guessed"),
                    F.when(F.col("actual") == F.col("predicted"), F.col("n"))
                    .otherwise(F.lit(0).cast("long"))
                    .alias("hits"),
                ),
                F.struct(
                    F.col("predicted").alias("label"),
                    F.lit(0).cast("long").alias("support"),
                    F.col("n").alias("guessed"),
                    F.lit(0).cast("long").alias("hits"),
                ),
            )
        )
    )
    precision = _ratio(F.col("hits"), F.col("guessed"))
    recall = _ratio(F.col("hits"), F.col("support"))
    # 2PR / (P + R), written in counts.
    f1 = _ratio(2 * F.col("hits"), F.col("guessed") + F.col("support"))
    classes = (
        both_sides.where(F.col("label").isNotNull())
        .groupBy("label")
        .agg(*[F.sum(c).alias(c) for c in ("support", "guessed", "hits")])
        .withColumns({"precision": precision, "recall": recall, "f1_score": f1})
    )
    scores = ("precision", "recall", "f1_score")
    total = F.sum("support")
    nothing = F.lit(None).cast("double")
    summary = classes.agg(
        total.alias("support"),
        _ratio(F.sum("hits"), total).alias("accuracy"),
        *[F.avg(s).alias(f"macro_{s}") for s in scores],
        *[_ratio(F.sum(F.col(s) * F.col("support")), total).alias(f"weighted_{s}") for s in scores],
    ).select(
        F.inline(
            F.array(
                F.struct(
                    F.lit("accuracy").alias("label"),
                    nothing.alias("precision"),
                    nothing.alias("recall"),
                    F.col("accuracy").alias("f1_score"),
                    F.col("support"),
                ),
                *[
                    F.struct(
                        F.lit(f"{kind} avg").alias("label"),
                        *[F.col(f"{kind}_{s}").alias(s) for s in scores],
                        F.col("support"),
                    )
                    for kind in ("macro", "weighted")
                ],
            )
        )
    )
    return classes.select("label", *scores, "support").unionByName(summary)


def confusion_matrix(
    df: DataFrame,
    actual: str = SENTIMENT,
    predicted: str = PREDICTED,
    labels: Sequence[str] = SENTIMENTS,
    others: str | None = "other",
) -> DataFrame:
    """Rows per actual class, one column per predicted class; ``labels`` sets both.

    Labels off the list, and missing predictions, are counted in a row and a column named ``others``;
    with None they are an error. Rows without an actual label are no cases. One aggregate over the
    data. A class that never occurs still has its row.
    """
    listed = list(labels)
    if others is None:
        problem = F.lit("a label is not on the list, or a prediction is missing")
        rest = F.raise_error(problem).cast("string")
    else:
        labels, rest = [*listed, others], F.lit(others)
    place = lambda c: F.when(F.col(c).isin(*listed), F.col(c)).otherwise(rest).alias(c)
    counted = [F.count_if(F.col("predicted") == label).alias(label) for label in labels]
    pairs = df.select(named(actual).alias("actual"), named(predicted).alias("predicted"))
    pairs = pairs.where(F.col("actual").isNotNull()).select(place("actual"), place("predicted"))
    found = pairs.groupBy("actual").agg(*counted)
    every = df.sparkSession.range(0, 1, numPartitions=1).select(
        F.explode(F.array(*[F.lit(label) for label in labels])).alias("actual")
    )
    filled = [F.coalesce(label, F.lit(0).cast("long")).alias(label) for label in labels]
    return every.join(found, "actual", "left").select("actual", *filled)
