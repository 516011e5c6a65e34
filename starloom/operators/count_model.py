"""A sentiment model in closed form: multinomial naive Bayes from one aggregate over token counts.

Weights are whole numbers, floor(SCALE * ln p), so a score is the same in whatever order it is summed. A model is two
small tables and is scored by a join on the terms of a text; terms that training did not see count for no class.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from starloom.fixed_values import PREDICTED, REVIEW_ID, SENTIMENT, SENTIMENTS, TEXT
from starloom.functions.columns import argmax, look_up, named
from starloom.llm.words import sums
from starloom.operators.bounded import small_side
from starloom.operators.metrics import classification_report
from starloom.operators.sampling import train_test_split
from starloom.operators.text_model import tokenize
from starloom.session import written_once

SCALE = 1_000_000
ROW = "_counted_row"
# Tokens of the texts that are scored together, or of one longer text.
BLOCK_TOKENS = 500_000


class CountModel(NamedTuple):
    """``terms`` (term, weights) with a weight per class; ``priors`` (place, label, prior) in the order of classes."""

    terms: DataFrame
    priors: DataFrame


def _weight(part: Column, whole: Column) -> Column:
    return F.floor(SCALE * F.ln(part / whole)).cast("long")


def fit_counts(
    labelled: DataFrame, text_col: str = TEXT, label_col: str = SENTIMENT, classes: Sequence[str] = SENTIMENTS
) -> CountModel:
    """A model of the rows with one of ``classes``; each count is one more than found.

    Two aggregates, over rows and over tokens. Tokens are combined in each task before they are shuffled, so a
    frequent word costs a row per task. A missing text has no tokens.
    """
    names = list(classes)
    place = look_up(label_col, {name: i for i, name in enumerate(names)}).alias("place")
    rows = labelled.select(named(text_col).cast("string").alias(TEXT), place).where(F.col("place").isNotNull())
    spoken = tokenize(rows).select("place", F.explode("tokens").alias("term"))
    counted = spoken.groupBy("term").agg(*[F.count_if(F.col("place") == i).alias(f"n{i}") for i in range(len(names))])
    counted = written_once(counted, "term-counts")
    sizes = rows.agg(*[F.count_if(F.col("place") == i) for i in range(len(names))]).first()
    tokens = counted.agg(F.count(F.lit(1)), *[F.coalesce(F.sum(f"n{i}"), F.lit(0)) for i in range(len(names))]).first()
    weights = [_weight(F.col(f"n{i}") + 1, F.lit(tokens[0] + tokens[i + 1])) for i in range(len(names))]
    terms = written_once(counted.select("term", F.array(*weights).alias("weights")), "term-weights")
    listed = [(i, name, sizes[i] + 1, sum(sizes) + len(names)) for i, name in enumerate(names)]
    priors = labelled.sparkSession.createDataFrame(listed, "place int, label string, part long, whole long")
    return CountModel(terms, priors.select("place", "label", _weight(F.col("part"), F.col("whole")).alias("prior")))


def predict_counts(model: CountModel, df: DataFrame, text_col: str = TEXT) -> DataFrame:
    """Add ``predicted_sentiment``: the class of the highest score, the first of ``classes`` on a tie.

    Rows are told apart by a number of their own, so equal ids do not meet. A vocabulary within the bounds of a
    broadcast is joined where the texts are read, and a row per text is shuffled; a larger one is joined by a
    shuffle of the different terms of blocks of texts.
    """
    listed = model.priors.orderBy("place").collect()  # a row per class
    rows = written_once(df.withColumn(ROW, F.monotonically_increasing_id()), "rows-to-score")
    spoken = tokenize(rows.select(ROW, named(text_col).cast("string").alias(TEXT))).select(ROW, "tokens")
    terms, held = small_side(model.terms)
    if held is None:
        scores = _by_blocks(spoken, terms, len(listed))
    else:
        totals = [F.sum(F.col("weights")[i]).alias(f"s{i}") for i in range(len(listed))]
        scores = spoken.select(ROW, F.explode("tokens").alias("term")).join(terms, "term").groupBy(ROW).agg(*totals)
    scored = rows.join(scores, ROW, "left")
    totals = F.array(*[F.lit(r["prior"]) + F.coalesce(f"s{i}", F.lit(0)) for i, r in enumerate(listed)])
    best = look_up(argmax(totals), {i: r["label"] for i, r in enumerate(listed)})
    return scored.select(*[named(c) for c in df.columns if c != PREDICTED], best.alias(PREDICTED))


def _by_blocks(spoken: DataFrame, terms: DataFrame, n_classes: int) -> DataFrame:
    """(row, s0, s1, ...): sums of weights of the tokens of each row of (row, tokens).

    A block holds its different terms and all its tokens as numbers of these. Only the terms meet the vocabulary;
    their weights then go to the block, which is one row.
    """

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, lists = batch.column(0).to_numpy().astype(np.int64), batch.column(1)
            starts = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(), dtype=np.int64)])
            first = 0
            while first < len(ids):
                last = max(first + 1, int(np.searchsorted(starts, starts[first] + BLOCK_TOKENS, "right")) - 1)
                last = min(last, len(ids))
                found = lists.slice(first, last - first).flatten().dictionary_encode()
                numbers = [ids[first:last], starts[first : last + 1] - starts[first], found.indices.to_numpy().astype(np.int32)]
                words = pa.ListArray.from_arrays(pa.array([0, len(found.dictionary)], pa.int32()), found.dictionary)
                columns = [pa.array(ids[first : first + 1]), words, *(pa.array([n.tobytes()], pa.binary()) for n in numbers)]
                yield pa.RecordBatch.from_arrays(columns, ["block", "terms", "rows", "starts", "codes"])
                first = last

    def summed(block: pa.Table, known: pa.Table) -> pa.Table:
        rows, starts = (np.frombuffer(block.column(c)[0].as_py(), np.int64) for c in ("rows", "starts"))
        codes = np.frombuffer(block.column("codes")[0].as_py(), np.int32)
        weights = np.zeros((int(codes.max(initial=-1)) + 1, n_classes), np.int64)
        found = known.column("weights").combine_chunks().flatten().to_numpy()
        weights[known.column("code").to_numpy()] = found.reshape(-1, n_classes)
        columns = sums(weights[codes], starts).T
        return pa.table({ROW: rows} | {f"s{i}": column for i, column in enumerate(columns)})

    fields = "block long, terms array<string>, rows binary, starts binary, codes binary"
    blocks = written_once(spoken.mapInArrow(packed, fields), "spoken-blocks")
    asked = blocks.select("block", F.posexplode("terms").alias("code", "term"))
    weighed = asked.join(terms, "term").select(F.col("block").alias("of"), "code", "weights")
    held = blocks.drop("terms").groupBy("block").cogroup(weighed.groupBy("of"))
    return held.applyInArrow(summed, ", ".join([f"{ROW} long", *(f"s{i} long" for i in range(n_classes))]))


def train_counts(
    labelled: DataFrame,
    output_dir: str | None = None,
    text_col: str = TEXT,
    label_col: str = SENTIMENT,
    classes: Sequence[str] = SENTIMENTS,
    test_size: float = 0.3,
    seed: int = 42,
    id_col: str = REVIEW_ID,
) -> tuple[CountModel, DataFrame]:
    """Fit on one part of a labelled table, report on the other, like ``train_sentiment``."""
    train, test = train_test_split(labelled, test_size, seed, id_col)
    model = fit_counts(train, text_col, label_col, classes)
    if output_dir is not None:
        save_counts(model, output_dir)
    kept = test.where(named(label_col).isin(*classes))
    return model, classification_report(predict_counts(model, kept, text_col), label_col, PREDICTED)


def save_counts(model: CountModel, path: str) -> None:
    model.terms.write.mode("overwrite").parquet(f"{path}/terms")
    model.priors.write.mode("overwrite").parquet(f"{path}/priors")


def load_counts(spark: SparkSession, path: str) -> CountModel:
    return CountModel(spark.read.parquet(f"{path}/terms"), spark.read.parquet(f"{path}/priors"))
