"""A training corpus from ``documents``: quality, near-duplicates, benchmark passages, personal data, packing.

Each stage takes what the one before kept, with all columns of ``documents``, and the last one returns
token sequences. Clean documents go through all stages unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from starloom.llm import factorisation, packing, phrase_index, rule_forest, simhash, surrogates
from starloom.llm.queries import PIECE_END, QUALITY_THRESHOLD, surrogate_key, tokenizer
from starloom.llm.words import fold, table
from starloom.session import written_once

# Rows to drop that are broadcast; more are joined by a shuffle.
BROADCAST_ROWS = 200_000


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that the quality classifier rejects.

    A null or empty text is judged by its statistics; repeated rows are judged alike; an empty table stays empty.
    """
    labelled = rule_forest.clean_labels(table(spark, sf_dir, "labels")).where(fold() != 0)
    model = factorisation.train(docs, labelled, ["n_chars"])
    return factorisation.accepted(docs, model, ["n_chars"], QUALITY_THRESHOLD)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that fingerprints link: the one with the smallest id.

    A row is judged by its own id and text, whatever becomes of other rows of its id. Of rows equal in both one
    stays, the smallest by all its columns. Rows without an id go where their group has one with an id; else
    one of them stays. Null and empty texts are one group.
    """
    key = phrase_index.document_key()
    judged = written_once(simhash.keepers(docs, key), "near-duplicates")
    kept = _without(docs, judged.where("NOT kept"), key)
    repeated = judged.where("kept").groupBy("doc_id", "row_key").count().where("count > 1")
    if repeated.isEmpty():
        return kept
    copies = _matching(kept, repeated, key, "left_semi").select(
        key.alias("_key"), F.col("doc_id").alias("_id"), F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row")
    )
    one = copies.groupBy("_key", "_id").agg(F.min("_row").alias("_row")).select("_row.*")
    return _without(kept, repeated, key).unionByName(one)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that hold benchmark passages on at least a twentieth of their words.

    A null or empty text stays; repeated rows go or stay together; without benchmark items all stay.
    """
    judged = phrase_index.contamination(docs, table(spark, sf_dir, "benchmark"))
    dropped = judged.where("contaminated").withColumnRenamed("key", "row_key")
    return _without(docs, dropped, phrase_index.document_key())


def _without(docs: DataFrame, dropped: DataFrame, key: F.Column) -> DataFrame:
    return _matching(docs, dropped, key, "left_anti")


def _matching(docs: DataFrame, listed: DataFrame, key: F.Column, how: str) -> DataFrame:
    """Rows of ``docs`` whose id and key are, or are not, among ``listed`` (doc_id, row_key). With the id, two texts
    of one key are told apart unless both have the same id as well."""
    listed = written_once(listed.select(F.col("doc_id").alias("_id"), F.col("row_key").alias("_key")).distinct(), "listed")
    small = F.broadcast(listed) if listed.count() <= BROADCAST_ROWS else listed
    same = (key == F.col("_key")) & F.col("doc_id").cast("long").eqNullSafe(F.col("_id"))
    return docs.join(small, same, how)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by surrogates; ``n_chars`` follows the text and is null for a null one. All rows stay."""
    replaced = surrogates.surrogates_for(docs, surrogate_key(spark))
    return replaced.withColumn("n_chars", F.length("text").cast("long"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, dealt to sequences of at most 4096 tokens.

    A null or empty text is one token, its end; repeated rows are packed each; an empty table gives no rows.
    """
    pieces = packing.cut(docs, tokenizer(), PIECE_END)
    digested = pieces.withColumn("ids", F.crc32("ids")).withColumnRenamed("ids", "ids_crc32")
    return packing.pack(written_once(digested, "pieces"))


STAGES = [
    ("quality classifier", quality),
    ("near-duplicates", near_duplicates),
    ("decontamination", decontaminated),
    ("personal data", without_personal_data),
    ("packing", packed),
]

# Stages 1 and 5 learn or search, which SQL cannot express; tests/llm holds the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written_once(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
