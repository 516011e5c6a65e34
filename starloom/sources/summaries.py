"""The summary store: one text per category key, versioned, with JSON import and export.

Writers do not lock each other out. Each writes its rows to a folder of its own and then commits them as the next
version, which only one can; the others start again from that version.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from starloom.functions.columns import category_key
from starloom.sources import commits
from starloom.sources.reviews import path_is_missing

KEY = "category_key"
SUMMARY = "summary"
SCHEMA = f"{KEY} string, {SUMMARY} string"
# The folder of commits; Spark's readers skip it.
COMMITS = "_commits"
# A JSON object is one value in one task.
JSON_ROWS, JSON_BYTES = 1_000_000, 256 * 1024 * 1024
KEPT_VERSIONS = 2
# Times a writer starts again because another one was first.
ATTEMPTS = 50


def _committed(spark: SparkSession, path: str) -> int:
    """The latest version, 0 if there is none."""
    return max(map(int, commits.claimed(spark, f"{path}/{COMMITS}")), default=0)


def _data_of(spark: SparkSession, path: str, version: int) -> DataFrame:
    """The rows of a version, which its commit names the folder of."""
    if not version:
        return spark.createDataFrame([], SCHEMA)
    writer = spark.read.text(f"{path}/{COMMITS}/{version:012d}").first()[0]
    return spark.read.schema(SCHEMA).parquet(f"{path}/{writer}").where(F.col(KEY).isNotNull())


def _commit(spark: SparkSession, path: str, version: int, writer: str) -> bool:
    """Whether ``writer`` is now the folder of ``version``; False if another one is already."""
    return commits.claim(spark, f"{path}/{COMMITS}", f"{version:012d}", writer)


def load_summaries(spark: SparkSession, path: str) -> DataFrame:
    """The latest version; a store that does not exist yet is an empty table."""
    return _data_of(spark, path, _committed(spark, path))


def save_summaries(summaries: DataFrame, path: str, keep: int = KEPT_VERSIONS) -> None:
    """Replace the content of the store. Every key must be there once, and none may be null.

    A new version is added beside the old ones, so ``summaries`` may itself come from the store; the
    newest ``keep`` versions stay. Of several writers at once, the last to commit decides.
    """
    _checked(summaries)
    _write(summaries.sparkSession, path, lambda _: summaries, keep)


def upsert_summaries(new: DataFrame, path: str, keep: int = KEPT_VERSIONS) -> None:
    """Set the summaries of the given keys, keep the others, also those that other writers set meanwhile."""
    _checked(new)
    _write(new.sparkSession, path, lambda old: merged(old, new), keep)


def _checked(summaries: DataFrame) -> None:
    counts = summaries.groupBy(KEY).agg(F.count(F.lit(1)).alias("n"))
    wrong = counts.where(F.col(KEY).isNull() | (F.col("n") > 1)).first()
    if wrong is not None:
        raise ValueError(f"{wrong['n']} summaries have the key {wrong[KEY]}")


def _write(spark: SparkSession, path: str, content: Callable[[DataFrame], DataFrame], keep: int) -> None:
    """Commit ``content`` of the latest version as the next one; where another writer was first, start again from
    what that one has committed. Rows lie in a folder of their own, so nobody sees those of a commit that failed."""
    for _ in range(ATTEMPTS):
        base = _committed(spark, path)
        writer = f"version={base + 1:012d}-{uuid.uuid4().hex}"
        try:
            rows = content(_data_of(spark, path, base)).select(KEY, SUMMARY)
            # A row without a key, so that an empty table is a version as well.
            rows.unionByName(spark.createDataFrame([(None, None)], SCHEMA)).write.parquet(f"{path}/{writer}")
        except Exception:
            if _committed(spark, path) == base:
                raise
            continue  # others have committed so often that the base is gone
        if _commit(spark, path, base + 1, writer):
            _drop_versions(spark, path, base + 1 - max(1, keep))
            return
        commits.remove(spark, f"{path}/{writer}")
    raise RuntimeError(f"{ATTEMPTS} other versions of {path} were committed first")


def _drop_versions(spark: SparkSession, path: str, last: int) -> None:
    """Remove the commits up to version ``last`` and the folders that were written for them."""
    folder, files = commits.folder_of(spark, path)
    listed, _ = commits.folder_of(spark, f"{path}/{COMMITS}")
    for status in [*files.listStatus(listed), *files.listStatus(folder)]:
        name = status.getPath().getName()
        number = name if name.isdigit() else name.removeprefix("version=").split("-")[0]
        if number.isdigit() and int(number) <= last:
            files.delete(status.getPath(), True)


def merged(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows of ``new``, and those of ``old`` whose key is not among them."""
    return old.join(new, KEY, "left_anti").select(KEY, SUMMARY).unionByName(new.select(KEY, SUMMARY))


def load_summaries_json(spark: SparkSession, path: str) -> DataFrame:
    """One JSON object ``{category_key: text}``; a missing file is an empty table, a broken one an error."""
    try:
        text = spark.read.text(path, wholetext=True)
    except AnalysisException as error:
        if path_is_missing(error):
            return spark.createDataFrame([], SCHEMA)
        raise
    entries = F.from_json("value", "map<string,string>", {"mode": "FAILFAST"})
    return text.select(F.explode(entries).alias(KEY, SUMMARY))


def save_summaries_json(
    summaries: DataFrame,
    path: str,
    mode: str = "overwrite",
    max_rows: int = JSON_ROWS,
    max_bytes: int = JSON_BYTES,
) -> None:
    """The table as one JSON object. That is a single value in one task, so a larger table is refused."""
    summaries = summaries.select(KEY, SUMMARY)
    length = F.coalesce(F.octet_length(KEY), F.lit(0)) + F.coalesce(F.octet_length(SUMMARY), F.lit(0))
    size = summaries.agg(F.count(F.lit(1)).alias("rows"), F.sum(length).alias("bytes")).first()
    if size["rows"] > max_rows or (size["bytes"] or 0) > max_bytes:
        raise ValueError("too many summaries for one JSON object; use save_summaries")
    entry = F.struct(KEY, SUMMARY)
    as_object = F.to_json(F.map_from_entries(F.sort_array(F.collect_list(entry))))
    summaries.agg(as_object.alias("value")).write.mode(mode).text(path)


def summaries_for(spark: SparkSession, summaries: DataFrame, categories: Sequence[str]) -> DataFrame:
    """Every given category with its key and stored text, empty where there is none."""
    wanted = spark.createDataFrame([(c,) for c in categories], "meta_category string")
    return (
        wanted.withColumn(KEY, category_key("meta_category"))
        .join(summaries, KEY, "left")
        .select("meta_category", KEY, F.coalesce(SUMMARY, F.lit("")).alias(SUMMARY))
    )
