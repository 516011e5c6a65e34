"""Review tables as CSV and Parquet."""

from __future__ import annotations

import csv
from collections import Counter

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from starloom.fixed_values import META, NULL_TOKENS, RATING, REVIEW_ID
from starloom.functions.columns import named
from starloom.operators.bounded import small_side
from starloom.operators.cleaning import refuse_collisions
from starloom.sources import csv_blocks

# Quotes inside a field are doubled, and a field may run over several lines.
CSV_DIALECT = {"quote": '"', "escape": '"', "encoding": "UTF-8"}
# Columns that are read as numbers; every other column is text.
NUMERIC_COLUMNS = {RATING: "double"}


def load_reviews(
    spark: SparkSession,
    path: str,
    numeric: dict[str, str] | str | None = None,
    multi_line: bool = True,
    with_id: bool = True,
    blocks: bool | None = None,
) -> DataFrame:
    """A review CSV with its header as it stands.

    Columns are found by name, whatever their order, and missing-value tokens become null.
    ``numeric`` gives the types of number columns by lower-case name; text in them that is no number
    becomes null. ``"infer"`` reads the file once more to find the columns that hold only numbers. By
    default the rating is a number, and so is a ``review_id`` column that holds only whole numbers.

    A file with line breaks inside fields (``multi_line``) is read by one task, or in ``blocks`` by many, which
    gives the same rows; by default in blocks where a file is larger than one. Its lines are then read
    once more, to learn which blocks begin inside quotes. Lines of such files end with a line feed.

    ``with_id`` adds ``review_id``, the place of the row in the input, by file name and then by line,
    unless the file has that column. Rows are counted for it once more.
    """
    written, header = _header(spark, path)
    if multi_line and (_has_large_file(spark, path) if blocks is None else blocks):
        return _in_blocks(spark, path, header, numeric, with_id)
    schema = T.StructType([T.StructField(name, T.StringType()) for name in header])
    if written != header:
        _refuse_other_headers(spark, path)
    # Where names are unique, Spark holds the header of every file against the first one.
    raw = (
        spark.read.schema(schema)
        .options(**CSV_DIALECT)
        .option("header", True)
        .option("multiLine", multi_line)
        .option("enforceSchema", written != header)
        .csv(path)
    )
    cells = _cells(raw, header, numeric)
    if with_id and REVIEW_ID not in header:
        return _with_place(raw, cells)
    return raw.select(*cells)


def _cells(raw: DataFrame, header: list[str], numeric: dict[str, str] | str | None) -> list[Column]:
    """Columns without missing-value tokens, numbers as numbers."""
    present = {name: F.when(~named(name).isin(*NULL_TOKENS), named(name)) for name in header}
    if numeric == "infer":
        types = _number_types(raw, present)
    else:
        types = NUMERIC_COLUMNS if numeric is None else numeric
    if numeric is None and REVIEW_ID in header:
        found = _number_types(raw, {REVIEW_ID: present[REVIEW_ID]})
        if found.get(REVIEW_ID) == "bigint":
            types = types | found
    cells = []
    for name, cell in present.items():
        wanted = types.get(name.lower())
        cells.append((cell.try_cast(wanted) if wanted else cell).alias(name))
    return cells


def _has_large_file(spark: SparkSession, path: str) -> bool:
    """Whether a file is larger than a task's share; lists files and reads none."""
    setting = spark.conf.get("spark.sql.files.maxPartitionBytes")
    share = F.expr(f"CAST(regexp_extract('{setting}', '[0-9]+', 0) AS LONG)") * _UNIT[setting.rstrip("bB").lstrip("0123456789").lower()]
    sizes = spark.read.format("binaryFile").load(path).select("length")
    return not sizes.where(F.col("length") > share).isEmpty()


_UNIT = {"": 1, "k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40}


def _in_blocks(
    spark: SparkSession, path: str, header: list[str], numeric: dict[str, str] | str | None, with_id: bool
) -> DataFrame:
    found, firsts = csv_blocks.records(spark, path)
    plain = F.regexp_replace(F.col("first"), "^\ufeff|\r$", "")
    if firsts.select(plain).distinct().limit(2).count() > 1:
        raise ValueError(f"files under {path} have different headers")
    fields = ", ".join("`" + name.replace("`", "``") + "` string" for name in header)
    parsed = F.from_csv("record", fields, {**CSV_DIALECT, "multiLine": "true"})
    place = "_place" if "_place" not in header else "_place of the row"
    raw = found.select(parsed.alias("_row"), F.col("place").alias(place))
    raw = raw.select(*(F.col("_row").getField(name).alias(name) for name in header), place)
    cells = _cells(raw, header, numeric)
    if with_id and REVIEW_ID not in header:
        cells.append(named(place).alias(REVIEW_ID))
    return raw.select(*cells)


def _with_place(raw: DataFrame, cells: list[Column]) -> DataFrame:
    """``cells`` and the place of each row in the input, however files are packed into tasks.

    Rows are counted by block of a file; the blocks before it, and the rows before it in its own block,
    make the place of a row.
    """
    at = {
        "_file": F.col("_metadata.file_path"),
        "_start": F.col("_metadata.file_block_start"),
        "_row": F.monotonically_increasing_id(),
    }
    placed = [column.alias(name) for name, column in at.items()]
    blocks = (
        raw.select(*placed)
        .groupBy("_file", "_start")
        .agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    )
    earlier = Window.orderBy("_file", "_start").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before")
    # A row for each 128 MB or so of input.
    offsets, _ = small_side(blocks.select("_file", "_start", "_first", before))
    place = F.col("_before") + F.col("_row") - F.col("_first")
    joined = raw.select(*cells, *placed).join(offsets, ["_file", "_start"])
    names = [name for name in joined.columns if name not in (*at, "_first", "_before")]
    return joined.select(*map(named, names), place.alias(REVIEW_ID))


def _number_types(raw: DataFrame, present: dict[str, Column]) -> dict[str, str]:
    """Whole-number and number columns by lower-case name, from one pass over the text."""
    counts = []
    for i, cell in enumerate(present.values()):
        counts.append(F.count(cell).alias(f"text_{i}"))
        counts.append(F.count(cell.try_cast("bigint")).alias(f"bigint_{i}"))
        counts.append(F.count(cell.try_cast("double")).alias(f"double_{i}"))
    found = raw.agg(*counts).first()
    types = {}
    for i, name in enumerate(present):
        for kind in ("bigint", "double"):
            if name.lower() not in types and 0 < found[f"text_{i}"] == found[f"{kind}_{i}"]:
                types[name.lower()] = kind
    return types


def _refuse_other_headers(spark: SparkSession, path: str) -> None:
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("row")
    )
    headers = lines.groupBy("file").agg(F.min_by("value", "row").alias("header"))
    if headers.select("header").distinct().limit(2).count() > 1:
        raise ValueError(f"files under {path} have different headers")


def _header(spark: SparkSession, path: str) -> tuple[list[str], list[str]]:
    """Names of the first line, and the names of the columns: a repeated name gets a number, one that
    differs in case is refused."""
    first = spark.read.text(path).limit(1).collect()
    if not first:
        raise ValueError(f"no header in {path}")
    names = next(csv.reader([first[0][0].removeprefix("\ufeff")]))
    seen: Counter = Counter()
    unique = []
    for name in names:
        unique.append(f"{name}.{seen[name]}" if seen[name] else name)
        seen[name] += 1
    refuse_collisions(unique)
    return names, unique


def save_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """A CSV folder with headers that ``load_reviews`` reads back unchanged."""
    (
        df.write.mode(mode)
        .options(**CSV_DIALECT)
        .option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def save_table(
    df: DataFrame,
    path: str,
    mode: str = "errorifexists",
    by_category: bool = False,
    rebalance: bool | None = None,
) -> None:
    """Parquet; ``by_category`` gives every meta-category a folder that its filter alone reads.

    ``rebalance`` spends a shuffle on files of even size: adaptive execution then merges small partitions
    and splits those of a large category. It is the default by category, where each task would else
    write a file for each category.
    """
    if by_category if rebalance is None else rebalance:
        df = df.hint("rebalance", META) if by_category else df.hint("rebalance")
    writer = df.write.mode(mode)
    if by_category:
        writer = writer.partitionBy(META)
    writer.parquet(path)


def load_table(spark: SparkSession, path: str, keep: bool = False) -> DataFrame:
    """A Parquet review table, kept in memory and on disk for several reports with ``keep``."""
    df = spark.read.parquet(path)
    return df.persist() if keep else df


def path_is_missing(error: AnalysisException) -> bool:
    return error.getCondition() == "PATH_NOT_FOUND"
