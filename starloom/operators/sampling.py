"""Reproducible samples and splits, decided per row from a hash of seed and id."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from starloom.fixed_values import REVIEW_ID, SENTIMENT
from starloom.functions.columns import named, seeded_hash
from starloom.operators.bounded import small_side

# Hex digits of the hash by which rows are counted: 4,096 groups per class, few enough for each
# partition to combine its rows well. If the one that holds a class's last row is too large to be
# ranked, its rows are counted again by four more digits.
COARSE_DIGITS = 3
FINE_DIGITS = 7
# Rows of one class that are ranked in one task to place its cut.
EDGE_ROWS = 1_000_000
# Copies of one row that one task writes out again.
COPY_CHUNK = 1_000_000


def balance_classes(
    df: DataFrame,
    label_col: str = SENTIMENT,
    n_per_class: int | None = None,
    seed: int = 42,
    id_col: str = REVIEW_ID,
    edge_rows: int = EDGE_ROWS,
) -> DataFrame:
    """Exactly ``min(n, class size)`` rows of every class; ``n`` is the smallest class by default.

    The rows with the smallest seeded hash of their id are taken, so the sample is the same however
    the table is partitioned. No class is sorted for that: counts per hash prefix tell in which
    prefix the n-th row lies, and only the rows there are ranked. Those passes read label and id
    alone, but for rows without an id, and run when this is called. The sample itself is a filter on the cut of the class, so
    whole rows are not shuffled. Rows without a label belong to no class.
    """
    if n_per_class is not None and n_per_class < 0:
        raise ValueError("n_per_class must not be negative")
    labelled = df.where(named(label_col).isNotNull())
    if n_per_class == 0:
        return labelled.limit(0)
    missing = has_missing(labelled, id_col)
    keyed = _keyed(labelled, label_col, seed, id_col, missing)
    cuts = _cuts(keyed, n_per_class, edge_rows)
    if cuts.isEmpty():
        raise ValueError(f"no row has a label in {label_col}")

    columns = [named(c) for c in df.columns]
    identity = row_identity(labelled, id_col, missing)
    hashed = seeded_hash("sample", seed, identity)
    marked = labelled.withColumns({"_label": named(label_col), "_hash": hashed}).join(
        cuts, "_label"
    )
    here, last = F.struct("_hash", identity), F.struct("_last_hash", "_last_id")
    if cuts.where("_spare > 0").isEmpty():
        return marked.where(F.col("_last_hash").isNull() | (here <= last)).select(*columns)
    # The cut falls between rows with one and the same id.
    clear = marked.where(F.col("_last_hash").isNull() | (here < last)).select(*columns)
    return clear.unionByName(_some_copies(marked.where(here == last), df.columns))


def has_missing(df: DataFrame, column: str) -> bool:
    """Whether a row has no value there: a pass over that column, which skips files that hold no nulls."""
    return not df.where(named(column).isNull()).isEmpty()


def row_identity(df: DataFrame, id_col: str = REVIEW_ID, missing: bool = True) -> Column:
    """The id as text. A row without one goes by its content, so that such rows spread like any other and
    only equal rows share a place. Where no id is ``missing``, no other column is read."""
    known = named(id_col).cast("string")
    return F.coalesce(known, _content(df)) if missing else known


def _content(df: DataFrame) -> Column:
    fields = [named(f.name) for f in df.schema.fields if not isinstance(f.dataType, T.MapType)]
    return F.concat(F.lit("row "), F.hex(F.xxhash64(*fields)))


def _keyed(df: DataFrame, label_col: str, seed: int, id_col: str, missing: bool) -> DataFrame:
    """(_label, _id, _hash) of each row. Rows without an id are a branch of their own, so that the others are read
    by label and id alone."""
    known = df.where(named(id_col).isNotNull()).select(
        named(label_col).alias("_label"), named(id_col).cast("string").alias("_id")
    )
    if missing:
        content = _content(df).alias("_id")
        known = known.unionByName(
            df.where(named(id_col).isNull()).select(named(label_col).alias("_label"), content)
        )
    return known.withColumn("_hash", seeded_hash("sample", seed, F.col("_id")))


def _cuts(keyed: DataFrame, n: int | None, edge_rows: int) -> DataFrame:
    """Hash and id of the last sampled row per class, null for a class that stays whole.

    Of the rows with that very id, ``_tie_need`` are in the sample and ``_spare`` are not.
    """
    counts = _prefix_counts(keyed, COARSE_DIGITS)
    if n is None:
        sizes = counts.groupBy("_label").agg(F.sum("_rows").alias("_size"))
        need = sizes.agg(F.min("_size")).scalar()
    else:
        need = F.lit(n).cast("long")
    prefixes, _ = small_side(_prefix_of_nth_row(counts, need))
    if not prefixes.where(F.col("_in_prefix") > edge_rows).isEmpty():
        counts = _prefix_counts(_at_prefix(keyed, prefixes), FINE_DIGITS, "_need")
        finer = _prefix_of_nth_row(counts, F.col("_need"))
        prefixes, _ = small_side(prefixes.where("_prefix IS NULL").unionByName(finer))

    # Rows of one id count as one here, so a group of copies is never gathered.
    edge = (
        _at_prefix(keyed, prefixes)
        .groupBy("_label", "_need", "_hash", "_id")
        .agg(F.count(F.lit(1)).alias("_ties"))
    )
    upto = F.sum("_ties").over(_running("_hash", "_id"))
    last = edge.withColumn("_upto", upto).where(_crosses(F.col("_need"), F.col("_ties")))
    last = last.select(
        "_label",
        F.col("_hash").alias("_last_hash"),
        F.col("_id").alias("_last_id"),
        (F.col("_need") - F.col("_upto") + F.col("_ties")).alias("_tie_need"),
        (F.col("_upto") - F.col("_need")).alias("_spare"),
    )
    return small_side(prefixes.select("_label").join(last, "_label", "left"))[0]


def _running(*order: str | Column) -> Window:
    window = Window.partitionBy("_label").orderBy(*order)
    return window.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def _crosses(need: Column, rows: Column) -> Column:
    """Whether the row numbered ``need`` is among these ``rows``, the last of which is ``_upto``."""
    return (F.col("_upto") >= need) & (F.col("_upto") - rows < need)


def _prefix_counts(keyed: DataFrame, digits: int, *carry: str) -> DataFrame:
    prefix = F.substring("_hash", 1, digits).alias("_prefix")
    return keyed.groupBy("_label", prefix, *carry).agg(F.count(F.lit(1)).alias("_rows"))


def _prefix_of_nth_row(counts: DataFrame, need: Column) -> DataFrame:
    """Per class the prefix with its row number ``need``, and how many rows to take from there."""
    upto = F.sum("_rows").over(_running("_prefix"))
    cut = F.struct(
        F.col("_prefix"),
        (need - F.col("_upto") + F.col("_rows")).alias("_need"),
        F.col("_rows").alias("_in_prefix"),
    )
    return (
        counts.withColumn("_upto", upto)
        .withColumn("_cut", F.when(_crosses(need, F.col("_rows")), cut))
        .groupBy("_label")
        .agg(F.max("_cut").alias("_cut"))
        .select("_label", "_cut._prefix", "_cut._need", "_cut._in_prefix")
    )


def _at_prefix(keyed: DataFrame, prefixes: DataFrame) -> DataFrame:
    wanted = prefixes.where("_prefix IS NOT NULL").select("_label", "_prefix", "_need")
    return (
        keyed.join(wanted, "_label")
        .where(F.startswith("_hash", "_prefix"))
        .drop("_prefix")
    )


def _some_copies(tied: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``_tie_need`` of the rows of one id per class, counted as groups of equal rows."""
    copies = tied.groupBy("_label", "_tie_need", *[named(c) for c in columns]).agg(
        F.count(F.lit(1)).alias("_rows")
    )
    upto = F.sum("_rows").over(_running(F.xxhash64(*[named(c) for c in columns])))
    left = F.col("_tie_need") - F.col("_upto") + F.col("_rows")
    taken = copies.withColumn("_upto", upto).withColumn("_take", F.least("_rows", left))
    starts = F.sequence(F.lit(0).cast("long"), F.col("_take") - 1, F.lit(COPY_CHUNK).cast("long"))
    chunks = taken.where("_take > 0").withColumn("_start", F.explode(starts))
    size = F.least(F.lit(COPY_CHUNK).cast("long"), F.col("_take") - F.col("_start"))
    return (
        chunks.repartition("_label", "_start")
        .withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), size)))
        .select(*[named(c) for c in columns])
    )


def in_test_split(test_size: float, seed: int = 42, id_col: str | Column = REVIEW_ID) -> Column:
    """Whether a row belongs to the test part: its hash lies in the first ``test_size`` of all."""
    if not 0 <= test_size <= 1:
        raise ValueError("test_size must lie between 0 and 1")
    first_eight = F.substring(seeded_hash("split", seed, id_col), 1, 8)
    place = F.conv(first_eight, 16, 10).cast("long")
    return place < F.lit(round(test_size * 2**32)).cast("long")


def train_test_split(
    df: DataFrame, test_size: float = 0.3, seed: int = 42, id_col: str = REVIEW_ID
) -> tuple[DataFrame, DataFrame]:
    """Two parts that together are the table; sizes are close to, not exactly, ``test_size``."""
    identity = row_identity(df, id_col, has_missing(df, id_col))
    in_test = in_test_split(test_size, seed, identity)
    return df.where(~in_test), df.where(in_test)


def concat(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Stack tables by column name; a column that one of them lacks is null there."""
    for other in others:
        first = first.unionByName(other, allowMissingColumns=True)
    return first
