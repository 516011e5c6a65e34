"""Quality rules: an isolation forest on rule statistics.

``rule_statistics`` takes each whole text once and gives small rows; the forest is fitted on a bounded
sample of labelled rows (``TREES * TREE_ROWS`` good and ``BAD_SHARE`` of it bad ones), and its threshold is
calibrated on all labelled rows, through a histogram of scores.

Defined cases: a null or empty text has no words and all its statistics are 0; repeated ids are kept as
separate rows; a label that is neither 0 nor 1 counts as none; with contradicting labels the lower one
holds; without any labelled row of quality 1 nothing can be isolated and only the base rule decides.
Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from starloom.llm.words import chunks, filled, split_words, sums

TREES, TREE_ROWS, SEED = 100, 256, 7
# Labelled bad rows in the sample. Few, so that a split sets them apart; but some, as a statistic that all
# good rows share is never split on.
BAD_SHARE = 0.02
BINS = 2000
# At most this share of the labelled good rows may be called anomalous.
GOOD_LOSS = 0.001

# Text that one step takes.
STEP_BYTES = 1 << 20

COUNTS = [
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_distinct", "n_lines",
    "n_upper", "n_digits", "n_marks",
]
STATISTICS = "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS)


def rule_statistics(docs: DataFrame) -> DataFrame:
    """One row of counts per document of (doc_id, text)."""
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        _statistics, STATISTICS
    )


def _statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for chunk in chunks(batches, max_bytes=STEP_BYTES):
        columns = text_counts(chunk.column("text"))
        arrays = [chunk.column("doc_id"), *(pa.array(columns[c], pa.int64()) for c in COUNTS)]
        yield pa.RecordBatch.from_arrays(arrays, ["doc_id", *COUNTS])


def text_counts(texts: pa.Array) -> dict[str, np.ndarray]:
    texts = filled(texts)
    words = split_words(texts)
    n_texts = len(texts)
    chars = pc.utf8_length(words.dictionary).to_numpy()
    owner = words.owner
    distinct = np.unique(owner * max(1, len(words.dictionary)) + words.codes)
    found = {
        "n_words": words.counts,
        "word_chars": sums(chars[words.codes], words.starts),
        "n_repeat_words": sums(_repeated(words.codes, owner, len(chars)), words.starts),
        "n_distinct": np.bincount(distinct // max(1, len(words.dictionary)), minlength=n_texts),
    }
    for name, pattern in (
        ("n_symbols", r"[#*$%&|<>]"),
        ("n_upper", r"\p{Lu}"),
        ("n_digits", r"[0-9]"),
        ("n_marks", r"[!?]"),
    ):
        found[name] = pc.count_substring_regex(texts, pattern).to_numpy()
    lists = pc.split_pattern(texts, "\n")
    lines = lists.flatten().dictionary_encode()
    worded = pc.not_equal(pc.ascii_trim_whitespace(lines.dictionary), "").to_numpy(zero_copy_only=False)
    codes = lines.indices.to_numpy()
    owner = np.repeat(np.arange(n_texts), np.diff(lists.offsets.to_numpy()))
    real = worded[codes]
    owner, codes = owner[real].astype(np.int64), codes[real]
    found["n_lines"] = np.bincount(owner, minlength=n_texts)
    once = np.unique(owner * max(1, len(lines.dictionary)) + codes) // max(1, len(lines.dictionary))
    found["n_dup_lines"] = found["n_lines"] - np.bincount(once, minlength=n_texts)
    return found


def _repeated(codes: np.ndarray, owner: np.ndarray, n_codes: int) -> np.ndarray:
    """Whether each word is in a 3-word window that its text has twice or more."""
    covered = np.zeros(len(codes), dtype=np.int64)
    if len(codes) < 3:
        return covered
    codes = codes.astype(np.int64)
    pairs = codes[:-1] * n_codes + codes[1:]
    if n_codes >= 1 << 21:  # the product of three would not fit
        pairs = np.unique(pairs, return_inverse=True)[1]
    windows = pairs[:-1] * n_codes + codes[2:]
    start = np.flatnonzero(owner[:-2] == owner[2:])
    start = start[np.argsort(windows[start], kind="stable")]
    same = (windows[start[1:]] == windows[start[:-1]]) & (owner[start[1:]] == owner[start[:-1]])
    again = np.concatenate([start[1:][same], start[:-1][same]])
    for step in range(3):
        covered[again + step] = 1
    return covered


def features(counts: dict[str, np.ndarray]) -> np.ndarray:
    """Rows of rule statistics as shares, which do not grow with the length of a text."""
    n = {k: np.asarray(v, dtype=np.float64) for k, v in counts.items()}
    words, chars = np.maximum(1, n["n_words"]), np.maximum(1, n["word_chars"])
    return np.column_stack(
        [
            n["word_chars"] / words,
            n["n_symbols"] / words,
            n["n_dup_lines"] / np.maximum(1, n["n_lines"]),
            n["n_repeat_words"] / words,
            # The share of new words falls with the length, about as a power of it.
            np.log(np.maximum(1, n["n_distinct"])) / np.log(np.maximum(2, n["n_words"])),
            n["n_upper"] / chars,
            n["n_digits"] / chars,
            n["n_marks"] / words,
        ]
    )


def telling(good: np.ndarray, bad: np.ndarray, good_loss: float = GOOD_LOSS, least: float = 0.1) -> np.ndarray:
    """The statistics that more than ``least`` of the bad rows have above nearly all good ones; all
    statistics where none tells, or where nothing bad is known. The others vary among good texts, and
    would set odd but good rows apart."""
    every = np.arange(good.shape[1])
    if not len(bad):
        return every
    found = np.flatnonzero((bad > np.quantile(good, 1 - good_loss, axis=0)).mean(axis=0) > least)
    return found if len(found) else every


class Forest:
    """Isolation trees as flat arrays: split feature (-1: leaf), cut, left child and leaf depth."""

    def __init__(self, rows: np.ndarray, trees: int = TREES, tree_rows: int = TREE_ROWS, seed: int = SEED):
        random = np.random.default_rng(seed)
        self.size = min(tree_rows, len(rows))
        self.trees = []
        for _ in range(trees):
            chosen = rows[random.choice(len(rows), self.size, replace=False)]
            self.trees.append(_grow(chosen, int(np.ceil(np.log2(max(2, self.size)))), random))

    def scores(self, rows: np.ndarray) -> np.ndarray:
        """Anomaly score 0 to 1: 2 to the power of minus the mean path length over its expectation."""
        total = np.zeros(len(rows))
        for feature, cut, left, depth in self.trees:
            node = np.zeros(len(rows), dtype=np.int64)
            active = np.flatnonzero(feature[node] >= 0)
            while len(active):
                at = node[active]
                node[active] = left[at] + (rows[active, feature[at]] >= cut[at])
                active = active[feature[node[active]] >= 0]
            total += depth[node]
        return np.exp2(-total / len(self.trees) / max(1.0, float(_expected(self.size))))


def _expected(n: np.ndarray | int) -> np.ndarray:
    """Mean path length of a failed search in a binary tree of n keys."""
    n = np.asarray(n, dtype=np.float64)
    m = np.maximum(2, n)
    return np.where(n < 2, 0.0, np.where(n == 2, 1.0, 2 * (np.log(m - 1) + np.euler_gamma) - 2 * (m - 1) / m))


def _grow(rows: np.ndarray, limit: int, random: np.random.Generator) -> tuple[np.ndarray, ...]:
    feature, cut, left, depth = [-1], [0.0], [0], [0.0]
    waiting = [(0, rows, 0)]
    while waiting:
        node, held, level = waiting.pop()
        low, high = held.min(axis=0), held.max(axis=0)
        usable = np.flatnonzero(high > low)
        if level >= limit or not len(usable):
            depth[node] = level + float(_expected(len(held)))
            continue
        f = int(random.choice(usable))
        at = random.uniform(low[f], high[f])
        right = held[:, f] >= at
        if right.all():  # the cut fell on the lowest value
            right = held[:, f] > low[f]
            at = held[right, f].min()
        feature[node], cut[node], left[node] = f, at, len(feature)
        for side in (held[~right], held[right]):
            waiting.append((len(feature), side, level + 1))
            for values, empty in ((feature, -1), (cut, 0.0), (left, 0), (depth, 0.0)):
                values.append(empty)
    return np.array(feature), np.array(cut), np.array(left), np.array(depth)


def base_failed() -> F.Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def clean_labels(labels: DataFrame, column: str = "quality") -> DataFrame:
    """One label per document, 0 or 1; the lower one where several differ."""
    return (
        labels.where(F.col("doc_id").isNotNull() & F.col(column).isin(0, 1))
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.min(column).cast("int").alias("label"))
    )


def judge(statistics: DataFrame, labels: DataFrame, good_loss: float = GOOD_LOSS) -> DataFrame:
    """``statistics`` with anomaly (double), base_failed and kept (boolean).

    ``statistics`` is read several times and should be a written table.
    """
    spark = statistics.sparkSession
    labelled = statistics.join(clean_labels(labels), "doc_id")
    order = F.xxhash64("doc_id", F.lit(SEED))
    wanted = {1: TREES * TREE_ROWS, 0: int(BAD_SHARE * TREES * TREE_ROWS)}
    usable = labelled.where(~base_failed()).select("label", "doc_id", *COUNTS)
    good, bad = (
        usable.where(F.col("label") == label).orderBy(order, *COUNTS).limit(n).toArrow()
        for label, n in wanted.items()
    )
    if good.num_rows < 2:
        scored = statistics.withColumn("anomaly", F.lit(0.0))
        return scored.withColumn("base_failed", base_failed()).withColumn("kept", ~base_failed())
    good, bad = features(_columns(good)), features(_columns(bad))
    used = telling(good, bad)
    sample = np.concatenate([good, bad[: max(1, int(BAD_SHARE * len(good)))]])
    forest = spark.sparkContext.broadcast(Forest(sample[:, used]))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            anomaly = forest.value.scores(features(_columns(batch))[:, used])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(anomaly)], [*batch.schema.names, "anomaly"]
            )

    def scored(rows: DataFrame) -> DataFrame:
        fields = ", ".join(f"{name} {kind}" for name, kind in rows.dtypes)
        return rows.mapInArrow(score, f"{fields}, anomaly double")

    histogram = (
        scored(labelled.where(~base_failed()))
        .groupBy(F.floor(F.col("anomaly") * BINS).cast("int").alias("bin"))
        .agg(F.sum("label").alias("good"), F.sum(1 - F.col("label")).alias("bad"))
        .collect()
    )
    threshold = calibrated([tuple(row) for row in histogram], good_loss)
    return (
        scored(statistics)
        .withColumn("base_failed", base_failed())
        .withColumn("kept", ~F.col("base_failed") & (F.col("anomaly") < threshold))
    )


def calibrated(histogram: list[tuple[int, int, int]], good_loss: float) -> float:
    """The lowest score from which rows are anomalous: of the cuts that lose no more than
    ``good_loss`` of the good rows, the highest that catches as many bad rows as any."""
    good = sum(row[1] for row in histogram)
    best, caught, lost, threshold = 0, 0, 0, 2.0
    for bin_, good_here, bad_here in sorted(histogram, reverse=True):
        lost, caught = lost + good_here, caught + bad_here
        if lost > good_loss * good:
            break
        if caught > best:
            best, threshold = caught, bin_ / BINS
    return threshold


def _columns(rows: pa.RecordBatch | pa.Table) -> dict[str, np.ndarray]:
    return {c: np.asarray(rows.column(c)) for c in COUNTS}
