"""Naive Bayes against plain counting."""

import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from starloom.operators import bounded, count_model as cm
from starloom.plans.training import main as train_main
from starloom.sources.reviews import save_csv

ROWS = [
    (1, "Good good lamp", "positive"),
    (1, "good; chair", "positive"),
    (2, "bad lamp", "negative"),
    (3, None, "neutral"),
    (4, "", "neutral"),
    (5, "it is", "neutral"),
    (6, "bad bad chair", "negative"),
    (None, "fine", "positive"),
    (7, "unlabelled", None),
    (8, "off the list", "other"),
]


def plain(rows, classes):
    """Weights and priors by the formula."""
    kept = [(t or "", c) for _, t, c in rows if c in classes]
    words = {c: Counter() for c in classes}
    for text, c in kept:
        words[c].update("".join(x if x.isalnum() else " " for x in text.lower()).split())
    vocabulary = set().union(*words.values())
    log = lambda a, b: math.floor(cm.SCALE * math.log(a / b))
    weights = {t: [log(words[c][t] + 1, words[c].total() + len(vocabulary)) for c in classes] for t in vocabulary}
    return weights, [log(sum(k == c for _, k in kept) + 1, len(kept) + len(classes)) for c in classes]


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(ROWS, "review_id long, `reviews.text` string, rating_sentiment string").repartition(3)


def test_weights_are_those_of_counting(rows):
    model = cm.fit_counts(rows)
    weights, priors = plain(ROWS, cm.SENTIMENTS)
    assert {r.term: r.weights for r in model.terms.collect()} == weights
    assert [(r.label, r.prior) for r in model.priors.orderBy("place").collect()] == list(zip(cm.SENTIMENTS, priors, strict=True))


@pytest.mark.parametrize("bound", [0, 50_000])
def test_predictions_in_place_and_reloaded(spark, rows, tmp_path, monkeypatch, bound):
    """Texts, ids and other columns stay; ties go to the first class; unknown words count for none."""
    monkeypatch.setattr(bounded.small_side, "__defaults__", (bound, bounded.MAX_BYTES))
    model = cm.fit_counts(rows)
    cm.save_counts(model, str(tmp_path / "m"))
    weights, priors = plain(ROWS, cm.SENTIMENTS)

    def best(text):
        known = [weights[w] for w in "".join(x if x.isalnum() else " " for x in (text or "").lower()).split() if w in weights]
        totals = [p + sum(w[i] for w in known) for i, p in enumerate(priors)]
        return cm.SENTIMENTS[totals.index(max(totals))]

    extra = rows.withColumns({"term": F.lit("x"), "weights": F.lit(1), "predicted_sentiment": F.lit("old")})
    for held in (model, cm.load_counts(spark, str(tmp_path / "m"))):
        found = cm.predict_counts(held, extra)
        assert sorted(found.columns) == sorted(extra.columns)
        assert Counter((r["review_id"], r["reviews.text"], r["predicted_sentiment"]) for r in found.collect()) == Counter(
            (i, t, best(t)) for i, t, _ in ROWS
        )


def test_training_reports_on_the_rest(spark):
    words = F.element_at(F.array(F.lit("awful broken"), F.lit("plain usual"), F.lit("great lovely")), (F.col("id") % 3 + 1).cast("int"))
    names = F.element_at(F.array(*map(F.lit, ("negative", "neutral", "positive"))), (F.col("id") % 3 + 1).cast("int"))
    table = spark.range(300).select(F.col("id").alias("review_id"), words.alias("reviews.text"), names.alias("rating_sentiment"))
    _, report = cm.train_counts(table)
    found = {r["label"]: r for r in report.collect()}
    assert found["accuracy"]["f1_score"] == 1.0 and 50 < found["accuracy"]["support"] < 130


def test_empty_and_one_class(spark, rows):
    model = cm.fit_counts(rows.limit(0))
    assert model.terms.count() == 0
    assert {r["predicted_sentiment"] for r in cm.predict_counts(model, rows).collect()} == {cm.SENTIMENTS[0]}
    assert cm.predict_counts(model, rows.limit(0)).count() == 0


def test_command_line(spark, rows, tmp_path, capsys):
    save_csv(rows.where("rating_sentiment IS NOT NULL").drop("review_id"), str(tmp_path / "rows.csv"))
    train_main(["--data", str(tmp_path / "rows.csv"), "--out", str(tmp_path / "model"), "--model", "counts"])
    assert "accuracy" in capsys.readouterr().out
    assert cm.load_counts(spark, str(tmp_path / "model")).priors.count() == 3


@pytest.mark.parametrize("size", [1, 4, 1000])
def test_blocks_of_texts_meet_a_large_vocabulary_by_term(spark, rows, monkeypatch, size):
    """The same predictions from blocks of any size as from a vocabulary in memory; no row per text and term."""
    model = cm.fit_counts(rows)
    held = [tuple(r) for r in cm.predict_counts(model, rows).collect()]
    monkeypatch.setattr(bounded.small_side, "__defaults__", (0, bounded.MAX_BYTES))
    monkeypatch.setattr(cm, "BLOCK_TOKENS", size)
    written = []
    monkeypatch.setattr(cm, "written_once", lambda df, name: written.append(name) or bounded.written_once(df, name))
    assert Counter(tuple(r) for r in cm.predict_counts(model, rows).collect()) == Counter(held)
    assert written == ["rows-to-score", "spoken-blocks"]
