"""Answers held to options, against the distance of every pair."""

import itertools
import random

import pytest

from starloom.operators.closest import closest_options, hold_to_options


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def plain(answers, options, distance):
    out = {}
    for a in answers:
        best = min(edits(a, o) for o in options)
        near = [o for o in options if edits(a, o) == best]
        if best <= distance and len(near) == 1:
            out[a] = (near[0], best)
    return out


@pytest.mark.parametrize("distance", [0, 1, 2, 3])
def test_closest_against_all_pairs(spark, distance):
    """All texts of up to three letters, and random longer ones, so that there are many ties and empty texts."""
    short = ["".join(p) for n in range(4) for p in itertools.product("ab", repeat=n)]
    draw = random.Random(distance)
    texts = short + ["".join(draw.choices("abc", k=draw.randint(4, 9))) for _ in range(60)]
    options = sorted(set(texts[::4] + ["petsupplies", "ä" * 5, "abcabcabc"]))
    answers = sorted({*texts, "petsuplies", "petsupplyes", "ä" * 4, "q" * 5000})
    rows = lambda values, name: spark.createDataFrame([(v,) for v in values], f"{name} string")
    found = closest_options(rows([*answers, None], "answer"), rows([*options, None, options[0]], "option"), distance)
    assert {r["answer"]: (r["option"], r["distance"]) for r in found.collect()} == plain(answers, options, distance)


def test_rows_stay_and_answers_are_kept(spark):
    said = ["Pet Supplies", "pet-supplies.", "'Pet Suplies'", "Toys", "Toyz", "Boys", None, "", "I think it is Toys, as in the text."]
    mapping = spark.createDataFrame(list(enumerate(said)), "categories long, meta_category string")
    held = hold_to_options(mapping, ["Pet Supplies", "Toys", "Boy"])
    rows = {r["categories"]: (r["answer"], r["meta_category"]) for r in held.collect()}
    expected = ["Pet Supplies", "Pet Supplies", "Pet Supplies", "Toys", "Toys", None, None, None, None]
    assert rows == {i: (a, e) for i, (a, e) in enumerate(zip(said, expected, strict=True))}


def test_equal_plain_forms_and_no_options(spark):
    mapping = spark.createDataFrame([("x", "a b"), ("y", "c")], "categories string, meta_category string")
    rows = hold_to_options(mapping, ["A b", "a-B", "c"]).collect()
    assert {r["categories"]: r["meta_category"] for r in rows} == {"x": None, "y": "c"}
    assert {r["meta_category"] for r in hold_to_options(mapping, []).collect()} == {None}
    assert hold_to_options(mapping.limit(0), ["c"]).count() == 0
