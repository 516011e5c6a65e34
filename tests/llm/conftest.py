import pytest

from starloom.llm.words import table

SMALL = "/root/testdata/sf0.001"
# Names that operators use for columns of their own.
CLASHING = [
    "score", "key", "words", "fp", "row", "kept", "n_words", "block", "term", "label", "length", "ids", "part",
    "rank", "component_id", "said", "found", "gaps", "n", "train", "index", "value", "host", "path", "tokens",
]


@pytest.fixture(scope="session")
def small():
    return SMALL


@pytest.fixture(scope="session")
def documents(spark):
    return table(spark, SMALL, "documents")


def odd_texts():
    """Null, empty, blank and very long texts, ties and repeated rows."""
    prose = " ".join(f"word{i % 97} and{i % 31}" for i in range(40))
    return [
        (1, prose, "en"),
        (1, prose, "en"),
        (2, prose, "en"),
        (3, None, "en"),
        (4, "", None),
        (5, " \t\n ", "fr"),
        (6, "x" * 300_000, "fr"),
        (7, "long text " * 60_000, None),
        (8, "Ωμέγα ñ 漢字 \U0001f600 é", "el"),
        (None, prose, "en"),
        (None, None, None),
    ]


@pytest.fixture(scope="session")
def odd(spark):
    """Odd documents with further columns whose names operators use themselves."""
    rows = [(i, t, lang, None, None if t is None else len(t), *["clash"] * len(CLASHING)) for i, t, lang in odd_texts()]
    named = ", ".join(f"`{c}` string" for c in CLASHING)
    schema = f"doc_id long, text string, lang string, source string, n_chars long, {named}"
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture(scope="session")
def empty(spark, odd):
    return spark.createDataFrame([], odd.schema)


@pytest.fixture(scope="session")
def label_rows(spark):
    rows = [(1, 1, 0), (1, 0, 0), (2, 1, 0), (3, 0, 1), (6, 0, None), (None, 1, 0), (7, None, 0), (8, 5, 0), (99, 1, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
