import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent.parent))

from starloom.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[8]",
        spark__sql__shuffle__partitions="8",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def review_csv():
    return str(Path(__file__).parent / "fixtures" / "reviews.csv")


@pytest.fixture(scope="session")
def ranked_reviews(spark):
    """Two categories; two products of the first tie on the number of reviews."""
    ratings = [
        ("Office", "Lamp", [3, 2, 4]),
        ("Bike", "Pump", [1]),
        ("Bike", "Lock", [5, 5]),
        ("Bike", "Helmet", [4, 4, 3, 5]),
        ("Office", "Chair", [2]),
        ("Bike", "Bell", [2, 3]),
    ]
    rows = [(c, n, float(r)) for c, n, stars in ratings for r in stars]
    return spark.createDataFrame(rows, "meta_category string, name string, `reviews.rating` double")
