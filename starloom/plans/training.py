"""Train on a balanced review table from the command line.

    python -m starloom.plans.training --data <csv or parquet> --out <folder>

Data whose path ends in ``.csv`` is read as CSV, anything else as Parquet.
"""

from __future__ import annotations

import argparse

from starloom.operators.count_model import train_counts
from starloom.operators.text_model import train_sentiment
from starloom.session import build_session
from starloom.sources.reviews import load_reviews, load_table


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--data", required=True)
    parser.add_argument("--out", required=True)
    parser.add_argument("--test-size", type=float, default=0.3)
    parser.add_argument("--seed", type=int, default=42)
    parser.add_argument("--max-iter", type=int, default=30)
    parser.add_argument("--model", choices=["regression", "counts"], default="regression")
    given = parser.parse_args(arguments)

    spark = build_session("train-sentiment")
    if given.data.endswith(".csv"):
        balanced = load_reviews(spark, given.data)
    else:
        balanced = load_table(spark, given.data)
    shared = {"test_size": given.test_size, "seed": given.seed}
    if given.model == "counts":
        _, report = train_counts(balanced, given.out, **shared)
    else:
        _, report = train_sentiment(balanced, given.out, max_iter=given.max_iter, **shared)
    report.orderBy("label").show(truncate=False)


if __name__ == "__main__":
    main()
