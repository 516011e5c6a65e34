"""Texts that are handed to a model, filled as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from starloom.fixed_values import META_CATEGORIES
from starloom.functions.columns import named

# {cat} and {options} are filled in.
CATEGORY_TEMPLATE = (
    "Pick the one category out of {options} that fits the product category '{cat}'.\n"
    "Answer with the bare name from that list and with nothing else.\n"
    "A product category with 'Health & Beauty' or 'Health and Beauty' in it is Health & Beauty;"
    " a litter box belongs to Pet Supplies."
)


def category_prompt(
    category: str | Column,
    options: Sequence[str] | None = None,
    template: str = CATEGORY_TEMPLATE,
) -> Column:
    """The question for one raw category string."""
    quoted = ", ".join(f"'{option}'" for option in options or META_CATEGORIES)
    parts = template.replace("{options}", quoted).split("{cat}")
    pieces: list[Column] = [F.lit(parts[0])]
    for part in parts[1:]:
        pieces += [named(category).cast("string"), F.lit(part)]
    return F.concat(*pieces)
