from starloom.functions.columns import (
    argmax,
    category_key,
    decode_sentiment,
    encode_sentiment,
    look_up,
    model_label_sentiment,
    named,
    seeded_hash,
    sentiment_of,
    short_name,
    strip,
    thousands,
    truncate_tokens,
    two_decimals,
)
from starloom.functions.prompts import category_prompt

__all__ = [
    "argmax",
    "category_key",
    "category_prompt",
    "decode_sentiment",
    "encode_sentiment",
    "look_up",
    "model_label_sentiment",
    "named",
    "seeded_hash",
    "sentiment_of",
    "short_name",
    "strip",
    "thousands",
    "truncate_tokens",
    "two_decimals",
]
