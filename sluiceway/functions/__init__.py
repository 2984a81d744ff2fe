"""Column expressions shared by the layer transforms."""

from sluiceway.functions.columns import (
    WHITESPACE,
    clip_text,
    code_label,
    digits_to_date,
    enforce,
    fallback_label,
    lenient_date,
    lenient_timestamp,
    not_in_future,
    quotient,
    rank_text,
    repaired_price,
    repaired_sales,
    stamp,
    strip,
    without_prefix,
)

__all__ = [
    "WHITESPACE",
    "clip_text",
    "code_label",
    "digits_to_date",
    "enforce",
    "fallback_label",
    "lenient_date",
    "lenient_timestamp",
    "not_in_future",
    "quotient",
    "rank_text",
    "repaired_price",
    "repaired_sales",
    "stamp",
    "strip",
    "without_prefix",
]
