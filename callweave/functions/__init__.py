from callweave.functions.values import (
    blank_to_null,
    canonical_flag,
    canonical_time,
    category,
    flag_or_false,
    published_flag,
    published_text,
    scrub_text,
    strict_time,
    table_time,
    strip,
    whole_number,
)

__all__ = [
    "blank_to_null",
    "canonical_flag",
    "canonical_time",
    "category",
    "flag_or_false",
    "published_flag",
    "published_text",
    "scrub_text",
    "strict_time",
    "strip",
    "whole_number",
]
