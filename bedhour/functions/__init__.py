from .scalar import (
    age_years,
    col,
    contains_text,
    hour_ceil,
    hour_round,
    last_parenthesised,
    nan_to_null,
    positive_flag,
    sum_skip_null,
    to_number,
)

__all__ = [
    "age_years",
    "col",
    "contains_text",
    "hour_ceil",
    "hour_round",
    "last_parenthesised",
    "nan_to_null",
    "positive_flag",
    "sum_skip_null",
    "to_number",
]
