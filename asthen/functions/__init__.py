"""Column expressions; every function takes and returns native Columns."""

from asthen.functions.columns import (
    blank_to_null,
    choose,
    clean_string,
    exact_mean,
    in_vocabulary,
    moment,
    month_of,
    null_if_negative,
    rank_code,
    safe_ratio,
    seconds_between,
    surrogate_key,
    text_as,
)

__all__ = [
    "blank_to_null",
    "choose",
    "clean_string",
    "exact_mean",
    "in_vocabulary",
    "moment",
    "month_of",
    "null_if_negative",
    "rank_code",
    "safe_ratio",
    "seconds_between",
    "surrogate_key",
    "text_as",
]
