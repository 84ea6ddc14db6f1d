"""Text cleaning, typed casts, exact decimal arithmetic and keys."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, WindowSpec
from pyspark.sql import functions as F

# Fixed value: stands in for a null part of a surrogate key, so that keys equal
# the ones already published downstream.
NULL_KEY_PART = "_dbt_utils_surrogate_key_null_"

# Operand type of exact ratios. Dividing two of these keeps 18 decimal places.
EXACT = "decimal(20,4)"


def blank_to_null(text: Column) -> Column:
    """Trim spaces; what is then empty becomes null."""
    return F.nullif(F.trim(text), F.lit(""))


def clean_string(text: Column, case: str = "lower") -> Column:
    """Trimmed text in lower, upper or unchanged ("none") case, blank as null."""
    if case == "lower":
        text = F.lower(text)
    elif case == "upper":
        text = F.upper(text)
    elif case != "none":
        raise ValueError(f"case must be lower, upper or none, not {case!r}")
    return blank_to_null(text)


def text_as(text: Column, data_type: str) -> Column:
    """Cast messy text; blanks are null, malformed text fails the job (ANSI cast)."""
    return blank_to_null(text).cast(data_type)


def in_vocabulary(text: Column, words: Sequence[str], default: str) -> Column:
    """Lower-cased text if it is one of `words`, else `default` (also for null)."""
    word = clean_string(text)
    return F.when(word.isin(*words), word).otherwise(F.lit(default))


def choose(cases: Sequence[tuple[Column, str]], default: str) -> Column:
    """First label whose condition is true."""
    (condition, label), *rest = cases
    out = F.when(condition, F.lit(label))
    for condition, label in rest:
        out = out.when(condition, F.lit(label))
    return out.otherwise(F.lit(default))


def rank_code(text: Column, ranks: Mapping[str, int], default: int) -> Column:
    """Integer rank of an upper-cased code; unknown codes and null get `default`."""
    code = F.upper(F.trim(text))
    return F.coalesce(*[F.when(code == name, F.lit(rank)) for name, rank in ranks.items()], F.lit(default))


def null_if_negative(number: Column) -> Column:
    """Reject the value, keep the row."""
    return F.when(number >= 0, number)


def safe_ratio(part: Column, whole: Column, digits: int) -> Column:
    """part / whole rounded half up; null when the divisor is zero or null."""
    return F.round(part.cast(EXACT) / F.nullif(whole.cast(EXACT), F.lit(0).cast(EXACT)), digits)


def exact_mean(number: Column, digits: int, over: WindowSpec | None = None) -> Column:
    """Mean of a decimal column, rounded once.

    avg() of a decimal(12,2) keeps six places, so rounding it to two can round
    twice; sum / count keeps eighteen.
    """
    total, n = F.sum(number), F.count(number)
    if over is not None:
        total, n = total.over(over), n.over(over)
    return F.round(total / F.nullif(n, F.lit(0)), digits)


def moment(clock: datetime) -> Column:
    """Literal zone-less time; F.lit(datetime) would be an instant, shown in the session's zone."""
    return F.lit(clock.isoformat(sep=" ")).cast("timestamp_ntz")


def month_of(moment: Column) -> Column:
    """First day of the month, as a date; free of the session time zone."""
    return F.trunc(moment, "MM")


def seconds_between(earlier: Column, later: Column) -> Column:
    """Whole seconds from earlier to later; free of the session time zone."""
    return (later - earlier).cast("interval second").cast("bigint")


def surrogate_key(*parts: Column) -> Column:
    """md5 over the text of the parts, nulls included."""
    return F.md5(F.concat_ws("-", *[F.coalesce(p.cast("string"), F.lit(NULL_KEY_PART)) for p in parts]))
