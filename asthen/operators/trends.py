"""Movement between periods, rolling frames and baselines.

The windows run on one row per key and day or month, so a key's group is bounded by
the calendar. Never use them on raw readings.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from asthen.functions import choose, exact_mean, safe_ratio


def in_order(key: str, order: str) -> WindowSpec:
    return Window.partitionBy(key).orderBy(order)


def trailing(key: str, order: str, rows: int) -> WindowSpec:
    """The current row and the rows - 1 before it; a missing day stretches the span."""
    return in_order(key, order).rowsBetween(1 - rows, 0)


def rolling_mean(value: str, key: str, order: str, rows: int, digits: int) -> Column:
    return exact_mean(F.col(value), digits, trailing(key, order, rows))


def rolling_max(value: str, key: str, order: str, rows: int) -> Column:
    return F.max(value).over(trailing(key, order, rows))


def baseline(value: str, key: str, order: str) -> Column:
    """The key's first value; null for good if that first value is null."""
    return F.first(value, ignorenulls=False).over(in_order(key, order))


def vs_baseline(value: str, baseline_value: str, digits: int = 4) -> Column:
    return safe_ratio(F.col(value), F.col(baseline_value), digits)


def movement(
    df: DataFrame, key: str, order: str, value: str, previous: str, change: str
) -> DataFrame:
    """Add the previous period's value and the difference to it."""
    before = F.lag(value).over(in_order(key, order))
    return df.withColumns({previous: before, change: F.col(value) - before})


def trend_label(previous: str, change: str) -> Column:
    return choose(
        [
            (F.col(previous).isNull(), "baseline"),
            (F.col(change) > 0, "growing"),
            (F.col(change) < 0, "shrinking"),
        ],
        "stable",
    )
