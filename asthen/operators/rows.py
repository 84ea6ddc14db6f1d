"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_in_order(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row of each key in the given order.

    Filtering row_number() = 1 lets Spark plan a WindowGroupLimit on both sides of
    the shuffle: each map task ships at most one row per key, so a key that holds a
    large part of the table never travels to one task.
    """
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col("_rank") == 1).drop("_rank")


def latest_per_key(
    df: DataFrame, keys: Sequence[str], by: Sequence[str], tie: Sequence[str] = ()
) -> DataFrame:
    """Row with the largest `by`; a null counts as largest. `tie` makes the order total."""
    return first_in_order(df, keys, [F.col(c).desc_nulls_first() for c in (*by, *tie)])


def earliest_per_key(
    df: DataFrame, keys: Sequence[str], by: Sequence[str], tie: Sequence[str] = ()
) -> DataFrame:
    """Row with the smallest `by`; a null counts as largest. `tie` makes the order total."""
    return first_in_order(df, keys, [F.col(c).asc_nulls_last() for c in (*by, *tie)])


def drop_flagged(df: DataFrame, flag: str) -> DataFrame:
    """Remove rows whose boolean flag is true; a null flag keeps the row."""
    return df.filter(~F.coalesce(F.col(flag), F.lit(False)))


def latest_since(
    df: DataFrame, keys: Sequence[str], by: str, at: str, since: Column, tie: Sequence[str] = (),
    at_day: str | None = None, by_day: str | None = None,
) -> DataFrame:
    """latest_per_key(df) restricted to rows with at >= since, without ranking all history.

    A row outside the period matters only where it is a later version of a key seen
    inside it, so its `by` is null or at least the smallest `by` inside the period.
    Everything else is dropped before the shuffle; the minimum is a scalar subquery.

    A table partitioned by the days of `at` and `by` names them in `at_day` and `by_day`:
    the period and its rivals are then whole partitions, and nothing else is read.
    """
    inside = F.col(at) >= since
    days = F.col(at_day) >= F.to_date(since) if at_day else F.lit(True)
    # A null `by` counts as largest, so it can be left out of the minimum; with only
    # nulls inside, rows outside can win through a null of their own.
    floor = df.filter(days & inside).agg(F.min(by)).scalar()
    rivals = df.filter(inside | F.col(by).isNull() | (F.col(by) >= floor))
    if at_day and by_day:
        rivals = rivals.filter(days | F.col(by_day).isNull() | (F.col(by_day) >= F.to_date(floor)))
    return latest_per_key(rivals, keys, [by], tie).filter(inside)
