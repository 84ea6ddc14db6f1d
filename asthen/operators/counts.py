"""Distinct counts under conditions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def distinct_counts(
    df: DataFrame, by: Sequence[str], entity: str, total: str, under: Mapping[str, Column]
) -> DataFrame:
    """Distinct entities per group, in all and under each condition.

    One row per group and entity with a flag per condition comes first, then plain
    counts: Spark would otherwise copy every row once per distinct count. A null
    entity counts as nobody.
    """
    flags = df.groupBy(*by, entity).agg(*[F.bool_or(c).alias(name) for name, c in under.items()])
    known = F.col(entity).isNotNull()
    return flags.groupBy(*by).agg(
        F.count(entity).alias(total), *[F.count_if(known & F.col(name)).alias(name) for name in under]
    )
