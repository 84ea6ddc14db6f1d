"""Audits of stored Parquet tables that read no rows: from file footers and partition names."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from asthen.operators.quality import freshness
from asthen.sources.tables import newest_partition, read_table

_V1, _PUSH = "spark.sql.sources.useV1SourceList", "spark.sql.parquet.aggregatePushdown"


def footer_scan(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet table whose counts, and least and greatest whole numbers and dates, Spark takes from
    the files' footers where nothing is filtered."""
    before = spark.conf.get(_V1)
    spark.conf.set(_PUSH, "true")
    # which reader a table gets is settled here, once
    spark.conf.set(_V1, ",".join(s for s in before.split(",") if s.strip() != "parquet"))
    try:
        return spark.read.parquet(path)
    finally:
        spark.conf.set(_V1, before)


def stored_row_counts(spark: SparkSession, paths: Mapping[str, str]) -> DataFrame:
    """Row count of every stored table, by name, without decoding a column."""
    counts = [
        footer_scan(spark, path).agg(F.count("*").alias("n")).select(
            F.lit(name).alias("table_name"), F.greatest("n", F.lit(0)).alias("row_count")  # none without a file
        )
        for name, path in paths.items()
    ]
    return reduce(DataFrame.unionByName, counts).orderBy("table_name")


def stored_freshness(
    spark: SparkSession, path: str, table: str, loaded_at: str, day: str, as_of: Column, warn_hours: int, error_hours: int
) -> DataFrame:
    """`freshness` of a table stored by the day of its load time: only the newest day is read."""
    newest = newest_partition(spark, path, day)
    rows = read_table(spark, path)
    if newest is not None:
        rows = rows.filter(F.col(day) == F.lit(newest))
    return freshness(rows, table, loaded_at, as_of, warn_hours, error_hours)
