"""Incremental rebuilds and type-2 history."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: newest day assumed for an empty target.
EMPTY_TARGET_DAY = "1900-01-01"


def lookback_start(target: DataFrame, day: str, days: int) -> DataFrame:
    """One row, `cutoff`: the target's newest day minus `days`, a midnight."""
    newest = F.coalesce(F.max(day), F.to_date(F.lit(EMPTY_TARGET_DAY)))
    return target.agg(F.date_sub(newest, days).alias("cutoff"))


def lookback_literal(target: DataFrame, day: str, days: int) -> Column:
    """The cutoff as a literal, so that scans prune partitions while planning."""
    return F.lit(lookback_start(target, day, days).first()["cutoff"])


def lookback_from(newest: date | None, days: int) -> Column:
    """The same cutoff where the newest day is known, from a table's partitions."""
    return F.lit((newest or date.fromisoformat(EMPTY_TARGET_DAY)) - timedelta(days=days))


def keyed_upsert(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Delete the target rows whose key is in the batch, insert the batch.

    Idempotent. A key that vanished from the source but is not in the batch stays.
    Columns only one side has are null on the other, so the schema only grows.
    """
    kept = target.join(batch.select(*keys), list(keys), "left_anti").select(*target.columns)
    return kept.unionByName(batch, allowMissingColumns=True)


def with_new_columns(target: DataFrame, source: DataFrame) -> DataFrame:
    """Append the columns only the source has, null for the rows already there."""
    new = {f.name: F.lit(None).cast(f.dataType) for f in source.schema if f.name not in target.columns}
    return target.withColumns(new) if new else target


def scd2_columns(key: str, updated_at: str) -> list[Column]:
    return [
        scd2_id(F.col(key), F.col(updated_at)).alias("scd_id"),
        F.col(updated_at).alias("valid_from"),
        F.lit(None).cast("timestamp_ntz").alias("valid_to"),
    ]


def scd2_id(key: Column, updated_at: Column) -> Column:
    """Id of a version. A key that returns with the same change time repeats its id."""
    return F.md5(F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("")) for c in (key, updated_at)]))


def scd2_first_load(source: DataFrame, key: str, updated_at: str) -> DataFrame:
    return source.select("*", *scd2_columns(key, updated_at))


def scd2_changes(
    open_rows: DataFrame, source: DataFrame, key: str, updated_at: str, as_of: Column
) -> DataFrame:
    """The next state of the open versions: kept, closed and newly opened rows.

    One full outer join of the open versions with the source (one row per key each);
    every pair yields the old version, the new one, or both. A source row that is not
    newer than the open version changes nothing, whatever its other columns say.
    """
    columns = open_rows.columns
    old = open_rows.select(F.col(key).alias("_old_key"), F.struct(*columns).alias("_old"))
    new = scd2_first_load(source, key, updated_at)
    new = new.select(F.col(key).alias("_new_key"), F.struct(*[
        F.col(c) if c in new.columns else F.lit(None).cast(open_rows.schema[c].dataType).alias(c)
        for c in columns
    ]).alias("_new"))

    pairs = old.join(new, F.col("_old_key") == F.col("_new_key"), "full_outer")
    had, has = F.col("_old").isNotNull(), F.col("_new").isNotNull()
    newer = F.col("_new.valid_from") > F.col("_old.valid_from")
    closed_at = F.when(~has, as_of).when(newer, F.col("_new.valid_from"))
    kept = F.when(had, F.col("_old").withField("valid_to", closed_at.cast("timestamp_ntz")))
    opened = F.when(has & (~had | newer), F.col("_new"))
    versions = pairs.select(F.explode(F.array(kept, opened)).alias("_v")).filter(F.col("_v").isNotNull())
    return versions.select("_v.*")


def scd2_merge(
    history: DataFrame, source: DataFrame, key: str, updated_at: str, as_of: Column
) -> DataFrame:
    """Whole history after one more snapshot; closed versions pass through untouched."""
    history = with_new_columns(history, source)
    closed = history.filter(F.col("valid_to").isNotNull())
    still_open = history.filter(F.col("valid_to").isNull())
    return closed.unionByName(scd2_changes(still_open, source, key, updated_at, as_of))
