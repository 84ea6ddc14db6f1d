"""The incremental daily rollup as a job on a stored table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from asthen.operators.history import lookback_from, lookback_literal
from asthen.plans.history import generator_daily, generator_daily_since
from asthen.plans.staging import stage_readings
from asthen.sources.tables import exists, newest_partition, read_table, refresh, upsert
from asthen.sources.warehouse import Warehouse

# Fixed value: days looked back for late readings.
LOOKBACK_DAYS = 14
ROLLUP_KEY, ROLLUP_DAY = "generator_day_id", "reading_date"


def refresh_generator_daily(
    raw_readings: DataFrame, path: str, full_refresh: bool = False, lookback_days: int = LOOKBACK_DAYS
) -> DataFrame:
    """Bring the stored rollup up to date and return it.

    A first or full run aggregates everything. Later runs recompute the whole days from
    `newest day - lookback_days` on and replace their rows by key, so running twice changes
    nothing; a reading that arrives later than that is not picked up. The newest day is that of
    the newest partition. Raw readings stored by day (`with_reading_days`) are read from the
    cutoff on only, together with what was synced since.
    """
    spark = raw_readings.sparkSession
    if full_refresh or not exists(spark, path):
        return refresh(generator_daily(stage_readings(raw_readings)), path, [ROLLUP_DAY])
    target = read_table(spark, path)
    cutoff = lookback_from(newest_partition(spark, path, ROLLUP_DAY), lookback_days)
    batch = generator_daily_since(raw_readings, cutoff)
    return upsert(batch, path, [ROLLUP_KEY], ROLLUP_DAY, since=cutoff, target=target)


def publish_generator_daily(
    raw_readings: DataFrame, warehouse: Warehouse, layer: str, name: str, lookback_days: int = LOOKBACK_DAYS
) -> DataFrame:
    """The same on a catalog table, which shows all days of a run at once."""
    if not warehouse.exists(layer, name):
        return warehouse.replace(generator_daily(stage_readings(raw_readings)), layer, name, [ROLLUP_DAY])
    cutoff = lookback_literal(warehouse.table(layer, name), ROLLUP_DAY, lookback_days)
    batch = generator_daily_since(raw_readings, cutoff)
    return warehouse.upsert(batch, layer, name, [ROLLUP_KEY], ROLLUP_DAY, since=cutoff)
