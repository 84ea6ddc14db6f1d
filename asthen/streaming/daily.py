"""The daily rollup and delivery counts kept by state, in event time.

Unlike `rollup`, which reruns the batch job on stored readings, these hold what they need in the
state store and never read a reading twice. Readings more than the lateness behind the
newest are dropped, and counted by `events.late_rows`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from asthen.functions import clean_string, surrogate_key
from asthen.plans.history import daily_measures
from asthen.plans.rollup import LOOKBACK_DAYS, ROLLUP_DAY, ROLLUP_KEY
from asthen.plans.staging import READING_KEY, READING_ORDER, READING_TIE, clean_readings
from asthen.streaming.events import (
    EVENT_TIME,
    CatalogTable,
    first_deliveries,
    latest_versions,
    per_day,
    with_event_time,
    write_upserts,
)

LATENESS = f"{LOOKBACK_DAYS} days"


def _with_id(days: DataFrame) -> DataFrame:
    return days.select(surrogate_key(F.col("generator_id"), F.col(ROLLUP_DAY)).alias(ROLLUP_KEY), "*")


def closed_days(raw: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """The daily rollup of a stream of raw readings, one row per generator and day, final: a day goes
    out when no reading of it can come any more. The latest sync of a reading wins."""
    # a null sync counts as the latest, as in the batch job
    by = [x for c in (*READING_ORDER, *READING_TIE) for x in (F.col(c).isNull(), F.col(c))]
    latest = latest_versions(with_event_time(raw, "read_at", lateness), READING_KEY, by)
    return _with_id(per_day(clean_readings(latest, EVENT_TIME), ["generator_id"], daily_measures(), ROLLUP_DAY))


def write_closed_days(
    raw: DataFrame, table: str | CatalogTable, checkpoint: str, lateness: str = LATENESS, **trigger
) -> StreamingQuery:
    """Add each day to the table once it is closed."""
    return write_upserts(closed_days(raw, lateness), table, checkpoint, [ROLLUP_KEY], ROLLUP_DAY, "append", **trigger)


def daily_deliveries(raw: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """Per generator and day read: how many versions of readings have been delivered so far, repeated
    deliveries of a version counted once, and the newest sync."""
    timed = with_event_time(raw, "read_at", lateness)
    once = first_deliveries(timed, [*READING_KEY, *READING_ORDER])
    named = once.withColumn("generator_id", clean_string(F.col("generator_id"), "upper"))
    measures = {"delivery_count": F.count("*"), "last_synced_at": F.max(READING_ORDER[0])}
    return _with_id(per_day(named, ["generator_id"], measures, ROLLUP_DAY))


def write_daily_deliveries(
    raw: DataFrame, table: str | CatalogTable, checkpoint: str, lateness: str = LATENESS, **trigger
) -> StreamingQuery:
    """Keep the table up to date after every micro-batch."""
    return write_upserts(daily_deliveries(raw, lateness), table, checkpoint, [ROLLUP_KEY], ROLLUP_DAY, **trigger)
