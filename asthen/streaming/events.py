"""Event-time operators over streams, with state that the watermark bounds.

`lateness` is how long a row may arrive after the newest one seen: the watermark trails the newest
event time by it. Rows behind the watermark are dropped by the first operator that keeps state, and
counted (`late_rows`); state behind it is let go.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from asthen.sources.tables import upsert
from asthen.sources.warehouse import Warehouse

DAY = "1 day"
CatalogTable = tuple[Warehouse, str, str]
# The column of the watermark: wall-clock times as if they were of UTC, so no session's zone matters.
EVENT_TIME = "_event_time"


def with_event_time(stream: DataFrame, at: str, lateness: str) -> DataFrame:
    """The stream with a watermark over its zone-less time column."""
    since = f"timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', cast(`{at}` as timestamp_ntz))"
    moment = F.expr(f"timestampadd(MICROSECOND, {since}, timestamp'1970-01-01 00:00:00Z')")
    return stream.withColumn(EVENT_TIME, moment).withWatermark(EVENT_TIME, lateness)


def first_deliveries(timed: DataFrame, key: Sequence[str]) -> DataFrame:
    """Each key once, as first delivered, of a stream with event time. A key is remembered until
    the watermark has passed its time by the lateness, so state holds that span and no more; a
    copy that comes later counts as a new row, unless it is late by then. Rows without a time
    count as those of 1970: they are late as soon as there is a watermark."""
    return timed.dropDuplicatesWithinWatermark(list(key))


def latest_versions(timed: DataFrame, key: Sequence[str], by: Sequence[Column], period: str = DAY) -> DataFrame:
    """The version of each key with the greatest `by` among those that came before the watermark
    passed the end of their period, of a stream with event time; it goes out once, then (append
    mode). Versions in different periods are different rows. Rows without a time belong to no
    period and go."""
    row = F.struct(*[c for c in timed.columns if c != EVENT_TIME])
    kept = timed.groupBy(F.window(EVENT_TIME, period).alias("_period"), *key).agg(
        F.max_by(row, F.struct(*by)).alias("_row")
    )
    # the period's own last moment is the event time of what follows
    return kept.select(F.window_time("_period").alias(EVENT_TIME), "_row.*")


def per_day(timed: DataFrame, keys: Sequence[str], measures: Mapping[str, Column], day: str) -> DataFrame:
    """One row per day and keys of a stream with event time."""
    groups = timed.groupBy(F.window(EVENT_TIME, DAY).alias("_window"), *keys)
    counted = groups.agg(*[m.alias(n) for n, m in measures.items()])
    start = F.date_from_unix_date((F.unix_seconds("_window.start") / 86_400).cast("int"))
    return counted.select(*keys, start.alias(day), *measures)


def write_upserts(
    rows: DataFrame, table: str | CatalogTable, checkpoint: str, keys: Sequence[str], partition: str,
    mode: str = "update", **trigger,
) -> StreamingQuery:
    """Keep a table equal to the newest rows of an aggregated stream, by key. `table` is a path, whose
    partitions are replaced in place, or (warehouse, layer, name): readers of that see a batch whole
    or not at all, and a batch that fails half-way loses nothing.

    In update mode every group that a micro-batch touched goes out anew; in append mode each goes
    out once, when the watermark has closed it. A batch replaces its keys, so one that is
    repeated after a failure changes nothing, and only the partitions it touches are written.
    """

    def merge(batch: DataFrame, number: int) -> None:
        batch = batch.persist()
        try:
            # no row to write means no partition to touch; the first batch makes the table
            if number and batch.isEmpty():
                return
            if isinstance(table, str):
                upsert(batch, table, keys, partition)
            else:
                warehouse, layer, name = table
                warehouse.upsert(batch, layer, name, keys, partition)
        finally:
            batch.unpersist()

    writer = rows.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    return writer.foreachBatch(merge).trigger(**trigger).start()


def late_rows(query: StreamingQuery) -> int:
    """Rows dropped behind the watermark so far, as the query's progress reports them."""
    return sum(
        s["numRowsDroppedByWatermark"] for p in query.recentProgress for s in p["stateOperators"]
    )


def state_rows(query: StreamingQuery) -> int:
    """Rows of state the query holds after its last batch."""
    last = query.lastProgress
    return sum(s["numRowsTotal"] for s in last["stateOperators"]) if last else 0
