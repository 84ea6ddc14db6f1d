"""Daily rollup of a stream of readings.

Each micro-batch is added to the stored raw readings and followed by one run of the
incremental batch job on them. The latest sync of a reading therefore wins, copies count
once, and late readings are picked up exactly as far back as the batch job looks: the
table always equals batch runs over what had arrived. Nothing is kept in memory between
batches; a run reads the days looked back, and what was synced since.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from asthen.plans.rollup import LOOKBACK_DAYS, refresh_generator_daily
from asthen.plans.staging import READ_DAY, SYNC_DAY, with_reading_days
from asthen.sources.tables import append_batch, read_batches


def write_generator_daily(
    raw: DataFrame, path: str, readings_path: str, checkpoint: str,
    lookback_days: int = LOOKBACK_DAYS, **trigger,
) -> StreamingQuery:
    """Keep the table at `path` up to date from a stream of raw readings, kept at `readings_path`.

    `trigger` as for DataStreamWriter.trigger, e.g. availableNow=True. A repeated batch
    replaces itself in the stored readings, and the rollup's upsert is idempotent, so a restart
    from the checkpoint loses and doubles nothing.
    """
    schema = with_reading_days(raw).schema

    def merge(batch: DataFrame, number: int) -> None:
        append_batch(with_reading_days(batch), readings_path, number, [READ_DAY, SYNC_DAY])
        readings = read_batches(batch.sparkSession, readings_path, schema)
        refresh_generator_daily(readings, path, lookback_days=lookback_days)

    return (
        raw.writeStream.option("checkpointLocation", checkpoint)
        .foreachBatch(merge)
        .trigger(**trigger)
        .start()
    )
