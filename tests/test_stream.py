"""The stream must leave the table a batch run over the same readings would."""

from decimal import Decimal

from conftest import rows, ts

from asthen.plans import history, staging
from asthen.sources.registry import SOURCES
from asthen.sources.tables import read_table
from asthen.streaming.rollup import write_generator_daily

SCHEMA = SOURCES["generator_readings"].ddl


def deliver(spark, folder, data):
    df = spark.createDataFrame([
        (i, g, ts(at), output, Decimal("70.00"), Decimal("2.000"), None, ts(synced))
        for i, g, at, output, synced in data], SCHEMA)
    df.coalesce(1).write.mode("append").parquet(str(folder / "in"))


def run(spark, folder):
    raw = spark.readStream.schema(SCHEMA).parquet(str(folder / "in"))
    write_generator_daily(
        raw, str(folder / "out"), str(folder / "readings"), str(folder / "checkpoint"), availableNow=True
    ).awaitTermination()
    return read_table(spark, str(folder / "out"))


def test_stream_equals_batch_with_late_and_repeated_readings(spark, tmp_path):
    first = [(f"r{d}-{h}", " gen-1", f"2024-01-{d:02} {h:02}:00", f"{d + h}.05", f"2024-01-{d:02} {h:02}:10")
             for d in range(1, 21) for h in (0, 11, 23)]
    faulty = [("f1", "GEN-1", "2024-01-20 05:00", "-3", "2024-01-20 06:00"),
              ("f2", "gen-2", "2024-01-20 05:00", "", "2024-01-20 06:00")]
    deliver(spark, tmp_path, first + faulty)
    run(spark, tmp_path)
    # nine days late, and everything of one day once more
    late = [("late", "GEN-1", "2024-01-11 12:00", "900", "2024-01-20 12:00")]
    deliver(spark, tmp_path, late + [r for r in first if r[0].startswith("r20-")])
    out = run(spark, tmp_path)

    arrived = spark.read.schema(SCHEMA).parquet(str(tmp_path / "in"))
    batch = history.generator_daily(staging.stage_readings(arrived))
    assert rows(out, *batch.columns) == rows(batch)
    assert out.count() == 21

    # nothing new: a restart changes nothing
    assert rows(run(spark, tmp_path), *batch.columns) == rows(batch)


def test_readings_older_than_the_lookback_are_not_counted(spark, tmp_path):
    deliver(spark, tmp_path, [("new", "g", "2024-03-01", "10", "2024-03-01")])
    run(spark, tmp_path)
    deliver(spark, tmp_path, [("old", "g", "2024-01-01", "10", "2024-03-01"),
                              ("recent", "g", "2024-02-20", "10", "2024-03-01")])
    days = [str(r[0]) for r in rows(run(spark, tmp_path), "reading_date")]
    assert days == ["2024-02-20", "2024-03-01"]


def test_the_latest_sync_of_a_reading_wins_on_the_stream(spark, tmp_path):
    deliver(spark, tmp_path, [("r", "g", "2024-03-02 10:00", "10", "2024-03-02 11:00"),
                              ("s", "g", "2024-03-03 10:00", "7", "2024-03-03 11:00")])
    run(spark, tmp_path)
    # one corrected, one older than what is there, one moved to another day
    deliver(spark, tmp_path, [("r", "g", "2024-03-02 10:00", "20", "2024-03-02 19:00"),
                              ("s", "g", "2024-03-03 10:00", "1", "2024-03-03 10:30")])
    out = run(spark, tmp_path)
    assert [(str(d), float(v)) for d, v in rows(out, "reading_date", "avg_output_kw")] == [
        ("2024-03-02", 20.0), ("2024-03-03", 7.0)]
