"""Event-time streams: late rows, repeated deliveries, restarts and the state they keep."""

from decimal import Decimal

import pytest
from conftest import rows, ts

from asthen.plans import history, staging
from asthen.sources.registry import SOURCES
from asthen.sources.tables import read_table
from asthen.sources.warehouse import Warehouse
from asthen.streaming.daily import write_closed_days, write_daily_deliveries
from asthen.streaming.events import late_rows, state_rows

SCHEMA = SOURCES["generator_readings"].ddl


def deliver(spark, folder, data):
    df = spark.createDataFrame([
        (i, g, ts(at), output, Decimal("70.00"), Decimal("2.000"), None, ts(synced))
        for i, g, at, output, synced in data], SCHEMA)
    df.coalesce(1).write.mode("append").parquet(str(folder / "in"))


def run(spark, folder, write):
    """All that has been delivered; a new query on the same checkpoint each time, as after a restart."""
    raw = spark.readStream.schema(SCHEMA).parquet(str(folder / "in"))
    query = write(raw, str(folder / "out"), str(folder / "checkpoint"), availableNow=True)
    query.awaitTermination()
    return read_table(spark, str(folder / "out")), query


def deliveries(days, hours=(0, 11, 23), prefix="r"):
    return [(f"{prefix}{d}-{h}", " gen-1", f"2024-01-{d:02} {h:02}:00", f"{d + h}.05", f"2024-01-{d:02} {h:02}:10")
            for d in days for h in hours]


def test_closed_days_equal_the_batch_and_drop_late_rows(spark, tmp_path):
    """Days are final once the watermark has passed them; corrections win until then."""
    first = deliveries(range(1, 21))
    deliver(spark, tmp_path, first)
    out, query = run(spark, tmp_path, write_closed_days)
    assert [str(d) for (d,) in rows(out, "reading_date")] == [f"2024-01-{d:02}" for d in range(1, 6)]
    assert late_rows(query) == 0
    # one of an open day corrected, one of an open day new, one of a closed day too late
    second = [("r10-0", "gen-1", "2024-01-10 00:00", "500", "2024-01-20 20:00"),
              ("new", "gen-1", "2024-01-09 12:00", "7", "2024-01-20 20:00"),
              ("r12-0", "gen-1", "2024-01-12 00:00", "1", "2024-01-11 00:00")]  # an older sync
    late = [("late", "gen-1", "2024-01-03 12:00", "900", "2024-01-20 20:00")]
    deliver(spark, tmp_path, second + late)
    out, query = run(spark, tmp_path, write_closed_days)
    assert late_rows(query) == 1
    deliver(spark, tmp_path, deliveries([40 - 9], prefix="end"))  # the 31st closes all up to the 16th
    out, query = run(spark, tmp_path, write_closed_days)
    batch = spark.createDataFrame([
        (i, g, ts(at), output, Decimal("70.00"), Decimal("2.000"), None, ts(s)) for i, g, at, output, s in first + second
    ], SCHEMA)
    want = history.generator_daily(staging.stage_readings(batch)).where("reading_date <= '2024-01-16'")
    assert rows(out, *want.columns) == rows(want) and out.count() == 16
    # the state holds what the 14 days before the newest reading brought, no more
    assert state_rows(query) == 4 * 3 + 3
    again, _ = run(spark, tmp_path, write_closed_days)
    assert rows(again, *want.columns) == rows(want)


def test_repeated_deliveries_count_once_across_restarts(spark, tmp_path):
    first = deliveries(range(1, 4))
    deliver(spark, tmp_path, first + first[:2])
    run(spark, tmp_path, write_daily_deliveries)
    # stopped in mid-stream: all come again, with one new and one new version
    more = [("r3-0", "gen-1", "2024-01-03 00:00", "3.05", "2024-01-05 00:00"), *deliveries([4])]
    deliver(spark, tmp_path, first + more)
    out, query = run(spark, tmp_path, write_daily_deliveries)
    assert [(str(d), n) for d, n in rows(out, "reading_date", "delivery_count")] == [
        ("2024-01-01", 3), ("2024-01-02", 3), ("2024-01-03", 4), ("2024-01-04", 3)]
    assert late_rows(query) == 0
    held = state_rows(query)
    assert held == 13 + 4  # a key per delivery, a group per day
    # far later: the keys and days behind the watermark go, and old copies are late, not new
    later = [("far", "gen-1", "2024-03-10 00:00", "1", "2024-03-10 00:10")]
    deliver(spark, tmp_path, later)
    _, query = run(spark, tmp_path, write_daily_deliveries)
    assert state_rows(query) == 1 + 1
    deliver(spark, tmp_path, first + later)
    out, query = run(spark, tmp_path, write_daily_deliveries)
    assert late_rows(query) == len(first) and state_rows(query) == 1 + 1
    assert out.count() == 5 and rows(out.where("reading_date = '2024-03-10'"), "delivery_count") == [(1,)]


def test_rows_without_a_time_are_left_out(spark, tmp_path):
    deliver(spark, tmp_path, deliveries([1]) + [("x", "gen-1", None, "1", "2024-01-01"), (None, None, "2024-01-01", "1", None)])
    out, _ = run(spark, tmp_path, write_daily_deliveries)
    assert rows(out, "generator_id", "delivery_count") == [(None, 1), ("GEN-1", 3)]


def test_a_batch_that_fails_half_way_loses_nothing(spark, tmp_path):
    """Killed between writing its rows and the switch, a batch is done again by the next start."""
    house = Warehouse(spark, str(tmp_path / "house"), prefix="events_")
    source = tmp_path / "in"

    def start():
        raw = spark.readStream.schema(SCHEMA).parquet(str(source))
        return write_daily_deliveries(raw, (house, "marts", "days"), str(tmp_path / "checkpoint"), availableNow=True)

    try:
        deliver(spark, tmp_path, deliveries(range(1, 4)))
        start().awaitTermination()
        before = rows(house.table("marts", "days"))
        deliver(spark, tmp_path, deliveries([3, 4], hours=(1, 2), prefix="more"))
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(house, "_switch", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
            with pytest.raises(Exception, match="killed"):
                start().awaitTermination()
        assert rows(house.table("marts", "days")) == before
        start().awaitTermination()
        out = house.table("marts", "days")
        assert [(str(d), n) for d, n in rows(out, "reading_date", "delivery_count")] == [
            ("2024-01-01", 3), ("2024-01-02", 3), ("2024-01-03", 5), ("2024-01-04", 2)]
    finally:
        spark.sql("DROP DATABASE IF EXISTS events_marts CASCADE")
