"""Readings, the daily rollup, its trend and the incremental runs."""

from datetime import datetime
from decimal import Decimal

import pytest
from conftest import day, rows, ts
from pyspark.sql import functions as F

from asthen.operators.history import keyed_upsert, lookback_start
from asthen.operators.rows import latest_since
from asthen.plans import analyses, history, marts, staging
from asthen.plans.rollup import refresh_generator_daily
from asthen.sources.registry import SOURCES
from asthen.sources.tables import read_table, upsert


def readings(spark, data):
    """(id, generator, read_at, output, synced_at)"""
    schema = SOURCES["generator_readings"].schema
    return spark.createDataFrame([
        (i, g, ts(at), output, Decimal("70.00"), Decimal("2.000"), None, ts(synced))
        for i, g, at, output, synced in data], schema)


FIXTURE = [
    ("r1", "gen-1 ", "2024-01-01 10:00", "100.00", "2024-01-01 10:05"),
    ("r1", "gen-1 ", "2024-01-01 10:00", "110.00", "2024-01-01 11:00"),
    ("r2", "GEN-1", "2024-01-01 11:00", "-5.00", "2024-01-01 11:10"),
    ("r3", "GEN-1", "2024-01-01 12:00", "", "2024-01-01 12:10"),
    ("r4", "GEN-1", "2024-01-02 00:00", "100.00", "2024-01-09"),
    ("r5", "GEN-1", "2024-01-02 01:00", "101.01", "2024-01-02 01:20"),
    ("r6", "GEN-1", "2024-01-04 00:00", "200.00", "2024-01-04 00:30"),
    ("r7", "GEN-2", "2024-01-01 00:00", "-1.00", "2024-01-01 00:30"),
    ("r8", "GEN-2", "2024-01-02 00:00", "50.00", "2024-01-02 00:30"),
]


def test_daily_output(spark):
    daily = history.generator_daily(staging.stage_readings(readings(spark, FIXTURE)))
    out = marts.generator_daily_output(daily).withColumn("d", F.dayofmonth("reading_date"))
    got = [tuple(str(v) for v in r) for r in rows(
        out, "generator_id", "d", "reading_count", "valid_reading_count", "faulty_reading_count",
        "avg_output_kw", "rolling_7d_avg_output_kw", "baseline_output_kw", "output_vs_baseline_pct",
        "is_below_975pct_baseline", "had_sensor_fault")]
    assert got == [
        ("GEN-1", "1", "3", "1", "1", "110.00", "110.00", "110.00", "1.0000", "False", "True"),
        ("GEN-1", "2", "2", "2", "0", "100.51", "105.26", "110.00", "0.9137", "True", "False"),
        ("GEN-1", "4", "1", "1", "0", "200.00", "136.84", "110.00", "1.8182", "False", "False"),
        ("GEN-2", "1", "1", "0", "1", "None", "None", "None", "None", "None", "True"),
        ("GEN-2", "2", "1", "1", "0", "50.00", "50.00", "None", "None", "None", "False")]
    worklist = analyses.degradation_worklist(out)
    assert [tuple(map(str, r)) for r in rows(worklist)] == [("GEN-1", "2024-01-02", "1", "0.9137")]


def test_frames_count_rows_and_the_vibration_flag_uses_the_rolling_maximum(spark):
    days = spark.sql("""
        select 'k' as generator_day_id, 'G' as generator_id, date'2024-01-01' + id * 2 as reading_date,
               1L as reading_count, 1L as valid_reading_count, 0L as faulty_reading_count,
               cast(id as decimal(12,2)) as avg_output_kw, cast(0 as decimal(12,2)) as min_output_kw,
               cast(0 as decimal(12,2)) as max_output_kw, cast(0 as decimal(12,2)) as avg_temperature_c,
               cast(if(id = 0, 4.501, 4.5) as decimal(8,3)) as max_vibration_mm_s
        from (select explode(sequence(0, 30)) as id)""")
    out = {r["reading_date"]: r for r in marts.generator_daily_output(days).collect()}
    last, before = out[day("2024-03-01")], out[day("2024-02-28")]
    assert last["rolling_7d_avg_output_kw"] == Decimal("27.00")
    assert last["rolling_30d_avg_output_kw"] == Decimal("15.50")
    assert (before["is_high_vibration"], last["is_high_vibration"]) == (True, False)
    assert last["output_vs_baseline_pct"] is None  # the baseline is zero


def test_copies_of_one_sync_are_chosen_repeatably(spark):
    data = [("r1", "g", "2024-01-01", out, "2024-01-02") for out in ("1", "3", "2")]
    for order in (data, data[::-1]):
        staged = staging.stage_readings(readings(spark, order).repartition(3))
        assert [r["output_kw"] for r in staged.collect()] == [Decimal("3.00")]


def test_sync_lag_profile(spark):
    out = analyses.sync_lag_profile(staging.stage_readings(readings(spark, FIXTURE)))
    assert rows(out) == [(8, 7 * 86_400, 1)]


def test_cutoff(spark):
    target = spark.createDataFrame([(day("2024-12-31"),), (day("2024-12-30"),)], "reading_date date")
    assert lookback_start(target, "reading_date", 14).first()[0] == day("2024-12-17")
    assert lookback_start(target.limit(0), "reading_date", 14).first()[0] == day("1899-12-18")


def test_recent_readings_equal_filtering_after_the_dedup(spark):
    """Versions of one reading on both sides of the cutoff, and unknown sync times."""
    cut = "2024-12-17"
    data = [
        ("in", "g", "2024-12-17 00:00", "1", "2024-12-17 01:00"),
        ("out", "g", "2024-12-16 23:59:59", "1", "2024-12-18"),
        ("moved_out", "g", "2024-12-18", "1", "2024-12-18"), ("moved_out", "g", "2024-12-01", "2", "2024-12-30"),
        ("moved_in", "g", "2024-12-01", "1", "2024-12-02"), ("moved_in", "g", "2024-12-20", "2", "2024-12-20"),
        ("null_wins", "g", "2024-12-19", "1", "2024-12-31"), ("null_wins", "g", "2024-12-02", "2", None),
        ("null_stays", "g", "2024-12-19", "1", None), ("null_stays", "g", "2024-12-02", "2", "2024-12-31"),
        ("undated", "g", None, "1", "2024-12-31"),
    ]
    raw = readings(spark, data)
    since = F.lit(day(cut))
    recent = latest_since(raw, ["reading_id"], "_synced_at", "read_at", since, staging.READING_TIE)
    direct = staging.stage_readings(raw).filter(F.col("read_at") >= since)
    assert rows(staging.clean_readings(recent)) == rows(direct)
    assert [r[0] for r in rows(direct, "reading_id")] == ["in", "moved_in", "null_stays"]


def hours(generator, days, output="10.00"):
    return [(f"{generator}-{d}-{h}", generator, f"2024-12-{d:02} {h:02}:00", output, f"2024-12-{d:02} {h:02}:30")
            for d in days for h in (0, 12)]


def test_incremental_runs(spark, tmp_path):
    path = str(tmp_path / "generator_daily")
    first = hours("G1", range(1, 32)) + hours("G2", range(1, 32))
    assert refresh_generator_daily(readings(spark, first), path).count() == 62
    before = rows(read_table(spark, path))
    assert rows(refresh_generator_daily(readings(spark, first), path)) == before

    late = [("late-20", "G1", "2024-12-20 05:00", "100.00", "2025-01-01"),
            ("late-01", "G1", "2024-12-01 05:00", "100.00", "2025-01-01")]
    gone = [r for r in first if not r[0].startswith("G2-25-")]
    after = refresh_generator_daily(readings(spark, gone + late), path)
    got = {(r["generator_id"], r["reading_date"].day): (r["reading_count"], r["avg_output_kw"])
           for r in after.collect()}
    assert len(got) == 62
    assert got["G1", 20] == (3, Decimal("40.00"))     # the whole day again
    assert got["G1", 1] == (2, Decimal("10.00"))      # too old to be looked at
    assert got["G2", 25] == (2, Decimal("10.00"))     # no source rows left, kept
    evidence = analyses.rerun_evidence(after, "generator_day_id").first()
    assert tuple(evidence) == (62, 62)

    rebuilt = refresh_generator_daily(readings(spark, gone + late), path, full_refresh=True)
    assert rebuilt.count() == 61


def test_full_and_incremental_agree_when_nothing_is_too_late(spark, tmp_path):
    data = hours("G1", range(1, 29))
    path = str(tmp_path / "t")
    refresh_generator_daily(readings(spark, [r for r in data if r[4] < "2024-12-20"]), path)
    out = refresh_generator_daily(readings(spark, data), path)
    assert rows(out, "generator_day_id", "reading_count", "avg_output_kw") == rows(
        history.generator_daily(staging.stage_readings(readings(spark, data))),
        "generator_day_id", "reading_count", "avg_output_kw")


def test_upsert_appends_new_columns(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k int, x string")
    batch = spark.createDataFrame([(2, "c", 5.0), (3, "d", 6.0)], "k int, x string, y double")
    assert rows(keyed_upsert(target, batch, ["k"])) == [(1, "a", None), (2, "c", 5.0), (3, "d", 6.0)]
    narrower = keyed_upsert(batch, target, ["k"])
    assert rows(narrower) == [(1, "a", None), (2, "b", None), (3, "d", 6.0)]


def test_stored_upsert_touches_only_its_days_and_grows_the_schema(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = "k int, d date, x int"
    upsert(spark.createDataFrame([(1, day("2024-01-01"), 1), (2, day("2024-01-02"), 1),
                                  (3, day("2024-01-02"), 1)], schema), path, ["k"], "d")
    untouched = list((tmp_path / "t" / "d=2024-01-01").glob("*.parquet"))
    batch = spark.createDataFrame([(2, day("2024-01-02"), 9, "new")], f"{schema}, y string")
    for _ in range(2):
        upsert(batch, path, ["k"], "d")
        assert rows(read_table(spark, path), "k", "d", "x", "y") == [
            (1, day("2024-01-01"), 1, None), (2, day("2024-01-02"), 9, "new"), (3, day("2024-01-02"), 1, None)]
    assert list((tmp_path / "t" / "d=2024-01-01").glob("*.parquet")) == untouched


def test_stored_upsert_keeps_undated_rows(spark, tmp_path):
    path, schema = str(tmp_path / "t"), "k int, d date, x int"
    upsert(spark.createDataFrame([(1, None, 1), (2, None, 1), (3, day("2024-01-01"), 1)], schema), path, ["k"], "d")
    out = upsert(spark.createDataFrame([(2, None, 9)], schema), path, ["k"], "d")
    assert rows(out, "k", "d", "x") == [(1, None, 1), (2, None, 9), (3, day("2024-01-01"), 1)]


@pytest.mark.parametrize("value", ["", "   ", None])
def test_missing_output_is_neither_valid_nor_faulty(spark, value):
    daily = history.generator_daily(staging.stage_readings(
        readings(spark, [("r", "g", "2024-01-01", value, "2024-01-01")])))
    assert rows(daily, "reading_count", "valid_reading_count", "faulty_reading_count", "avg_output_kw") == [
        (1, 0, 0, None)]
    assert daily.first()["last_synced_at"] == datetime(2024, 1, 1)


def test_a_run_may_start_from_an_empty_target(spark, tmp_path):
    path = str(tmp_path / "t")
    assert refresh_generator_daily(readings(spark, []), path).count() == 0
    out = refresh_generator_daily(readings(spark, hours("G1", range(1, 29))), path)
    assert out.count() == 28


def test_the_lookback_is_a_parameter(spark, tmp_path):
    path = str(tmp_path / "t")
    refresh_generator_daily(readings(spark, hours("G1", range(1, 29))), path)
    late = readings(spark, hours("G1", range(1, 29)) + [("late", "G1", "2024-12-02 05:00", "9", "2024-12-28")])
    assert refresh_generator_daily(late, path).filter("reading_count = 3").count() == 0
    assert refresh_generator_daily(late, path, lookback_days=27).filter("reading_count = 3").count() == 1
