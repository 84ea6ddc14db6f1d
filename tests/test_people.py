"""Dwelling history, population and occupancy."""

import random
from datetime import date, datetime, timedelta
from itertools import zip_longest

import pytest
from conftest import rows, ts
from pyspark.sql import Window
from pyspark.sql import functions as F

from asthen.operators.intervals import event_intervals, expand_months, month_grid
from asthen.plans import analyses, history, marts

LO, HI = "2022-01-01", "2022-04-01"
RESIDENTS = ("resident_id string, dwelling_id string, registered_at timestamp_ntz, resident_status string, "
             "birth_date date")
RELOCATIONS = ("relocation_id string, resident_id string, from_dwelling_id string, to_dwelling_id string, "
               "relocated_at timestamp_ntz")
DWELLINGS = "dwelling_id string, level_number int, dwelling_type string, capacity int"
ZONES = "level_number int, zone_name string, supply_tier int, has_lift_access boolean"


@pytest.fixture(scope="module")
def small(spark):
    birth = date(1980, 1, 1)
    residents = spark.createDataFrame([
        ("R1", "D1", ts("2000-01-01"), "active", birth), ("R2", "D2", ts("1999-01-01"), "deceased", birth),
    ], RESIDENTS)
    relocations = spark.createDataFrame([
        ("L1", "R1", "D1", "D2", ts("2022-01-20 10:00")), ("L2", "R1", "D2", "D3", ts("2022-03-01")),
        ("L3", "R3", "D1", "D2", ts("2022-02-01")),
    ], RELOCATIONS)
    dwellings = spark.createDataFrame([
        ("D1", 1, "FAMILY", 5), ("D2", 1, "STANDARD", 3), ("D3", 2, "SINGLE", 1)], DWELLINGS)
    zones = spark.createDataFrame([(i, "Up Top", 1, False) for i in (1, 2, 3)], ZONES)
    return residents, relocations, dwellings, zones


def test_dwelling_history(small):
    out = history.dwelling_history(*small[:2])
    assert rows(out, "resident_id", "dwelling_id", "valid_from", "valid_to", "is_current_residency") == sorted([
        ("R1", "D1", ts("2000-01-01"), ts("2022-01-20 10:00"), False),
        ("R1", "D2", ts("2022-01-20 10:00"), ts("2022-03-01"), False),
        ("R1", "D3", ts("2022-03-01"), None, True),
        ("R2", "D2", ts("1999-01-01"), None, True),
    ], key=str)


def test_occupancy(small):
    residents, relocations, dwellings, zones = small
    population = history.level_monthly_population(
        history.dwelling_history(residents, relocations), dwellings, zones, LO, HI)
    out = marts.level_monthly_occupancy(population)
    got = rows(out.withColumn("m", F.month("month_start")), "level_number", "m", "total_residents",
               "active_residents", "family_dwelling_residents", "resident_change", "occupancy_trend",
               "is_empty_level")
    assert got == [
        (1, 1, 3, 2, 1, None, "baseline", False), (1, 2, 2, 1, 0, -1, "shrinking", False),
        (1, 3, 2, 1, 0, 0, "stable", False), (1, 4, 1, 0, 0, -1, "shrinking", True),
        (2, 1, 0, 0, 0, None, "baseline", True), (2, 2, 0, 0, 0, 0, "stable", True),
        (2, 3, 1, 1, 0, 1, "growing", False), (2, 4, 1, 1, 0, 0, "stable", False),
        (3, 1, 0, 0, 0, None, "baseline", True), (3, 2, 0, 0, 0, 0, "stable", True),
        (3, 3, 0, 0, 0, 0, "stable", True), (3, 4, 0, 0, 0, 0, "stable", True),
    ]
    assert dict(rows(analyses.trend_distribution(out))) == {
        "baseline": 3, "shrinking": 2, "growing": 1, "stable": 6}


def test_dim_levels(spark, small):
    residents, relocations, dwellings, zones = small
    occupancy = marts.level_monthly_occupancy(history.level_monthly_population(
        history.dwelling_history(residents, relocations), dwellings, zones, LO, HI))
    equipment = spark.createDataFrame([(1, "CRITICAL"), (1, None), (9, "LOW")], "level_number int, criticality string")
    out = marts.dim_levels(zones, dwellings, equipment, occupancy)
    got = [tuple(str(v) for v in r) for r in rows(
        out, "level_number", "dwelling_count", "total_capacity", "equipment_count", "critical_equipment_count",
        "current_active_residents", "current_trend", "capacity_utilisation")]
    assert got == [("1", "2", "8", "2", "1", "0", "shrinking", "0.000"),
                   ("2", "1", "1", "0", "0", "1", "stable", "1.000"),
                   ("3", "0", "0", "0", "0", "0", "stable", "None")]


def test_residents_by_level_keeps_unmatched_people(spark, small):
    residents, _, dwellings, zones = small
    lost = spark.createDataFrame([("R9", "D9", ts("2000-01-01"), "active", None),
                                  ("R8", None, ts("2000-01-01"), "active", None)], RESIDENTS)
    people = residents.unionByName(lost).withColumn("full_name", F.lit("x"))
    out = history.residents_by_level(people, dwellings, zones)
    assert rows(out, "resident_id", "dwelling_id", "level_number", "zone_name") == [
        ("R1", "D1", 1, "Up Top"), ("R2", "D2", 1, "Up Top"), ("R8", None, None, None), ("R9", None, None, None)]


def test_sanctions_count_at_the_destination(spark, small):
    _, relocations, dwellings, zones = small
    reasons = relocations.withColumn("relocation_reason", F.when(F.col("resident_id") == "R1", "SANCTION"))
    out = analyses.sanctioned_relocations_by_level(reasons, dwellings, zones)
    assert rows(out) == [(1, "Up Top", 1), (2, "Up Top", 1)]


def random_moves(seed):
    """People with few moves and one with a third of all; ties, gaps and unknown times."""
    rng = random.Random(seed)
    start = datetime(2022, 1, 1)
    moves = []
    for i in range(300):
        who = "R0" if i % 3 == 0 else f"R{rng.randrange(1, 40)}"
        at = None if rng.random() < 0.03 else start + timedelta(days=rng.randrange(0, 110), hours=rng.choice((0, 9)))
        to = None if rng.random() < 0.05 else f"D{rng.randrange(8)}"
        moves.append((f"L{i:04}", who, f"D{rng.randrange(8)}" if rng.random() > 0.05 else None, to, at))
    people = [(f"R{i}", f"D{i % 8}" if i % 7 else None, start + timedelta(days=rng.randrange(-50, 60)),
               rng.choice(("active", "deceased")), None) for i in range(45)]
    return moves, people


def periods_by_hand(moves, people):
    late = datetime.max
    out = []
    for who, home, registered, status, _ in people:
        mine = sorted((m for m in moves if m[1] == who), key=lambda m: (m[4] or late, m[0]))
        first = mine[0] if mine else None
        out.append((who, (first[2] or home) if first else home, registered, first[4] if first else None, status))
        for move, following in zip_longest(mine, mine[1:]):
            out.append((who, move[3], move[4], following[4] if following else None, status))
    return [p for p in out if p[1] is not None]


def counts_by_hand(periods, levels):
    months = [date(2022, m, 1) for m in (1, 2, 3, 4)]
    counts = {(lv, m): [0, 0] for lv in range(4) for m in months}
    for _, dwelling, start, end, status in periods:
        for m in months:
            after = date(m.year, m.month + 1, 1)
            if (start and start < datetime(after.year, after.month, 1)
                    and (end is None or end >= datetime(m.year, m.month, 1))):
                counts[levels[dwelling], m][0] += 1
                counts[levels[dwelling], m][1] += status == "active"
    return sorted((lv, str(m), *c) for (lv, m), c in counts.items())


@pytest.mark.parametrize("seed", range(3))
def test_history_and_counts_equal_brute_force(spark, seed):
    moves, people = random_moves(seed)
    residents = spark.createDataFrame(people, RESIDENTS)
    relocations = spark.createDataFrame(moves, RELOCATIONS).repartition(5)
    levels = {f"D{i}": i % 4 for i in range(8)}
    dwellings = spark.createDataFrame([(d, lv, "FAMILY", 1) for d, lv in levels.items()], DWELLINGS)
    zones = spark.createDataFrame([(lv, "z", 1, False) for lv in range(4)], ZONES)
    expected = periods_by_hand(moves, people)
    out = history.dwelling_history(residents, relocations)
    got = rows(out, "resident_id", "dwelling_id", "valid_from", "valid_to", "resident_status")
    assert sorted(map(str, got)) == sorted(map(str, expected))
    counted = history.level_monthly_population(out, dwellings, zones, LO, HI)
    got = sorted((r[0], str(r[1]), r[2], r[3]) for r in rows(
        counted, "level_number", "month_start", "total_residents", "active_residents"))
    assert got == counts_by_hand(expected, levels)


@pytest.mark.parametrize("small_bytes", [1 << 60, 0])
def test_event_intervals_equal_one_window_per_key(spark, small_bytes):
    """Also for null keys, undated events, ties, and keys with so many events that they are cut."""
    moves, _ = random_moves(7)
    busy = [(f"b{i}", None if i % 2 else "busy", None, None,
             None if i % 13 == 0 else ts(f"2024-01-{1 + i * 7 % 28:02} 0{i % 7}:00"), None) for i in range(2_000)]
    busy += [(None if i % 3 else f"t{i}", "same time", None, None, ts("2024-01-01"), None) for i in range(900)]
    busy += [(f"u{i}", "no time", None, None, None, None) for i in range(700)]
    events = spark.createDataFrame(moves + [m[: len(moves[0])] for m in busy], RELOCATIONS).repartition(3)
    events = events.select("relocation_id", "resident_id", "relocated_at")
    one = Window.partitionBy("resident_id").orderBy(F.col("relocated_at").asc_nulls_last(), "relocation_id")
    whole = events.withColumn("valid_to", F.lead("relocated_at").over(one)).withColumn(
        "is_first", F.row_number().over(one) == 1)
    out = event_intervals(events, "resident_id", "relocated_at", "relocation_id", first="is_first",
                          slice_rows=200, small_bytes=small_bytes)
    columns = ["relocation_id", "resident_id", "relocated_at", "valid_to"]
    assert rows(out, *columns) == rows(whole, *columns)
    # rows alike in all of these are interchangeable, so the firsts are counted
    assert rows(out.filter("is_first"), *columns) == rows(whole.filter("is_first"), *columns)


def test_a_level_in_two_zones_counts_its_people_in_each(spark):
    residents = spark.createDataFrame([("r", "D", "active")], "resident_id string, dwelling_id string, resident_status string")
    history_rows = residents.withColumns({
        "valid_from": F.lit("2022-01-05").cast("timestamp_ntz"), "valid_to": F.lit(None).cast("timestamp_ntz")})
    dwellings = spark.createDataFrame([("D", 1, "FAMILY", 1)], DWELLINGS)
    zones = spark.createDataFrame([(1, "A", 1, False), (1, "B", 1, False), (2, "A", 1, False)], ZONES)
    out = history.level_monthly_population(history_rows, dwellings, zones, "2022-01-01", "2022-02-01")
    got = rows(out, "level_number", "zone_name", "month_start", "total_residents", "active_residents")
    assert [(r[0], r[1], *r[3:]) for r in got] == [
        (1, "A", 1, 1), (1, "A", 1, 1), (1, "B", 1, 1), (1, "B", 1, 1), (2, "A", 0, 0), (2, "A", 0, 0)]


def test_expanding_equals_the_range_join(spark):
    moves, _ = random_moves(3)
    data = [(m[0], m[4], n[4]) for m, n in zip(moves, moves[1:], strict=False)]
    spans = spark.createDataFrame(data, "id string, a timestamp_ntz, b timestamp_ntz")
    spine = month_grid(spark.range(1), LO, HI).drop("id")
    joined = spine.join(spans, (F.col("month_start") >= F.trunc("a", "MM"))
                        & (F.col("b").isNull() | (F.col("month_start") <= F.trunc("b", "MM"))))
    assert rows(expand_months(spans, "a", "b", LO, HI), "id", "month_start") == rows(joined, "id", "month_start")
