from datetime import date
from decimal import Decimal

import pytest
from conftest import rows, ts

from asthen.plans import staging
from asthen.sources.registry import SOURCES, read_source


def raw(spark, table, data):
    return spark.createDataFrame(data, SOURCES[table].schema)


def resident(key, status, given, family, synced, deleted, updated="2024-01-01"):
    return (key, given, family, date(1990, 1, 1), "D1", status, ts("2000-01-01"), ts(updated),
            ts(f"2024-01-02 {synced}") if synced else None, deleted)


def test_residents(spark):
    df = raw(spark, "residents", [
        resident("R1", " active ", "Ann", "Bell", "10:00", False),
        resident("R1", "ACTIVE", "Ann", "Bell", "11:00", False),
        resident("R2", "", "Cy", "", "10:00", False),
        resident("R3", "unregistered", "Di", "Eke", "10:00", None),
        resident("R4", "active", "Fay", "Gow", "09:00", False),
        resident("R4", "active", "Fay", "Gow", "12:00", True),
        resident("R5", None, "Hal", "Ito", "10:00", False),
    ])
    out = staging.stage_residents(df)
    assert rows(out, "resident_id", "resident_status", "full_name", "is_deleted") == [
        ("R1", "active", "Ann Bell", False), ("R2", "unknown", None, False),
        ("R3", "unknown", "Di Eke", False), ("R5", "unknown", "Hal Ito", False),
    ]


def test_a_null_sync_time_counts_as_latest_and_updated_at_settles_ties(spark):
    df = raw(spark, "residents", [
        resident("R1", "active", "A", "B", "10:00", False),
        resident("R1", "deceased", "A", "B", None, False),
        resident("R2", "active", "A", "B", "10:00", False, "2024-01-01"),
        resident("R2", "relocated", "A", "B", "10:00", False, "2024-01-05"),
    ])
    out = staging.stage_residents(df)
    assert rows(out, "resident_id", "resident_status") == [("R1", "deceased"), ("R2", "relocated")]


def test_relocation_reasons(spark):
    df = raw(spark, "relocations", [(f"L{i}", "R1", "D1", "D2", ts("2024-01-01"), reason)
                                    for i, reason in enumerate([" sanction ", "", None, "Family"])])
    assert rows(staging.stage_relocations(df), "relocation_id", "relocation_reason") == [
        ("L0", "SANCTION"), ("L1", "UNSPECIFIED"), ("L2", "UNSPECIFIED"), ("L3", "FAMILY")]


def test_assignments_keep_a_blank_status_and_read_blank_ends_as_open(spark):
    df = raw(spark, "job_assignments", [
        ("A1", "R1", " mech ", " ", "day", ts("2024-01-01"), "  ", "", ts("2024-01-01")),
        ("A2", "R1", "MECH", "Clerk", "", ts("2024-01-01"), "2024-02-01 08:00:00", " Ended ", None),
    ])
    assert rows(staging.stage_assignments(df), "assignment_id", "department_code", "role_title", "shift_code",
                "ended_at", "assignment_status", "is_current") == [
        ("A1", "MECH", None, "DAY", None, "", True),
        ("A2", "MECH", "Clerk", None, ts("2024-02-01 08:00"), "ended", False)]


def test_department_codes_are_not_normalised(spark):
    df = raw(spark, "departments", [(" mech ", " Mechanical ", 140, 2)])
    assert rows(staging.stage_departments(df)) == [(" mech ", "Mechanical", 140, 2)]


def test_equipment_ranks(spark):
    df = raw(spark, "equipment", [(f"E{i}", " Pump ", 3, c, date(2020, 1, 1))
                                  for i, c in enumerate([" critical", "HIGH", "medium", "LOW ", "odd", "", None])])
    assert rows(staging.stage_equipment(df), "equipment_id", "criticality", "criticality_rank") == [
        ("E0", "CRITICAL", 1), ("E1", "HIGH", 2), ("E2", "MEDIUM", 3), ("E3", "LOW", 4),
        ("E4", "ODD", 9), ("E5", None, 9), ("E6", None, 9)]


def test_maintenance_orders_keep_negative_durations(spark):
    df = raw(spark, "maintenance_orders", [
        ("M1", "E1", "mech", ts("2024-01-02"), "", "p1", "open", ""),
        ("M2", "E1", "mech", ts("2024-01-02"), "2024-01-01 12:00:00", " p2", "CLOSED", "3.5"),
    ])
    assert rows(staging.stage_maintenance_orders(df), "order_id", "closed_at", "labour_hours", "priority",
                "order_status", "is_open") == [
        ("M1", None, None, "P1", "OPEN", True),
        ("M2", ts("2024-01-01 12:00"), Decimal("3.5"), "P2", "CLOSED", False)]


def test_csv_sources_read_blanks_as_null(spark, tmp_path):
    folder = tmp_path / "mech_db"
    folder.mkdir()
    (folder / "generator_readings.csv").write_text(
        "reading_id,generator_id,read_at,output_kw,temperature_c,vibration_mm_s,is_manual_entry,_synced_at\n"
        "RD-1,gen-1,2024-01-01 10:00:00,,71.25,2.125,,2024-01-01 10:05:00\n"
        "RD-2,gen-1,2024-01-01 11:00:00,-5.00,71.25,2.125,true,2024-01-09 11:00:00\n")
    df = read_source(spark, "generator_readings", str(tmp_path))
    assert df.schema == SOURCES["generator_readings"].schema
    assert rows(staging.stage_readings(df), "reading_id", "generator_id", "output_kw", "is_faulty_reading",
                "is_manual_entry", "sync_lag_seconds") == [
        ("RD-1", "GEN-1", None, None, False, 300), ("RD-2", "GEN-1", None, True, True, 8 * 86_400)]


def test_level_zones(spark, tmp_path):
    (tmp_path / "seeds").mkdir()
    (tmp_path / "seeds" / "level_zones.csv").write_text(
        "level_number,zone_name,supply_tier,has_lift_access\n1, Up Top ,1,true\n2,Mids,2,\n")
    out = staging.stage_level_zones(read_source(spark, "level_zones", str(tmp_path)))
    assert rows(out, "level_number", "zone_name", "supply_tier", "has_lift_access") == [
        (1, "Up Top", 1, True), (2, "Mids", 2, False)]


def test_csv_columns_in_another_order_are_refused(spark, tmp_path):
    (tmp_path / "works_db").mkdir()
    (tmp_path / "works_db" / "departments.csv").write_text(
        "department_name,department_code,home_level,establishment_headcount\nMechanical,MECH,140,5\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_source(spark, "departments", str(tmp_path)).collect()


def test_residents_equal_in_both_clocks_give_one_answer(spark):
    schema = SOURCES["residents"].ddl
    moment = ts("2024-01-01")
    two = [("R", name, "x", None, "D", "active", moment, moment, moment, False) for name in ("a", "b")]
    for data in (two, two[::-1]):
        out = staging.stage_residents(spark.createDataFrame(data, schema).coalesce(1))
        assert rows(out, "given_name") == [("b",)]
