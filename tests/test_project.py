"""A whole run from csv files to marts, twice, and a run with a failing check."""

from datetime import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from asthen.plans.project import MODELS, all_checks, run_project, source_freshness
from asthen.plans.project import all_models as project_models
from asthen.sources.registry import SOURCES, read_sources

AS_OF = datetime(2025, 1, 2)

CSV = {
    "census_db/dwellings": """dwelling_id,level_number,unit_number,dwelling_type,capacity
DW-001-01,1,1,STANDARD,3
DW-002-01,2,1,family,5
""",
    "census_db/residents": """resident_id,given_name,family_name,birth_date,dwelling_id,status,registered_at,updated_at,_synced_at,_deleted
RES-1,Ann,Bell,1990-01-01,DW-001-01,Active,2000-01-01 00:00:00,2021-01-01 00:00:00,2021-01-01 01:00:00,false
RES-1,Ann,Bell,1990-01-01,DW-001-01,ACTIVE,2000-01-01 00:00:00,2021-01-01 00:00:00,2021-01-01 02:00:00,false
RES-2,Cy,,1990-01-01,DW-002-01,,2000-01-01 00:00:00,2021-01-01 00:00:00,2021-01-01 01:00:00,
RES-3,Di,Eke,1990-01-01,DW-002-01,active,2000-01-01 00:00:00,2021-01-01 00:00:00,2021-01-01 01:00:00,true
""",
    "census_db/relocations": """relocation_id,resident_id,from_dwelling_id,to_dwelling_id,relocated_at,reason
REL-1,RES-1,DW-001-01,DW-002-01,2023-05-05 10:00:00,SANCTION
""",
    "works_db/departments": """department_code,department_name,home_level,establishment_headcount
MECH,Mechanical,140,1
""",
    "works_db/job_assignments": """assignment_id,resident_id,department_code,role_title,shift_code,started_at,ended_at,status,updated_at
JOB-1,RES-1,MECH,Clerk,DAY,2020-01-01 00:00:00,,ACTIVE,2020-01-01 00:00:00
JOB-2,RES-2,RECYC,Shadow,NIGHT,2022-03-03 00:00:00,2022-04-04 00:00:00,ENDED,2022-04-04 00:00:00
""",
    "mech_db/equipment": """equipment_id,equipment_name,level_number,criticality,installed_on
EQ-1,Pump,2,critical,2001-01-01
""",
    "mech_db/generator_readings": """reading_id,generator_id,read_at,output_kw,temperature_c,vibration_mm_s,is_manual_entry,_synced_at
RD-1,GEN-1,2024-12-31 10:00:00,100.00,70.00,2.000,false,2025-01-01 10:00:00
RD-2,GEN-1,2024-12-31 11:00:00,-100.00,70.00,2.000,false,2025-01-01 11:00:00
""",
    "mech_db/maintenance_orders": """order_id,equipment_id,department_code,opened_at,closed_at,priority,status,labour_hours
MO-1,EQ-1,MECH,2024-01-02 00:00:00,2024-01-01 12:00:00,P1,CLOSED,2.5
MO-2,EQ-1,MECH,2024-01-02 00:00:00,,P2,OPEN,
""",
}


# Levels of the seed; the test needs no more than a few of each zone.
ZONES = "level_number,zone_name,supply_tier,has_lift_access\n" + "".join(
    f"{level},{zone},{tier},{lift}\n"
    for level, zone, tier, lift in (
        (1, "Up Top", 1, "true"), (2, "Up Top", 1, "false"), (20, "Up Top", 1, ""), (21, "Mids", 2, "true"),
        (34, "Mids", 2, "true"), (101, "Down Deep", 3, "false"), (144, "Down Deep", 3, "true"),
    ))


@pytest.fixture
def raw(spark, tmp_path):
    for name, text in CSV.items():
        path = tmp_path / "raw" / f"{name}.csv"
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text)
    (tmp_path / "raw" / "seeds").mkdir()
    (tmp_path / "raw" / "seeds" / "level_zones.csv").write_text(ZONES)
    return read_sources(spark, str(tmp_path / "raw"))


def test_there_are_54_checks_with_four_warnings_only():
    checks = all_checks()
    assert len(checks) == 54 and len({c.name for c in checks}) == 54
    assert sum(c.severity == "warn" for c in checks) == 4


def test_models_come_after_their_inputs():
    seen = set(SOURCES)
    for model in MODELS:
        assert set(model.inputs) <= seen, model.name
        seen.add(model.name)


def test_run(spark, tmp_path, raw):
    root = str(tmp_path / "warehouse")
    for _ in range(2):
        outcomes = {o.model: o for o in run_project(spark, raw, root, AS_OF)}
        assert {o.status for o in outcomes.values()} == {"built"}
        warned = {line["check_name"] for o in outcomes.values() for line in o.checks if line["status"] == "warn"}
        assert warned == {"unique_residents_resident_id", "maintenance_orders_close_after_opening"}
        assert spark.table("level_monthly_occupancy").count() == 36 * 7
        assert rows(spark.sql("""
            select month_start, level_number, active_residents, total_residents
            from level_monthly_occupancy where level_number in (1, 2)
            and month_start in (date'2023-04-01', date'2023-05-01', date'2023-06-01')"""
        ).withColumn("month_start", F.month("month_start"))) == [
            (4, 1, 1, 1), (4, 2, 0, 1), (5, 1, 1, 1), (5, 2, 1, 2), (6, 1, 0, 0), (6, 2, 1, 2)]
        assert rows(spark.table("department_monthly_staffing").groupBy("department_name").count()) == [
            ("Mechanical", 36), ("UNMAPPED", 2)]
        assert rows(spark.table("generator_daily_output"), "reading_count", "faulty_reading_count") == [(2, 1)]
        assert rows(spark.table("assignment_history").filter("valid_to is null"), "assignment_id") == [
            ("JOB-1",), ("JOB-2",)]
        assert spark.table("dim_levels").filter("critical_equipment_count = 1").count() == 1


def test_a_failed_check_stops_what_is_below(spark, tmp_path, raw):
    doubled = dict(raw, dwellings=raw["dwellings"].unionByName(raw["dwellings"]))
    outcomes = {o.model: o.status for o in run_project(spark, doubled, str(tmp_path / "w"), AS_OF)}
    assert outcomes["dwellings"] == "failed"
    skipped = {m for m, status in outcomes.items() if status == "skipped"}
    assert skipped == {"stage_dwellings", "residents_by_level", "level_monthly_population",
                       "level_monthly_occupancy", "dim_levels"}
    assert outcomes["generator_daily_output"] == outcomes["department_monthly_staffing"] == "built"


def test_freshness_of_the_readings(raw):
    assert rows(source_freshness(raw, AS_OF), "table_name", "age_seconds", "status") == [
        ("generator_readings", 13 * 3600, "warn")]


def test_freshness_has_a_line_for_each_source_with_a_load_time(raw, monkeypatch):
    from dataclasses import replace

    from asthen.plans import project

    two = {**SOURCES, "residents": replace(SOURCES["residents"], loaded_at="_synced_at", warn_hours=1, error_hours=2)}
    monkeypatch.setattr(project, "SOURCES", two)
    assert rows(source_freshness(raw, AS_OF), "table_name") == [("generator_readings",), ("residents",)]


def test_the_months_of_a_run_are_a_parameter():
    names = [m.name for m in project_models("2030-01-01", "2030-02-01")]
    assert names == [m.name for m in MODELS]
