"""All models with their inputs, storage and checks, and a run over them.

A run goes through the models in order: build, store if it is a table, check. A model
with a failed error check, or with an input that failed, stops everything below it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession

from asthen.functions import moment
from asthen.operators.quality import Check, Observed, ends_before_start, freshness, report
from asthen.plans import history, marts, staging
from asthen.plans.rollup import LOOKBACK_DAYS, publish_generator_daily, refresh_generator_daily
from asthen.sources.registry import SOURCES
from asthen.sources.tables import HistoryTable, refresh, table_path
from asthen.sources.warehouse import Warehouse

VIEW, TABLE, INCREMENTAL, SNAPSHOT = "view", "table", "incremental", "snapshot"
# Accepted values and bounds of the checks.
ZONES = ("Up Top", "Mids", "Down Deep")
TRENDS = ("baseline", "growing", "shrinking", "stable")
# The table of a model's ranges beside the model, for its checks.
RANGES = "{}.ranges"


@dataclass(frozen=True)
class Model:
    name: str
    layer: str
    inputs: tuple[str, ...]
    build: Callable[..., DataFrame] | None
    stored: str = VIEW
    checks: tuple[Check, ...] = ()
    # of a snapshot: its key and the column that tells when a row changed
    versioned_by: tuple[str, str] = ("", "")
    # of a view that repeats rows: these once, which checks may read as the table RANGES names
    ranges: Callable[..., DataFrame] | None = None


@dataclass(frozen=True)
class Outcome:
    """Result of one model: built, failed or skipped, with its check lines."""

    model: str
    status: str
    checks: tuple = ()


def _checks(table: str, not_null: Iterable[str] = (), unique: Iterable[str] = (),
            grain: Iterable[str] = (), extra: Iterable[Check] = ()) -> tuple[Check, ...]:
    grain = tuple(grain)
    return (
        *[Check(table, "unique", (c,)) for c in unique],
        *[Check(table, "not_null", (c,)) for c in not_null],
        *([Check(table, "unique_combination", grain)] if grain else []),
        *extra,
    )


def close_before_open(orders: DataFrame) -> DataFrame:
    return ends_before_start(orders, "opened_at", "closed_at", "negative_duration_seconds").select(
        "order_id", "equipment_id", "opened_at", "closed_at", "negative_duration_seconds"
    )


# Models that shuffle and are read several times, by checks and by others, are stored
# even where a view would do: a view is computed again for each reader.
def all_models(lo: str | Column = history.FIRST_MONTH, hi: str | Column = history.LAST_MONTH) -> tuple[Model, ...]:
    """The models, reporting on the months from `lo` to `hi`."""
    return (
        Model("stage_residents", "staging", ("residents",), staging.stage_residents, TABLE, _checks(
            "stage_residents", ["resident_id", "dwelling_id"], ["resident_id"], extra=[
                Check("stage_residents", "accepted_values", ("resident_status",),
                      options={"values": (*staging.STATUSES, staging.UNKNOWN_STATUS)})])),
        Model("stage_dwellings", "staging", ("dwellings",), staging.stage_dwellings, checks=_checks(
            "stage_dwellings", ["dwelling_id", "level_number"], ["dwelling_id"])),
        Model("stage_relocations", "staging", ("relocations",), staging.stage_relocations, checks=_checks(
            "stage_relocations", ["relocation_id", "resident_id"], ["relocation_id"])),
        Model("stage_assignments", "staging", ("job_assignments",), staging.stage_assignments),
        Model("stage_departments", "staging", ("departments",), staging.stage_departments),
        Model("stage_readings", "staging", ("generator_readings",), staging.stage_readings),
        Model("stage_equipment", "staging", ("equipment",), staging.stage_equipment),
        Model("stage_maintenance_orders", "staging", ("maintenance_orders",),
              staging.stage_maintenance_orders, checks=(
                  Check("stage_maintenance_orders", "rows", severity="warn", rows=close_before_open,
                        label="maintenance_orders_close_after_opening"),)),
        Model("stage_level_zones", "staging", ("level_zones",), staging.stage_level_zones),
        Model("assignment_history", "snapshots", ("job_assignments",), None, SNAPSHOT,
              versioned_by=("assignment_id", "updated_at")),
        Model("dwelling_history", "intermediate", ("stage_residents", "stage_relocations"),
              history.dwelling_history),
        Model("residents_by_level", "intermediate",
              ("stage_residents", "stage_dwellings", "stage_level_zones"),
              history.residents_by_level, TABLE, _checks(
                  "residents_by_level", ["resident_id", "level_number", "zone_name"], ["resident_id"],
                  extra=[Check("residents_by_level", "accepted_values", ("zone_name",),
                               options={"values": ZONES})])),
        Model("level_monthly_population", "intermediate",
              ("dwelling_history", "stage_dwellings", "stage_level_zones"),
              lambda *tables: history.level_monthly_population(*tables, lo, hi), TABLE, _checks(
                  "level_monthly_population", ["month_start", "level_number", "active_residents"],
                  grain=["month_start", "level_number"])),
        Model("assignment_months", "intermediate", ("stage_assignments", "stage_departments"),
              lambda *tables: history.assignment_months(*tables, lo, hi), checks=_checks(
                  "assignment_months",
                  ["month_start", "assignment_id", "department_name", "is_unmapped_department"],
                  extra=[Check("assignment_months", "unique_combination", ("assignment_id", "month_start"),
                               rows=history.repeated_assignment_months,
                               reads=RANGES.format("assignment_months"))]),
              ranges=lambda *tables: history.assignment_ranges(*tables, lo, hi)),
        Model("generator_daily", "intermediate", ("generator_readings",), None, INCREMENTAL, checks=_checks(
            "generator_daily", ["generator_day_id"], ["generator_day_id"],
            ["generator_id", "reading_date"],
            [Check("generator_daily", "accepted_range", ("avg_output_kw",), options={"low": 0})])),
        Model("level_monthly_occupancy", "marts", ("level_monthly_population",),
              marts.level_monthly_occupancy, TABLE, _checks(
                  "level_monthly_occupancy", ["level_month_id"], ["level_month_id"],
                  ["level_number", "month_start"],
                  [Check("level_monthly_occupancy", "accepted_values", ("occupancy_trend",),
                         options={"values": TRENDS})])),
        # Reads the staged assignments: the distinct counts need no expanded months. It still
        # waits for the checks of assignment_months.
        Model("department_monthly_staffing", "marts",
              ("stage_assignments", "stage_departments", "assignment_months"),
              lambda assignments, departments, _: marts.department_monthly_staffing(
                  assignments, departments, lo, hi),
              TABLE, _checks(
                  "department_monthly_staffing", ["department_month_id", "headcount"],
                  ["department_month_id"], ["department_code", "month_start"],
                  [Check("department_monthly_staffing", "accepted_range", ("establishment_fill_rate",),
                         "warn", {"low": 0, "high": 2})])),
        Model("generator_daily_output", "marts", ("generator_daily",), marts.generator_daily_output, TABLE),
        Model("dim_levels", "marts",
              ("stage_level_zones", "stage_dwellings", "stage_equipment", "level_monthly_occupancy"),
              marts.dim_levels, TABLE),
    )


MODELS = all_models()


def all_checks() -> list[Check]:
    """Checks of the raw tables and of the models."""
    return [c for s in SOURCES.values() for c in s.checks] + [c for m in MODELS for c in m.checks]


def source_freshness(raw: Mapping[str, DataFrame], as_of: datetime) -> DataFrame:
    """Freshness of the given sources that declare a load time, a line each."""
    lines = [
        freshness(raw[s.table], s.table, s.loaded_at, moment(as_of), s.warn_hours, s.error_hours)
        for s in SOURCES.values()
        if s.loaded_at and s.table in raw
    ]
    return reduce(DataFrame.unionByName, lines)


def _check(tables: Mapping[str, DataFrame], checks: tuple[Check, ...]) -> tuple:
    # one line per check
    return tuple(report(tables, checks).collect()) if checks else ()


def run_project(
    spark: SparkSession, raw: Mapping[str, DataFrame], root: str, as_of: datetime,
    models: tuple[Model, ...] = MODELS, lookback_days: int = LOOKBACK_DAYS, warehouse: Warehouse | None = None,
) -> list[Outcome]:
    """Build, store and check every model under `root`; every model is also a temp view.

    `models` may be `all_models` of other months; `lookback_days` is that of the daily rollup. With a
    `warehouse`, every model is a table `layer.name` of its catalog, for all sessions, and what a
    reader sees changes at once. Views are stored there as well: a DataFrame has no text
    that a catalog could keep.
    """
    ready = dict(raw)
    outcomes = []

    def settle(name: str, lines: tuple) -> None:
        failed = any(line["status"] == "error" for line in lines)
        if failed:
            ready.pop(name)
        outcomes.append(Outcome(name, "failed" if failed else "built", lines))

    for name, source in SOURCES.items():
        if name in raw:
            settle(name, _check(raw, source.checks))
    for model in models:
        if any(i not in ready for i in model.inputs):
            outcomes.append(Outcome(model.name, "skipped"))
            continue
        inputs = [ready[i] for i in model.inputs]
        # a stored model's rows are checked as they are written
        seen = Observed(model.checks if model.build and (warehouse or model.stored == TABLE) else ())
        path, place = table_path(root, model.layer, model.name), (model.layer, model.name)
        if model.stored == SNAPSHOT:
            table = HistoryTable(spark, path, *model.versioned_by)
            table.snapshot(inputs[0], moment(as_of))
            df = warehouse.view(*place, path, *table.files()) if warehouse else table.read()
        elif warehouse and model.stored == INCREMENTAL:
            df = publish_generator_daily(inputs[0], warehouse, *place, lookback_days=lookback_days)
        elif warehouse:
            df = warehouse.replace(seen.watch(model.build(*inputs)), *place)
        elif model.stored == INCREMENTAL:
            df = refresh_generator_daily(inputs[0], path, lookback_days=lookback_days)
        elif model.stored == TABLE:
            df = refresh(seen.watch(model.build(*inputs)), path)
        else:
            df = model.build(*inputs)
        df.createOrReplaceTempView(model.name)
        ready[model.name] = df
        if model.ranges:
            ready[RANGES.format(model.name)] = model.ranges(*inputs)
        rest = tuple(c for c in model.checks if c not in seen.checks)
        settle(model.name, (*seen.lines(), *_check(ready, rest)))
    return outcomes
