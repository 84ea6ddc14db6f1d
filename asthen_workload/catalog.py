"""The registered queries: every operator and model run over the test tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from asthen.functions import clean_string, moment, safe_ratio, surrogate_key
from asthen.operators import history as incremental
from asthen.operators import quality
from asthen.operators.counts import distinct_counts
from asthen.operators.intervals import event_intervals, month_grid, month_spine, months_between
from asthen.operators.ranges import in_intervals
from asthen.operators.rows import earliest_per_key, latest_per_key, latest_since
from asthen.plans import analyses, history, marts, project, staging
from asthen.plans.rollup import LOOKBACK_DAYS, ROLLUP_DAY, ROLLUP_KEY, refresh_generator_daily
from asthen.sources.audit import stored_freshness, stored_row_counts
from asthen.sources.registry import SOURCES, split_source
from asthen.sources.tables import HistoryTable, read_table, refresh, work_dir
from asthen.streaming.daily import write_closed_days, write_daily_deliveries
from asthen.streaming.rollup import write_generator_daily
from asthen_workload.bindings import HI, LO, RAW_TABLES, TEST_TABLES, Tables, stream_tables

AS_OF_FRESHNESS = datetime(2024, 2, 8, 12)
AS_OF_SNAPSHOT = datetime(2002, 1, 1)
# The first incremental run saw what had been synced by then.
FIRST_RUN = datetime(2024, 1, 20)

REPORTED = ("stage_residents", "stage_dwellings", "stage_relocations", "stage_maintenance_orders")

Query = Callable[[Tables], DataFrame]
QUERIES: dict[str, Query] = {}


def query_as(name: str) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        QUERIES[name] = build
        return build

    return register


def query(build: Query) -> Query:
    return query_as(build.__name__)(build)


def publish(df: DataFrame) -> DataFrame:
    """Plain result types: decimals as double, integers as bigint."""

    def plain(field):
        kind = field.dataType.typeName()
        if kind == "decimal":
            return F.col(field.name).cast("double").alias(field.name)
        if kind == "integer":
            return F.col(field.name).cast("bigint").alias(field.name)
        return F.col(field.name)

    return df.select(*[plain(f) for f in df.schema])


def run(build: Query) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: publish(build(Tables(spark, sf_dir)))


# --- staging ---------------------------------------------------------------------


@query
def stage_residents(t):
    return staging.stage_residents(t["residents"])


@query
def stage_dwellings(t):
    return staging.stage_dwellings(t["dwellings"])


@query
def stage_relocations(t):
    return staging.stage_relocations(t["relocations"])


@query
def stage_assignments(t):
    return staging.stage_assignments(t["job_assignments"])


@query
def stage_departments(t):
    return staging.stage_departments(t["departments"])


@query
def stage_readings(t):
    return staging.stage_readings(t["generator_readings"])


@query
def stage_equipment(t):
    return staging.stage_equipment(t["equipment"])


@query
def stage_maintenance_orders(t):
    return staging.stage_maintenance_orders(t["maintenance_orders"])


@query
def dim_zone_seed(t):
    return staging.stage_level_zones(t["level_zones"])


# --- expressions -------------------------------------------------------------------


@query_as("clean_string")
def clean_string_cases(t):
    reason = F.col("reason")
    return t["relocations"].select(
        "relocation_id",
        clean_string(reason, "lower").alias("reason_lower"),
        clean_string(reason, "upper").alias("reason_upper"),
        clean_string(reason, "none").alias("reason_as_is"),
    )


@query
def coalesce_category(t):
    return staging.stage_relocations(t["relocations"]).select("relocation_id", "relocation_reason")


@query
def full_name(t):
    return staging.clean_residents(t["residents"]).select(
        "resident_id", "synced_at", "given_name", "family_name", "full_name"
    )


@query
def normalise_status(t):
    return staging.clean_residents(t["residents"]).select("resident_id", "synced_at", "resident_status")


@query
def criticality_rank(t):
    return staging.stage_equipment(t["equipment"]).select("equipment_id", "criticality", "criticality_rank")


@query
def cast_after_nullif(t):
    return staging.stage_maintenance_orders(t["maintenance_orders"]).select(
        "order_id", "opened_at", "closed_at", "labour_hours"
    )


@query
def open_flag(t):
    return staging.stage_maintenance_orders(t["maintenance_orders"]).select("order_id", "closed_at", "is_open")


@query
def null_faulty_values(t):
    return staging.clean_readings(t["generator_readings"]).select(
        "reading_id", "synced_at", "output_kw", "is_faulty_reading"
    )


@query
def sync_lag(t):
    return staging.stage_readings(t["generator_readings"]).select(
        "reading_id", "read_at", "synced_at", "sync_lag_seconds"
    )


@query_as("surrogate_key")
def surrogate_keys(t):
    day = F.to_date("o_orderdate")
    late = F.when(F.col("o_orderstatus") == "F", F.col("o_custkey"))
    return t["orders"].select(
        "o_orderkey",
        surrogate_key(F.col("o_custkey"), day).alias("customer_day_id"),
        surrogate_key(late, day).alias("with_null_part_id"),
    )


@query_as("safe_ratio")
def safe_ratios(t):
    codes = staging.stage_assignments(t["job_assignments"]).groupBy("department_code").agg(
        F.count("*").alias("n_assignments")
    )
    departments = staging.stage_departments(t["departments"])
    return departments.join(codes, "department_code", "left").select(
        "department_code", "n_assignments", "establishment_headcount",
        safe_ratio(F.col("n_assignments"), F.col("establishment_headcount"), 4).alias("ratio"),
    )


# --- rows and intervals --------------------------------------------------------------


@query
def dedup_latest(t):
    return latest_per_key(t["residents"], staging.RESIDENT_KEY, staging.RESIDENT_ORDER).select(
        "resident_id", "status", F.col("_synced_at").alias("synced_at"), F.col("_deleted").alias("deleted")
    )


@query
def soft_delete_filter(t):
    return staging.stage_residents(t["residents"]).select("resident_id", "is_deleted")


@query
def dedup_readings(t):
    return latest_per_key(
        t["generator_readings"], staging.READING_KEY, staging.READING_ORDER, staging.READING_TIE
    ).select("reading_id", "read_at", "output_kw", F.col("_synced_at").alias("synced_at"))


@query
def first_row_per_key(t):
    return earliest_per_key(t["orders"], ["o_custkey"], ["o_orderdate"], ["o_orderkey"]).select(
        "o_custkey", "o_orderkey", "o_orderdate", "o_totalprice"
    )


@query
def latest_row_per_key(t):
    return latest_per_key(t["orders"], ["o_custkey"], ["o_orderdate"], ["o_orderkey"]).select(
        "o_custkey", "o_orderkey", "o_orderdate", "o_totalprice"
    )


@query
def assignment_at_move(t):
    """The assignments that a person held at the moment of each move."""
    moves = staging.stage_relocations(t["relocations"]).select("resident_id", "relocation_id", "relocated_at")
    held = staging.stage_assignments(t["job_assignments"]).select("resident_id", "assignment_id", "started_at", "ended_at")
    return in_intervals(moves, "relocated_at", held, "started_at", "ended_at", ["resident_id"])


@query
def orders_open_at(t):
    """Maintenance orders that are open at a moment of each month."""
    first = F.explode(months_between(F.to_date(F.lit(LO)), F.to_date(F.lit(HI))))
    months = t.spark.range(1).select(first.alias("month_start"))
    moments = months.select((F.col("month_start").cast("timestamp_ntz") + F.expr("interval 252 hours")).alias("moment"))
    orders = staging.stage_maintenance_orders(t["maintenance_orders"]).select("order_id", "opened_at", "closed_at")
    open_then = in_intervals(moments, "moment", orders, "opened_at", "closed_at")
    return open_then.groupBy("moment").agg(F.count("*").alias("open_orders"))


@query_as("event_intervals")
def event_interval_rows(t):
    events = t["orders"].select("o_custkey", "o_orderkey", F.col("o_orderdate").alias("valid_from"))
    return event_intervals(events, "o_custkey", "valid_from", "o_orderkey")


def order_bounds(t):
    return t["orders"].agg(
        F.min(F.to_date("o_orderdate")).alias("first_day"), F.max(F.to_date("o_orderdate")).alias("last_day")
    )


@query_as("month_spine")
def month_spine_rows(t):
    return month_spine(order_bounds(t), "first_day", "last_day")


@query_as("month_grid")
def month_grid_rows(t):
    bounds = order_bounds(t)
    return month_grid(
        staging.stage_level_zones(t["level_zones"]).select("level_number", "zone_name", "supply_tier"),
        F.trunc(bounds.select("first_day").scalar(), "MM"),
        F.trunc(bounds.select("last_day").scalar(), "MM"),
    )


# --- people --------------------------------------------------------------------------


@query
def dwelling_history(t):
    return history.dwelling_history(
        staging.stage_residents(t["residents"]), staging.stage_relocations(t["relocations"])
    )


@query
def residents_by_level(t):
    return history.residents_by_level(
        staging.stage_residents(t["residents"]), staging.stage_dwellings(t["dwellings"]),
        staging.stage_level_zones(t["level_zones"]),
    )


@query
def level_monthly_population(t):
    return history.level_monthly_population(
        dwelling_history(t), staging.stage_dwellings(t["dwellings"]),
        staging.stage_level_zones(t["level_zones"]), LO, HI,
    )


@query
def population_of_doubled_levels(t):
    """Every seventh level stands in a second zone; both have all its people."""
    zones = staging.stage_level_zones(t["level_zones"]).select("level_number", "zone_name", "supply_tier")
    second = zones.filter("level_number % 7 = 0").withColumns(
        {"zone_name": F.lit("Second"), "supply_tier": F.lit(9).cast(zones.schema["supply_tier"].dataType)}
    )
    return history.level_monthly_population(
        dwelling_history(t), staging.stage_dwellings(t["dwellings"]), zones.union(second), LO, HI
    )


@query
def level_monthly_occupancy(t):
    return marts.level_monthly_occupancy(level_monthly_population(t))


@query
def month_over_month(t):
    return level_monthly_occupancy(t).select(
        "level_number", "month_start", "active_residents", "previous_active_residents", "resident_change"
    )


@query
def occupancy_trend(t):
    return level_monthly_occupancy(t).select(
        "level_number", "month_start", "occupancy_trend", "is_empty_level", "is_significant_decline"
    )


@query
def trend_distribution(t):
    return analyses.trend_distribution(level_monthly_occupancy(t))


@query
def dim_levels(t):
    return marts.dim_levels(
        staging.stage_level_zones(t["level_zones"]), staging.stage_dwellings(t["dwellings"]),
        staging.stage_equipment(t["equipment"]), level_monthly_occupancy(t),
    )


@query
def sanctioned_relocations_by_level(t):
    return analyses.sanctioned_relocations_by_level(
        staging.stage_relocations(t["relocations"]), staging.stage_dwellings(t["dwellings"]),
        staging.stage_level_zones(t["level_zones"]),
    )


# --- work ----------------------------------------------------------------------------


def staged_work(t):
    return staging.stage_assignments(t["job_assignments"]), staging.stage_departments(t["departments"])


@query
def unmapped_left_join(t):
    return history.with_department(*staged_work(t)).select(
        "assignment_id", "department_code", "department_name", "home_level", "is_unmapped_department"
    )


@query
def assignment_months(t):
    return history.assignment_months(*staged_work(t), LO, HI)


@query
def department_monthly_staffing(t):
    return marts.department_monthly_staffing(*staged_work(t), LO, HI)


@query
def filtered_distinct_counts(t):
    assignments, _ = staged_work(t)
    shifts = {name: F.col("shift_code") == code for name, code in marts.SHIFTS.items()}
    shadows = {"shadow_count": F.col("role_title") == marts.SHADOW_ROLE}
    return distinct_counts(assignments, ["department_code"], "resident_id", "headcount", {**shifts, **shadows})


# --- generators ------------------------------------------------------------------------


@query
def generator_daily(t):
    return history.generator_daily(staging.stage_readings(t["generator_readings"]))


@query
def generator_daily_output(t):
    return marts.generator_daily_output(generator_daily(t))


@query
def rolling_7(t):
    return generator_daily_output(t).select(
        "generator_id", "reading_date", "avg_output_kw", "rolling_7d_avg_output_kw"
    )


@query
def rolling_30(t):
    return generator_daily_output(t).select(
        "generator_id", "reading_date", "rolling_30d_avg_output_kw", "rolling_30d_max_vibration"
    )


@query
def baseline_ratio(t):
    return generator_daily_output(t).select(
        "generator_id", "reading_date", "baseline_output_kw", "output_vs_baseline_pct"
    )


@query
def threshold_flags(t):
    return generator_daily_output(t).select(
        "generator_id", "reading_date", "is_below_975pct_baseline", "had_sensor_fault", "is_high_vibration"
    )


@query
def degradation_worklist(t):
    return analyses.degradation_worklist(generator_daily_output(t))


@query
def sync_lag_profile(t):
    return analyses.sync_lag_profile(staging.stage_readings(t["generator_readings"]))


# --- incremental and history -------------------------------------------------------------


def synced_by(t, clock):
    return t["generator_readings"].filter(F.col("_synced_at") < moment(clock))


def first_run(t):
    """The rollup as the first run left it."""
    return history.generator_daily(staging.stage_readings(synced_by(t, FIRST_RUN)))


def next_run(t, target):
    cutoff = incremental.lookback_start(target, ROLLUP_DAY, LOOKBACK_DAYS).scalar()
    batch = history.generator_daily_since(t["generator_readings"], cutoff)
    return incremental.keyed_upsert(target, batch, [ROLLUP_KEY])


@query
def incremental_lookback_filter(t):
    cutoff = incremental.lookback_start(first_run(t), ROLLUP_DAY, LOOKBACK_DAYS).scalar()
    recent = latest_since(
        t["generator_readings"], staging.READING_KEY, staging.READING_ORDER[0], "read_at", cutoff,
        staging.READING_TIE,
    )
    return staging.clean_readings(recent).select("reading_id", "read_at", "synced_at", "output_kw")


@query
def incremental_upsert(t):
    return next_run(t, first_run(t))


def stored_rollup_after_reruns(t):
    """The stored rollup after a first run on what was synced by then and two on everything."""
    path = f"{work_dir(t.spark)}/generator_daily"
    refresh_generator_daily(synced_by(t, FIRST_RUN), path)
    refresh_generator_daily(t["generator_readings"], path)
    return refresh_generator_daily(t["generator_readings"], path)


@query
def incremental_idempotent(t):
    return stored_rollup_after_reruns(t)


@query
def rollup_from_empty_target(t):
    """A first run before any reading had come, then one on all, stored by day."""
    folder = work_dir(t.spark)
    readings = staging.with_reading_days(t["generator_readings"])
    refresh_generator_daily(readings.limit(0), f"{folder}/rollup")
    refresh(readings, f"{folder}/readings", [staging.READ_DAY, staging.SYNC_DAY])
    return refresh_generator_daily(read_table(t.spark, f"{folder}/readings"), f"{folder}/rollup")


@query
def rerun_evidence(t):
    return analyses.rerun_evidence(stored_rollup_after_reruns(t), ROLLUP_KEY)


@query
def schema_drift_append(t):
    """A target from before the vibration column existed."""
    return next_run(t, first_run(t).drop("max_vibration_mm_s"))


@query
def scd2_first_load(t):
    return incremental.scd2_first_load(t["assignments_before"], "assignment_id", "updated_at")


@query
def scd2_merge(t):
    return incremental.scd2_merge(
        scd2_first_load(t), t["assignments_after"], "assignment_id", "updated_at",
        moment(AS_OF_SNAPSHOT),
    )


@query
def scd2_stored(t):
    """The same two states through the stored history, and a third run in which nothing changed."""
    table = HistoryTable(t.spark, f"{work_dir(t.spark)}/assignment_history", "assignment_id", "updated_at")
    for name in ("assignments_before", "assignments_after", "assignments_after"):
        table.snapshot(t[name], moment(AS_OF_SNAPSHOT))
    return table.read()


# --- checks --------------------------------------------------------------------------------


@query
def row_count_audit(t):
    return quality.row_counts({f"{SOURCES[n].system}.{n}": t[n] for n in RAW_TABLES})


@query
def stored_row_audit(t):
    """Of the test tables as they are stored, from their files' footers."""
    return stored_row_counts(t.spark, {n: f"{t.sf_dir}/{n}.parquet" for n in TEST_TABLES})


@query
def stored_freshness_by_day(t):
    """The readings stored by the day they were synced."""
    path = f"{work_dir(t.spark)}/readings"
    synced = t["generator_readings"].withColumn(staging.SYNC_DAY, F.to_date("_synced_at"))
    refresh(synced, path, [staging.SYNC_DAY])
    source = SOURCES["generator_readings"]
    return stored_freshness(t.spark, path, source.table, source.loaded_at, staging.SYNC_DAY,
                            moment(AS_OF_FRESHNESS), source.warn_hours, source.error_hours)


@query
def quarantine(t):
    """The readings as csv, some with a temperature or a time that is none; good rows and refused lines."""
    feed = t["reading_feed"]
    bad = {"temperature_c": (97, "n/a"), "read_at": (89, "yesterday")}
    columns = SOURCES["generator_readings"].schema.names
    lines = feed.select(*[
        F.when(F.col("n") % bad[c][0] == 0, bad[c][1]).otherwise(F.col(c).cast("string")).alias(c) if c in bad
        else F.col(c).cast("string").alias(c) for c in columns])
    folder = work_dir(t.spark)
    lines.write.option("header", True).csv(f"{folder}/mech_db/generator_readings.csv")
    good, refused = split_source(t.spark, "generator_readings", folder)
    return good.select("reading_id", "read_at", "temperature_c", F.lit(False).alias("is_refused")).unionByName(
        refused.select(F.split("line", ",")[0].alias("reading_id"), F.lit(True).alias("is_refused")),
        allowMissingColumns=True)


@query
def source_freshness(t):
    return project.source_freshness({"generator_readings": t["generator_readings"]}, AS_OF_FRESHNESS)


@query
def dq_unique(t):
    return quality.not_unique(t["generator_readings"], "reading_id")


@query
def dq_not_null(t):
    return quality.missing(t["residents"], "dwelling_id").select("resident_id", "dwelling_id")


@query
def dq_accepted_values(t):
    return quality.unexpected_values(t["residents"], "status", staging.STATUSES)


@query
def dq_unique_combination(t):
    return quality.repeated(t["lineitem"], ["l_orderkey", "l_linenumber"])


@query
def dq_accepted_range(t):
    return quality.out_of_range(
        staging.clean_readings(t["generator_readings"]), "temperature_c", low=41, high=200
    ).select("reading_id", "synced_at", "temperature_c")


@query
def dq_close_before_open(t):
    return project.close_before_open(staging.stage_maintenance_orders(t["maintenance_orders"]))


def raw_tables(t):
    return {n: t[n] for n in (*RAW_TABLES, "level_zones")}


@query
def dq_report(t):
    """All checks, whatever the outcome of those above them."""
    built = {
        **{m.name: m.build(t[m.inputs[0]]) for m in project.MODELS if m.name in REPORTED},
        "residents_by_level": residents_by_level(t),
        "level_monthly_population": level_monthly_population(t),
        "assignment_months": assignment_months(t),
        project.RANGES.format("assignment_months"): history.assignment_ranges(*staged_work(t), LO, HI),
        "generator_daily": history.generator_daily(staging.stage_readings(t["generator_readings"])),
        "level_monthly_occupancy": level_monthly_occupancy(t),
        "department_monthly_staffing": department_monthly_staffing(t),
    }
    return quality.report({**raw_tables(t), **built}, project.all_checks())


@query
def project_run(t):
    """The run over all models: what was built, what failed its checks, what was skipped below."""
    outcomes = project.run_project(
        t.spark, raw_tables(t), work_dir(t.spark), AS_OF_FRESHNESS, project.all_models(LO, HI)
    )
    return t.spark.createDataFrame([(o.model, o.status) for o in outcomes], "model string, status string")


@query
def defect_profile(t):
    return analyses.defect_profile(
        {n: t[n] for n in RAW_TABLES}, staging.stage_departments(t["departments"])
    )


# --- stream ----------------------------------------------------------------------------------


def stream_generator_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as a file stream, through to the stored rollup."""
    folder = work_dir(spark)
    raw = stream_tables(spark, sf_dir)["generator_readings"]
    write_generator_daily(
        raw, f"{folder}/rollup", f"{folder}/readings", f"{folder}/checkpoint", availableNow=True
    ).awaitTermination()
    return publish(read_table(spark, f"{folder}/rollup"))


def streamed(write, change=lambda raw: raw) -> Callable[[SparkSession, str], DataFrame]:
    """A stream of the events as raw readings, through state to a stored table."""

    def run_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
        folder = work_dir(spark)
        raw = change(stream_tables(spark, sf_dir)["generator_readings"])
        write(raw, f"{folder}/days", f"{folder}/checkpoint", availableNow=True).awaitTermination()
        return publish(read_table(spark, f"{folder}/days"))

    return run_stream


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {**{name: run(build) for name, build in QUERIES.items()},
            "stream_generator_daily": stream_generator_daily,
            "stream_closed_days": streamed(write_closed_days),
            # every delivery comes twice
            "stream_daily_deliveries": streamed(write_daily_deliveries, lambda raw: raw.union(raw))}
