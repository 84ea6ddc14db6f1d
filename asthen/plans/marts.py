"""Marts: occupancy, staffing, generator output and the level dimension.

Business states are published as flags, never filtered out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from asthen.functions import safe_ratio, surrogate_key
from asthen.operators.intervals import (
    clamp_months,
    counts_between_steps,
    disjoint_months,
    month_steps,
)
from asthen.operators.rows import latest_per_key
from asthen.operators.trends import baseline, movement, rolling_max, rolling_mean, trend_label, vs_baseline
from asthen.plans.history import FIRST_MONTH, LAST_MONTH, UNMAPPED

# Thresholds of the published flags.
SIGNIFICANT_DECLINE = -2
DEGRADED_BELOW = "0.975"
HIGH_VIBRATION = "4.5"
SHADOW_ROLE = "Shadow"
SHIFTS = {"day_shift_headcount": "DAY", "swing_shift_headcount": "SWING", "night_shift_headcount": "NIGHT"}


def level_monthly_occupancy(population: DataFrame) -> DataFrame:
    """Population per level and month with its movement since the month before."""
    moved = movement(
        population, "level_number", "month_start", "active_residents",
        "previous_active_residents", "resident_change",
    )
    return moved.select(
        surrogate_key(F.col("level_number"), F.col("month_start")).alias("level_month_id"),
        "month_start", "level_number", "zone_name", "supply_tier",
        "total_residents", "active_residents", "family_dwelling_residents",
        "previous_active_residents", "resident_change",
        trend_label("previous_active_residents", "resident_change").alias("occupancy_trend"),
        (F.col("active_residents") == 0).alias("is_empty_level"),
        (F.col("resident_change") < SIGNIFICANT_DECLINE).alias("is_significant_decline"),
    )


def generator_daily_output(daily: DataFrame) -> DataFrame:
    """Daily output against its rolling averages and the generator's first day.

    The means are taken over the published, rounded daily averages.
    """
    key, order = "generator_id", "reading_date"
    trend = daily.withColumns({
        "rolling_7d_avg_output_kw": rolling_mean("avg_output_kw", key, order, 7, 2),
        "rolling_30d_avg_output_kw": rolling_mean("avg_output_kw", key, order, 30, 2),
        "baseline_output_kw": baseline("avg_output_kw", key, order),
        "rolling_30d_max_vibration": rolling_max("max_vibration_mm_s", key, order, 30),
    })
    below = F.col("avg_output_kw") < F.col("baseline_output_kw") * F.lit(DEGRADED_BELOW).cast("decimal(4,3)")
    return trend.select(
        "generator_day_id", "generator_id", "reading_date",
        "reading_count", "valid_reading_count", "faulty_reading_count",
        "avg_output_kw", "min_output_kw", "max_output_kw", "avg_temperature_c", "max_vibration_mm_s",
        "rolling_7d_avg_output_kw", "rolling_30d_avg_output_kw",
        F.round("baseline_output_kw", 2).alias("baseline_output_kw"),
        F.round("rolling_30d_max_vibration", 3).alias("rolling_30d_max_vibration"),
        vs_baseline("avg_output_kw", "baseline_output_kw").alias("output_vs_baseline_pct"),
        below.alias("is_below_975pct_baseline"),
        (F.col("faulty_reading_count") > 0).alias("had_sensor_fault"),
        (F.col("rolling_30d_max_vibration") > F.lit(HIGH_VIBRATION).cast("decimal(2,1)")).alias(
            "is_high_vibration"
        ),
    )


# What staffing counts, in this order; a membership has the bit of each that it counts for.
STAFFING = ("assignment_count", "headcount", *SHIFTS, "shadow_count")
ASSIGNMENTS = 0


def _memberships(assignments: DataFrame) -> DataFrame:
    """Two rows per assignment, itself and its person, each with the measures it counts for as bits.

    These are dealt by entity, and all further steps per entity keep that dealing: the assignments
    are read and moved once. A null person counts as nobody and goes first; a null assignment
    stays, as it makes the department appear.
    """
    conditions = [*[F.col("shift_code") == code for code in SHIFTS.values()], F.col("role_title") == SHADOW_ROLE]
    of_person = F.lit(1 << 1)
    for i, condition in enumerate(conditions, 2):
        of_person = of_person.bitwiseOR(F.when(condition, 1 << i).otherwise(0))
    entities = F.array(
        F.struct(F.lit(True).alias("is_assignment"), F.col("assignment_id").cast("string").alias("entity"),
                 F.lit(1 << ASSIGNMENTS).alias("measures")),
        F.struct(F.lit(False).alias("is_assignment"), F.col("resident_id").cast("string").alias("entity"),
                 of_person.alias("measures")),
    )
    return (
        assignments.select("department_code", "first_month", "last_month", F.inline(entities))
        .filter(F.col("is_assignment") | F.col("entity").isNotNull())
        .repartition("department_code", "is_assignment", "entity")
    )


def department_monthly_staffing(
    assignments: DataFrame, departments: DataFrame,
    lo: str | Column = FIRST_MONTH, hi: str | Column = LAST_MONTH,
) -> DataFrame:
    """Distinct people and assignments per department and month against establishment.

    Equals distinct counts over assignment_months, without producing its rows: a
    person's overlapping ranges in a department are cut to disjoint ones, whose edges
    then sum up like those of any interval, and hold until the department's next edge. Rows
    shuffled grow with the assignments, not with assignments times months. Departments are joined to the finished counts.
    Codes without a department keep a row each.
    """
    covered = clamp_months(assignments, "started_at", "ended_at", lo, hi)
    pieces = disjoint_months(
        _memberships(covered), ["department_code", "is_assignment", "entity"],
        "first_month", "last_month", "measures", len(STAFFING), "measure",
    )
    steps = month_steps(pieces, "first_month", "last_month", hi)

    def change(condition: Column) -> Column:
        return F.sum(F.when(condition, F.col("step")).otherwise(0))

    counted = F.col("entity").isNotNull()
    per_month = steps.groupBy("department_code", "month_start").agg(
        *[change((F.col("measure") == i) & counted).alias(name) for i, name in enumerate(STAFFING)],
        # null ids count as nobody but still make the department appear that month
        change(F.col("measure") == ASSIGNMENTS).alias("_present"),
    )
    counts = counts_between_steps(per_month, ["department_code"], [*STAFFING, "_present"], hi, "_present")

    known = departments.groupBy("department_code", "department_name").agg(
        F.max("establishment_headcount").alias("establishment_headcount")
    )
    known = known.select(
        F.col("department_code").alias("_code"), F.col("department_name").alias("_name"),
        "establishment_headcount",
    )
    named = counts.join(known, F.col("department_code") == F.col("_code"), "left")
    return named.select(
        surrogate_key(F.col("department_code"), F.col("month_start")).alias("department_month_id"),
        "month_start", "department_code",
        F.coalesce("_name", F.lit(UNMAPPED)).alias("department_name"),
        "establishment_headcount", *STAFFING,
        (F.col("headcount") - F.col("establishment_headcount")).alias("headcount_variance"),
        safe_ratio(F.col("headcount"), F.col("establishment_headcount"), 3).alias("establishment_fill_rate"),
        (F.col("headcount") < F.col("establishment_headcount")).alias("is_understaffed"),
        F.col("_code").isNull().alias("is_unmapped_department"),
    )


def dim_levels(zones: DataFrame, dwellings: DataFrame, equipment: DataFrame, occupancy: DataFrame) -> DataFrame:
    """One row per level: size, equipment and the latest occupancy.

    Each side is reduced to one row per level before it is joined.
    """
    housing = dwellings.groupBy("level_number").agg(
        F.count("*").alias("dwelling_count"), F.sum("capacity").alias("total_capacity")
    )
    machines = equipment.groupBy("level_number").agg(
        F.count("*").alias("equipment_count"),
        F.count_if(F.col("criticality") == "CRITICAL").alias("critical_equipment_count"),
    )
    now = latest_per_key(occupancy, ["level_number"], ["month_start"]).select(
        "level_number",
        F.col("active_residents").alias("current_active_residents"),
        F.col("occupancy_trend").alias("current_trend"),
    )
    joined = (
        zones.join(housing, "level_number", "left")
        .join(machines, "level_number", "left")
        .join(now, "level_number", "left")
    )
    zero = F.lit(0)
    return joined.select(
        "level_number", "zone_name", "supply_tier", "has_lift_access",
        F.coalesce("dwelling_count", zero).alias("dwelling_count"),
        F.coalesce("total_capacity", zero).alias("total_capacity"),
        F.coalesce("equipment_count", zero).alias("equipment_count"),
        F.coalesce("critical_equipment_count", zero).alias("critical_equipment_count"),
        F.coalesce("current_active_residents", zero).alias("current_active_residents"),
        "current_trend",
        safe_ratio(F.col("current_active_residents"), F.col("total_capacity"), 3).alias(
            "capacity_utilisation"
        ),
    )
