"""Intermediate models: who lived where, who worked where, what each generator did."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from asthen.functions import exact_mean, surrogate_key
from asthen.operators.intervals import (
    clamp_months,
    event_intervals,
    expand_months,
    month_grid,
    month_steps,
    months_between,
    running_counts,
)
from asthen.operators.quality import repeated
from asthen.operators.rows import latest_since
from asthen.plans.staging import (
    READ_DAY,
    READING_KEY,
    READING_ORDER,
    READING_TIE,
    SYNC_DAY,
    clean_readings,
)

# The reporting months and the name of departments without a match.
FIRST_MONTH, LAST_MONTH = "2022-01-01", "2024-12-01"
UNMAPPED = "UNMAPPED"


def dwelling_history(residents: DataFrame, relocations: DataFrame) -> DataFrame:
    """One row per person and period in a dwelling.

    Every move opens a period that the next move closes. Before the first move the
    person lived where that move came from, since registration; who never moved lives
    in the current dwelling. Status and birth date are today's, not those of the period.
    The first move yields two periods. Moves without a person belong to no one and go first.
    """
    moves = event_intervals(
        relocations.filter(F.col("resident_id").isNotNull()).select(
            "resident_id", "relocation_id", "from_dwelling_id", "to_dwelling_id", "relocated_at"
        ),
        "resident_id", "relocated_at", "relocation_id", valid_to="_until", first="_is_first",
    )
    people = residents.select(
        "resident_id", "dwelling_id", "registered_at", "resident_status", "birth_date"
    )
    both = people.join(moves, "resident_id", "left")

    moved, is_first = F.col("_is_first").isNotNull(), F.col("_is_first")
    original = F.struct(
        F.coalesce("from_dwelling_id", "dwelling_id").alias("dwelling_id"),
        F.col("registered_at").alias("valid_from"),
        F.col("relocated_at").alias("valid_to"),
    )
    after_move = F.struct(
        F.col("to_dwelling_id").alias("dwelling_id"),
        F.col("relocated_at").alias("valid_from"),
        F.col("_until").alias("valid_to"),
    )
    periods = (
        F.when(moved & is_first, F.array(original, after_move))
        .when(moved, F.array(after_move))
        .otherwise(F.array(original))
    )
    return (
        both.select("resident_id", "resident_status", "birth_date", F.explode(periods).alias("_p"))
        .select("resident_id", "_p.*", "resident_status", "birth_date")
        .filter(F.col("dwelling_id").isNotNull())
        .select(
            "resident_id", "dwelling_id", "valid_from", "valid_to",
            F.col("valid_to").isNull().alias("is_current_residency"),
            "resident_status", "birth_date",
        )
    )


def residents_by_level(residents: DataFrame, dwellings: DataFrame, zones: DataFrame) -> DataFrame:
    """Each person with the current dwelling, its level and zone; unmatched stay, as null.

    No broadcast hints: Spark broadcasts a side it has measured to be small, and splits
    the partition of a crowded dwelling otherwise.
    """
    d = dwellings.select(F.col("dwelling_id").alias("_d"), "level_number", "dwelling_type")
    z = zones.select(F.col("level_number").alias("_l"), "zone_name", "supply_tier", "has_lift_access")
    return (
        residents.join(d, F.col("dwelling_id") == F.col("_d"), "left")
        .join(z, F.col("level_number") == F.col("_l"), "left")
        .select(
            "resident_id", "full_name", "resident_status", "birth_date", "registered_at",
            F.col("_d").alias("dwelling_id"), "level_number", "dwelling_type",
            "zone_name", "supply_tier", "has_lift_access",
        )
    )


def level_monthly_population(
    history: DataFrame, dwellings: DataFrame, zones: DataFrame,
    lo: str | Column = FIRST_MONTH, hi: str | Column = LAST_MONTH,
) -> DataFrame:
    """Periods that cover a month, per level and month; empty levels count zero.

    Counts periods: who moves within a month counts on both levels. Each period becomes
    its two edges, which are summed per dwelling and month before any shuffle, then per
    level; the running sum over levels and months gives the counts, to which each row of the
    zones then adds its attributes. The range join of periods with months is never
    carried out.
    """
    covered = clamp_months(history, "valid_from", "valid_to", lo, hi)
    steps = month_steps(
        covered.select("resident_id", "dwelling_id", "resident_status", "first_month", "last_month"),
        "first_month", "last_month", hi,
    ).filter(F.col("resident_id").isNotNull())
    per_dwelling = steps.groupBy("dwelling_id", "month_start").agg(
        F.sum("step").alias("total"),
        F.sum(F.when(F.col("resident_status") == "active", F.col("step")).otherwise(0)).alias("active"),
    )
    per_level = (
        per_dwelling.join(dwellings.select("dwelling_id", "level_number", "dwelling_type"), "dwelling_id")
        .groupBy("level_number", "month_start")
        .agg(
            F.sum("total").alias("total_residents"),
            F.sum("active").alias("active_residents"),
            F.sum(F.when(F.col("dwelling_type") == "FAMILY", F.col("total")).otherwise(0)).alias(
                "family_dwelling_residents"
            ),
        )
    )
    grid = month_grid(zones.select("level_number").distinct(), lo, hi)
    measures = ["total_residents", "active_residents", "family_dwelling_residents"]
    counts = running_counts(grid.select("month_start", "level_number"), per_level, ["level_number"], measures)
    # a level may stand in several zones, each with all its people, and may be null
    z = zones.groupBy(F.col("level_number").alias("_l"), "zone_name", "supply_tier").agg(
        F.count("*").alias("_rows")  # a repeated row counts its people again
    )
    return counts.join(z, F.col("level_number").eqNullSafe(F.col("_l"))).select(
        "month_start", "level_number", "zone_name", "supply_tier",
        *[(F.col(m) * F.col("_rows")).alias(m) for m in measures],
    )


def with_department(assignments: DataFrame, departments: DataFrame) -> DataFrame:
    """Left join to the departments; codes without a match are named and flagged."""
    d = departments.select(
        F.col("department_code").alias("_code"), F.col("department_name").alias("_name"),
        "home_level", "establishment_headcount",
    )
    return (
        assignments.join(d, F.col("department_code") == F.col("_code"), "left")
        .withColumn("department_name", F.coalesce("_name", F.lit(UNMAPPED)))
        .withColumn("is_unmapped_department", F.col("_code").isNull())
        .drop("_code", "_name")
    )


def assignment_months(
    assignments: DataFrame, departments: DataFrame,
    lo: str | Column = FIRST_MONTH, hi: str | Column = LAST_MONTH,
) -> DataFrame:
    """One row per assignment and month it was active, with its department.

    The department is joined before the months are expanded, on one row per assignment.
    """
    named = with_department(assignments, departments)
    return expand_months(named, "started_at", "ended_at", lo, hi).select(
        "month_start", "assignment_id", "resident_id", "department_code", "role_title",
        "shift_code", "is_current", "department_name", "home_level",
        "establishment_headcount", "is_unmapped_department",
    )


def assignment_ranges(
    assignments: DataFrame, departments: DataFrame,
    lo: str | Column = FIRST_MONTH, hi: str | Column = LAST_MONTH,
) -> DataFrame:
    """The rows that assignment_months repeats for each month, with their first and last one."""
    named = with_department(assignments, departments)
    return clamp_months(named, "started_at", "ended_at", lo, hi).select(
        "assignment_id", "first_month", "last_month"
    )


def repeated_assignment_months(ranges: DataFrame) -> DataFrame:
    """Assignments and months that assignment_months holds more than once, with their count, from its
    ranges: a month can only repeat for an assignment with several ranges, so only these
    are expanded, and what is exchanged grows with the assignments, not with their months."""
    n_ranges = F.count("*").over(Window.partitionBy("assignment_id"))
    several = ranges.withColumn("_n", n_ranges).filter(F.col("_n") > 1)
    months = several.select(
        "assignment_id", F.explode(months_between(F.col("first_month"), F.col("last_month"))).alias("month_start")
    )
    return repeated(months, ["assignment_id", "month_start"])


def daily_measures() -> dict[str, Column]:
    """What is measured per generator and day. Nulled outputs stay out."""
    return {
        "reading_count": F.count("*"),
        "valid_reading_count": F.count("output_kw"),
        "faulty_reading_count": F.count_if("is_faulty_reading"),
        "avg_output_kw": exact_mean(F.col("output_kw"), 2),
        "min_output_kw": F.round(F.min("output_kw"), 2),
        "max_output_kw": F.round(F.max("output_kw"), 2),
        "avg_temperature_c": exact_mean(F.col("temperature_c"), 2),
        "max_vibration_mm_s": F.round(F.max("vibration_mm_s"), 3),
        "last_synced_at": F.max("synced_at"),
    }


def generator_daily(readings: DataFrame) -> DataFrame:
    """One row per generator and day."""
    day = F.to_date("read_at")
    return (
        readings.groupBy("generator_id", day.alias("reading_date"))
        .agg(*[measure.alias(name) for name, measure in daily_measures().items()])
        .select(
            surrogate_key(F.col("generator_id"), F.col("reading_date")).alias("generator_day_id"), "*"
        )
    )


def generator_daily_since(raw_readings: DataFrame, cutoff: Column) -> DataFrame:
    """The daily rows of all whole days from the cutoff on, from raw readings.

    Equals filtering the staged readings, without ranking the whole history, and without reading it
    where the readings are stored by day (`with_reading_days`).
    """
    stored = {READ_DAY, SYNC_DAY} <= set(raw_readings.columns)
    recent = latest_since(
        raw_readings, READING_KEY, READING_ORDER[0], "read_at", cutoff, READING_TIE,
        READ_DAY if stored else None, SYNC_DAY if stored else None,
    )
    return generator_daily(clean_readings(recent))
