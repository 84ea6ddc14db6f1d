"""Questions asked of the finished models."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from asthen.functions import blank_to_null
from asthen.operators.quality import not_unique
from asthen.plans.staging import STATUSES

SANCTION = "SANCTION"
DAY_SECONDS = 86_400


def sanctioned_relocations_by_level(relocations: DataFrame, dwellings: DataFrame, zones: DataFrame) -> DataFrame:
    """Sanctioned moves per destination level; counted per dwelling before the joins."""
    per_dwelling = (
        relocations.filter(F.col("relocation_reason") == SANCTION)
        .groupBy(F.col("to_dwelling_id").alias("dwelling_id"))
        .agg(F.count("*").alias("n"))
    )
    per_level = (
        per_dwelling.join(dwellings.select("dwelling_id", "level_number"), "dwelling_id", "left")
        .groupBy("level_number")
        .agg(F.sum("n").alias("sanctioned_relocations"))
    )
    return per_level.join(zones.select("level_number", "zone_name"), "level_number", "left").select(
        "level_number", "zone_name", "sanctioned_relocations"
    )


def degradation_worklist(output: DataFrame) -> DataFrame:
    """Generators that fell below the threshold, earliest first."""
    below = F.col("is_below_975pct_baseline")
    return (
        output.groupBy("generator_id")
        .agg(
            F.min(F.when(below, F.col("reading_date"))).alias("first_below_date"),
            F.count_if(below).alias("days_below"),
            F.min("output_vs_baseline_pct").alias("lowest_output_vs_baseline_pct"),
        )
        .filter(F.col("first_below_date").isNotNull())
        .orderBy("first_below_date", "lowest_output_vs_baseline_pct", "generator_id")
    )


def trend_distribution(occupancy: DataFrame) -> DataFrame:
    """How often each trend occurs: one class only would mean the history is not used."""
    return occupancy.groupBy("occupancy_trend").agg(F.count("*").alias("n_rows"))


def sync_lag_profile(readings: DataFrame) -> DataFrame:
    """Worst delay, and readings that took more than a day: sizes the lookback."""
    lag = F.col("sync_lag_seconds")
    return readings.agg(
        F.count("*").alias("n_readings"),
        F.max(lag).alias("max_lag_seconds"),
        F.count_if(lag > DAY_SECONDS).alias("late_readings"),
    )


def defect_profile(tables: dict[str, DataFrame], departments: DataFrame) -> DataFrame:
    """Count of every known defect in the raw tables, one pass per table."""
    blank = lambda c: blank_to_null(F.col(c)).isNull()
    status = F.lower(F.trim("status"))
    output = blank_to_null(F.col("output_kw")).cast("decimal(12,2)")
    closed = blank_to_null(F.col("closed_at")).cast("timestamp_ntz")
    per_row = {
        "residents": {
            "status_not_normalised": ~F.col("status").isin(*STATUSES) & status.isin(*STATUSES),
            "status_blank": blank("status"),
            "status_undocumented": ~blank("status") & ~status.isin(*STATUSES),
            "soft_deleted": F.coalesce("_deleted", F.lit(False)),
        },
        "relocations": {"reason_blank": blank("reason")},
        "job_assignments": {"ended_at_blank": blank("ended_at")},
        "generator_readings": {
            "output_blank": blank("output_kw"),
            "output_negative": output < 0,
            "synced_late": F.col("_synced_at") - F.col("read_at") > F.expr("interval 1 day"),
        },
        "maintenance_orders": {"closed_before_opened": closed < F.col("opened_at")},
    }
    parts = []
    for table, rules in per_row.items():
        counts = tables[table].agg(*[F.count_if(rule).alias(name) for name, rule in rules.items()])
        lines = [
            F.struct(F.lit(table).alias("table_name"), F.lit(name).alias("defect"), F.col(name).alias("n"))
            for name in rules
        ]
        parts.append(counts.select(F.inline(F.array(*lines))))

    def line(table: str, defect: str, counted: DataFrame) -> DataFrame:
        return counted.select(F.lit(table).alias("table_name"), F.lit(defect).alias("defect"), "n")

    for table, key in (("residents", "resident_id"), ("generator_readings", "reading_id")):
        extra = not_unique(tables[table], key).agg(F.coalesce(F.sum(F.col("n_rows") - 1), F.lit(0)).alias("n"))
        parts.append(line(table, "extra_copies", extra))

    # Codes are counted before they are looked up, one row per code.
    codes = (
        tables["job_assignments"]
        .groupBy(F.upper(blank_to_null(F.col("department_code"))).alias("department_code"))
        .agg(F.count("*").alias("n"))
    )
    unmapped = codes.join(departments, "department_code", "left_anti")
    parts.append(line("job_assignments", "department_unmapped", unmapped.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"))))
    return reduce(DataFrame.unionByName, parts)


def rerun_evidence(table: DataFrame, key: str) -> DataFrame:
    """Rows and distinct keys; equal after any number of reruns."""
    per_key = table.groupBy(key).agg(F.count("*").alias("n"))
    return per_key.agg(F.sum("n").alias("n_rows"), F.count("*").alias("n_keys"))
