"""Staging: one raw table in, one typed and cleaned table out, no joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from asthen.functions import (
    blank_to_null,
    clean_string,
    in_vocabulary,
    null_if_negative,
    rank_code,
    seconds_between,
    text_as,
)
from asthen.operators.rows import drop_flagged, latest_per_key

# Controlled vocabularies and codes.
STATUSES = ("active", "deceased", "relocated")
UNKNOWN_STATUS = "unknown"
NO_REASON = "UNSPECIFIED"
CRITICALITY = {"CRITICAL": 1, "HIGH": 2, "MEDIUM": 3, "LOW": 4}
NO_CRITICALITY = 9

# Partitions of stored raw readings: the day read and the day synced.
READ_DAY, SYNC_DAY = "read_day", "sync_day"

# Makes the choice between copies of one state of a person repeatable.
RESIDENT_TIE = ["given_name", "family_name", "dwelling_id", "status", "birth_date", "registered_at", "_deleted"]
RESIDENT_KEY, RESIDENT_ORDER = ["resident_id"], ["_synced_at", "updated_at"]
READING_KEY, READING_ORDER = ["reading_id"], ["_synced_at"]
# Makes the choice between copies of one sync repeatable.
READING_TIE = ["read_at", "output_kw", "temperature_c", "vibration_mm_s", "generator_id", "is_manual_entry"]


def text(name: str):
    return F.col(name).cast("string").alias(name)


def stamp(name: str, alias: str | None = None):
    return F.col(name).cast("timestamp_ntz").alias(alias or name)


def whole(name: str):
    return F.col(name).cast("int").alias(name)


def with_reading_days(readings: DataFrame) -> DataFrame:
    """Raw readings with the days they are to be stored by."""
    return readings.withColumns({READ_DAY: F.to_date("read_at"), SYNC_DAY: F.to_date("_synced_at")})


def clean_residents(residents: DataFrame) -> DataFrame:
    given, family = blank_to_null(F.col("given_name")), blank_to_null(F.col("family_name"))
    return residents.select(
        text("resident_id"),
        text("dwelling_id"),
        given.alias("given_name"),
        family.alias("family_name"),
        # concat, not concat_ws: a missing part leaves no full name
        F.concat(given, F.lit(" "), family).alias("full_name"),
        in_vocabulary(F.col("status"), STATUSES, UNKNOWN_STATUS).alias("resident_status"),
        F.col("birth_date").cast("date").alias("birth_date"),
        stamp("registered_at"),
        stamp("updated_at"),
        stamp("_synced_at", "synced_at"),
        F.coalesce("_deleted", F.lit(False)).alias("is_deleted"),
    )


def stage_residents(residents: DataFrame) -> DataFrame:
    """Latest version per person; the deleted flag is looked at only afterwards, so an
    older live copy does not bring a deleted person back."""
    latest = latest_per_key(residents, RESIDENT_KEY, RESIDENT_ORDER, RESIDENT_TIE)
    return drop_flagged(clean_residents(latest), "is_deleted")


def stage_dwellings(dwellings: DataFrame) -> DataFrame:
    return dwellings.select(
        text("dwelling_id"),
        whole("level_number"),
        whole("unit_number"),
        clean_string(F.col("dwelling_type"), "upper").alias("dwelling_type"),
        whole("capacity"),
    )


def stage_relocations(relocations: DataFrame) -> DataFrame:
    return relocations.select(
        text("relocation_id"),
        text("resident_id"),
        text("from_dwelling_id"),
        text("to_dwelling_id"),
        stamp("relocated_at"),
        F.coalesce(clean_string(F.col("reason"), "upper"), F.lit(NO_REASON)).alias("relocation_reason"),
    )


def stage_assignments(assignments: DataFrame) -> DataFrame:
    return assignments.select(
        text("assignment_id"),
        text("resident_id"),
        clean_string(F.col("department_code"), "upper").alias("department_code"),
        blank_to_null(F.col("role_title")).alias("role_title"),
        clean_string(F.col("shift_code"), "upper").alias("shift_code"),
        stamp("started_at"),
        text_as(F.col("ended_at"), "timestamp_ntz").alias("ended_at"),
        stamp("updated_at"),
        # blank stays blank here
        F.lower(F.trim("status")).alias("assignment_status"),
        blank_to_null(F.col("ended_at")).isNull().alias("is_current"),
    )


def stage_departments(departments: DataFrame) -> DataFrame:
    return departments.select(
        text("department_code"),
        blank_to_null(F.col("department_name")).alias("department_name"),
        whole("home_level"),
        whole("establishment_headcount"),
    )


def clean_readings(readings: DataFrame, *keep: str) -> DataFrame:
    """The readings, with the columns named in `keep` besides. Impossible outputs become null but the reading stays, so a faulty sensor is not
    taken for an outage; is_faulty_reading is null where no output arrived."""
    output = text_as(F.col("output_kw"), "decimal(12,2)")
    read_at, synced_at = F.col("read_at").cast("timestamp_ntz"), F.col("_synced_at").cast("timestamp_ntz")
    return readings.select(
        *keep,
        text("reading_id"),
        clean_string(F.col("generator_id"), "upper").alias("generator_id"),
        read_at.alias("read_at"),
        synced_at.alias("synced_at"),
        null_if_negative(output).alias("output_kw"),
        F.col("temperature_c").cast("decimal(8,2)").alias("temperature_c"),
        F.col("vibration_mm_s").cast("decimal(8,3)").alias("vibration_mm_s"),
        F.coalesce("is_manual_entry", F.lit(False)).alias("is_manual_entry"),
        (output < 0).alias("is_faulty_reading"),
        seconds_between(read_at, synced_at).alias("sync_lag_seconds"),
    )


def stage_readings(readings: DataFrame) -> DataFrame:
    """Latest sync of each reading."""
    return clean_readings(latest_per_key(readings, READING_KEY, READING_ORDER, READING_TIE))


def stage_equipment(equipment: DataFrame) -> DataFrame:
    return equipment.select(
        text("equipment_id"),
        blank_to_null(F.col("equipment_name")).alias("equipment_name"),
        whole("level_number"),
        clean_string(F.col("criticality"), "upper").alias("criticality"),
        F.col("installed_on").cast("date").alias("installed_on"),
        rank_code(F.col("criticality"), CRITICALITY, NO_CRITICALITY).alias("criticality_rank"),
    )


def stage_maintenance_orders(orders: DataFrame) -> DataFrame:
    """Orders that close before they open are kept; a check reports them."""
    return orders.select(
        text("order_id"),
        text("equipment_id"),
        clean_string(F.col("department_code"), "upper").alias("department_code"),
        stamp("opened_at"),
        text_as(F.col("closed_at"), "timestamp_ntz").alias("closed_at"),
        text_as(F.col("labour_hours"), "decimal(8,1)").alias("labour_hours"),
        clean_string(F.col("priority"), "upper").alias("priority"),
        clean_string(F.col("status"), "upper").alias("order_status"),
        blank_to_null(F.col("closed_at")).isNull().alias("is_open"),
    )


def stage_level_zones(zones: DataFrame) -> DataFrame:
    return zones.select(
        whole("level_number"),
        blank_to_null(F.col("zone_name")).alias("zone_name"),
        whole("supply_tier"),
        F.coalesce("has_lift_access", F.lit(False)).alias("has_lift_access"),
    )
