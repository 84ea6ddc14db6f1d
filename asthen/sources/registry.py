"""Declared raw tables: schema, checks, load time and freshness thresholds.

Columns with messy content are text here; staging casts them.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from asthen.operators.quality import Check


@dataclass(frozen=True)
class Source:
    system: str
    table: str
    ddl: str
    checks: tuple[Check, ...] = ()
    loaded_at: str | None = None
    warn_hours: int | None = None
    error_hours: int | None = None

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(self.ddl)


def _unique(table: str, column: str, severity: str = "error") -> Check:
    return Check(table, "unique", (column,), severity)


def _not_null(table: str, column: str) -> Check:
    return Check(table, "not_null", (column,))


SOURCES = {
    s.table: s
    for s in (
        Source(
            "census_db", "dwellings",
            "dwelling_id string, level_number int, unit_number int, dwelling_type string, capacity int",
            (_unique("dwellings", "dwelling_id"), _not_null("dwellings", "dwelling_id")),
        ),
        Source(
            "census_db", "residents",
            "resident_id string, given_name string, family_name string, birth_date date, "
            "dwelling_id string, status string, registered_at timestamp_ntz, "
            "updated_at timestamp_ntz, _synced_at timestamp_ntz, _deleted boolean",
            (_unique("residents", "resident_id", "warn"), _not_null("residents", "resident_id")),
        ),
        Source(
            "census_db", "relocations",
            "relocation_id string, resident_id string, from_dwelling_id string, "
            "to_dwelling_id string, relocated_at timestamp_ntz, reason string",
            (_unique("relocations", "relocation_id"), _not_null("relocations", "relocation_id")),
        ),
        Source(
            "works_db", "departments",
            "department_code string, department_name string, home_level int, establishment_headcount int",
            (_unique("departments", "department_code"), _not_null("departments", "department_code")),
        ),
        Source(
            "works_db", "job_assignments",
            "assignment_id string, resident_id string, department_code string, role_title string, "
            "shift_code string, started_at timestamp_ntz, ended_at string, status string, "
            "updated_at timestamp_ntz",
            (_unique("job_assignments", "assignment_id"), _not_null("job_assignments", "assignment_id"),
             _not_null("job_assignments", "resident_id")),
        ),
        Source(
            "mech_db", "equipment",
            "equipment_id string, equipment_name string, level_number int, criticality string, "
            "installed_on date",
            (_unique("equipment", "equipment_id"), _not_null("equipment", "equipment_id")),
        ),
        Source(
            "mech_db", "generator_readings",
            "reading_id string, generator_id string, read_at timestamp_ntz, output_kw string, "
            "temperature_c decimal(8,2), vibration_mm_s decimal(8,3), is_manual_entry boolean, "
            "_synced_at timestamp_ntz",
            (_unique("generator_readings", "reading_id", "warn"),),
            loaded_at="_synced_at", warn_hours=12, error_hours=48,
        ),
        Source(
            "mech_db", "maintenance_orders",
            "order_id string, equipment_id string, department_code string, opened_at timestamp_ntz, "
            "closed_at string, priority string, status string, labour_hours string",
            (_unique("maintenance_orders", "order_id"), _not_null("maintenance_orders", "order_id")),
        ),
        Source(
            "seeds", "level_zones",
            "level_number int, zone_name string, supply_tier int, has_lift_access boolean",
        ),
    )
}


def read_source(spark: SparkSession, table: str, root: str, fmt: str = "csv") -> DataFrame:
    """Read `root/<system>/<table>` with its declared schema; nothing is inferred.

    csv files carry a header, which must name the columns in their declared order, and sit at
    `<table>.csv`; an empty field is null. With
    fmt="table" the root is a catalog (or empty) and system.table names the table.
    """
    source = SOURCES[table]
    if fmt == "table":
        return spark.table(".".join(p for p in (root, source.system, table) if p))
    path = f"{root}/{source.system}/{table}"
    reader = spark.read.schema(source.schema)
    if fmt == "csv":
        options = {"header": True, "mode": "FAILFAST", "enforceSchema": False}
        return reader.options(**options).csv(f"{path}.csv")
    return reader.format(fmt).load(path)


# The column of a line that could not be read as its table's columns.
LINE = "_refused_line"


def split_source(spark: SparkSession, table: str, root: str) -> tuple[DataFrame, DataFrame]:
    """The rows of a csv file that fit the declared columns, and (table_name, line, file) of the lines
    that don't: a value of another type, or too few or too many. No line stops the load and
    none is lost. All columns of a line are always read, so a row is good or refused
    whichever columns a query asks for. A header of other columns is still an error.
    """
    source = SOURCES[table]
    options = {"header": True, "mode": "PERMISSIVE", "enforceSchema": False, "columnNameOfCorruptRecord": LINE}
    schema = T.StructType([*source.schema.fields, T.StructField(LINE, T.StringType())])
    path = f"{root}/{source.system}/{table}.csv"
    lines = spark.read.schema(schema).options(**options).csv(path)
    # always true, but needs every column: those that a plan doesn't need aren't read, nor refused
    read = F.length(F.concat_ws("", *[F.col(c).cast("string") for c in source.schema.names])) >= 0
    lines = lines.filter(read)
    good = lines.filter(F.col(LINE).isNull()).drop(LINE)
    refused = lines.filter(F.col(LINE).isNotNull()).select(
        F.lit(table).alias("table_name"), F.col(LINE).alias("line"), F.col("_metadata.file_path").alias("file")
    )
    return good, refused


def split_sources(spark: SparkSession, root: str) -> tuple[dict[str, DataFrame], DataFrame]:
    """The good rows of every table, and the refused lines of all."""
    both = {table: split_source(spark, table, root) for table in SOURCES}
    refused = reduce(DataFrame.unionByName, [r for _, r in both.values()])
    return {table: good for table, (good, _) in both.items()}, refused


def read_sources(spark: SparkSession, root: str, fmt: str = "csv") -> dict[str, DataFrame]:
    return {table: read_source(spark, table, root, fmt) for table in SOURCES}
