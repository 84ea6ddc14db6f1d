"""Data checks. Each returns the violating rows; a check passes when there are none."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field, replace
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, Row
from pyspark.sql import functions as F

from asthen.functions import seconds_between


def repeated(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Combinations that occur more than once, with their count; nulls group together."""
    return df.groupBy(*columns).agg(F.count("*").alias("n_rows")).filter(F.col("n_rows") > 1)


def not_unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once; nulls are not compared."""
    return repeated(df.filter(F.col(column).isNotNull()), [column])


def is_missing(column: str) -> Column:
    return F.col(column).isNull()


def is_out_of_range(
    column: str, low: Any = None, high: Any = None, inclusive: bool = True
) -> Column:
    """True outside the bounds, either of which may be absent; null passes."""
    c = F.col(column)
    tests = []
    if low is not None:
        tests.append(c < low if inclusive else c <= low)
    if high is not None:
        tests.append(c > high if inclusive else c >= high)
    if not tests:
        raise ValueError("a range needs at least one bound")
    return reduce(lambda a, b: a | b, tests)


def missing(df: DataFrame, column: str) -> DataFrame:
    return df.filter(is_missing(column))


def unexpected_values(df: DataFrame, column: str, accepted: Sequence[Any]) -> DataFrame:
    """Values outside the list, with their count; null passes."""
    return df.filter(~F.col(column).isin(*accepted)).groupBy(column).agg(F.count("*").alias("n_rows"))


def out_of_range(df: DataFrame, column: str, low: Any = None, high: Any = None, inclusive: bool = True) -> DataFrame:
    return df.filter(is_out_of_range(column, low, high, inclusive))


def ends_before_start(df: DataFrame, start: str, end: str, duration: str) -> DataFrame:
    """Rows that end before they start, with the negative duration in seconds."""
    return df.filter(F.col(end) < F.col(start)).withColumn(
        duration, seconds_between(F.col(start), F.col(end))
    )


@dataclass(frozen=True)
class Check:
    """One test of one table. kind: unique, not_null, accepted_values,
    unique_combination, accepted_range, or rows (a function giving the violations).

    A check that names a table in `reads` is counted there, by `rows`, where that table is given:
    one that gives the same violations from fewer rows."""

    table: str
    kind: str
    columns: tuple[str, ...] = ()
    severity: str = "error"
    options: Mapping[str, Any] = field(default_factory=dict)
    rows: Callable[[DataFrame], DataFrame] | None = None
    label: str | None = None
    reads: str | None = None

    @property
    def name(self) -> str:
        return self.label or "_".join([self.kind, self.table, *self.columns])

    def row_condition(self) -> Column | None:
        """The violation as a condition on a single row, for kinds that allow it."""
        if self.kind == "not_null":
            return is_missing(self.columns[0])
        if self.kind == "accepted_range":
            return is_out_of_range(self.columns[0], **self.options)
        return None

    def violations(self, df: DataFrame) -> DataFrame:
        condition = self.row_condition()
        if condition is not None:
            return df.filter(condition)
        if self.kind == "unique":
            return not_unique(df, self.columns[0])
        if self.kind == "unique_combination":
            return repeated(df, self.columns)
        if self.kind == "accepted_values":
            return unexpected_values(df, self.columns[0], self.options["values"])
        if self.kind == "rows":
            return self.rows(df)
        raise ValueError(f"unknown check kind {self.kind!r}")


GROUPING = ("unique", "unique_combination", "accepted_values")


def _line(check: Check, violations: Column) -> Column:
    return F.struct(
        F.lit(check.name).alias("check_name"), F.lit(check.severity).alias("severity"),
        violations.alias("violations"),
    )


def _one_grouping(df: DataFrame, on_rows: Sequence[Check], grouped: Sequence[Check]) -> DataFrame:
    """All checks of a table that count groups, with those on single rows, as grouping sets of one
    aggregate: the table is computed once and its groups are exchanged once."""
    columns = list(dict.fromkeys(c for check in grouped for c in check.columns))
    sets = list(dict.fromkeys(check.columns for check in grouped)) + ([()] if on_rows else [])
    on_row = [F.count_if(c.row_condition()).alias(f"_rows{i}") for i, c in enumerate(on_rows)]
    groups = df.groupingSets([list(s) for s in sets], *columns).agg(
        F.grouping_id().alias("_set"), F.count("*").alias("_n"), *on_row
    )

    def of(columns_of_set: tuple[str, ...]) -> Column:
        # a bit is set for each column left out, the first column's the highest
        left_out = "".join("0" if c in columns_of_set else "1" for c in columns)
        return F.col("_set") == int(left_out, 2)

    def violates(check: Check) -> Column:
        column = F.col(check.columns[0])
        if check.kind == "accepted_values":
            return ~column.isin(*check.options["values"])
        return (F.col("_n") > 1) & (column.isNotNull() if check.kind == "unique" else F.lit(True))

    lines = [_line(c, F.coalesce(F.sum(F.when(of(()), F.col(f"_rows{i}"))), F.lit(0)))
             for i, c in enumerate(on_rows)]
    lines += [_line(c, F.count_if(of(c.columns) & violates(c))) for c in grouped]
    return groups.agg(F.array(*lines).alias("_lines")).select(F.inline("_lines"))


def count_violations(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """(check_name, severity, violations) for all checks of one table.

    Conditions on single rows and checks that count groups share one pass over the table, whatever
    their number; only a check given as a function has its own.
    """
    on_rows = [c for c in checks if c.row_condition() is not None]
    grouped = [c for c in checks if c.kind in GROUPING]
    parts = []
    if grouped:
        parts.append(_one_grouping(df, on_rows, grouped))
    elif on_rows:
        lines = [_line(c, F.count_if(c.row_condition())) for c in on_rows]
        parts.append(df.agg(F.array(*lines).alias("_lines")).select(F.inline("_lines")))
    for check in checks:
        if check not in on_rows and check not in grouped:
            parts.append(check.violations(df).agg(_line(check, F.count("*")).alias("_line")).select("_line.*"))
    return reduce(DataFrame.unionByName, parts)


class Observed:
    """Checks on single rows, counted by the job that writes a table, so that it needs no scan for
    them. A task that runs twice may count twice; none counts what isn't there."""

    def __init__(self, checks: Iterable[Check]):
        self.checks = [c for c in checks if c.row_condition() is not None]
        self._seen = Observation()

    def watch(self, df: DataFrame) -> DataFrame:
        """The same rows, counted on their way."""
        if not self.checks:
            return df
        return df.observe(self._seen, *[F.count_if(c.row_condition()).alias(f"n{i}") for i, c in enumerate(self.checks)])

    def lines(self) -> list[Row]:
        """As those of `report`, once the rows have been written."""
        counts = self._seen.get if self.checks else {}
        found = []
        for i, check in enumerate(self.checks):
            n = counts.get(f"n{i}", 0)  # nothing is reported where no task ran
            status = check.severity if n else "pass"
            found.append(Row(check_name=check.name, severity=check.severity, violations=n, status=status))
        return found


def report(tables: Mapping[str, DataFrame], checks: Iterable[Check]) -> DataFrame:
    """One line per check: check_name, severity, violations, status (pass, warn, error)."""
    by_table: dict[str, list[Check]] = {}
    for check in checks:
        if check.reads in tables:
            check = replace(check, table=check.reads, kind="rows", label=check.name)
        by_table.setdefault(check.table, []).append(check)
    counts = reduce(
        DataFrame.unionByName, [count_violations(tables[t], group) for t, group in by_table.items()]
    )
    return counts.withColumn(
        "status", F.when(F.col("violations") == 0, F.lit("pass")).otherwise(F.col("severity"))
    )


def freshness(
    df: DataFrame, table: str, loaded_at: str, as_of: Column, warn_hours: int, error_hours: int
) -> DataFrame:
    """Age of the newest load at `as_of`, and whether it is past a threshold."""
    age = F.col("age_seconds")
    return (
        df.agg(F.max(loaded_at).alias("max_loaded_at"))
        .withColumn("age_seconds", seconds_between(F.col("max_loaded_at"), as_of))
        .select(
            F.lit(table).alias("table_name"),
            "max_loaded_at",
            "age_seconds",
            F.when(age.isNull() | (age > error_hours * 3600), "error")
            .when(age > warn_hours * 3600, "warn")
            .otherwise("pass")
            .alias("status"),
        )
    )


def row_counts(tables: Mapping[str, DataFrame], refused: DataFrame | None = None) -> DataFrame:
    """Row count of every table, by name; with `refused` (a line each, with its table_name) also how many
    lines of each table could not be read."""
    counts = [
        df.agg(F.lit(name).alias("table_name"), F.count("*").alias("row_count"))
        for name, df in tables.items()
    ]
    counted = reduce(DataFrame.unionByName, counts)
    if refused is not None:
        lines = refused.groupBy("table_name").agg(F.count("*").alias("refused_count"))
        counted = counted.join(lines, "table_name", "left").withColumn(
            "refused_count", F.coalesce("refused_count", F.lit(0)))
    return counted.orderBy("table_name")
