"""Validity intervals, month spines and counts of what is active per month.

A month m is covered by an interval when month(start) <= m and the end is open or
m <= month(end): first and last month both count. Months are dates (first day).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from asthen.functions import month_of

ONE_MONTH = "interval 1 month"


def as_month(month: str | Column) -> Column:
    return month if isinstance(month, Column) else F.to_date(F.lit(month))


def months_between(first: Column, last: Column) -> Column:
    return F.sequence(first, last, F.expr(ONE_MONTH))


# --- intervals from events -----------------------------------------------------

# Events of one key that a task orders, about; a key with twice as many is cut by time.
SLICE_ROWS = 1_000_000
# Sampled events for each slice, and cuts of a key at most.
SLICE_SAMPLE, MOST_CUTS = 200, 1_000
# Events that Spark estimates to take fewer bytes have no key worth cutting and aren't sampled.
SMALL_BYTES = 64 << 20


def _cuts(events: DataFrame, key: str, at: str, tie: str, slice_rows: int, small_bytes: int) -> DataFrame | None:
    """One row per key to be cut: the ascending (time, tie) at which its next slices begin."""
    size = events._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    if int(str(size)) < small_bytes:
        return None
    share = min(1.0, SLICE_SAMPLE / slice_rows)
    order = Window.partitionBy("_key").orderBy(F.col("_at").asc_nulls_last(), F.col("_tie").asc())
    sample = events.select(F.col(key).alias("_key"), F.col(at).alias("_at"), F.col(tie).alias("_tie"))
    nth = F.row_number().over(order)
    found = (
        sample.sample(share, seed=11)
        .withColumn("_nth", nth)
        .filter((F.col("_nth") % SLICE_SAMPLE == 0) & F.col("_at").isNotNull())
        .drop("_nth")
    )
    # one row per SLICE_ROWS events of a frequent key; literal from here on, so every use agrees
    cuts: dict = {}
    for one, time, last in sorted(found.collect(), key=lambda r: (r[1], r[2] is not None, r[2])):
        cuts.setdefault(one, []).append((time, last))
    if not cuts:
        return None
    thinned = [(k, c[:: -(-len(c) // MOST_CUTS)]) for k, c in cuts.items()]
    inner = T.StructType(found.schema.fields[1:])
    schema = T.StructType([found.schema["_key"], T.StructField("_cuts", T.ArrayType(inner))])
    return events.sparkSession.createDataFrame(thinned, schema)


def event_intervals(
    events: DataFrame, key: str, at: str, tie: str, valid_to: str = "valid_to", first: str | None = None,
    slice_rows: int = SLICE_ROWS, small_bytes: int = SMALL_BYTES,
) -> DataFrame:
    """Each event lasts until the key's next one; the last stays open (null). `first`, if named,
    is a column that marks each key's first event.

    The events are exchanged once, by key, and ordered in their tasks. A key with very many, as a
    sample tells, is cut along its time into slices of about `slice_rows`, which go to tasks of
    their own; only the start of each slice is then carried to the last event of the slice
    before it. Events without a time sort last, null keys are a key like any other.
    """
    cuts = _cuts(events, key, at, tie, slice_rows, small_bytes)
    order = [F.col(at).asc_nulls_last(), F.col(tie).asc()]
    if cuts is None:
        whole = Window.partitionBy(key).orderBy(*order)
        out = events.withColumn(valid_to, F.lead(at).over(whole))
        return out.withColumn(first, F.row_number().over(whole) == 1) if first else out

    before = F.filter("_cuts", lambda c: c <= F.struct(F.col(at).alias("_at"), F.col(tie).alias("_tie")))
    place = F.when(F.col("_cuts").isNull(), 0).otherwise(
        F.size(F.when(F.col(at).isNull(), F.col("_cuts")).otherwise(before))
    )
    sliced = (
        events.join(cuts, F.col(key).eqNullSafe(F.col("_key")), "left")
        .withColumn("_slice", place)
        .withColumn("_is_cut", F.col("_cuts").isNotNull())
        .drop("_key", "_cuts")
    )
    own = Window.partitionBy(key, "_slice").orderBy(*order)
    rows = sliced.withColumns({"_next": F.lead(at).over(own), "_nth": F.row_number().over(own)})
    # one row per slice of the keys that were cut
    along = Window.partitionBy("_key").orderBy("_of")
    carried = (
        sliced.filter("_is_cut")
        .groupBy(F.col(key).alias("_key"), F.col("_slice").alias("_of"))
        .agg(F.min(at).alias("_start"))
        .select("_key", "_of", F.lead("_start").over(along).alias("_carried"),
                (F.row_number().over(along) > 1).alias("_later"))
    )
    same = F.col(key).eqNullSafe(F.col("_key")) & (F.col("_slice") == F.col("_of")) & F.col("_is_cut")
    joined = rows.join(carried, same, "left").withColumn(valid_to, F.coalesce("_next", "_carried"))
    if first:
        joined = joined.withColumn(first, (F.col("_nth") == 1) & ~F.coalesce("_later", F.lit(False)))
    return joined.drop("_slice", "_is_cut", "_next", "_nth", "_key", "_of", "_carried", "_later")


# --- months --------------------------------------------------------------------


def month_spine(bounds: DataFrame, first: str, last: str, month: str = "month_start") -> DataFrame:
    """All months between two date columns of a one-row table."""
    return bounds.select(F.explode(months_between(month_of(F.col(first)), month_of(F.col(last)))).alias(month))


def month_grid(dim: DataFrame, lo: str | Column, hi: str | Column, month: str = "month_start") -> DataFrame:
    """Every row of a dimension for every month; a per-row explode, so no join."""
    return dim.withColumn(month, F.explode(months_between(as_month(lo), as_month(hi))))


def clamp_months(
    df: DataFrame, start: str, end: str, lo: str | Column, hi: str | Column,
    first: str = "first_month", last: str = "last_month",
) -> DataFrame:
    """Add the first and last covered month inside [lo, hi]; drop what covers none.

    A null start covers nothing, a null end is open. Inverted intervals go as well.
    """
    lo, hi = as_month(lo), as_month(hi)
    clamped = df.filter(F.col(start).isNotNull()).withColumns({
        first: F.greatest(month_of(F.col(start)), lo),
        # least ignores the null of an open end
        last: F.least(month_of(F.col(end)), hi),
    })
    return clamped.filter(F.col(first) <= F.col(last))


def expand_months(
    df: DataFrame, start: str, end: str, lo: str | Column, hi: str | Column, month: str = "month_start"
) -> DataFrame:
    """One row per covered month: the range join with a spine, without a join."""
    clamped = clamp_months(df, start, end, lo, hi, "_first", "_last")
    return clamped.withColumn(month, F.explode(months_between(F.col("_first"), F.col("_last")))).drop(
        "_first", "_last"
    )


# --- counts per month ------------------------------------------------------------


def month_steps(
    df: DataFrame, first: str, last: str, hi: str | Column, month: str = "month_start"
) -> DataFrame:
    """Replace covered months by their edges: step +1 in the first, -1 after the last.

    Two rows per interval however long it is, where expanding gives one per month.
    """
    enter = F.struct(F.col(first).alias(month), F.lit(1).alias("step"))
    leave = F.struct(F.add_months(F.col(last), 1).alias(month), F.lit(-1).alias("step"))
    edges = F.when(F.col(last) < as_month(hi), F.array(enter, leave)).otherwise(F.array(enter))
    return df.select(*[c for c in df.columns if c not in (first, last)], F.inline(edges))


def disjoint_months(
    df: DataFrame, entity: Sequence[str], first: str, last: str, kinds: str, n_kinds: int, kind: str
) -> DataFrame:
    """Cut an entity's month ranges so that those of one kind no longer overlap; their union stays.

    `kinds` is a bit set, bit i for kind i of `n_kinds`; the rows that come back have a range of
    one `kind` each. Counting them then counts the entity once per month and kind. The ranges are
    sorted once per entity for all kinds, and fan out to these only behind it.
    """
    before = Window.partitionBy(*entity).orderBy(first).rowsBetween(Window.unboundedPreceding, -1)
    has = [F.col(kinds).bitwiseAND(1 << i) != 0 for i in range(n_kinds)]
    covered = [f"_covered{i}" for i in range(n_kinds)]
    ranges = df.select(
        *entity, kinds, first, last,
        *[F.max(F.when(h, F.col(last))).over(before).alias(c) for h, c in zip(has, covered)],
    )
    starts = [F.greatest(F.col(first), F.add_months(c, 1)) for c in covered]
    cut = [
        F.when(h & (start <= F.col(last)), F.struct(F.lit(i).alias(kind), start.alias(first)))
        for i, (h, start) in enumerate(zip(has, starts))
    ]
    return ranges.select(*entity, last, F.inline(F.array_compact(F.array(*cut))))


def counts_between_steps(
    steps: DataFrame, keys: Sequence[str], measures: Sequence[str], hi: str | Column, present: str,
    month: str = "month_start",
) -> DataFrame:
    """Sum the per-month changes up for each key, from its first step to `hi`; `steps` has one row per
    keys and month. Only months with a positive `present` are returned.

    A sum holds until the key's next step, so each step's row is repeated for the months up to
    there; there is no grid of keys and months to build, join and sort.
    """
    along = Window.partitionBy(*keys).orderBy(month)
    so_far = along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = steps.select(
        *keys, F.col(month).alias("_from"), F.lead(month).over(along).alias("_next"),
        *[F.sum(m).over(so_far).alias(m) for m in measures],
    ).filter(F.col(present) > 0)
    until = F.coalesce(F.add_months("_next", -1), as_month(hi))
    return summed.select(*keys, F.explode(months_between(F.col("_from"), until)).alias(month), *measures)


def running_counts(
    grid: DataFrame, steps: DataFrame, keys: Sequence[str], measures: Sequence[str],
    month: str = "month_start", null_safe: bool = False,
) -> DataFrame:
    """Sum the per-month changes up along the grid; `steps` has one row per keys and month."""
    right = steps.select(*[F.col(c).alias(f"_{c}") for c in (*keys, month)], *measures)

    def same(c: str) -> Column:
        a, b = F.col(c), F.col(f"_{c}")
        return a.eqNullSafe(b) if null_safe else a == b

    joined = grid.join(right, reduce(lambda a, b: a & b, [same(c) for c in (*keys, month)]), "left")
    so_far = (
        Window.partitionBy(*keys).orderBy(month).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    sums: Mapping[str, Column] = {m: F.sum(F.coalesce(F.col(m), F.lit(0))).over(so_far) for m in measures}
    return joined.select(*grid.columns, *[c.alias(m) for m, c in sums.items()])
