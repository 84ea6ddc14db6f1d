"""Joins of points with the intervals that hold them, by bins: any times or numbers, open ends."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Bins of a level are this many times as wide as those of the level below.
STEP = 8
# Width of the narrowest bins: an hour in microseconds; of dates and numbers, one.
HOUR = 3_600_000_000
LEVELS = 24


def _position(df: DataFrame, name: str) -> Column:
    """The column's place on a line of whole numbers; fractions of a number are cut."""
    kind, c = df.schema[name].dataType, F.col(name)
    if isinstance(kind, T.TimestampNTZType):
        return F.expr(f"timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', `{name}`)")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(c)
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("long")
    return F.floor(c).cast("long")


def _whole(a: Column, width: Column) -> Column:
    """a / width rounded down, in whole numbers."""
    return ((a - F.pmod(a, width)) / width).cast("long")


def in_intervals(
    points: DataFrame, at: str, intervals: DataFrame, start: str, end: str, on: Sequence[str] = (),
    inclusive_end: bool = False, base: int | None = None,
) -> DataFrame:
    """Each point with every interval that holds it: start <= at < end, or <= end if
    `inclusive_end`; a null end is open. Rows with a null point, start or `on` column meet nothing,
    nor do intervals that end before they start. Other columns of the two must differ in name.

    An interval stands in the bins it touches, of the level at which these are at most STEP + 1;
    a point stands in one bin of each level that has intervals. Bins meet by equality, so
    no row is compared with all of the other side, and a crowded bin is split as any skewed join
    key. Open ends count as the last point, and intervals beyond the points are left out first.
    """
    clash = (set(points.columns) & set(intervals.columns)) - set(on)
    if clash:
        raise ValueError(f"columns of both sides: {sorted(clash)}")
    timed = isinstance(points.schema[at].dataType, (T.TimestampType, T.TimestampNTZType))
    base = base or (HOUR if timed else 1)
    widths = [base * STEP**i for i in range(LEVELS) if base * STEP**i < 1 << 58]

    bounds = points.select(_position(points, at).alias("_at")).agg(F.min("_at").alias("a"), F.max("_at").alias("b"))
    first, last = bounds.select("a").scalar(), bounds.select("b").scalar()
    low = F.greatest(_position(intervals, start), first)
    high = F.least(F.coalesce(_position(intervals, end), last), last)
    kept = (
        intervals.filter(F.col(start).isNotNull() & (F.col(end).isNull() | (F.col(end) >= F.col(start))))
        .filter((_position(intervals, start) <= last) & (F.col(end).isNull() | (_position(intervals, end) >= first)))
        .withColumns({"_low": low, "_high": high})
    )
    # the least level whose bins are as wide as an STEP-th of the interval
    span = F.col("_high") - F.col("_low")
    level = reduce(lambda a, i: F.when(span <= STEP * widths[i], i).otherwise(a), reversed(range(len(widths))), F.lit(len(widths)))
    width = F.element_at(F.array(*[F.lit(w) for w in widths]), F.least(F.col("_level"), F.lit(len(widths) - 1)) + 1)
    leveled = kept.withColumn("_level", F.least(level, F.lit(len(widths) - 1))).withColumn("_width", width)
    binned = leveled.withColumn(
        "_bin", F.explode(F.sequence(_whole(F.col("_low"), F.col("_width")), _whole(F.col("_high"), F.col("_width"))))
    ).drop("_low", "_high", "_width")
    present = leveled.agg(F.sort_array(F.collect_set("_level"))).scalar()
    place = _position(points, at)
    spread = points.filter(F.col(at).isNotNull()).select(
        *[F.col(c).alias(f"_on_{c}") if c in on else F.col(c) for c in points.columns],
        place.alias("_place"), F.explode(present).alias("_of"),
    )
    spread = spread.withColumn("_point", _whole(F.col("_place"), F.element_at(F.array(*[F.lit(w) for w in widths]), F.col("_of") + 1)))
    before_end = F.col(at) <= F.col(end) if inclusive_end else F.col(at) < F.col(end)
    same = (F.col("_of") == F.col("_level")) & (F.col("_point") == F.col("_bin"))
    for c in on:
        same &= F.col(f"_on_{c}") == F.col(c)
    joined = spread.join(binned, same & (F.col(start) <= F.col(at)) & (F.col(end).isNull() | before_end))
    others = [c for c in points.columns if c not in on]
    return joined.select(*on, *others, *[c for c in intervals.columns if c not in on])
