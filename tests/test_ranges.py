"""Range joins against all pairs compared."""

import random
import re
from datetime import datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from asthen.operators import ranges
from asthen.operators.ranges import in_intervals

START = datetime(2020, 1, 1)


def sample(seed, n=150):
    rng = random.Random(seed)

    def moment():
        return None if rng.random() < 0.05 else START + timedelta(seconds=rng.choice((1, 3600, 86_400)) * rng.randrange(-50, 400))

    points = [(i, rng.choice(("a", "b", None)), moment()) for i in range(n)]
    intervals = []
    for i in range(n):
        begin = moment()
        length = rng.choice((0, 1, 60, 7200, 86_400 * 3, 86_400 * 300, 86_400 * 36_000, -5))
        finish = None if begin is None or rng.random() < 0.15 else begin + timedelta(seconds=length)
        intervals.append((i, rng.choice(("a", "b", None)), begin, finish))
    intervals.append((900, "a", datetime(1800, 1, 1), None))
    intervals.append((901, "b", datetime(1700, 1, 1), datetime(1750, 1, 1)))
    return points, intervals


def by_hand(points, intervals, keyed, inclusive):
    return sorted(
        (p[0], v[0]) for p in points for v in intervals
        if p[2] and v[2] and (not keyed or (p[1] and p[1] == v[1])) and v[2] <= p[2]
        and (v[3] is None or p[2] < v[3] or (inclusive and p[2] == v[3])))


@pytest.mark.parametrize(("seed", "keyed", "inclusive"), [(0, True, False), (1, False, False), (2, False, True)])
def test_equals_all_pairs(spark, seed, keyed, inclusive):
    points, intervals = sample(seed)
    p = spark.createDataFrame(points, "id int, k string, at timestamp_ntz")
    v = spark.createDataFrame(intervals, f"iid int, {'k' if keyed else 'ik'} string, a timestamp_ntz, b timestamp_ntz")
    out = in_intervals(p, "at", v, "a", "b", ["k"] if keyed else [], inclusive)
    assert rows(out, "id", "iid") == sorted(by_hand(points, intervals, keyed, inclusive), key=str)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert not re.search("NestedLoop|Cartesian", plan)


@pytest.mark.parametrize("kind", ["date", "int", "double"])
def test_dates_and_numbers(spark, kind):
    rng = random.Random(4)
    lists = [[rng.randrange(-300, 900) / (4 if kind == "double" else 1) for _ in range(3)] for _ in range(120)]
    make = (lambda x: (START + timedelta(days=int(x))).date()) if kind == "date" else (int if kind == "int" else float)
    points = [(i, make(r[0])) for i, r in enumerate(lists)]
    intervals = [(i, make(r[1]), None if i % 9 == 0 else make(r[2])) for i, r in enumerate(lists)]
    p = spark.createDataFrame(points, f"id int, at {kind}")
    v = spark.createDataFrame(intervals, f"iid int, a {kind}, b {kind}")
    want = [(i, j) for i, at in points for j, a, b in intervals if a <= at and (b is None or at < b)]
    assert rows(in_intervals(p, "at", v, "a", "b"), "id", "iid") == sorted(want, key=str)


def test_intervals_take_few_bins(spark):
    """However long: at most STEP + 2 rows, and a point one row per level in use."""
    spans = [(i, START, START + timedelta(seconds=7**i)) for i in range(1, 11)]
    v = spark.createDataFrame(spans, "iid int, a timestamp_ntz, b timestamp_ntz")
    p = spark.range(0, 300, 1, 2).select("id", F.expr("timestamp_ntz'2020-01-01' + make_interval(0, 0, 0, cast(id as int))").alias("at"))
    text = in_intervals(p, "at", v, "a", "b")._jdf.queryExecution().executedPlan().toString()
    assert "Generate explode" in text and ranges.STEP == 8
    out = in_intervals(p, "at", v, "a", "b")
    assert out.count() == sum(1 + (7**i - 1) // 86_400 for i in range(1, 11) if (7**i - 1) // 86_400 < 300) + sum(
        300 for i in range(1, 11) if (7**i - 1) // 86_400 >= 300)


def test_empty_sides_and_clashes(spark):
    p = spark.createDataFrame([], "id int, at timestamp_ntz")
    v = spark.createDataFrame([(1, START, None)], "iid int, a timestamp_ntz, b timestamp_ntz")
    assert in_intervals(p, "at", v, "a", "b").count() == 0
    full = spark.createDataFrame([(1, START)], "id int, at timestamp_ntz")
    assert in_intervals(full, "at", v.limit(0), "a", "b").count() == 0
    with pytest.raises(ValueError, match="both sides"):
        in_intervals(full, "at", v.withColumnRenamed("iid", "id"), "a", "b")
