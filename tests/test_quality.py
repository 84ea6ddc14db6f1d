import pytest
from conftest import rows, ts

from asthen.functions import moment
from asthen.operators import quality
from asthen.operators.quality import Check, Observed, count_violations


@pytest.fixture(scope="module")
def numbers(spark):
    return spark.createDataFrame([(1, None), (1, None), (None, 2), (None, 3)], "x int, y int")


def test_unique_ignores_nulls(numbers):
    assert rows(quality.not_unique(numbers, "x")) == [(1, 2)]


def test_combinations_group_nulls(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, 2)], "x int, y int")
    assert rows(quality.repeated(df, ["x", "y"])) == [(1, None, 2)]


def test_not_null(numbers):
    assert quality.missing(numbers, "x").count() == 2


def test_accepted_values_let_null_pass(spark):
    df = spark.createDataFrame([("a",), ("z",), ("z",), (None,)], "x string")
    assert rows(quality.unexpected_values(df, "x", ["a", "b"])) == [("z", 2)]


@pytest.mark.parametrize(("low", "high", "inclusive", "expected"), [
    (0, 2, True, [-1, 3]), (0, 2, False, [-1, 0, 2, 3]), (0, None, True, [-1]), (None, 2, True, [3]),
])
def test_range_lets_null_pass(spark, low, high, inclusive, expected):
    df = spark.createDataFrame([(v,) for v in (-1, 0, 1, 2, 3, None)], "x int")
    assert [r[0] for r in rows(quality.out_of_range(df, "x", low, high, inclusive))] == expected


def test_range_needs_a_bound():
    with pytest.raises(ValueError):
        quality.is_out_of_range("x")


def test_ends_before_start(spark):
    df = spark.createDataFrame([(ts("2024-01-02"), ts("2024-01-01 12:00")), (ts("2024-01-02"), None),
                                (ts("2024-01-02"), ts("2024-01-02"))], "a timestamp_ntz, b timestamp_ntz")
    assert rows(quality.ends_before_start(df, "a", "b", "seconds"), "seconds") == [(-43_200,)]


@pytest.mark.parametrize(("newest", "status"), [
    ("2024-01-31 13:00", "pass"), ("2024-01-31 12:00", "pass"), ("2024-01-31 11:00", "warn"),
    ("2024-01-30 00:00", "warn"), ("2024-01-29 23:00", "error"), (None, "error"),
])
def test_freshness(spark, newest, status):
    df = spark.createDataFrame([(ts(newest),), (ts("2024-01-01") if newest else None,)], "loaded timestamp_ntz")
    as_of = moment(ts("2024-02-01"))
    assert quality.freshness(df, "t", "loaded", as_of, 12, 48).first()["status"] == status


def test_report(spark, numbers):
    checks = [
        Check("n", "unique", ("x",), "warn"), Check("n", "not_null", ("x",)),
        Check("n", "accepted_range", ("y",), options={"low": 0}),
        Check("n", "accepted_values", ("x",), options={"values": [1]}),
        Check("n", "unique_combination", ("x", "y")),
        Check("m", "rows", rows=lambda df: df.filter("id > 1"), label="small"),
    ]
    report = quality.report({"n": numbers, "m": spark.range(3)}, checks)
    assert rows(report) == sorted([
        ("unique_n_x", "warn", 1, "warn"), ("not_null_n_x", "error", 2, "error"),
        ("accepted_range_n_y", "error", 0, "pass"), ("accepted_values_n_x", "error", 0, "pass"),
        ("unique_combination_n_x_y", "error", 1, "error"), ("small", "error", 1, "error"),
    ])


def test_row_counts(spark):
    out = quality.row_counts({"b": spark.range(2), "a": spark.range(3)})
    assert [tuple(r) for r in out.collect()] == [("a", 3), ("b", 2)]


def test_checks_of_a_table_share_one_grouping(spark):
    """Grouping sets count what each check would by itself, on nulls, repeats and an empty table."""
    data = [(1, "a", 1.0), (1, "a", None), (2, None, -1.0), (None, "z", 5.0), (None, "z", 7.0), (3, "q", 2.0), (3, "b", 0.5)]
    df = spark.createDataFrame(data, "k int, v string, x double")
    checks = [
        Check("t", "unique", ("k",)), Check("t", "not_null", ("v",)), Check("t", "unique_combination", ("k", "v")),
        Check("t", "accepted_values", ("v",), "warn", {"values": ("a", "b")}),
        Check("t", "accepted_range", ("x",), options={"low": 0, "high": 6}), Check("t", "unique", ("v",)),
        Check("t", "rows", rows=lambda d: d.filter("x > 4"), label="big"),
    ]
    for some in (df, df.limit(0)):
        got = {r.check_name: r.violations for r in count_violations(some, checks).collect()}
        assert got == {c.name: c.violations(some).count() for c in checks}
    plan = count_violations(df, checks[:6])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Scan") == 1


def test_rows_are_checked_as_they_are_written(spark, tmp_path):
    df = spark.range(0, 100, 1, 4).selectExpr("id", "nullif(id % 10, 3) as x")
    checks = [Check("t", "not_null", ("x",)), Check("t", "accepted_range", ("x",), "warn", {"high": 8}), Check("t", "unique", ("id",))]
    seen = Observed(checks)
    seen.watch(df).write.parquet(str(tmp_path / "t"))
    assert [(r.check_name, r.violations, r.status) for r in seen.lines()] == [
        ("not_null_t_x", 10, "error"), ("accepted_range_t_x", 10, "warn")]
    none = Observed(checks[:1])
    none.watch(df.limit(0)).write.parquet(str(tmp_path / "none"))
    assert [(r.violations, r.status) for r in none.lines()] == [(0, "pass")]
    assert Observed(checks[2:]).lines() == []
