from decimal import Decimal

import pytest
from conftest import ts
from pyspark.sql import functions as F

from asthen.functions import (
    blank_to_null,
    choose,
    clean_string,
    exact_mean,
    in_vocabulary,
    month_of,
    null_if_negative,
    rank_code,
    safe_ratio,
    seconds_between,
    surrogate_key,
    text_as,
)


def one(spark, column, **values):
    schema = ", ".join(f"{k} {v[1]}" for k, v in values.items())
    df = spark.createDataFrame([tuple(v[0] for v in values.values())], schema or "x int")
    return df.select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(("text", "case", "expected"), [
    (" Sanction ", "upper", "SANCTION"), (" Sanction ", "lower", "sanction"), (" Sanction ", "none", "Sanction"),
    ("", "upper", None), ("   ", "none", None), (None, "lower", None), ("\t", "none", "\t"),
])
def test_clean_string(spark, text, case, expected):
    assert one(spark, clean_string(F.col("s"), case), s=(text, "string")) == expected


def test_clean_string_rejects_other_cases():
    with pytest.raises(ValueError):
        clean_string(None, "title")


@pytest.mark.parametrize(("text", "expected"), [
    (" ACTIVE ", "active"), ("", "unknown"), (None, "unknown"), ("unregistered", "unknown"),
])
def test_vocabulary(spark, text, expected):
    assert one(spark, in_vocabulary(F.col("s"), ("active", "deceased"), "unknown"), s=(text, "string")) == expected


@pytest.mark.parametrize(("text", "expected"), [(" high ", 2), ("LOW", 4), ("odd", 9), ("", 9), (None, 9)])
def test_rank_code(spark, text, expected):
    ranks = {"HIGH": 2, "LOW": 4}
    assert one(spark, rank_code(F.col("s"), ranks, 9), s=(text, "string")) == expected


def test_choose_takes_the_first_true_condition(spark):
    cases = [(F.col("x") > 5, "big"), (F.col("x") > 1, "some")]
    assert [one(spark, choose(cases, "none"), x=(x, "int")) for x in (9, 3, 0)] == ["big", "some", "none"]


def test_casts_treat_blanks_as_null_and_reject_text(spark):
    assert one(spark, text_as(F.col("s"), "timestamp_ntz"), s=("  ", "string")) is None
    assert one(spark, text_as(F.col("s"), "timestamp_ntz"), s=(" 2024-01-02 03:04:05 ", "string")) == ts(
        "2024-01-02 03:04:05")
    assert one(spark, text_as(F.col("s"), "decimal(12,2)"), s=("-5.00", "string")) == Decimal("-5.00")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        one(spark, text_as(F.col("s"), "decimal(12,2)"), s=("n/a", "string"))


def test_negative_is_null_and_keeps_its_type(spark):
    df = spark.createDataFrame([(Decimal("-1.00"),), (Decimal("0.00"),), (None,)], "x decimal(12,2)")
    out = df.select(null_if_negative(F.col("x")).alias("x"))
    assert out.schema["x"].dataType.simpleString() == "decimal(12,2)"
    assert [r["x"] for r in out.collect()] == [None, Decimal("0.00"), None]


@pytest.mark.parametrize(("a", "b", "expected"), [
    (1, 2, "0.500"), (2, 3, "0.667"), (5, 0, None), (5, None, None), (None, 5, None), (1, 16, "0.063"),
])
def test_safe_ratio(spark, a, b, expected):
    value = one(spark, safe_ratio(F.col("a"), F.col("b"), 3), a=(a, "bigint"), b=(b, "int"))
    assert (value is None) == (expected is None) and (value is None or value == Decimal(expected))


def test_mean_rounds_once_and_half_up(spark):
    df = spark.createDataFrame([(Decimal("100.00"),), (Decimal("101.01"),), (None,)], "x decimal(12,2)")
    assert df.agg(exact_mean(F.col("x"), 2)).first()[0] == Decimal("100.51")
    # 0.0049999... : rounding to six places first would give 0.01
    thin = spark.range(3_000_001).select(F.when(F.col("id") < 15_000, F.lit("1.00")).otherwise("0.00")
                                         .cast("decimal(12,2)").alias("x"))
    assert thin.agg(exact_mean(F.col("x"), 2)).first()[0] == Decimal("0.00")
    assert df.filter("x is null").agg(exact_mean(F.col("x"), 2)).first()[0] is None


def test_month_and_seconds_do_not_depend_on_the_zone(spark):
    # 2024-03-10 has 23 hours in the session's zone
    assert one(spark, seconds_between(F.col("a"), F.col("b")), a=(ts("2024-03-10"), "timestamp_ntz"),
               b=(ts("2024-03-11"), "timestamp_ntz")) == 86_400
    assert str(one(spark, month_of(F.col("a")), a=(ts("2024-03-01"), "timestamp_ntz"))) == "2024-03-01"


def test_surrogate_key_marks_nulls(spark):
    import hashlib
    key = one(spark, surrogate_key(F.col("a"), F.col("b")), a=("GEN-1", "string"), b=(None, "date"))
    assert key == hashlib.md5(b"GEN-1-_dbt_utils_surrogate_key_null_").hexdigest()


def test_blank_to_null_keeps_inner_spaces(spark):
    assert one(spark, blank_to_null(F.col("s")), s=("  a b ", "string")) == "a b"
