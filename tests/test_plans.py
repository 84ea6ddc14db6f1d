"""The physical plans the operators are written for."""

import re

import pytest
from conftest import rows
from pyspark.sql import functions as F

from asthen.operators.intervals import event_intervals
from asthen.plans import staging
from asthen.plans.history import generator_daily_since
from asthen.plans.rollup import refresh_generator_daily
from asthen_workload import catalog
from asthen_workload.bindings import Tables

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def tree(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def t(spark):
    return Tables(spark, SF)


@pytest.mark.parametrize("name", [n for n in catalog.QUERIES if n not in (
    "incremental_idempotent", "rerun_evidence", "rollup_from_empty_target")])
def test_no_pairing_joins_and_no_python(t, name):
    text = tree(catalog.QUERIES[name](t))
    for node in ("CartesianProduct", "NestedLoopJoin", "PythonUDF", "ArrowEvalPython", "MapInPandas"):
        assert node not in text, node


@pytest.mark.parametrize("name", ["dedup_readings", "dedup_latest", "first_row_per_key", "latest_row_per_key"])
def test_one_row_per_key_is_cut_before_the_shuffle(t, name):
    text = tree(catalog.QUERIES[name](t))
    assert re.search(r"row_number\(\), 1, Final.*Exchange hashpartitioning.*row_number\(\), 1, Partial", text, re.S)


def test_population_is_summed_before_its_shuffles(t):
    text = tree(catalog.QUERIES["level_monthly_population"](t))
    assert "partial_sum(step" in text
    # the join with the dwellings is an equality, without months
    assert not re.search(r"Join [^\n]*valid_(from|to)", text)


def test_staffing_does_not_expand_months(t):
    text = tree(catalog.QUERIES["department_monthly_staffing"](t))
    # the only explode over a month sequence builds the grid of departments
    assert len(re.findall(r"Generate explode\(sequence", text)) == 1


def test_months_are_expanded_without_a_shuffle(t):
    assert "Exchange hashpartitioning" not in tree(catalog.QUERIES["assignment_months"](t))


def test_scans_read_only_what_is_used(t):
    text = plan(catalog.QUERIES["sanctioned_relocations_by_level"](t))
    scans = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    assert any("o_orderpriority" in s and "o_totalprice" not in s and "o_orderdate" not in s for s in scans)
    text = plan(catalog.QUERIES["dq_unique_combination"](t))
    assert re.findall(r"ReadSchema: struct<([^>]*)>", text) == ["l_orderkey:bigint,l_linenumber:int"]


def rows_scanned(df):
    """Rows that all file scans of a query gave, from the plan that ran."""
    df.collect()
    todo, n = [df._jdf.queryExecution().executedPlan()], 0
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if name.startswith("AdaptiveSparkPlan"):
            todo.append(node.executedPlan())
            continue
        if name.startswith("ReusedSubquery"):
            continue
        if name.startswith("Scan "):
            n += node.metrics().apply("numOutputRows").value()
        for more in (node.children(), node.subqueries()):
            todo += [more.apply(i) for i in range(more.size())]
        if "QueryStage" in name:
            todo.append(node.plan())
        if name.startswith("Subquery"):
            todo.append(node.child())
    return n


def test_a_rerun_reads_the_days_looked_back_only(spark, tmp_path):
    """Ten months of raw readings stored by day; the job reads its 15 days and what was synced since."""
    from asthen.operators.history import lookback_from
    from asthen.sources.tables import newest_partition, read_table, refresh

    raw = spark.range(300 * 20).select(
        F.concat(F.lit("r"), "id").alias("reading_id"), F.lit("g").alias("generator_id"),
        (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(F.floor(F.col("id") / 20))).alias("read_at"),
        F.lit("10").alias("output_kw"), F.lit(1).cast("decimal(8,2)").alias("temperature_c"),
        F.lit(1).cast("decimal(8,3)").alias("vibration_mm_s"), F.lit(False).alias("is_manual_entry"),
    )
    late = F.when(F.col("reading_id").endswith("7"), 3).otherwise(0)
    raw = raw.withColumn("_synced_at", F.col("read_at") + F.make_dt_interval(late, F.lit(1)))
    raw = staging.with_reading_days(raw).coalesce(1)
    stored = refresh(raw, str(tmp_path / "raw"), [staging.READ_DAY, staging.SYNC_DAY])
    path = str(tmp_path / "daily")
    first = refresh_generator_daily(stored, path)
    before = rows(first)
    assert len(before) == 300
    newest = newest_partition(spark, path, "reading_date")
    assert str(newest) == "2024-10-26"
    batch = generator_daily_since(read_table(spark, str(tmp_path / "raw")), lookback_from(newest, 14))
    assert batch.count() == 15
    # of 6,000 rows the period's, for the earliest sync (once to prune, once to filter) and with
    # the rivals, which were synced since
    assert 15 * 20 <= rows_scanned(batch) <= 3 * (15 + 3) * 20
    again = refresh_generator_daily(read_table(spark, str(tmp_path / "raw")), path)
    assert rows(again) == before


def test_events_are_read_and_exchanged_once(t):
    text = tree(catalog.QUERIES["event_intervals"](t))
    assert text.count("FileScan parquet") == 1 and len(re.findall(r"\bExchange ", text)) == 1
    assert "Join" not in text


def test_a_frequent_key_is_cut_and_only_slice_starts_are_carried(spark):
    """The events are exchanged once, by key and slice; what else moves is one row per slice and
    task, and it is joined where the events are."""
    events = spark.range(0, 6_000, 1, 3).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
        F.timestamp_seconds(F.col("id") * 977 % 5_000).cast("timestamp_ntz").alias("at"), "id")
    out = event_intervals(events, "k", "at", "id", slice_rows=200, small_bytes=0)
    text = tree(out)
    assert re.search(r"Window .*\[k#\d+L?, _slice#\d+\]", text)
    moved = re.findall(r"Exchange hashpartitioning\(k#\d+L?, _slice#\d+.*\n[^\w]*(\w+)", text)
    assert sorted(moved) == ["HashAggregate", "Project"]  # slice starts, summed first, and events
    assert "partial_min" in text and "SortAggregate" not in text and out.count() == 6_000


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_crowded_dwelling_is_split(spark, t, no_broadcast):
    """Row-level joins leave skew to AQE: the crowded partition is read in parts."""
    from asthen.plans import history, staging
    settings = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
                "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        crowd = spark.range(0, 60_000, 1, 6).select(
            F.concat(F.lit("R"), "id").alias("resident_id"), F.lit("x").alias("full_name"),
            F.lit("active").alias("resident_status"), F.lit(None).cast("date").alias("birth_date"),
            F.lit(None).cast("timestamp_ntz").alias("registered_at"),
            F.when(F.col("id") % 3 == 0, F.lit("DW-1")).otherwise(
                F.concat(F.lit("DW-"), F.col("id") % 500)).alias("dwelling_id"))
        out = history.residents_by_level(crowd, staging.stage_dwellings(t["dwellings"]),
                                         staging.stage_level_zones(t["level_zones"]))
        assert len(out.collect()) == 60_000
        assert "SortMergeJoin(skew=true) [dwelling_id" in tree(out)
    finally:
        for k in settings:
            spark.conf.unset(k)
