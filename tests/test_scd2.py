import pytest
from conftest import rows, ts
from pyspark.sql import functions as F

from asthen.functions import moment
from asthen.operators.history import scd2_first_load, scd2_merge
from asthen.sources.tables import HistoryTable

SOURCE = "k string, status string, updated_at timestamp_ntz"


def source(spark, *data):
    return spark.createDataFrame([(k, s, ts(at)) for k, s, at in data], SOURCE)


def clock(text):
    return moment(ts(text))


def merge(history, df, as_of):
    return scd2_merge(history, df, "k", "updated_at", clock(as_of))


def before(spark):
    history = scd2_first_load(source(spark, ("K1", "a", "2024-01-01"), ("K2", "a", "2024-01-01"),
                                     ("K3", "a", "2024-01-01"), ("K5", "a", "2023-06-01")), "k", "updated_at")
    return history.withColumn("valid_to", F.when(F.col("k") == "K5", clock("2023-12-01")))


def after(spark):
    return source(spark, ("K1", "b", "2024-02-01"), ("K2", "b", "2024-01-01"), ("K4", "a", "2024-01-20"),
                  ("K5", "b", "2024-02-02"))


EXPECTED = [
    ("K1", "a", ts("2024-01-01"), ts("2024-02-01")), ("K1", "b", ts("2024-02-01"), None),
    ("K2", "a", ts("2024-01-01"), None), ("K3", "a", ts("2024-01-01"), ts("2024-03-01")),
    ("K4", "a", ts("2024-01-20"), None), ("K5", "a", ts("2023-06-01"), ts("2023-12-01")),
    ("K5", "b", ts("2024-02-02"), None)]
SHOWN = ("k", "status", "valid_from", "valid_to")


def test_merge(spark):
    merged = merge(before(spark), after(spark), "2024-03-01")
    assert rows(merged, *SHOWN) == EXPECTED
    assert rows(merge(merged, after(spark), "2024-04-01"), *SHOWN) == EXPECTED


def test_a_key_that_returns_unchanged_repeats_its_id(spark):
    first = scd2_first_load(source(spark, ("K", "a", "2024-01-01")), "k", "updated_at")
    nothing = source(spark, ("X", "a", "2024-01-01")).limit(0)
    gone = merge(first, nothing, "2024-02-01")
    back = merge(gone, source(spark, ("K", "a", "2024-01-01")), "2024-03-01")
    assert rows(back, *SHOWN) == [("K", "a", ts("2024-01-01"), None), ("K", "a", ts("2024-01-01"), ts("2024-02-01"))]
    assert back.select("scd_id").distinct().count() == 1


def test_older_source_rows_change_nothing(spark):
    first = scd2_first_load(source(spark, ("K", "a", "2024-01-01")), "k", "updated_at")
    assert rows(merge(first, source(spark, ("K", "z", "2023-01-01")), "2024-02-01"), *SHOWN) == [
        ("K", "a", ts("2024-01-01"), None)]


def test_new_columns_are_appended(spark):
    wider = after(spark).withColumn("grade", F.lit(3))
    merged = merge(before(spark), wider, "2024-03-01")
    assert rows(merged.filter("grade is not null"), "k") == [("K1",), ("K4",), ("K5",)]


def test_stored_history(spark, tmp_path):
    table = HistoryTable(spark, str(tmp_path / "h"), "k", "updated_at")
    assert table.snapshot(source(spark, ("K1", "a", "2024-01-01"), ("K2", "a", "2024-01-01"),
                                 ("K3", "a", "2024-01-01")), clock("2024-01-02")) == 0
    assert table.snapshot(after(spark), clock("2024-03-01")) == 1
    expected = [r for r in EXPECTED if r[2] != ts("2023-06-01")]
    assert rows(table.read(), *SHOWN) == expected

    # a third run closes nothing, an unfinished fourth is not seen
    assert table.snapshot(after(spark), clock("2024-04-01")) == 2
    assert rows(table.read(), *SHOWN) == expected
    table.snapshot(source(spark, ("K9", "a", "2024-05-01")), clock("2024-05-01"))
    (tmp_path / "h" / "v=3" / "_schema").rename(tmp_path / "h" / "v=3" / "_unfinished")
    assert table.version() == 2
    assert rows(table.read(), *SHOWN) == expected
    assert table.snapshot(after(spark), clock("2024-06-01")) == 3
    assert rows(table.read(), *SHOWN) == expected

    table.expire(keep=1)
    assert rows(table.read(), *SHOWN) == expected


def test_a_run_writes_the_buckets_it_changes(spark, tmp_path):
    """Of 2,000 keys three change: a new version, a key that goes and one that comes."""
    def state(changed, gone, come):
        ids = [i for i in range(2_000) if i not in gone] + come
        return source(spark, *[(f"K{i}", "b" if i in changed else "a",
                                "2024-02-01" if i in changed else "2024-01-01") for i in ids])

    def files(run):
        return {str(p.relative_to(tmp_path / "h")): p.stat().st_size
                for p in (tmp_path / "h" / f"v={run}").rglob("*.parquet")}

    table = HistoryTable(spark, str(tmp_path / "h"), "k", "updated_at", buckets=50)
    first = state((), (), [])
    table.snapshot(first, clock("2024-01-02"))
    before = files(0)
    assert len(before) == 50
    second = state((7,), (8,), [5_000])
    assert table.snapshot(second, clock("2024-03-01")) == 1
    after = files(1)
    opened = {p.split("/")[2] for p in after if "/open=1/" in p}
    assert 1 <= len(opened) <= 3 and sum(after.values()) < 0.2 * sum(before.values()) and files(0) == before
    merged = merge(scd2_first_load(first, "k", "updated_at"), second, "2024-03-01")
    assert rows(table.read(), *SHOWN) == rows(merged, *SHOWN)
    # nothing changed: no rows are read whole or written
    assert table.snapshot(second, clock("2024-04-01")) == 2
    assert files(2) == {} and rows(table.read(), *SHOWN) == rows(merged, *SHOWN)
    # old open versions go once no kept run reads them
    table.expire(keep=1)
    assert {p.split("/")[2] for p in files(0)} == {p.split("/")[2] for p in before} - opened
    assert rows(table.read(), *SHOWN) == rows(merged, *SHOWN)
    # everything changes, with a new column
    third = state(range(2_000), (), []).withColumn("grade", F.lit(1))
    assert HistoryTable(spark, str(tmp_path / "h"), "k", "updated_at").snapshot(third, clock("2024-05-01")) == 3
    again = merge(merged, third, "2024-05-01")
    assert rows(table.read(), *SHOWN, "grade") == rows(again, *SHOWN, "grade")


def test_a_first_snapshot_may_be_empty(spark, tmp_path):
    table = HistoryTable(spark, str(tmp_path / "h"), "k", "updated_at")
    assert table.snapshot(source(spark), clock("2024-01-01")) == 0
    assert table.read().count() == 0 and "status" in table.read().columns
    assert table.snapshot(source(spark, ("K1", "a", "2024-01-02")), clock("2024-01-03")) == 1
    assert rows(table.read(), "k", "valid_to") == [("K1", None)]


def test_the_open_versions_of_the_newest_run_are_never_expired(spark, tmp_path):
    table = HistoryTable(spark, str(tmp_path / "h"), "k", "updated_at")
    table.snapshot(source(spark, ("K1", "a", "2024-01-01")), clock("2024-01-02"))
    with pytest.raises(ValueError, match="keep at least 1"):
        table.expire(keep=0)
    assert table.read().count() == 1
