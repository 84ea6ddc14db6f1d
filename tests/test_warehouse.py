"""Tables of the catalog: what other sessions see, and what a run that fails half-way leaves."""

import pytest
from conftest import day, rows
from pyspark.sql import functions as F

from asthen.plans.project import MODELS, run_project
from asthen.sources import warehouse as module
from asthen.sources.warehouse import Warehouse
from test_project import AS_OF, raw  # noqa: F401

SCHEMA = "k int, d date, x int"


@pytest.fixture
def house(spark, tmp_path):
    made = Warehouse(spark, str(tmp_path / "house"), prefix=f"t{abs(hash(str(tmp_path))) % 10**9}_")
    yield made
    for db in spark.catalog.listDatabases():
        if db.name.startswith(made.prefix):
            spark.sql(f"DROP DATABASE `{db.name}` CASCADE")


def table(spark, *data):
    return spark.createDataFrame([(k, day(d), x) for k, d, x in data], SCHEMA)


def broken(df):
    """The rows, of which the last can't be computed."""
    return df.repartition(3).withColumn("x", F.when(F.col("k") == 2, F.raise_error(F.lit("stopped"))).otherwise(F.col("x")))


def test_a_failed_refresh_leaves_the_old_rows(spark, house):
    old = table(spark, (1, "2024-01-01", 1), (2, "2024-01-02", 2))
    out = house.replace(old, "marts", "m")
    with pytest.raises(Exception, match="stopped"):
        house.replace(broken(old), "marts", "m")
    assert rows(house.table("marts", "m")) == rows(out) == rows(old)
    # killed after the rows are written, before the switch
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(house, "_switch", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError):
            house.replace(table(spark, (9, "2024-01-01", 9)), "marts", "m")
    assert rows(house.table("marts", "m")) == rows(old)
    new = old.withColumn("y", F.lit("a")).drop("x")
    house.replace(new, "marts", "m")
    assert rows(house.table("marts", "m")) == rows(new) and house.table("marts", "m").columns == ["k", "d", "y"]
    assert len(house.clean("marts", "m")) == 2 and rows(house.table("marts", "m")) == rows(new)


def test_a_failed_upsert_leaves_the_old_rows(spark, house, tmp_path):
    old = table(spark, (1, "2024-01-01", 1), (2, "2024-01-02", 2), (3, "2024-01-02", 3), (4, None, 4))
    house.upsert(old, "marts", "u", ["k"], "d")
    files = {p for p in tmp_path.rglob("*.parquet")}
    with pytest.raises(Exception, match="stopped"):
        house.upsert(broken(table(spark, (2, "2024-01-02", 20))), "marts", "u", ["k"], "d")
    assert rows(house.table("marts", "u")) == rows(old)
    out = house.upsert(table(spark, (2, "2024-01-02", 20), (5, "2024-01-05", 5)), "marts", "u", ["k"], "d")
    want = [(1, day("2024-01-01"), 1), (2, day("2024-01-02"), 20), (3, day("2024-01-02"), 3),
            (4, None, 4), (5, day("2024-01-05"), 5)]
    assert rows(out) == sorted(want, key=str)
    assert {p for p in tmp_path.rglob("*.parquet")} >= files  # a reader of the old state still has its files
    out = house.upsert(table(spark, (4, None, 40)), "marts", "u", ["k"], "d")
    assert rows(out.where("k = 4"), "x") == [(40,)] and out.count() == 5
    # a column that is new
    out = house.upsert(table(spark, (1, "2024-01-01", 10)).withColumn("y", F.lit(7)), "marts", "u", ["k"], "d")
    assert rows(out, "k", "x", "y") == [(1, 10, 7), (2, 20, None), (3, 3, None), (4, 40, None), (5, 5, None)]
    assert rows(out) == rows(house.table("marts", "u"))


def test_many_upserts_equal_one_table(spark, house, monkeypatch):
    """With and without a known first day; parts are joined up when there are many."""
    monkeypatch.setattr(module, "MOST_PARTS", 3)
    held = {}
    for i in range(9):
        data = [(k, f"2024-01-{1 + k % 28:02}", i) for k in range(i, 40, 7)]
        since = F.lit("2024-01-05").cast("date") if i % 2 else None
        data = [r for r in data if since is None or r[1] >= "2024-01-05"]
        held |= {k: (k, day(d), x) for k, d, x in data}
        out = house.upsert(table(spark, *data), "marts", "many", ["k"], "d", since=since)
        assert rows(out) == sorted(held.values(), key=lambda r: tuple((True, str(v)) for v in r))
    assert len(house._parts("marts", "many")) <= 3
    house.clean("marts", "many")
    assert house.table("marts", "many").count() == len(held)


def test_another_session_reads_every_model(spark, house, raw, tmp_path):  # noqa: F811
    for _ in range(2):
        outcomes = run_project(spark, raw, str(tmp_path / "w"), AS_OF, warehouse=house)
    assert {o.status for o in outcomes} == {"built"}
    other = spark.newSession()
    for model in MODELS:
        seen = other.table(f"{house.prefix}{model.layer}.{model.name}")
        assert seen.columns == spark.table(model.name).columns
        assert rows(seen) == rows(spark.table(model.name))
    assert other.table(f"{house.prefix}marts.level_monthly_occupancy").count() == 36 * 7
    assert other.table(f"{house.prefix}snapshots.assignment_history").where("valid_to is null").count() == 2


def test_an_empty_table_keeps_its_columns(spark, house):
    house.replace(table(spark), "marts", "none", ["d"])
    assert spark.newSession().table(f"{house.prefix}marts.none").columns == ["k", "d", "x"]
    out = house.upsert(table(spark, (1, "2024-01-01", 1)), "marts", "none", ["k"], "d")
    assert rows(out) == [(1, day("2024-01-01"), 1)]
