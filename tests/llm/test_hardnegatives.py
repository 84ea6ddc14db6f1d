"""Hard negatives: table scores against products, the query against SQL and brute force."""

import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from asthen.llm import hardnegatives as H
from asthen.llm import queries
from asthen.llm.hardnegatives import Best, SubsetSums, bit_planes, hard_negatives


@pytest.mark.parametrize("dims", [1, 7, 8, 9, 64])
@pytest.mark.parametrize("size", [1, 100, 1 << 20, 1 << 40])
def test_scores_are_exact(dims, size):
    dice = np.random.default_rng(dims)
    a = dice.integers(-size, size + 1, (5, dims))
    c = dice.integers(-size, size + 1, (33, dims))
    with np.errstate(over="ignore"):
        want = c @ a.T  # wraps at 64 bits as the tables do
    assert (SubsetSums(a).scores(bit_planes(c)) == want).all()


def test_widest_numbers():
    c = np.array([[-(1 << 63), (1 << 63) - 1, 0, -1]])
    assert (SubsetSums(np.array([[0, 1, 5, 2]])).scores(bit_planes(c)) == (1 << 63) - 3).all()


def test_best_keeps_ties_by_place():
    best = Best(np.array([0, 5]), 2)
    best.add(np.array([0, 0, 0, 1]), np.array([3, 3, 3, 6]), np.array([4, 1, 9, 2]))
    assert best.place.tolist() == [1, 4, 2]
    assert best.enters(np.array([[3, 5], [4, 4]]), np.array([0, 1])).tolist() == [[False, True], [True, False]]


def brute(rows, positives=5, negatives=10):
    seen, usable = set(), []
    for key, label, x in rows:
        if label is None or x is None or any(v is None or not math.isfinite(v) for v in x):
            continue
        v = tuple(math.floor(256 * v) for v in x)
        if (key, label, v) not in seen:
            seen.add((key, label, v))
            usable.append((key, label, v))
    out = []
    order = lambda r: (-r[0], r[1] is None, r[1] or 0)
    for i, (key, label, a) in enumerate(usable):
        if key is None or key % 100:
            continue
        score = [
            (sum(x * y for x, y in zip(a, v)), k, lab)
            for j, (k, lab, v) in enumerate(usable)
            if j != i and len(v) == len(a)
        ]
        for ps, pk, _ in sorted([s for s in score if s[2] == label], key=order)[:positives]:
            fit = [s for s in score if s[2] != label and 30 * ps <= 100 * s[0] <= 90 * ps]
            for rank, (ns, nk, _) in enumerate(sorted(fit, key=order)[:negatives], 1):
                out.append((key, pk, rank, nk, ps, ns))
    return sorted(out, key=str)


def run(spark, rows, **more):
    rows = [(*r, "x", 1, 2) for r in rows]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>, row string, dims int, key int")
    return df, sorted(map(tuple, hard_negatives(df, F.col("vec_id") % 100 == 0, **more).collect()), key=str)


def sample(n=400, seed=1):
    dice = np.random.default_rng(seed)
    rows = [(i, int(dice.integers(0, 3)), [float(v) for v in dice.normal(size=10).round(1)]) for i in range(n)]
    rows += [(i + 1000, r[1], r[2]) for i, r in enumerate(rows[:60])]  # ties
    rows += [(2000 + i, i % 2, rows[0][2]) for i in range(40)]  # a group of copies
    rows += [
        (None, 1, rows[0][2]), (7, 1, None), (8, None, rows[0][2]), (9, 1, [1.0, None] + [0.0] * 8),
        (10, 1, [float("nan")] * 10), (11, 1, [float("inf")] * 10), (300, 2, rows[5][2]), (300, 2, rows[5][2]),
        (12, 1, [1.0, 2.0]), (500, 1, [1.0, 2.5]), (13, 0, [0.5, 1.0]), (14, 1, []), (600, 1, []), (15, 0, []),
        (700, 1, [0.0] * 10), (800, 77, rows[3][2]),
    ]
    return rows


def test_awkward_rows(spark):
    rows = sample()
    df, got = run(spark, rows)
    assert got == brute(rows) and len(got) > 100
    assert hard_negatives(df.limit(0), F.col("vec_id") % 100 == 0).count() == 0


def test_many_cells(spark, monkeypatch):
    rows = sample(seed=2)
    for rows_a_cell in (3, 60):
        monkeypatch.setattr(H, "CELL_ROWS", rows_a_cell if rows_a_cell > 20 else 100)
        monkeypatch.setattr(H, "BLOCK", 7)
        monkeypatch.setattr(H, "ANCHORS", rows_a_cell)
        assert run(spark, rows)[1] == brute(rows)


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_query_against_sql(spark, sf):
    folder = f"/root/testdata/{sf}"
    con = duckdb.connect()
    con.sql(f"create view embeddings as select * from '{folder}/embeddings.parquet'")
    want = con.sql(queries.all_sql()["op12_hard_negatives"])
    got = queries.op12_hard_negatives(spark, folder).select(*want.columns)
    assert sorted(map(tuple, got.collect())) == sorted(want.fetchall())
