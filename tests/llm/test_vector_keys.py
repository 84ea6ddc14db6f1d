"""Near vectors where keys are null or stand for several vectors."""

import random

import numpy as np

from asthen.llm.embeddings import near_vectors


def brute(rows, least=0.93):
    usable = [r for r in rows if r[0] is not None and r[2] is not None]
    comp = {r[0]: r[0] for r in rows if r[0] is not None}

    def linked(a, b):
        x, y = np.array(a[2]), np.array(b[2])
        return a[2] == b[2] or x @ y / np.sqrt((x @ x) * (y @ y)) >= least

    pairs = [(i, j) for i in range(len(usable)) for j in range(i) if usable[i][2] == usable[j][2]
             and usable[i][1] == usable[j][1] or usable[i][1] == usable[j][1] and linked(usable[i], usable[j])]
    count = [0] * len(usable)
    for i, j in pairs:
        count[i] += 1
        count[j] += 1
    for _ in range(len(usable)):
        for i, j in pairs:
            low = min(comp[usable[i][0]], comp[usable[j][0]])
            comp[usable[i][0]] = comp[usable[j][0]] = low
    out = [(r[0], n, comp[r[0]]) for r, n in zip(usable, count)]
    return sorted(out + [(r[0], 0, comp.get(r[0])) for r in rows if r not in usable], key=str)


def run(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    return sorted(((r.vec_id, r.n_links, r.component_id) for r in near_vectors(df).collect()), key=str)


def test_a_key_with_two_vectors(spark):
    rows = [(1, 0, [1.0, 0.0]), (1, 0, [0.0, 1.0]), (2, 0, [0.0, 1.0]), (3, 0, [1.0, 0.01]), (None, 0, [1.0, 0.0]),
            (1, 0, [1.0, 0.0]), (9, 1, [1.0, 0.0]), (4, 0, None)]
    got = run(spark, rows)
    assert [r for r in got if r[0] == 2] == [(2, 1, 1)]
    assert got == brute(rows)


def test_repeated_keys_at_random(spark):
    rng = random.Random(8)
    pool = [[round(rng.gauss(0, 1), 1) or 0.1 for _ in range(3)] for _ in range(30)]
    rows = [(rng.randrange(40), rng.randrange(2), rng.choice(pool)) for _ in range(120)]
    assert run(spark, rows) == brute(rows)
