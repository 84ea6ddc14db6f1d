"""Line dedup, decontamination and vectors against brute force."""

import random

import numpy as np
import pytest

from asthen.llm import embeddings, linededup
from asthen.llm.decontamination import contained_items
from asthen.llm.linededup import dedup_lines
from asthen.llm.queries import all_sql


def prose(rng, n):
    return [f"w{rng.randrange(4000)}" for _ in range(n)]


@pytest.fixture(scope="module")
def passages():
    rng = random.Random(4)

    def marked(words):
        return [w + rng.choice([".", "\n", ","]) if i % 11 == 9 else w for i, w in enumerate(words)]

    shared = [marked(prose(rng, n)) for n in (52, 60, 75, 90, 130)]
    texts = []
    for i in range(40):
        words = marked(prose(rng, rng.choice([30, 200, 900])))
        if i % 2:
            at = rng.randrange(len(words))
            words[at:at] = shared[i % 5]
        texts.append(" ".join(words))
    clean = [i for i in range(40) if i % 2 == 0]
    return texts, shared, clean


def test_passages_inside_lines_go_and_clean_texts_stay(spark, passages):
    texts, shared, clean = passages
    rows = [(i, t, "x", 1) for i, t in enumerate(texts)]
    extra = [(40, None, "x", 1), (41, "", "x", 1), (42, texts[0], "x", 1), (None, texts[0], "x", 1),
             (43, "a " * 400, "x", 1), (41, "", "x", 1), (44, "é" * 30 + " " + texts[2] + " ü", "x", 1)]
    docs = spark.createDataFrame(rows + extra, "doc_id long, text string, spans string, pos int")
    got = {}
    for r in dedup_lines(docs).collect():
        got.setdefault(r.doc_id, []).append(r)
    assert sum(map(len, got.values())) == len(rows) + len(extra)
    for i in clean:
        assert got[i][0].text == texts[i] and got[i][0].removed_words == 0
    assert got[40][0].text is None and got[41][0].text == "" and len(got[41]) == 2
    assert got[42][0].text.strip() == "" and got[None][0].text == texts[0]
    assert len(got[43][0].text.split()) < 60
    assert len(got[44][0].text.split()) < 40 and got[44][0].text.startswith("é" * 30)
    first = set()
    for i in range(1, 40, 2):
        old, r = texts[i], got[i][0]
        cut = "".join(
            old[a:b] for a, b in zip([0] + [s.end for s in r.removed_spans],
                                     [s.start for s in r.removed_spans] + [len(old)])
        )
        assert cut == r.text
        if i % 5 in first:  # all but the edges of the passage is gone
            assert r.removed_words >= 0.6 * len(shared[i % 5])
            assert r.removed_words <= len(shared[i % 5]) + 2
        else:
            assert r.text == old
        first.add(i % 5)


def test_line_dedup_of_nothing(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert dedup_lines(docs).collect() == []


def test_lines_do_not_depend_on_what_stands_before():
    rng = random.Random(9)
    a, b = " ".join(prose(rng, 300)).encode(), " ".join(prose(rng, 80)).encode()
    one = linededup.cut_lines(np.frombuffer(b, np.uint8), np.array([0, len(b)]))
    both = linededup.cut_lines(np.frombuffer(a + b, np.uint8), np.array([0, len(a), len(a + b)]))
    assert both.hash[both.doc == 1].tolist() == one.hash.tolist()
    # chunks of any size give the same hashes
    old = linededup.CHUNK
    linededup.CHUNK = 64
    try:
        small = linededup.cut_lines(np.frombuffer(a + b, np.uint8), np.array([0, len(a), len(a + b)]))
    finally:
        linededup.CHUNK = old
    assert small.hash.tolist() == both.hash.tolist()


def brute_contained(docs, items, threshold, n):
    import re

    def shingles(text):
        w = [x for x in re.split(r"[\W_]+", (text or "").lower()) if x]
        return {" ".join(w[i : i + n]) for i in range(len(w) - n + 1)}

    out = set()
    for i, t in docs:
        for j, u in items:
            if i is not None and j is not None and shingles(u):
                found = len(shingles(u) & shingles(t))
                if found / len(shingles(u)) >= threshold:
                    out.add((i, j, found, len(shingles(u))))
    return out


def test_contained_items(spark):
    rng = random.Random(2)
    items = [(i, " ".join(prose(rng, n))) for i, n in enumerate([5, 6, 9, 14, 33, 64, 65, 200])]
    items += [(20, "too few words"), (21, None), (22, ""), (None, " ".join(prose(rng, 20)))]
    docs = []
    for i in range(60):
        words = prose(rng, rng.choice([0, 3, 50, 2000]))
        part = items[i % 8][1].split()
        for _ in range(i % 4):  # up to three words changed
            part[rng.randrange(len(part))] = "changed"
        at = rng.randrange(len(words) + 1)
        words[at:at] = part
        docs.append((i, ", ".join(words).upper()))
    docs += [(60, None), (61, ""), (None, items[3][1])]
    frame = spark.createDataFrame([(*d, 1, 1) for d in docs], "doc_id long, text string, item_id int, hash int")
    bench = spark.createDataFrame([(*d, 1) for d in items], "item_id long, text string, doc_id int")
    got = contained_items(frame, bench)
    assert {tuple(r)[:4] for r in got.collect()} == brute_contained(docs, items, 0.8, 5)
    assert contained_items(frame.limit(0), bench).collect() == []
    assert contained_items(frame, bench.limit(0)).collect() == []


def test_contained_items_of_any_size(spark, monkeypatch):
    """With the joins that shuffle: no text beside its shingles; keys that repeat are one document."""
    from asthen.llm import decontamination

    rng = random.Random(6)
    items = [(i, " ".join(prose(rng, 30))) for i in range(12)]
    docs = [(i, " ".join(prose(rng, 4000) + items[i][1].split() + prose(rng, 4000))) for i in range(6)]
    for i in range(6, 12):  # an item cut in two, under one key
        part = items[i][1].split()
        docs += [(i, " ".join(prose(rng, 50) + part[:17])), (i, " ".join(part[13:] + prose(rng, 50))), (i, None)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = {tuple(r) for r in contained_items(frame, bench).collect()}
    assert {r[:2] for r in want} == {(i, i) for i in range(12)}
    monkeypatch.setattr(decontamination, "BROADCAST_ROWS", 0)
    for setting in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
        spark.conf.set(setting, -1)
    try:
        out = contained_items(frame, bench)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert {tuple(r) for r in out.collect()} == want
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    finally:
        for setting in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
            spark.conf.unset(setting)


def brute_vectors(rows, least=0.93):
    ids = [r[0] for r in rows]
    links = {i: 0 for i in range(len(rows))}
    comp = list(range(len(rows)))

    def unit(v):
        if not v or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            return None
        return np.array(v, float) / np.linalg.norm(v)

    units = [unit(r[1]) for r in rows]
    pairs = []
    for i, a in enumerate(units):
        for j, b in enumerate(units):
            if i != j and a is not None and b is not None and len(a) == len(b):
                if rows[i][2] is not None and rows[i][2] == rows[j][2] and a @ b >= least:
                    links[i] += 1
                    pairs.append((i, j))
    changed = True
    while changed:
        changed = False
        for i, j in pairs:
            if ids[comp[j]] < ids[comp[i]]:
                comp[i], changed = comp[j], True
    return {ids[i]: (links[i], ids[comp[i]]) for i in range(len(rows))}


@pytest.mark.parametrize("block", [4096, 40])
def test_vectors(spark, monkeypatch, block):
    monkeypatch.setattr(embeddings, "BLOCK", block)
    rng = np.random.default_rng(8)
    rows = []
    for i in range(260):
        v = rng.normal(size=12)
        if i % 3 == 0 and rows:
            v = np.array(rows[rng.integers(len(rows))][1]) + rng.normal(size=12) * 0.25
        rows.append((i, [float(x) for x in np.float32(v)], int(rng.integers(2))))
    rows += [(300 + i, rows[7][1], rows[7][2]) for i in range(90)]  # copies
    rows += [(400, None, 1), (401, [0.0] * 12, 1), (402, [float("nan")] * 12, 1), (403, rows[0][1], None),
             (404, [None] * 12, 1), (405, [float("inf")] * 12, 1), (406, [1.0, 2.0], 1),
             (407, [2.0, 4.0], 1), (408, [], 0)]
    frame = spark.createDataFrame(
        [(*r, 1, 1) for r in rows], "vec_id long, embedding array<float>, label int, rep int, n int"
    )
    got = embeddings.near_vectors(frame).collect()
    want = brute_vectors(rows)
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == want
    assert all(r.kept == (r.vec_id == r.component_id) for r in got) and len(got) == len(rows)
    assert embeddings.near_vectors(frame.limit(0)).collect() == []


def test_probes_are_sufficient_and_the_index_prunes():
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(40, 32))
    raw = centres[rng.integers(40, size=3000)] + rng.normal(size=(3000, 32)) * 0.12
    unit = raw / np.linalg.norm(raw, axis=1, keepdims=True)
    book = embeddings.fit(unit)
    near = embeddings.probes(book, unit, np.sqrt(2 - 2 * 0.93))
    lists = embeddings._nearest(unit, book.centroids)
    a, b = np.nonzero(unit @ unit.T >= 0.93)
    assert near[a, lists[b]].all()
    assert near.mean() < 0.5


@pytest.mark.parametrize("name", sorted(all_sql()))
def test_against_sql(spark, name):
    import duckdb

    from asthen.llm.queries import all_queries

    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings"):
        con.execute(f"create view {t} as select * from read_parquet('{folder}/{t}.parquet')")
    want = con.execute(all_sql()[name]).df()
    got = all_queries()[name](spark, folder).toPandas()
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns
    assert sorted(map(tuple, got[columns].values)) == sorted(map(tuple, want[columns].values))


def test_texts_under_one_key_are_apart(spark):
    from asthen.llm.simhash import one_of_each

    rng = random.Random(5)
    a, b, c, d = (" ".join(prose(rng, 200)) for _ in range(4))
    texts = [(1, a), (2, a), (2, b), (3, c), (3, c), (3, d), (4, d), (None, a), (None, a), (5, b)]
    docs = spark.createDataFrame([(i, t, n) for n, (i, t) in enumerate(texts)], "doc_id long, text string, row int")
    got = one_of_each(docs)
    assert got.columns == docs.columns
    want = [(1, a), (2, b), (3, c), (3, d), (None, a), (None, a)]
    assert sorted(map(str, want)) == sorted(str((r.doc_id, r.text)) for r in got.collect())
    assert one_of_each(docs.limit(0)).collect() == []


def test_fingerprints_are_made_once(spark, monkeypatch):
    """Without repeated keys the rows kept come from one semi-join, without Python."""
    from asthen.llm.simhash import one_of_each

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    out = one_of_each(docs)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and plan.count("text#") > 0
    assert out.count() <= docs.count()
