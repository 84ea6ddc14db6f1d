"""Near-duplicate vectors: inverted lists with product-quantised residuals, exact rerank."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from asthen.llm.common import components, stored

#: Vectors that centroids and code words are fitted on, at most; every vector is indexed.
SAMPLE = 8_192
#: Inverted lists, at most.
LISTS = 256
#: Code words of a subspace, and subspaces, at most.
WORDS, SUBSPACES = 256, 16
#: Vectors of one label that meet in one task, about; twice as many at most.
BLOCK = 4_096


@dataclass
class Codebook:
    """Centroids of the inverted lists and, for each subspace, code words of residuals."""

    centroids: np.ndarray  # lists x dimensions
    words: np.ndarray  # subspaces x words x dimensions of a subspace

    def encode(self, unit: np.ndarray, lists: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes of the residuals, and how far each vector is from what its code stands for."""
        residual = unit - self.centroids[lists]
        m, _, width = self.words.shape
        codes = np.empty((len(unit), m), np.uint8)
        for j in range(m):
            part = residual[:, j * width : (j + 1) * width]
            codes[:, j] = _nearest(part, self.words[j])
        return codes, np.linalg.norm(residual - self.decode(codes), axis=1)

    def decode(self, codes: np.ndarray) -> np.ndarray:
        return np.concatenate([w[c] for w, c in zip(self.words, codes.T)], axis=1)


def _squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances between the rows of a and b."""
    d = (a**2).sum(1)[:, None] + (b**2).sum(1)[None, :] - 2 * (a @ b.T)
    return np.maximum(d, 0)


def _nearest(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.concatenate(
        [_squared(a[i : i + 4096], b).argmin(1) for i in range(0, len(a), 4096)] or [np.zeros(0, int)]
    )


def _means(x: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """k-means from a fixed start; an empty cluster keeps its centre."""
    rng = np.random.default_rng(17)
    centres = x[rng.permutation(len(x))[:k]].copy()
    for _ in range(rounds):
        own = _nearest(x, centres)
        counts = np.bincount(own, minlength=k)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, x)
        centres[counts > 0] = sums[counts > 0] / counts[counts > 0][:, None]
    return centres


def fit(sample: np.ndarray) -> Codebook:
    """A codebook from unit vectors; dimensions must be a multiple of the number of subspaces."""
    lists = int(min(LISTS, max(1, len(sample) // 16)))
    centroids = _means(sample, lists)
    residual = sample - centroids[_nearest(sample, centroids)]
    dims = sample.shape[1]
    m = next(m for m in range(min(SUBSPACES, dims), 0, -1) if dims % m == 0)
    k = int(min(WORDS, len(sample)))
    parts = np.split(residual, m, axis=1)
    return Codebook(centroids, np.stack([_means(p, k, 6) for p in parts]))


def probes(book: Codebook, unit: np.ndarray, radius: float) -> np.ndarray:
    """Which lists can hold a vector within `radius` of each vector (rows x lists).

    A vector in list c is nearer to c's centroid than to the query's own one, so it lies beyond
    the plane half-way between the two; a list is needed if that plane is within the radius. The
    probes are therefore sufficient: no list with a link is left out.
    """
    d = _squared(unit, book.centroids)
    own = d.argmin(1)
    between = np.sqrt(_squared(book.centroids, book.centroids))[own]
    gap = d - d[np.arange(len(unit)), own][:, None]
    return gap <= 2 * between * (radius + 1e-9) + 1e-12


class InvertedLists:
    """Vectors of one block by list, with codes; searched by table look-ups, checked exactly."""

    def __init__(self, book: Codebook, raw: np.ndarray, lists: np.ndarray) -> None:
        self.book, self.raw = book, raw
        self.norm = np.sqrt((raw**2).sum(1))
        unit = raw / self.norm[:, None]
        self.order = np.argsort(lists, kind="stable")
        codes, self.error = book.encode(unit, lists)
        decoded = book.decode(codes)
        # |q - c - r|^2 = |q - c|^2 + (|r|^2 + 2 c.r) - 2 q.r: the middle is the row's own, the
        # last comes from the query's table
        own = (decoded**2).sum(1) + 2 * (decoded * book.centroids[lists]).sum(1)
        self.codes, self.own = codes[self.order], own[self.order]
        self.error = self.error[self.order]
        self.lists, first = np.unique(lists[self.order], return_index=True)
        self.bounds = np.append(first, len(lists))

    def links(
        self, raw: np.ndarray, least: float, size: int = 256
    ) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query, row) pairs with cosine >= least, in pieces."""
        book = self.book
        radius = float(np.sqrt(max(0.0, 2 - 2 * least)))
        m, k, width = book.words.shape
        for lo in range(0, len(raw), size):
            query = raw[lo : lo + size]
            norm = np.sqrt((query**2).sum(1))
            unit = query / norm[:, None]
            needed = probes(book, unit, radius)[:, self.lists]
            # the table: inner products of the query's parts with all code words
            table = np.einsum("qmw,mkw->mqk", unit.reshape(len(unit), m, width), book.words)
            to_list = _squared(unit, book.centroids[self.lists])
            found_q, found_r = [], []
            for i in np.flatnonzero(needed.any(axis=0)):
                rows = slice(self.bounds[i], self.bounds[i + 1])
                some = np.flatnonzero(needed[:, i])
                dot = np.zeros((len(some), rows.stop - rows.start))
                for j, code in enumerate(self.codes[rows].T):
                    dot += table[j][some][:, code]
                squared = to_list[some, i][:, None] + self.own[rows][None, :] - 2 * dot
                # a vector is off its code by `error`, so it may be that much nearer
                reach = (radius + self.error[rows] + 1e-7) ** 2
                q, r = np.nonzero(squared <= reach[None, :])
                found_q.append(some[q])
                found_r.append(self.order[rows][r])
            if not found_q:
                continue
            q, r = np.concatenate(found_q), np.concatenate(found_r)
            for a in range(0, len(q), 65_536):
                qa, ra = q[a : a + 65_536], r[a : a + 65_536]
                cosine = np.einsum("ij,ij->i", query[qa], self.raw[ra]) / (norm[qa] * self.norm[ra])
                keep = cosine >= least
                yield qa[keep] + lo, ra[keep]


def _vectors(column: pa.Array | pd.Series, dims: int) -> np.ndarray:
    """Rows as doubles, scaled by their largest part, shorter ones filled with zeros."""
    out = np.zeros((len(column), dims))
    for i, v in enumerate(column):
        out[i, : len(v)] = v
    return out / np.maximum(np.abs(out).max(axis=1, initial=0), 1e-300)[:, None]


def _usable(vector: Column) -> Column:
    finite = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    )
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _placer(book: Codebook, dims: int, radius: float):
    """The list of each vector, and the lists to be probed for it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 2048):
                part = batch.slice(lo, 2048)
                raw = _vectors(part.column("vector").to_numpy(zero_copy_only=False), dims)
                unit = raw / np.sqrt((raw**2).sum(1))[:, None]
                near = probes(book, unit, radius)
                lists = _nearest(unit, book.centroids).astype(np.int32)
                needed = [np.flatnonzero(n).astype(np.int32) for n in near]
                yield pa.RecordBatch.from_arrays(
                    [
                        *(part.column(n) for n in ("label", "size", "vector", "rep", "n")),
                        pa.array(lists),
                        pa.array(needed, pa.list_(pa.int32())),
                    ],
                    names=["label", "size", "vector", "rep", "n", "list", "probes"],
                )

    return run


def _tile(book: Codebook, dims: int, least: float):
    """Links of one tile: of its members among themselves, or with the visitors of another block.

    Gives for each vector with links their number (copies counted) and one edge; the edges
    span the tile's components.
    """

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        inside = rows["member"].to_numpy()
        members, visitors = rows[inside], rows[~inside]
        alone = bool(rows["own"].iloc[0])
        if not len(members) or (not alone and not len(visitors)):
            return pd.DataFrame({"rep": [], "links": [], "root": []}).astype("int64")
        raw = _vectors(members["vector"], dims)
        index = InvertedLists(book, raw, members["list"].to_numpy())
        asked = members if alone else visitors
        start = 0 if alone else len(members)
        reps = np.concatenate([members["rep"], visitors["rep"]])
        n = np.concatenate([members["n"], visitors["n"]])
        links, parent = np.zeros(len(reps), np.int64), np.arange(len(reps))
        for q, r in index.links(raw if alone else _vectors(asked["vector"], dims), least):
            if alone:
                once = q < r
                q, r = q[once], r[once]
            q = q + start
            np.add.at(links, q, n[r])
            np.add.at(links, r, n[q])
            _join(parent, q, r)
        some = np.flatnonzero(links)
        root = _roots(parent)[some]
        return pd.DataFrame({"rep": reps[some], "links": links[some], "root": reps[root]})

    return run


def _roots(parent: np.ndarray) -> np.ndarray:
    while True:
        up = parent[parent]
        if np.array_equal(up, parent):
            return parent
        parent = up


def _join(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Joins the components of a[i] and b[i], in place; the smaller root wins."""
    while len(a):
        parent[:] = _roots(parent)
        x, y = parent[a], parent[b]
        apart = x != y
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(parent, np.maximum(x, y), np.minimum(x, y))


def near_vectors(
    vectors: DataFrame,
    least: float = 0.93,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
) -> DataFrame:
    """(key, n_links, component_id, kept) for every row of `vectors`.

    Vectors of one label link if their cosine, in double precision, is at least `least`. Equal
    vectors are one entry that counts as often as it occurs. Centroids and code words are
    fitted on up to SAMPLE entries; every entry is indexed. A label's lists are dealt to blocks of
    about BLOCK entries, a larger list to several; a task meets one block, or one block and
    those vectors of another that need a probe of its lists. Probes and the bound on
    quantisation errors never lose a link, and a link is only given after the exact cosine. Tasks
    return counts and spanning edges, not pairs.

    Null or zero vectors, vectors with null or non-finite parts, and null labels link with
    nothing, nor do vectors of different length: 0 links, a component of their own, kept. Rows
    that repeat a key are one vertex, with the links of each row's own vector; a null key has a null component and is kept.
    Other columns are ignored; an empty table gives no rows.
    """
    rows = stored(
        vectors.select(
            F.col(key).cast("long").alias("id"),
            F.col(label).cast("string").alias("label"),
            F.col(vector).cast("array<double>").alias("vector"),
        ).withColumn(
            "ok", _usable(F.col("vector")) & F.col("label").isNotNull() & F.col("id").isNotNull()
        )
    )
    entries = stored(
        rows.where("ok")
        .groupBy("label", "vector")
        .agg(F.min("id").alias("first"), F.count("*").alias("n"))
        .withColumns({"size": F.size("vector"), "rep": F.monotonically_increasing_id()})
    )
    graph = stored(_entry_links(entries, least))
    # vertices are keys: an entry's least one stands for all that have its vector, and a key with
    # several vectors joins their entries
    ends = entries.select("rep", "first")
    linked = graph.where("rep != root").join(ends.withColumnRenamed("first", "a"), "rep")
    linked = linked.join(ends.select(F.col("rep").alias("root"), F.col("first").alias("b")), "root")
    entry = F.xxhash64("label", "vector")
    several = rows.where("ok").groupBy("id").agg(F.min(entry).alias("x"), F.max(entry).alias("y"))
    several = several.where("x != y").select("id")
    owned = rows.where("ok").join(several, "id", "left_semi").join(entries, ["label", "vector"])
    found = components(linked.select("a", "b").union(owned.select("id", "first")))
    sums = graph.groupBy("rep").agg(F.sum("links").alias("links"))
    known = stored(
        entries.join(sums, "rep", "left")
        .join(found, F.col("first") == F.col("vertex"), "left")
        .select(
            "label",
            "vector",
            (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
            F.coalesce("component", "first").alias("component_id"),
        )
    )
    good = rows.where("ok").join(known, ["label", "vector"]).select("id", "n_links", "component_id")
    rest = rows.where("not ok").select(
        "id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id")
    )
    return good.union(rest).select(
        F.col("id").alias(key),
        "n_links",
        "component_id",
        F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"),
    )


def _entry_links(entries: DataFrame, least: float) -> DataFrame:
    """(rep, links, root) from all tiles."""
    spark = entries.sparkSession
    schema = "rep long, links long, root long"
    dims = entries.agg(F.max("size")).first()[0]
    if dims is None:
        return spark.createDataFrame([], schema)
    m = next(m for m in range(min(SUBSPACES, dims), 0, -1) if dims % m == 0 or m == 1)
    dims = -(-dims // m) * m
    picked = entries.select("vector", F.xxhash64("first", "label").alias("h"), "first")
    picked = picked.orderBy("h", "first").limit(SAMPLE).toPandas()
    sample = _vectors(picked["vector"], dims)
    book = fit(sample / np.sqrt((sample**2).sum(1))[:, None])
    radius = float(np.sqrt(max(0.0, 2 - 2 * least)))
    types = "label string, size int, vector array<double>, rep long, n long, list int, probes array<int>"
    placed = stored(entries.mapInArrow(_placer(book, dims, radius), types))
    # blocks of lists: a running sum over at most LISTS rows of a label
    group = Window.partitionBy("label", "size")
    sizes = placed.groupBy("label", "size", "list").agg(F.count("*").alias("held"))
    before = F.sum("held").over(group.orderBy("list").rowsBetween(Window.unboundedPreceding, -1))
    parts = F.ceil(F.col("held") / BLOCK).cast("int")
    # a list's first block: by the vectors before it, and one more for each list cut into parts
    extra = F.sum(parts).over(group.orderBy("list").rowsBetween(Window.unboundedPreceding, -1))
    many = F.coalesce(extra, F.lit(0)) - F.row_number().over(group.orderBy("list")) + 1
    blocks = sizes.select(
        "label",
        "size",
        "list",
        parts.alias("parts"),
        (F.floor(F.coalesce(before, F.lit(0)) / BLOCK) + many).cast("int").alias("block"),
    )
    # the blocks by list, as an array: null where the label has no vector in a list
    by_list = F.map_from_entries(F.collect_list(F.struct("list", F.struct("block", "parts"))))
    plan = stored(
        blocks.groupBy("label", "size")
        .agg(by_list.alias("map"))
        .select(
            "label", "size",
            F.transform(F.sequence(F.lit(0), F.lit(LISTS - 1)), lambda i: F.col("map")[i]).alias("map"),
        )
    )
    mine = F.get("map", F.col("list"))
    dealt = placed.join(plan, ["label", "size"]).withColumn(
        "block", mine["block"] + F.pmod(F.xxhash64("rep"), mine["parts"]).cast("int")
    )
    # blocks with lists to probe, beyond the vector's own; of two blocks, the higher visits
    reached = F.flatten(
        F.transform(
            F.filter("probes", lambda p: F.get("map", p).isNotNull()),
            lambda p: F.sequence(
                F.get("map", p)["block"], F.get("map", p)["block"] + F.get("map", p)["parts"] - 1
            ),
        )
    )
    dealt = stored(
        dealt.withColumn("visits", F.filter(F.array_distinct(reached), lambda b: b < F.col("block")))
        .drop("map", "probes")
    )
    keys = ["label", "size", "block", "guest"]
    columns = [*keys, "rep", "n", "list", "vector", "member", "own"]
    home = dealt.withColumns({"guest": F.col("block"), "member": F.lit(True), "own": F.lit(True)})
    visits = dealt.select(
        "label", "size", F.explode("visits").alias("to"), F.col("block").alias("guest"),
        "rep", "n", "list", "vector",
    )
    visitors = visits.withColumnRenamed("to", "block").withColumns(
        {"member": F.lit(False), "own": F.lit(False)}
    )
    tiles = visits.select("label", "size", F.col("to").alias("block"), "guest").distinct()
    hosts = dealt.join(tiles, ["label", "size", "block"]).withColumns(
        {"member": F.lit(True), "own": F.lit(False)}
    )
    all_rows = home.select(columns).union(visitors.select(columns)).union(hosts.select(columns))
    return all_rows.groupBy(keys).applyInPandas(_tile(book, dims, least), schema)
