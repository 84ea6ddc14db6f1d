"""Near-duplicate documents by SimHash fingerprints, searched in Gray-ordered hierarchical indexes."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from asthen.llm.common import components, stored

#: Shingles whose bits are counted at a time.
CHUNK = 65_536
#: Fingerprints in a leaf of the index.
LEAF = 16
#: Fingerprints searched for at a time in one index.
BLOCK = 512

_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def fingerprint(text: str, words: int, seed: int = 42) -> int:
    """A bit is 1 if it is set in over half the 64-bit hashes of the word shingles, with repeats."""
    tokens = text.encode().translate(_LOWER).split()
    if not tokens:
        return 0
    last = max(len(tokens) - words + 1, 1)
    digest, join = xxhash.xxh64_intdigest, b" ".join
    ones = np.zeros(64, np.int64)
    for lo in range(0, last, CHUNK):
        hi = min(lo + CHUNK, last)
        if words == 3 and last > 1:
            a, b, c = tokens[lo:hi], tokens[lo + 1 : hi + 1], tokens[lo + 2 : hi + 2]
            hashes = [digest(x + b" " + y + b" " + z, seed) for x, y, z in zip(a, b, c)]
        else:
            hashes = [digest(join(tokens[i : i + words]), seed) for i in range(lo, hi)]
        octets = np.array(hashes, ">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(octets, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > last).tobytes(), "big")


def fingerprints(
    docs: DataFrame, words: int = 3, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id, fp) of whole texts, the fingerprint as a signed 64-bit number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(t.as_py() or "", words) for t in batch.column(1)]
            prints = np.array(prints, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(prints)], names=["doc_id", "fp"]
            )

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "doc_id long, fp long")


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def masks(distance: int, blocks: int = 6) -> list[int]:
    """Bit masks of which one leaves out all bits where two near fingerprints differ.

    The 64 bits are cut into `blocks`; at most `distance` of them can hold a difference, so each
    mask keeps all blocks but `distance`. With 2 of 6 blocks left out, 22 bits are free: no two
    distinct fingerprints that share the 42 kept bits can number more than 2^22.
    """
    edges = [64 * i // blocks for i in range(blocks + 1)]
    parts = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:])]
    return [
        sum(p for i, p in enumerate(parts) if i not in out)
        for out in combinations(range(blocks), distance)
    ]


def gray_rank(fp: Column) -> Column:
    """The place of a bit pattern in Gray order, in which neighbours differ in one bit."""
    for shift in (1, 2, 4, 8, 16, 32):
        fp = fp.bitwiseXOR(F.shiftrightunsigned(fp, shift))
    return fp


class GrayTree:
    """A hierarchical index over fingerprints in Gray order.

    Leaves are runs of LEAF neighbours. The bits on which all fingerprints below a node agree
    are factored out of its children into the node, so a path from the root to a fingerprint
    compares each bit once, and differences add up along it. A search goes down level by level
    for a block of queries and drops every node, with its whole group, whose accumulated
    differences exceed the distance.
    """

    def __init__(self, prints: np.ndarray) -> None:
        self.prints = prints
        n = -(-len(prints) // LEAF)
        padded = np.concatenate([prints, np.repeat(prints[-1:], n * LEAF - len(prints))])
        low = np.bitwise_and.reduce(padded.reshape(n, LEAF), axis=1)
        high = np.bitwise_or.reduce(padded.reshape(n, LEAF), axis=1)
        levels = [(low, high)]
        while len(low) > 1:
            if len(low) % 2:
                low, high = np.append(low, low[-1]), np.append(high, high[-1])
            low, high = low[::2] & low[1::2], high[::2] | high[1::2]
            levels.append((low, high))
        self.levels = []  # from the root: shared bits not shared by the parent, their values
        above = np.zeros(1, np.uint64)
        for low, high in reversed(levels):
            shared = ~(low ^ high)
            upper = above[np.arange(len(low)) // 2] if self.levels else above
            self.levels.append((shared & ~upper, low))
            above = shared
        self.free = ~above  # what is left to compare below each leaf

    def near(self, queries: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query index, fingerprint index) at most `distance` bits apart."""
        query = np.arange(len(queries))
        node = np.zeros(len(queries), np.int64)
        apart = np.zeros(len(queries), np.int64)
        for depth, (mask, value) in enumerate(self.levels):
            if depth:  # both children
                query, apart = np.repeat(query, 2), np.repeat(apart, 2)
                node = np.repeat(node * 2, 2)
                node[1::2] += 1
                real = node < len(mask)
                query, apart, node = query[real], apart[real], node[real]
            apart = apart + np.bitwise_count((queries[query] ^ value[node]) & mask[node])
            keep = apart <= distance
            query, apart, node = query[keep], apart[keep], node[keep]
        query, apart = np.repeat(query, LEAF), np.repeat(apart, LEAF)
        free = np.repeat(self.free[node], LEAF)
        member = (node[:, None] * LEAF + np.arange(LEAF)).ravel()
        real = member < len(self.prints)
        query, apart, free, member = query[real], apart[real], free[real], member[real]
        apart = apart + np.bitwise_count((queries[query] ^ self.prints[member]) & free)
        keep = apart <= distance
        return query[keep], member[keep]


def _links(prints: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Spanning edges (i, j) of the fingerprints' components under the distance."""
    n = len(prints)
    if n == 2:
        return [(0, 1)] if int(prints[0] ^ prints[1]).bit_count() <= distance else []
    parent = list(range(n))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = i = parent[parent[i]]
        return i

    found, tree = [], GrayTree(prints)
    for lo in range(0, n, BLOCK):
        a, b = tree.near(prints[lo : lo + BLOCK], distance)
        a = a + lo
        once = a < b
        for i, j in zip(a[once].tolist(), b[once].tolist()):
            x, y = root(i), root(j)
            if x != y:
                parent[y] = x
                found.append((i, j))
    return found


def _search(distance: int):
    """Edges among the rows of each group; rows come sorted by group and Gray rank."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in _and_end(batches):
            if batch is None:
                rows, done = held, True
            else:
                new = [batch.column(c).to_numpy() for c in ("mask", "shared", "fp", "rep")]
                rows = new if held is None else [np.concatenate(x) for x in zip(held, new)]
                done = False
            if rows is None or not len(rows[0]):
                continue
            mask, shared, fp, rep = rows
            starts = np.flatnonzero(
                np.concatenate([[True], (mask[1:] != mask[:-1]) | (shared[1:] != shared[:-1])])
            )
            ends = np.append(starts[1:], len(mask))
            if not done:  # the last group may go on
                held = [x[starts[-1] :] for x in rows]
                starts, ends = starts[:-1], ends[:-1]
            many = ends - starts > 1
            edges = [
                (rep[s + i], rep[s + j])
                for s, e in zip(starts[many].tolist(), ends[many].tolist())
                for i, j in _links(fp[s:e].view(np.uint64), distance)
            ]
            if edges:
                a, b = np.array(edges, np.int64).T
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return run


def _and_end(batches):
    yield from batches
    yield None


def link_fingerprints(prints: DataFrame, distance: int = 2) -> DataFrame:
    """(fp, component_id) for each distinct fingerprint of (doc_id, fp).

    Equal fingerprints are one entry with its least doc_id. The index is spread out by its upper
    nodes: an entry stands once under every kept-bits pattern (`masks`), and two entries within
    the distance share at least one. Under each pattern, a `GrayTree` over the rest is searched;
    a group there is bounded by the free bits, not by the data. Groups give spanning edges, not
    pairs.
    """
    entries = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("rep")))
    patterns = F.posexplode(F.array(*[F.lit(_signed(m)) for m in masks(distance)]))
    spread = (
        entries.where("rep is not null")
        .select("fp", "rep", patterns.alias("mask", "bits"))
        .select("mask", F.col("fp").bitwiseAND(F.col("bits")).alias("shared"), "fp", "rep")
    )
    edges = (
        spread.repartition("mask", "shared")
        .sortWithinPartitions("mask", "shared", gray_rank(F.col("fp")))
        .mapInArrow(_search(distance), "a long, b long")
    )
    found = components(edges)
    return stored(
        entries.join(found, F.col("rep") == F.col("vertex"), "left").select(
            "fp", F.coalesce("component", "rep").alias("component_id")
        )
    )


def simhash_components(
    docs: DataFrame, words: int = 3, distance: int = 2, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(key, fingerprint, component_id) for every row of `docs`.

    A-Z is lower-cased; words are runs without ASCII white space; each shingle of `words` words
    counts as often as it occurs, a shorter text is one shingle, a text without words (null,
    empty, blank) has fingerprint zero and links like any other. Fingerprints link at `distance`
    or fewer differing bits; component_id is the least key reachable. Every row of a repeated key
    is kept; rows with a null key get the component of their fingerprint, and none if only such
    rows are in it. Columns other than key and text are ignored; an empty table gives no rows.
    """
    prints = stored(fingerprints(docs, words, key, text))
    groups = link_fingerprints(prints, distance)
    return prints.join(groups, "fp", "left").select(
        F.col("doc_id").alias(key),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def one_of_each(
    docs: DataFrame, words: int = 3, distance: int = 2, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The rows of `docs`, whole, with one row for each group of near duplicates: that of the least
    key, then of the least fingerprint. Groups are of fingerprints, so different texts under one
    key are apart; of rows that share key and fingerprint one stays. Rows with a null key can't be
    told apart and all stay."""
    number = F.col(key).cast("long")
    named = docs.where(number.isNotNull())
    prints = stored(fingerprints(named, words, key, text))
    distinct = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("doc_id")))
    groups = link_fingerprints(distinct.select(F.col("fp").alias("doc_id"), "fp"), distance)
    kept = distinct.join(groups, "fp").groupBy("component_id")
    kept = kept.agg(F.min(F.struct("doc_id", "fp")).alias("least")).select("least.*")
    counts = prints.groupBy("doc_id").agg(F.count("*").alias("n"))
    kept = stored(kept.join(counts, "doc_id").withColumnsRenamed({"doc_id": "_key", "fp": "_fp"}))
    rows, unkeyed = named.withColumn("_key", number), docs.where(number.isNull())
    if kept.where("n > 1").isEmpty():  # the texts move once, and no fingerprint is made again
        return rows.join(kept, "_key", "left_semi").select(docs.columns).union(unkeyed)

    @F.arrow_udf("long")
    def print_of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            found = [fingerprint(t.as_py() or "", words) for t in texts]
            yield pa.array(np.array(found, np.uint64).view(np.int64))

    # rows of repeated keys are told apart by their fingerprints; written before anything filters
    # these, so they are made once
    keys = kept.groupBy("_key").agg((F.max("n") > 1).alias("_again"))
    marked = stored(rows.join(keys, "_key"))
    again = stored(marked.where("_again").withColumn("_fp", print_of(F.col(text))))
    again = again.join(kept, ["_key", "_fp"], "left_semi").dropDuplicates(["_key", "_fp"])
    single = marked.where("not _again").select(docs.columns)
    return single.union(again.select(docs.columns)).union(unkeyed)
