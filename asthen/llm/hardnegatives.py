"""Hard negatives by exact integer scores, computed with Four-Russians subset-sum tables."""

from __future__ import annotations

from collections.abc import Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from asthen.llm.common import stored

#: Candidates in a cell of the search, on average, at most (also anchors) and at least (where there
#: are slots to fill); a task holds one cell at a time.
CELL_ROWS, SMALL_CELL = 131_072, 8_192
#: Anchors whose tables are held together, and candidates scored against them at a time.
ANCHORS, BLOCK = 128, 4_096

_LEAST, _MOST = -(1 << 63), (1 << 63) - 1


# --- scores --------------------------------------------------------------------


class SubsetSums:
    """For each group of eight dimensions, the sums of a block of anchors over all 256 subsets."""

    def __init__(self, anchors: np.ndarray) -> None:
        count, self.dims = anchors.shape
        self.groups = -(-self.dims // 8)
        padded = np.zeros((count, self.groups * 8), np.int64)
        padded[:, : self.dims] = anchors
        byte = padded.reshape(count, self.groups, 8).transpose(1, 2, 0)
        tables = np.zeros((self.groups, 256, count), np.int64)
        for j in range(8):
            tables[:, 1 << j : 2 << j] = tables[:, : 1 << j] + byte[:, j : j + 1]
        self.tables = tables
        self.reach = float(np.abs(anchors.astype(np.float64)).sum(axis=1).max(initial=0))
        small = self.reach < 1 << 30
        self.narrow = tables.astype(np.int32) if small else None

    def scores(self, planes: np.ndarray) -> np.ndarray:
        """(candidates, anchors): inner products with candidates given by their bit planes.

        A plane's byte for a group picks the sum of the dimensions whose bit is set; planes are
        added from the highest, which counts negative, down, doubling in between. Numbers
        wrap at 64 bits; 32 are used where no score can need more.
        """
        bits, _, count = planes.shape
        fits = self.narrow is not None and self.reach * 2.0**bits < 2.0**31
        tables = self.narrow if fits else self.tables
        out = np.zeros((count, tables.shape[2]), tables.dtype)
        looked_up = np.empty_like(out)
        for bit in range(bits - 1, -1, -1):
            out += out
            for group in range(self.groups):
                np.take(tables[group], planes[bit, group], axis=0, out=looked_up)
                if bit == bits - 1:
                    out -= looked_up
                else:
                    out += looked_up
        return out


def bit_planes(vectors: np.ndarray) -> np.ndarray:
    """(bit, group of eight dimensions, vector): the vectors' two's complement, a byte a group."""
    low, high = int(vectors.min(initial=0)), int(vectors.max(initial=0))
    bits = max((~low).bit_length(), high.bit_length()) + 1
    count, dims = vectors.shape
    out = np.zeros((bits, -(-dims // 8), count), np.uint8)
    for bit in range(bits):
        ones = ((vectors >> bit) & 1).astype(np.uint8)
        out[bit] = np.packbits(ones, axis=1, bitorder="little").T
    return out


class Best:
    """The `count` best (score, place) of each slot: higher scores first, then lower places."""

    def __init__(self, low: np.ndarray, count: int) -> None:
        self.count = count
        self.full = np.zeros(len(low), bool)
        self.low = low.copy()  # the least score that enters
        self.slot = self.score = self.place = np.zeros(0, np.int64)

    def add(self, slot: np.ndarray, score: np.ndarray, place: np.ndarray) -> None:
        """Places rise from call to call, so a full slot is entered by a higher score only."""
        if not len(slot):
            return
        slot = np.concatenate([self.slot, slot])
        score = np.concatenate([self.score, score])
        place = np.concatenate([self.place, place])
        order = np.lexsort((place, ~score, slot))
        slot = slot[order]
        first = np.flatnonzero(np.diff(slot, prepend=-1))
        rank = np.arange(len(slot)) - np.repeat(first, np.diff(first, append=len(slot)))
        keep = rank < self.count
        self.slot, order = slot[keep], order[keep]
        self.score, self.place = score[order], place[order]
        last = rank[keep] == self.count - 1
        self.full[self.slot[last]] = True
        self.low[self.slot[last]] = self.score[last]

    def enters(self, score: np.ndarray, slots: np.ndarray) -> np.ndarray:
        """Where a (candidates, anchors) matrix of scores enters the anchors' slots."""
        low, full = self.low[slots], self.full[slots]
        bar = np.where(full & (low < _MOST), low + 1, low)
        return (score >= bar) & ~(full & (low == _MOST))


# --- cells ---------------------------------------------------------------------


def _matrix(packed: pa.ChunkedArray, dims: int, rows: np.ndarray) -> np.ndarray:
    """Vectors of `dims` numbers each, of one to eight bytes a number."""
    out = np.zeros((len(rows), dims), np.int64)
    if dims:
        for i, cell in enumerate(packed.take(pa.array(rows)).to_pylist()):
            out[i] = np.frombuffer(cell, f"<i{len(cell) // dims}")
    return out


def _search(count: int, same: bool):
    """Per slot of each anchor of a cell, the best `count` candidates of the cell, of its label if
    `same`, else of others, with scores from the slot's low to its high."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        parts: list[list[np.ndarray]] = [[] for _ in range(4)]
        if left.num_rows and right.num_rows:
            # candidates by key, null last: the order in which ties are settled
            right = right.sort_by([("key", "ascending"), ("row", "ascending")])
            a_dims, c_dims = (t["dims"].to_numpy() for t in (left, right))
            for dims in np.unique(a_dims):
                c_rows = np.flatnonzero(c_dims == dims)
                if not len(c_rows):
                    continue
                a_rows = np.flatnonzero(a_dims == dims)
                for part in _of_length(left, right, int(dims), a_rows, c_rows, count, same):
                    for all_, one in zip(parts, part):
                        all_.append(one)
        joined = [np.concatenate(p) if p else np.zeros(0, np.int64) for p in parts]
        anchor, slot, place, score = joined
        picked = right.take(pa.array(place))
        columns = [pa.array(anchor), pa.array(slot.astype(np.int32)), picked["row"], picked["key"]]
        return pa.table([*columns, pa.array(score)], names=["anchor", "slot", "row", "key", "score"])

    return run


def _of_length(left, right, dims, a_rows, c_rows, count, same) -> Iterator[tuple[np.ndarray, ...]]:
    """(anchor, slot, place, score) of anchors and candidates of one length, a block at a time."""
    label, own = (right[c].to_numpy()[c_rows] for c in ("label", "row"))
    vectors = _matrix(right["vector"], dims, c_rows)
    a_label, a_row = (left[c].to_numpy()[a_rows] for c in ("label", "row"))
    order = np.argsort(a_label, kind="stable")
    a_rows, a_label, a_row = a_rows[order], a_label[order], a_row[order]
    by_label = np.argsort(label, kind="stable")  # within a label by place
    cuts = np.flatnonzero(np.diff(a_label)) + 1 if same else np.zeros(0, int)
    planes: dict[int, np.ndarray] = {}
    for group in np.split(np.arange(len(a_rows)), cuts):
        places = np.arange(len(label))
        if same:
            lo, hi = (np.searchsorted(label[by_label], a_label[group[0]], s) for s in ("left", "right"))
            places = by_label[lo:hi]
        for lo in range(0, len(group), ANCHORS):
            at = group[lo : lo + ANCHORS]
            low, high = (
                np.array(left[c].take(pa.array(a_rows[at])).to_pylist(), np.int64)
                for c in ("low", "high")
            )
            slots = low.shape[1]
            best, tables = Best(low.ravel(), count), SubsetSums(_matrix(left["vector"], dims, a_rows[at]))
            edges = [0, *range(256, len(places), BLOCK), len(places)]  # a short block sets the bars
            for start, end in zip(edges, edges[1:]):
                some = places[start:end]
                if same:
                    own_planes = bit_planes(vectors[some])
                else:  # blocks are the same for all anchors of the cell
                    if start not in planes:
                        planes[start] = bit_planes(vectors[some])
                    own_planes = planes[start]
                score = tables.scores(own_planes)
                if same:
                    allowed = own[some][:, None] != a_row[at][None, :]
                else:
                    allowed = label[some][:, None] != a_label[at][None, :]
                for slot in range(slots):
                    of = np.arange(len(at)) * slots + slot
                    hit = allowed & (score <= high[:, slot]) & best.enters(score, of)
                    c, a = np.nonzero(hit)
                    best.add(of[a], score[c, a].astype(np.int64), some[c])
            anchor = a_row[at][best.slot // slots]
            yield anchor, best.slot % slots, c_rows[best.place], best.score


# --- jobs ----------------------------------------------------------------------


@F.arrow_udf(T.BinaryType())
def _packed(scaled: pa.Array) -> pa.Array:
    """Vectors of longs as bytes, in the least width that holds a vector."""
    flat = scaled.flatten().to_numpy(zero_copy_only=False)
    ends = np.cumsum(pc.list_value_length(scaled).to_numpy(zero_copy_only=False))
    out = []
    for lo, hi in zip([0, *ends[:-1]], ends):
        one = flat[lo:hi]
        bits = max(int(~one.min(initial=0)).bit_length(), int(one.max(initial=0)).bit_length()) + 1
        width = next(w for w in (1, 2, 4, 8) if bits <= 8 * w)
        out.append(one.astype(f"<i{width}").tobytes())
    return pa.array(out, pa.binary())


def usable_rows(vectors: DataFrame, key: str, label: str, vector: str, scale: int) -> DataFrame:
    """(row, key, label, dims, vector) of rows that take part, each distinct one once."""
    infinite = F.lit(float("inf"))
    x = F.col(vector)
    ok = x.isNotNull() & F.col(label).isNotNull()
    ok &= F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != infinite))
    scaled = F.transform(x, lambda v: F.floor(v.cast("double") * F.lit(float(scale))))
    rows = vectors.where(ok).select(
        F.col(key).cast("long").alias("key"),
        F.col(label).cast("long").alias("label"),
        F.size(x).alias("dims"),
        _packed(scaled).alias("vector"),
    )
    return stored(rows.distinct().withColumn("row", F.monotonically_increasing_id()))


def _top(found: DataFrame, count: int) -> DataFrame:
    """The best rows of each anchor's slot, numbered; tasks send no more than `count` of each."""
    order = Window.partitionBy("anchor", "slot").orderBy(
        F.desc("score"), F.asc_nulls_last("key"), F.asc("row")
    )
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= count)


def _scan(anchors: DataFrame, rows: DataFrame, cells: int, slices: int, count: int, same: bool, part) -> DataFrame:
    """Search a part of the cells; each pair of an anchor slice and a cell is one group."""
    tasks = cells * slices
    wanted = part(F.col("cell"))
    a = (
        anchors.withColumn("slice", F.pmod(F.xxhash64("row", F.lit(5)), F.lit(slices)))
        .withColumn("cell", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(cells - 1).cast("long"))))
        .where(wanted)
        .repartition(tasks, "cell", "slice")
    )
    c = (
        rows.withColumn("cell", F.pmod(F.xxhash64("row"), F.lit(cells)))
        .where(wanted)
        .withColumn("slice", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(slices - 1).cast("long"))))
        .repartition(tasks, "cell", "slice")
    )
    groups = a.groupBy("cell", "slice").cogroup(c.groupBy("cell", "slice"))
    return groups.applyInArrow(
        _search(count, same), "anchor long, slot int, row long, key long, score long"
    )


def best_scored(anchors: DataFrame, rows: DataFrame, count: int, same: bool) -> DataFrame:
    """(anchor, slot, row, key, score, rank): the `count` best rows of each slot of the anchors.

    Every anchor meets every row, in cells of at most about CELL_ROWS rows by as many anchors. The square
    root of the cells goes first; a slot it fills starts the others at its last
    score, so that these send on only rows which beat that.
    """
    total, queries = rows.count(), anchors.count()
    wished = 2 * rows.sparkSession.sparkContext.defaultParallelism
    cells = max(1, -(-total // CELL_ROWS), min(wished, -(-total // SMALL_CELL)))
    slices, step = max(1, -(-queries // CELL_ROWS)), isqrt(cells - 1) + 1
    first = stored(
        _top(_scan(anchors, rows, cells, slices, count, same, lambda c: c % step == 0), count)
    )
    bars = first.where(F.col("rank") == count).groupBy(F.col("anchor").alias("row"))
    bars = bars.agg(F.map_from_entries(F.collect_list(F.struct("slot", "score"))).alias("bars"))
    raised = F.transform("low", lambda x, i: F.greatest(x, F.try_element_at("bars", i)))
    raised = F.when(F.col("bars").isNull(), F.col("low")).otherwise(raised)
    barred = stored(anchors.join(bars, "row", "left").withColumn("low", raised).drop("bars"))
    rest = _scan(barred, rows, cells, slices, count, same, lambda c: c % step != 0)
    return _top(first.drop("rank").union(rest), count)


def hard_negatives(
    vectors: DataFrame,
    anchors: Column,
    key: str = "vec_id",
    label: str = "label",
    vector: str = "embedding",
    scale: int = 256,
    positives: int = 5,
    negatives: int = 10,
    least: int = 30,
    most: int = 90,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Components become floor(scale * x); a score is the inner product of two such vectors of
    one length, in 64 bits. Anchors are the rows where `anchors`, a condition on the key, holds. An
    anchor's positives are its best other rows of the same label; for each, its best rows
    of other labels follow whose score is `least` to `most` percent of the positive's, ranked.
    Higher scores come first, ties by smaller key, null keys last.

    Rows with a null label or vector, or a null or non-finite component, take no part. Rows equal
    in key, label and vector count once; rows that share only the key are each a row (and
    anchors) of their own. Labels are whole numbers. An anchor without positives, and a positive
    without negatives in reach, give no row. Other columns are ignored; an empty table gives no
    rows.
    """
    rows = usable_rows(vectors, key, label, vector, scale)
    asked = rows.withColumnRenamed("key", key).where(anchors).withColumnRenamed(key, "key")
    asked = stored(asked)
    whole = {"low": F.array(F.lit(_LEAST)), "high": F.array(F.lit(_MOST))}
    chosen = best_scored(asked.withColumns(whole), rows, positives, True)
    chosen = chosen.groupBy(F.col("anchor").alias("row")).agg(
        F.sort_array(F.collect_list(F.struct("rank", F.col("key").alias("id"), "score"))).alias("found")
    )
    # percent * score / 100, rounded up or down, without leaving 64 bits
    hundreds, rest = "(x.score - pmod(x.score, 100)) div 100", "pmod(x.score, 100)"

    def share(percent: int, rounding: str) -> Column:
        part = f"cast({rounding}({rest} * {percent} / 100) as bigint)"
        return F.expr(f"transform(found, x -> {hundreds} * {percent} + {part})")

    bounded = stored(
        asked.join(chosen, "row")
        .withColumns({"low": share(least, "ceil"), "high": share(most, "floor")})
    )
    slots = F.expr(f"array_repeat({_MOST}L, {positives} - size(found))")
    none = F.expr(f"array_repeat({_LEAST}L + 1, {positives} - size(found))")
    search = bounded.select(
        "row", "key", "label", "dims", "vector",
        F.concat("low", slots).alias("low"), F.concat("high", none).alias("high"),
    )
    found = best_scored(search, rows, negatives, False).withColumnsRenamed(
        {"row": "_row", "key": "negative_id", "score": "negative_score"}
    )
    named = bounded.select(F.col("row").alias("anchor"), F.col("key").alias("anchor_id"), "found")
    positive = F.element_at("found", F.col("slot") + 1)
    return found.join(named, "anchor").select(
        "anchor_id",
        positive["id"].alias("positive_id"),
        "rank",
        "negative_id",
        positive["score"].alias("positive_score"),
        "negative_score",
    )
