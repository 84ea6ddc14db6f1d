"""Toxicity: character n-grams scaled by naive Bayes log-count ratios, under a logistic model."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from asthen.llm.common import stored

#: Features: n-grams of these lengths, in bytes. They are first counted by 2^BITS hash places; the
#: ones kept go by their whole 64-bit keys, which differ for any two n-grams.
LENGTHS = (3, 4, 5, 6)
BITS = 20
#: Labelled rows the model is fitted on, at most; the ones with the least hashes of their ids.
MAX_LABELLED = 24_576
#: Features kept for the linear model: those that tell the classes apart best.
FEATURES = 8_192
#: Bytes of text whose n-grams are held at a time.
CHUNK = 1 << 20
#: Kept features whose sums are held at a time while fitting.
BLOCK = 1 << 20

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_FOLD[:33] = 32
_MIX = np.uint64(0x9E3779B97F4A7C15)


def held_out(key: Column) -> Column:
    """Rows that labels are never learned from."""
    return F.coalesce(F.crc32(F.encode(key.cast("string"), "utf-8")) % 5 == 0, F.lit(False))


def _keys(text: str | None) -> Iterator[np.ndarray]:
    """The 64-bit keys of all n-grams of a text, in turn; the upper BITS of a key are its place.

    A-Z is lower-cased, control characters are blanks, and a blank stands at either end. Long
    texts are read in overlapping chunks; nothing is cut off. No folded byte is zero, so n-grams
    of different lengths are different numbers, and multiplying by an odd one keeps them apart.
    """
    data = np.frombuffer((" " + (text or "") + " ").encode(), np.uint8)
    width = max(LENGTHS)
    for lo in range(0, max(len(data) - 2, 1), CHUNK):
        part = _FOLD[data[lo : lo + CHUNK + width - 1]].astype(np.uint64)
        gram = part
        for n in range(2, width + 1):
            if len(part) < n:
                break
            gram = (gram[:-1] << np.uint64(8)) | part[n - 1 :]
            if n in LENGTHS:
                yield (gram + np.uint64(n)) * _MIX


def _place(keys: np.ndarray) -> np.ndarray:
    return (keys >> np.uint64(64 - BITS)).astype(np.int64)


def places(text: str | None, found: np.ndarray) -> np.ndarray:
    """The places of all n-grams of a text, each once, ascending. `found` is scratch, all False."""
    for keys in _keys(text):
        found[_place(keys)] = True
    out = np.flatnonzero(found)
    found[out] = False
    return out


class Features:
    """A set of n-grams, by ascending key. Places only rule n-grams out; whole keys decide, so no
    other n-gram counts as a feature however long a text is."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        place = _place(keys)
        self.slot = np.full(1 << BITS, -1, np.int32)
        self.slot[place[::-1]] = np.arange(len(keys), dtype=np.int32)[::-1]  # the first at a place
        self.most = int(np.unique(place, return_counts=True)[1].max(initial=0))
        self.found = np.zeros(len(keys), bool)

    def of(self, text: str | None) -> np.ndarray:
        """The numbers of the features in a text, each once, ascending."""
        for keys in _keys(text):
            at = self.slot[_place(keys)]
            some = np.flatnonzero(at >= 0)
            at, keys = at[some], keys[some]
            for _ in range(self.most):
                hit = self.keys[at] == keys
                self.found[at[hit]] = True
                rest = ~hit & (at + 1 < len(self.keys))
                at, keys = at[rest] + 1, keys[rest]
        out = np.flatnonzero(self.found)
        self.found[out] = False
        return out


def _texts(batch: pa.RecordBatch) -> Iterator[str | None]:
    return (x.as_py() for x in batch.column("text"))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with each n-gram by class, summed over the task."""
    found, seen = np.zeros(1 << BITS, bool), np.zeros((2, 1 << BITS), np.int64)
    rows = np.zeros(2, np.int64)
    for batch in batches:
        for label, text in zip(batch.column("label").to_pylist(), _texts(batch)):
            seen[label, places(text, found)] += 1
            rows[label] += 1
    some = np.flatnonzero(seen.any(axis=0))
    place = np.append(some, -1)  # the number of rows goes by the place -1
    yield pa.RecordBatch.from_arrays(
        [pa.array(place), *(pa.array(np.append(seen[c][some], rows[c])) for c in (0, 1))],
        names=["place", "clean", "toxic"],
    )


def _count_keys(place: np.ndarray):
    """Rows with each n-gram at the given places by class, summed over the batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = np.zeros(1 << BITS, bool)
        wanted[place] = True
        for batch in batches:
            got: list[list[np.ndarray]] = [[np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]]
            for label, text in zip(batch.column("label").to_pylist(), _texts(batch)):
                own = [np.unique(keys[wanted[_place(keys)]]) for keys in _keys(text)]
                got[label].append(np.unique(np.concatenate(own)) if own else got[0][0])
            for label, lists in enumerate(got):
                keys, n = np.unique(np.concatenate(lists), return_counts=True)
                none = np.zeros(len(n), np.int64)
                counts = (none, n) if label else (n, none)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.view(np.int64)), *(pa.array(c) for c in counts)],
                    names=["key", "clean", "toxic"],
                )

    return run


@dataclass
class Model:
    """The keys of the features, ascending, and their weights."""

    keys: np.ndarray
    weights: np.ndarray
    bias: float

    def score(self, text: str | None, features: Features) -> float:
        z = self.bias + self.weights[features.of(text)].sum()
        return float(1 / (1 + np.exp(-np.clip(z, -500, 500))))


def labelled_rows(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str) -> DataFrame:
    """(text, label, order) of at most MAX_LABELLED labelled rows outside the held-out part.

    A key labelled both ways is left out. The labels picked are bounded, so they are sent to the
    documents, and the texts do not move.
    """
    picked = (
        labels.where(F.col(label).isin(0, 1) & ~held_out(F.col(key)) & F.col(key).isNotNull())
        .groupBy(F.col(key).cast("long").alias("id"))
        .agg(F.min(label).cast("int").alias("label"), F.max(label).cast("int").alias("most"))
        .where("label = most")
        .select("id", "label", F.xxhash64("id").alias("order"))
        .orderBy("order", "id")
        .limit(MAX_LABELLED)
    )
    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    return rows.join(F.broadcast(picked), "id").select("text", "label", "order")


def _best(seen, totals) -> tuple[np.ndarray, np.ndarray]:
    """(rows of `seen` that tell the classes apart best, log-count ratios of all)."""
    clean, toxic = (seen[c].to_numpy(np.float64) for c in ("clean", "toxic"))
    p = (toxic + 1) / (totals["toxic"] + 2)
    q = (clean + 1) / (totals["clean"] + 2)
    # how far the shares of rows with the feature lie apart, in standard errors
    share = (toxic + clean + 1) / (totals.sum() + 2)
    spread = np.sqrt(share * (1 - share) * (1 / totals["toxic"] + 1 / totals["clean"]))
    return np.sort(np.argsort(-np.abs(p - q) / spread, kind="stable")[:FEATURES]), np.log(p / q)


def fit(rows: DataFrame, steps: int = 300, rate: float = 0.05, decay: float = 1e-4) -> Model:
    """A model from (text, label, order); without both classes, a constant one.

    The places that tell the classes apart best are found first, then the n-grams at these are
    counted by class. The counts give each feature its log-count ratio r; presence of a
    feature counts as r, and a logistic regression (Adam over all rows at once, in a fixed order)
    weighs these. The driver holds the counts of 2^BITS places and the kept features of
    MAX_LABELLED rows.
    """
    seen = rows.mapInArrow(_count, "place long, clean long, toxic long").groupBy("place")
    seen = seen.agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    # places seen in two rows or less tell nothing
    seen = seen.where("place < 0 or clean + toxic > 2").toPandas().sort_values("place")
    totals = seen[seen["place"] < 0][["clean", "toxic"]].sum()
    if not totals["clean"] or not totals["toxic"]:
        p = (totals["toxic"] + 0.01) / (totals.sum() + 1)  # nothing is toxic without a label
        return Model(np.zeros(0, np.uint64), np.zeros(0), float(np.log(p / (1 - p))))
    seen = seen[seen["place"] >= 0]
    place = seen["place"].to_numpy()[_best(seen, totals)[0]]
    seen = rows.mapInArrow(_count_keys(place), "key long, clean long, toxic long").groupBy("key")
    seen = seen.agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    seen = seen.where("clean + toxic > 2").toPandas()
    seen["key"] = seen["key"].to_numpy().view(np.uint64)
    seen = seen.sort_values("key")
    best, ratio = _best(seen, totals)
    keys, ratio = seen["key"].to_numpy()[best], ratio[best]
    index, offsets, y = _design(rows, keys)
    w, b = np.zeros(len(keys)), 0.0
    m, v = np.zeros(len(keys) + 1), np.zeros(len(keys) + 1)
    blocks, lo = [], 0
    while lo < len(y):  # whole rows with about BLOCK kept features together
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + BLOCK, side="right")) - 1)
        blocks.append((lo, min(hi, len(y))))
        lo = blocks[-1][1]
    for step in range(1, steps + 1):
        grad, bias, scaled = np.zeros(len(keys)), 0.0, w * ratio
        for lo, hi in blocks:
            part = index[offsets[lo] : offsets[hi]]
            sizes = np.diff(offsets[lo : hi + 1])
            sums = np.append(0.0, np.cumsum(scaled[part]))
            z = sums[offsets[lo + 1 : hi + 1] - offsets[lo]] - sums[offsets[lo:hi] - offsets[lo]] + b
            error = 1 / (1 + np.exp(-np.clip(z, -500, 500))) - y[lo:hi]
            grad += np.bincount(part, np.repeat(error, sizes), len(keys))
            bias += error.sum()
        grad = np.append(grad * ratio / len(y) + decay * w, bias / len(y))
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        move = rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
    return Model(keys, w * ratio, float(b))


def _design(rows: DataFrame, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The features of each row, as numbers in `keys`, rows in a fixed order."""
    shared = rows.sparkSession.sparkContext.broadcast(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features(shared.value)
        for batch in batches:
            kept = [features.of(t).astype(np.int32).tobytes() for t in _texts(batch)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("order"), batch.column("label"), pa.array(kept, pa.binary())],
                names=["order", "label", "kept"],
            )

    got = rows.mapInArrow(run, "order long, label int, kept binary").toPandas()
    got = got.sort_values(["order", "label", "kept"])
    lists = [np.frombuffer(x, np.int32) for x in got["kept"]]
    offsets = np.cumsum([0, *map(len, lists)])
    index = np.concatenate(lists) if lists else np.zeros(0, np.int32)
    return index, offsets, got["label"].to_numpy(np.float64)


def scorer(docs: DataFrame, model: Model):
    """A column function that scores every whole text; the model is broadcast."""
    shared = docs.sparkSession.sparkContext.broadcast((model.keys, model.weights, model.bias))

    @F.arrow_udf("double")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        mine = Model(*shared.value)
        features = Features(mine.keys)
        for texts in batches:
            yield pa.array([mine.score(t.as_py(), features) for t in texts], pa.float64())

    return run


def learn(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic"
) -> Model:
    """The model that the labels outside the held-out part give."""
    return fit(stored(labelled_rows(docs, labels, key, text, label)))


def toxicity(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
) -> DataFrame:
    """(key, held_out, score, predicted) for every row of `docs`.

    Labels are learned from rows whose crc32 of the key, as text, is not divisible by 5; keys
    with two different labels, null keys and labels other than 0 and 1 teach nothing. Only the
    text enters a score; a null text is empty and scored like one. Repeated rows are scored
    alike and all returned. With no labels, or of one class only, all scores are the share of toxic ones,
    0.01 without any.
    Columns other than those named are ignored; an empty table gives no rows.
    """
    model = learn(docs, labels, key, text, label)
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    scored = rows.select("key", scorer(docs, model)("text").alias("score"))
    return scored.select(
        F.col("key").alias(key),
        held_out(F.col("key")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def without_toxic(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
) -> DataFrame:
    """The rows of `docs`, whole, whose text scores under 0.5."""
    model = learn(docs, labels, key, text, label)
    return docs.where(scorer(docs, model)(F.col(text)) < 0.5)
