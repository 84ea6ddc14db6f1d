"""Quality: naive Bayes support vectors. N-gram indicators, scaled by class log-count ratios, under a
linear hinge-loss model fitted by dual coordinate descent."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from asthen.llm.common import stored

#: Labelled rows the model is fitted on, at most; the ones with the least hashes of their ids.
MAX_LABELLED = 12_288
#: One labelled row of this many is kept from the fit, to turn margins into probabilities.
CALIBRATION = 4
#: N-grams kept: those whose share of rows differs most between the classes, in standard errors.
FEATURES = 4_096
#: Labelled rows that an n-gram must be in.
LEAST_ROWS = 5
#: Lengths of the character n-grams, in UTF-8 bytes; words and word pairs are features besides.
LENGTHS = (1, 2, 3, 4)
#: Lengths of n-grams of one repeated word, whichever it is, that are features as well.
REPEATS = (2, 3, 4, 6, 10)
#: Bytes of text whose n-grams are held at a time.
CHUNK = 1 << 20
#: Upper bits of a key that rule most n-grams out before whole keys are compared.
PREFIX = 17

_SPACE = np.zeros(256, bool)
_SPACE[:33] = True
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2^64
_INVERSE = pow(_BASE, -1, 1 << 64)
_MIX = np.uint64(0xD6E8FEB86659FD93)


def held_out(key: Column) -> Column:
    """Rows that labels are never learned from."""
    return F.coalesce(F.crc32(F.encode(key.cast("string"), "utf-8")) % 5 == 0, F.lit(False))


def _mixed(keys: np.ndarray) -> np.ndarray:
    keys = (keys ^ (keys >> np.uint64(32))) * _MIX
    return keys ^ (keys >> np.uint64(29))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class Grams:
    """The 64-bit keys of a text's n-grams: of bytes, of words, of pairs of words, and of
    repetitions of any word.

    Case counts, as it tells of quality; control characters are blanks. A word's key is a
    polynomial in its bytes, taken from prefix sums, so no word is handled by itself.
    """

    def __init__(self) -> None:
        self.up = self.down = np.zeros(0, np.uint64)

    def _reach(self, n: int) -> None:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up), 4096)
            self.up, self.down = _powers(_BASE, size), _powers(_INVERSE, size)

    def of(self, text: str | None) -> Iterator[np.ndarray]:
        """All keys, in turn, with repeats. Long texts are read in chunks of whole words that overlap
        by one word with its blanks; only a word longer than a chunk is cut."""
        data = np.frombuffer((" " + (text or "") + " ").encode(), np.uint8)
        lo = 0
        while True:
            part = data[lo : lo + CHUNK]
            if lo + CHUNK >= len(data):
                yield from self._chunk(part)
                return
            blank = _SPACE[part]
            end = len(part) - int(np.argmax(blank[::-1])) if blank.any() else 0  # after the last blank
            words = np.flatnonzero(~blank[1:end] & blank[: end - 1]) if end else []  # blanks before words
            if len(words) and words[-1]:
                yield from self._chunk(part[:end])
                lo += int(words[-1])
            else:
                yield from self._chunk(part)
                lo += CHUNK - max(LENGTHS)

    def _chunk(self, part: np.ndarray) -> Iterator[np.ndarray]:
        blank = _SPACE[part]
        wide = np.where(blank, np.uint8(32), part).astype(np.uint64)
        gram = wide
        for n in range(1, max(LENGTHS) + 1):
            if n > 1:
                gram = (gram[:-1] << np.uint64(8)) | wide[n - 1 :]
            if n in LENGTHS:
                yield _mixed(gram + np.uint64(n << 40))
        turns = np.flatnonzero(np.diff(blank, prepend=True, append=True))
        starts, ends = turns[::2], turns[1::2]
        if not len(starts):
            return
        self._reach(len(part) + 1)
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(wide * self.up[: len(part)], out=sums[1:])
        words = _mixed((sums[ends] - sums[starts]) * self.down[starts])
        yield words
        if len(words) > 1:
            yield _mixed(words[:-1] * np.uint64(3) + words[1:])
        yield self._repeats(words)

    def _repeats(self, words: np.ndarray) -> np.ndarray:
        """The key of each length in REPEATS that some word's unbroken repetition reaches."""
        change = np.flatnonzero(np.diff(words)) + 1
        longest = np.diff(change, prepend=0, append=len(words)).max()
        return np.array([n for n in REPEATS if n <= longest], np.uint64)

    def distinct(self, text: str | None) -> np.ndarray:
        return np.unique(np.concatenate([np.unique(k) for k in self.of(text)]))


class Features(Grams):
    """A set of n-grams by ascending key."""

    def __init__(self, keys: np.ndarray) -> None:
        super().__init__()
        self.keys = keys
        self.some = np.zeros(1 << PREFIX, bool)
        self.some[keys >> np.uint64(64 - PREFIX)] = True

    def present(self, text: str | None) -> np.ndarray:
        """The numbers of the features in a text, each once, ascending."""
        if not len(self.keys):
            return np.zeros(0, np.int64)
        found = np.zeros(len(self.keys), bool)
        for keys in self.of(text):
            keys = keys[self.some[keys >> np.uint64(64 - PREFIX)]]
            at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            found[at[self.keys[at] == keys]] = True
        return np.flatnonzero(found)


def labelled_rows(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str) -> DataFrame:
    """(text, label, order) of at most MAX_LABELLED labelled rows outside the held-out part.

    A key labelled both ways is left out. The labels picked are bounded, so they are sent to the
    documents, and only texts picked go on.
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


def _fits(order: Column) -> Column:
    return F.pmod(F.xxhash64(order, F.lit(1)), F.lit(CALIBRATION)) != 0


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with each n-gram by class, summed over the batch."""
    grams = Grams()
    for batch in batches:
        got: tuple[list, list] = ([], [])
        for label, text in zip(batch.column("label").to_pylist(), batch.column("text")):
            got[label].append(grams.distinct(text.as_py()))
        for label in (0, 1):
            if got[label]:
                keys, n = np.unique(np.concatenate(got[label]), return_counts=True)
                counts = [pa.array(np.zeros(len(n), np.int64)), pa.array(n)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.view(np.int64)), *(counts if label else counts[::-1])],
                    names=["key", "low", "high"],
                )


def ratios(rows: DataFrame, low: int, high: int) -> DataFrame:
    """(key, ratio) of the FEATURES n-grams that tell the classes apart best; `low` and `high` are
    the rows of each class. The counts stay in Spark; ties go by key."""
    seen = rows.mapInArrow(_count, "key long, low long, high long").groupBy("key")
    seen = seen.agg(F.sum("low").alias("low"), F.sum("high").alias("high"))
    p, q = (F.col("high") + 1) / (high + 2), (F.col("low") + 1) / (low + 2)
    share = (F.col("low") + F.col("high") + 1) / (low + high + 2)
    spread = F.sqrt(share * (1 - share) * (1 / high + 1 / low))
    kept = seen.where(F.col("low") + F.col("high") >= LEAST_ROWS)
    kept = kept.select("key", F.log(p / q).alias("ratio"), (F.abs(p - q) / spread).alias("apart"))
    return kept.orderBy(F.desc("apart"), "key").limit(FEATURES).select("key", "ratio")


def dual_coordinate_descent(
    rows: list[np.ndarray],
    values: np.ndarray,
    signs: np.ndarray,
    cost: float = 0.1,
    passes: int = 60,
    tolerance: float = 1e-3,
) -> tuple[np.ndarray, float]:
    """(w, b) that minimise |w|^2/2 + b^2/2 + cost * sum of hinge losses.

    Row i has values[j] at each j in rows[i], and 1 for the bias. Each step solves the dual in one
    row's multiplier, in a fixed random order; w is kept as the sum over rows. It ends
    when no multiplier's projected gradient exceeds the tolerance.
    """
    w, b = np.zeros(len(values)), 0.0
    alpha = np.zeros(len(rows))
    scaled = [values[r] for r in rows]
    square = np.array([1 + x @ x for x in scaled])
    dice = np.random.default_rng(7)
    for _ in range(passes):
        worst = 0.0
        for i in dice.permutation(len(rows)):
            index, x, y = rows[i], scaled[i], signs[i]
            slope = y * (w[index] @ x + b) - 1
            if alpha[i] <= 0:
                step = min(slope, 0.0)
            elif alpha[i] >= cost:
                step = max(slope, 0.0)
            else:
                step = slope
            if step:
                worst = max(worst, abs(step))
                new = min(max(alpha[i] - slope / square[i], 0.0), cost)
                change = (new - alpha[i]) * y
                w[index] += change * x
                b += change
                alpha[i] = new
        if worst <= tolerance:
            break
    return w, b


def sigmoid_fit(margins: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """(slope, offset) of the logistic curve that turns margins into probabilities, by Newton steps
    on smoothed targets; the slope is never negative."""
    high = label.sum()
    target = np.where(label == 1, (high + 1) / (high + 2), 1 / (len(label) - high + 2))
    slope, offset = 0.0, float(np.log(target.mean() / (1 - target.mean())))

    def loss(a: float, c: float) -> float:
        z = a * margins + c
        return float(np.sum(np.logaddexp(0, z) - target * z))

    now = loss(slope, offset)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(slope * margins + offset, -500, 500)))
        error, weight = p - target, p * (1 - p)
        grad = np.array([error @ margins, error.sum()])
        hess = np.array([[weight @ margins**2, weight @ margins], [weight @ margins, weight.sum()]])
        move = np.linalg.solve(hess + 1e-9 * np.eye(2), grad)
        size = 1.0
        while size > 1e-6 and loss(slope - size * move[0], offset - size * move[1]) > now:
            size /= 2
        slope, offset = slope - size * move[0], offset - size * move[1]
        then, now = now, loss(slope, offset)
        if then - now < 1e-9:
            break
    if slope < 0:
        return 0.0, float(np.log(target.mean() / (1 - target.mean())))
    return float(slope), float(offset)


@dataclass
class Model:
    """The features by ascending key with their weights, and the curve from margin to score."""

    keys: np.ndarray
    weights: np.ndarray
    bias: float
    slope: float
    offset: float

    def score(self, text: str | None, features: Features) -> float:
        margin = self.weights[features.present(text)].sum() + self.bias
        return float(1 / (1 + np.exp(-np.clip(self.slope * margin + self.offset, -500, 500))))


def _present(rows: DataFrame, keys: np.ndarray):
    """(rows of feature numbers, labels, whether they are fitted on), in a fixed order. The driver
    holds at most MAX_LABELLED x FEATURES numbers of two bytes, unless keys repeat in the documents."""
    shared = rows.sparkSession.sparkContext.broadcast(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features(shared.value)
        for batch in batches:
            kept = [features.present(t.as_py()).astype(np.uint16).tobytes() for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("order", "label", "fits")] + [pa.array(kept, pa.binary())],
                names=["order", "label", "fits", "kept"],
            )

    got = rows.withColumn("fits", _fits(F.col("order"))).mapInArrow(
        run, "order long, label int, fits boolean, kept binary"
    )
    # documents that share a key and features are one row of the fit
    got = got.distinct().toPandas().sort_values(["order", "label", "kept"])
    lists = [np.frombuffer(x, np.uint16).astype(np.int32) for x in got["kept"]]
    return lists, got["label"].to_numpy(), got["fits"].to_numpy(bool)


def learn(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality"
) -> Model:
    """The model that the labels outside the held-out part give; without both classes, one that
    gives every text the share of label 1 (1/2 without any label)."""
    rows = stored(labelled_rows(docs, labels, key, text, label))
    fitted = rows.where(_fits(F.col("order")))
    low, high = fitted.agg(F.count_if(F.col("label") == 0), F.count_if(F.col("label") == 1)).first()
    if not low or not high:
        share = (high + 1) / (low + high + 2)
        return Model(np.zeros(0, np.uint64), np.zeros(0), 0.0, 0.0, float(np.log(share / (1 - share))))
    best = ratios(fitted, low, high).toPandas()  # at most FEATURES rows
    best["key"] = best["key"].to_numpy(np.int64).view(np.uint64)
    best = best.sort_values("key")
    keys, ratio = best["key"].to_numpy(np.uint64), best["ratio"].to_numpy(np.float64)
    lists, y, fits = _present(rows, keys)
    w, b = dual_coordinate_descent(
        [x for x, f in zip(lists, fits) if f], ratio, np.where(y[fits] == 1, 1.0, -1.0)
    )
    weights = w * ratio
    apart = ~fits if (~fits).any() else fits  # with a handful of labels all are fitted on
    margins = np.array([weights[x].sum() + b for x, f in zip(lists, apart) if f])
    return Model(keys, weights, float(b), *sigmoid_fit(margins, y[apart]))


def scorer(docs: DataFrame, model: Model):
    """A column function that scores every whole text; the model is broadcast."""
    parts = (model.keys, model.weights, model.bias, model.slope, model.offset)
    shared = docs.sparkSession.sparkContext.broadcast(parts)

    @F.arrow_udf("double")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        mine = Model(*shared.value)
        features = Features(mine.keys)
        for texts in batches:
            yield pa.array([mine.score(t.as_py(), features) for t in texts], pa.float64())

    return run


def quality(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    least: float = 0.3,
) -> DataFrame:
    """(key, held_out, score, predicted) for every row of `docs`; predicted is 1 from `least` on.

    Labels are learned from rows whose crc32 of the key, as text, is not divisible by 5; keys
    with two different labels, null keys and labels other than 0 and 1 teach nothing. Only the
    text enters a score; a null text is empty and scored like one. Repeated rows are scored
    alike and all returned. With no labels, or of one class only, all scores are the smoothed
    share of label 1. Columns other than those named are ignored; an empty table gives no rows.
    """
    model = learn(docs, labels, key, text, label)
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    scored = rows.select("key", scorer(docs, model)("text").alias("score"))
    return scored.select(
        F.col("key").alias(key),
        held_out(F.col("key")).alias("held_out"),
        "score",
        (F.col("score") >= least).cast("int").alias("predicted"),
    )
