"""Periodic runs of words: Lyndon arrays from Baier's suffix grouping, roots extended to runs."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A run has at least this many words, and this many periods.
LEAST_WORDS, LEAST_PERIODS = 6, 4


def lyndon_array(ranks: np.ndarray) -> np.ndarray:
    """The length of the longest Lyndon word at each place: phase one of Baier's suffix sorter.

    Suffixes are grouped by a context, at first their first word. Groups are taken from the
    greatest on. A suffix whose context ends where a member of the group taken begins, and whose
    own group is lower, gains that group's context, as often as it follows unbroken;
    suffixes of one group that gain it equally often move to a new group right above their old
    one. When a group is taken, its context is the longest Lyndon word at its members, so the
    contexts' lengths are the array. No suffix is sorted any further. Linear but for the
    sorting of each group's gains.
    """
    n = len(ranks)
    order = np.argsort(ranks, kind="stable")
    cuts = np.flatnonzero(np.diff(ranks[order])) + 1
    members = [x.tolist() for x in np.split(order, cuts)]
    group = np.empty(n, np.int64)
    for g, x in enumerate(members):
        group[x] = g
    group = group.tolist()
    length = [1] * len(members)  # of a group's context
    below = list(range(-1, len(members) - 1))  # the next lower group
    above = list(range(1, len(members) + 1))
    above[-1] = -1
    owner = list(range(-1, n))  # the suffix, not taken yet, whose context ends at a place
    out = np.zeros(n, np.int64)
    g = len(members) - 1
    while g >= 0:
        size = length[g]
        now = [i for i in members[g] if group[i] == g]  # others have moved on
        members[g] = now
        gains: dict[tuple[int, int], list[int]] = {}
        for i in now:
            j = owner[i]
            if j >= 0 and group[j] == g:
                continue  # inside an unbroken chain of this context
            end, times = i + size, 1
            while end < n and group[end] == g:
                end, times = end + size, times + 1
            owner[end] = j
            if j >= 0:
                gains.setdefault((times, group[j]), []).append(j)
        # most copies first: each new group goes right above the old, so fewer copies lie lower
        for times, old in sorted(gains, reverse=True):
            new, moved = len(members), gains[times, old]
            members.append(moved)
            length.append(length[old] + times * size)
            below.append(old)
            above.append(above[old])
            if above[old] >= 0:
                below[above[old]] = new
            above[old] = new
            for j in moved:
                group[j] = new
        out[now] = size
        g = below[g]
    return out


class Extensions:
    """Longest common extensions of two places, to the right and to the left.

    Blocks of 2^k words are named by equal names of their halves, so equal names are equal
    words, and an extension is put together from blocks of falling size.
    """

    def __init__(self, ranks: np.ndarray) -> None:
        self.n, self.names = len(ranks), [ranks]
        while 2 << (len(self.names) - 1) <= self.n:
            half, last = 1 << (len(self.names) - 1), self.names[-1]
            pairs = last[:-half] * np.int64(self.n + 1) + last[half:]
            self.names.append(np.unique(pairs, return_inverse=True)[1])

    def right(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Equal words from a and b on; a < b."""
        a, b = a.copy(), b.copy()
        start = b.copy()
        for k in range(len(self.names) - 1, -1, -1):
            name = self.names[k]
            fits = np.flatnonzero(b < len(name))
            fits = fits[name[a[fits]] == name[b[fits]]]
            a[fits] += 1 << k
            b[fits] += 1 << k
        return b - start

    def left(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Equal words before a and b; a < b."""
        a, b = a.copy(), b.copy()
        start = a.copy()
        for k in range(len(self.names) - 1, -1, -1):
            name, size = self.names[k], 1 << k
            fits = np.flatnonzero(a >= size)
            fits = fits[name[a[fits] - size] == name[b[fits] - size]]
            a[fits] -= size
            b[fits] -= size
        return start - a


def _runs_of(ranks: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of a sequence of ranks."""
    n = len(ranks)
    found, reach = [], None
    for order in (ranks, ranks.max() - ranks):
        size = lyndon_array(order)
        at = np.arange(n)
        # a root is followed by two more of its kind in a run of four periods
        two = at + size < n
        two[two] = size[at[two] + size[two]] == size[two]
        at = at[two]
        at = at[order[at] == order[at + size[at]]]
        if not len(at):
            continue
        reach = reach or Extensions(ranks)
        size = size[at]
        begin = at - reach.left(at, at + size)
        length = at + size + reach.right(at, at + size) - begin
        long = (length >= LEAST_WORDS) & (length >= LEAST_PERIODS * size)
        found += zip(begin[long].tolist(), length[long].tolist(), size[long].tolist())
    return sorted(set(found), key=lambda r: (r[0], r[2]))


def _segments(words: np.ndarray) -> list[tuple[int, int]]:
    """Stretches (start, end) that hold all runs.

    Every word of a run is in it once a period, so LEAST_PERIODS times or more. A word rarer than
    that in a stretch is in none of its runs and can't extend one; it cuts the stretch, and so on
    until nothing is cut.
    """
    n = len(words)
    part = np.zeros(n, np.int64)  # the stretch of each word
    keep = np.arange(n)
    while len(keep):
        pair = part * np.int64(n) + words[keep]
        _, inverse, count = np.unique(pair, return_inverse=True, return_counts=True)
        often = count[inverse] >= LEAST_PERIODS
        if often.all():
            break
        keep, part = keep[often], part[often]
        if len(keep):
            new = np.concatenate([[False], (np.diff(keep) > 1) | (np.diff(part) > 0)])
            part = np.cumsum(new)
            wide = np.bincount(part) >= LEAST_WORDS
            keep, part = keep[wide[part]], part[wide[part]]
    if not len(keep):
        return []
    edges = np.flatnonzero(np.diff(part)) + 1
    return [(int(x[0]), int(x[-1]) + 1) for x in np.split(keep, edges)]


def word_runs(words: list[bytes]) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of a list of words, by start, then period: stretches
    with smallest period q, of max(6, 4 q) words or more, that no neighbouring word extends."""
    if len(words) < LEAST_WORDS:
        return []
    number: dict[bytes, int] = {}
    ranks = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
    out = []
    for lo, hi in _segments(ranks):
        own = np.unique(ranks[lo:hi], return_inverse=True)[1].astype(np.int64)
        out += [(lo + start, length, period) for start, length, period in _runs_of(own)]
    return out


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words without those that some run has after its first period."""
    if not runs:
        return words
    edges = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        edges[start + period] += 1
        edges[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(edges[:-1]) == 0).tolist()]


def greatest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run with the greatest length / period; ties go to the least start, then period."""
    best = None
    for run in runs:  # by start, then period
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def planted(words: list[bytes], key: int | None) -> list[bytes]:
    """The words with a periodic tail in about a tenth of the keys, as the key's checksum h rules:
    if h % 10 is 0, word i >= a becomes word a + (i - a) % p, with a and p from h / 10."""
    n = len(words)
    if key is None or not n:
        return words
    h = zlib.crc32(str(key).encode())
    if h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    times, rest = divmod(n - a, p)
    return words[:a] + words[a : a + p] * times + words[a : a + rest]


_SCHEMA = (
    "key long, n_words long, runs array<struct<start: long, length: long, period: long>>, "
    "collapsed string"
)


def _struct(runs: list[tuple[int, int, int]]) -> list[dict[str, int]]:
    return [dict(zip(("start", "length", "period"), r)) for r in runs]


def _arrow_runs() -> pa.DataType:
    return pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))


def _rows(batch: pa.RecordBatch, plant: bool) -> Iterator[tuple[int | None, list[bytes]]]:
    for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
        words = (text.as_py() or "").encode().split()
        yield key, planted(words, key) if plant else words


def periodic_runs(
    docs: DataFrame, key: str = "doc_id", text: str = "text", plant: bool = False
) -> DataFrame:
    """(key, n_words, runs, collapsed) for every row of `docs`.

    Words are runs without ASCII white space, case kept, numbered from 0; a null text has none. A
    run is a stretch with smallest period q, of max(6, 4 q) words or more, that neither
    neighbour extends; `runs` lists start, length and period by start, then period. `collapsed`
    joins by a blank the words that no run has after its first period. With `plant`, about
    a tenth of the documents get a periodic tail first (`planted`), none with a null key. Each
    row, a repeated one too, is judged by itself, in one pass without a shuffle; a task holds a
    text at a time. Other columns are ignored; an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 64):
                keys, sizes, runs, texts = [], [], [], []
                for k, words in _rows(batch.slice(i, 64), plant):
                    found = word_runs(words)
                    keys.append(k)
                    sizes.append(len(words))
                    runs.append(_struct(found))
                    texts.append(b" ".join(collapsed(words, found)).decode())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(keys, pa.int64()),
                        pa.array(sizes, pa.int64()),
                        pa.array(runs, _arrow_runs()),
                        pa.array(texts, pa.string()),
                    ],
                    names=["key", "n_words", "runs", "collapsed"],
                )

    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    return rows.mapInArrow(run, _SCHEMA).withColumnRenamed("key", key)


_DIGEST = (
    "key long, n_runs long, start long, length long, period long, exponent_milli long, "
    "runs_sha256 string, collapsed_sha256 string"
)


def run_digests(
    docs: DataFrame, key: str = "doc_id", text: str = "text", plant: bool = False
) -> DataFrame:
    """(key, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256) for every
    row: `periodic_runs` summed up where it is found, so no text leaves its task.

    The four numbers are those of the run with the greatest length / period (ties: least start,
    then period), null without runs; exponent_milli is 1000 length / period, cut to a whole
    number. The hashes are of all runs' lines `start,length,period` and of the collapsed text.
    """
    names = [c.split()[0] for c in _DIGEST.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for k, words in _rows(batch, plant):
                found = word_runs(words)
                lines = "".join(f"{s},{n},{q}\n" for s, n, q in found)
                best = greatest(found)
                four = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
                text_hash = sha256(b" ".join(collapsed(words, found))).hexdigest()
                out.append((k, len(found), *four, sha256(lines.encode()).hexdigest(), text_hash))
            columns = zip(*out) if out else [()] * len(names)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(list(c), pa.string() if n.endswith("256") else pa.int64())
                    for c, n in zip(columns, names)
                ],
                names=names,
            )

    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    return rows.mapInArrow(run, _DIGEST).withColumnRenamed("key", key)
