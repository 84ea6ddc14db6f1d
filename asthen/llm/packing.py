"""Token packing into fixed windows: full windows are cut first, the rest is packed best-fit."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from asthen.llm.common import stored

#: Rests that one task packs, about. More only lowers padding, which is then under one window a task.
RESTS_PER_TASK = 100_000


class BestFit:
    """Open windows by remaining capacity, under a segment tree over the capacities.

    A leaf counts the open windows with exactly that capacity left, an inner node those below it.
    The tightest window for a piece is the leftmost non-empty leaf from its length on.
    """

    def __init__(self, capacity: int) -> None:
        self.capacity = capacity
        self.size = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.size)
        self.open: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.windows = 0

    def _add(self, left: int, n: int) -> None:
        node = left + self.size
        while node:
            self.count[node] += n
            node >>= 1

    def tightest(self, length: int) -> int | None:
        """The least capacity of an open window that is at least `length`."""
        node, count = length + self.size, self.count
        if count[node]:
            return length
        while node > 1:
            if not node & 1 and count[node + 1]:
                node += 1
                break
            node >>= 1
        else:
            return None
        while node < self.size:
            node *= 2
            if not count[node]:
                node += 1
        return node - self.size

    def put(self, length: int) -> tuple[int, int]:
        """The window and the offset of a piece."""
        left = self.tightest(length)
        if left is None:
            window, left = self.windows, self.capacity
            self.windows += 1
        else:
            window = self.open[left].pop()
            self._add(left, -1)
        if left > length:
            self.open[left - length].append(window)
            self._add(left - length, 1)
        return window, self.capacity - left


def encoder(path: str):
    """Token ids of a text, by the vocabulary file at `path`, without special tokens added.

    Texts are encoded by the tokenizers library; where the file is byte-level BPE and tiktoken
    reads the same vocabulary, ordinary Latin text takes tiktoken's faster merge loop, which
    gives the same ids (tested). Other scripts and texts with the strings of special tokens
    always go through tokenizers.
    """
    import json

    import tiktoken
    from tokenizers import Tokenizer

    slow = Tokenizer.from_file(path)
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    vocab = spec["model"]["vocab"]
    special = [x["content"] for x in spec.get("added_tokens", ())]
    # byte-level vocabularies write each byte as a printable character
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    chars = {chr(b): b for b in plain}
    chars |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}
    ranks = {
        bytes(chars[c] for c in word): rank for word, rank in vocab.items() if word not in special
    }
    # how byte-level BPE splits text: contractions, letters, digits, other signs, white space
    pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
    fast = tiktoken.Encoding("bytes", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def encode(text: str) -> np.ndarray:
        if any(s in text for s in special) or (not text.isascii() and max(text) > "ɏ"):
            return np.array(slow.encode(text, add_special_tokens=False).ids, dtype="<u4")
        return fast.encode_to_numpy(text, allowed_special=set(), disallowed_special=()).astype("<u4")

    return encode


def _pieces(path: str, window: int, end_id: int):
    schema = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        for batch in batches:
            out: list[list[int | None]] = [[] for _ in schema]
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.append(encode(text.as_py() or ""), np.array([end_id], "<u4")).astype("<u4")
                for start in range(0, len(ids), window):
                    piece = ids[start : start + window]
                    row = (doc, start, len(piece), zlib.crc32(piece.tobytes()), len(ids))
                    for column, value in zip(out, row):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names=schema)

    return cut


def _packer(window: int):
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "part", "window", "offset"]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fit = BestFit(window)
        for batch in batches:  # longest first
            placed = [fit.put(n) for n in batch.column("length").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(n) for n in names[:6]),
                    pa.array([w for w, _ in placed], pa.int64()),
                    pa.array([o for _, o in placed], pa.int64()),
                ],
                names=names,
            )

    return pack


def pack(
    docs: DataFrame,
    tokenizer: str,
    window: int = 2048,
    end_id: int = 1,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Pieces of documents in sequences of at most `window` tokens, one row per piece.

    A document is its token ids and `end_id`. Documents longer than a window are first cut into
    full windows, each a sequence of its own; rests are dealt to tasks of about RESTS_PER_TASK
    by a hash, and each task packs its rests best-fit decreasing. Tasks' counts of sequences
    are summed up, so sequence ids are global and gapless. A task holds one number per open
    window, and the padding it causes is within its last windows.

    A null text is empty: one piece with only `end_id`. Null and repeated keys are kept as
    rows of their own. Columns other than key and text are ignored. An empty table gives an
    empty result. `tokenizer` is a path that every executor can open.

    Columns: key, start, length, ids_crc32 (of the ids as little-endian 32-bit numbers),
    doc_tokens, sequence_id, offset.
    """
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    pieces = stored(
        rows.mapInArrow(
            _pieces(tokenizer, window, end_id),
            "doc_id long, start long, length long, ids_crc32 long, doc_tokens long",
        )
    )
    full = pieces.where(F.col("length") == window)
    rest = pieces.where(F.col("length") < window)
    n_full, n_rest = pieces.agg(
        F.count_if(F.col("length") == window), F.count_if(F.col("length") < window)
    ).first()
    tasks = max(1, -(-n_rest // RESTS_PER_TASK))
    deal = F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(tasks)).cast("int")
    packed = stored(
        rest.withColumn("part", deal)
        .repartition(tasks, "part")
        .sortWithinPartitions("part", F.desc("length"), "doc_id", "start", "ids_crc32")
        .mapInArrow(
            _per_part(_packer(window)),
            "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, part int, "
            "window long, offset long",
        )
    )
    counts = dict(packed.groupBy("part").agg(F.max("window") + 1).collect())  # one line a task
    first, at = {}, 0
    for part in sorted(counts):
        first[part], at = at, at + counts[part]
    starts = F.array(*[F.lit(first.get(p, 0)).cast("long") for p in range(tasks)])
    # full windows follow, numbered by partition and row
    numbered = _numbered(full, at)
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    packed = packed.withColumn("sequence_id", starts[F.col("part")] + F.col("window"))
    out = packed.select(columns).unionByName(numbered.select(columns))
    return out.withColumnRenamed("doc_id", key)


def _per_part(pack_one):
    """`pack_one` over each run of equal parts: parts may share a task, and never share a window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current: list[int | None] = [None]
        rest: list[pa.RecordBatch] = []
        source = iter(batches)

        def of_part() -> Iterator[pa.RecordBatch]:
            while True:
                batch = rest.pop() if rest else next(source, None)
                if batch is None:
                    current[0] = None
                    return
                if not batch.num_rows:
                    continue
                parts = batch.column("part").to_numpy()
                if current[0] is None:
                    current[0] = int(parts[0])
                n = int(np.searchsorted(parts, current[0], side="right"))
                if n < batch.num_rows:
                    rest.append(batch.slice(n))
                if n:
                    yield batch.slice(0, n)
                if rest:
                    current[0] = None
                    return

        while True:
            got = False
            for out in pack_one(of_part()):
                got = True
                yield out
            if not got and not rest:
                return

    return run


def _numbered(full: DataFrame, first: int) -> DataFrame:
    """Sequence ids from `first` on for full windows: files' totals, then a row number in each."""
    placed = stored(
        full.withColumn("part", F.spark_partition_id()).withColumn(
            "place", F.monotonically_increasing_id()
        )
    )
    counts = dict(placed.groupBy("part").agg(F.count("*")).collect())  # one line a partition
    starts, at = {}, first
    for part in sorted(counts):
        starts[part], at = at, at + counts[part]
    # the place of a row is its partition in the upper and its row number in the lower 33 bits
    row = F.col("place") - F.shiftleft(F.col("part").cast("long"), 33)
    if not starts:
        return placed.withColumn("sequence_id", F.lit(0).cast("long")).withColumn(
            "offset", F.lit(0).cast("long")
        )
    listed = F.array(*[F.lit(starts.get(p, 0)).cast("long") for p in range(max(starts) + 1)])
    return placed.withColumn("sequence_id", listed[F.col("part")] + row).withColumn(
        "offset", F.lit(0).cast("long")
    )
