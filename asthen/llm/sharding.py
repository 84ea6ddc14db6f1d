"""Contiguous shards of nearly equal byte size, cut on global prefix sums."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from asthen.llm.common import stored


def shard_by_bytes(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shards: int = 16
) -> DataFrame:
    """(key, size, text_crc32, shard, slot) for every row of `docs`, in shards 0 .. shards - 1.

    Rows are put in key order by a range exchange of small rows (key, size, checksum; the text
    stays behind), each partition's bytes are summed, and the sums of the partitions before it
    are the offset at which a partition starts counting. The shard of a row is where the middle
    of its bytes lies among `shards` equal targets, so shards are contiguous in key order and
    miss the target by less than one document. Only one total per partition and one first row
    per shard pass through the driver.

    Size is the UTF-8 length plus 1; a null text counts as empty (checksum 0). Null keys sort
    first; equal keys are ordered by checksum and size, equal rows are interchangeable. Columns
    other than key and text are ignored. An empty table gives an empty result; with few rows
    some shards stay empty.
    """
    body = F.coalesce(F.col(text), F.lit("")).cast("string")
    rows = docs.select(
        F.col(key).alias("key"),
        (F.octet_length(body).cast("long") + 1).alias("size"),
        F.crc32(F.encode(body, "utf-8")).alias("text_crc32"),
    )
    ordered = stored(
        rows.repartitionByRange("key", "text_crc32", "size")
        .sortWithinPartitions("key", "text_crc32", "size")
        .withColumn("part", F.spark_partition_id())
        .withColumn("place", F.monotonically_increasing_id())
    )
    totals = sorted(
        ordered.groupBy("part").agg(F.sum("size"), F.count("*")).collect()
    )  # a line for each partition
    before, byte, row = {}, 0, 0
    for part, size, count in totals:
        before[part] = (byte, row)
        byte, row = byte + size, row + count
    placed = ordered.repartition("part").sortWithinPartitions("part", "place")
    cut = placed.mapInArrow(
        _cutter(before, max(byte, 1), shards),
        "key long, size long, text_crc32 long, shard int, row long",
    )
    cut = stored(cut)
    first = dict(cut.groupBy("shard").agg(F.min("row")).collect())  # a line for each shard
    starts = F.array(*[F.lit(first.get(s, 0)).cast("long") for s in range(shards)])
    return cut.select(
        F.col("key").alias(key),
        "size",
        "text_crc32",
        "shard",
        (F.col("row") - starts[F.col("shard")]).alias("slot"),
    )


def _cutter(before: dict[int, tuple[int, int]], total: int, shards: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at: dict[int, tuple[int, int]] = dict(before)
        for batch in batches:
            if not batch.num_rows:
                continue
            size = batch.column("size").to_numpy()
            parts = batch.column("part").to_numpy()
            shard = np.empty(len(size), np.int32)
            row = np.empty(len(size), np.int64)
            edges = np.flatnonzero(np.diff(parts)) + 1
            for lo, hi in zip([0, *edges], [*edges, len(parts)]):
                byte, first = at[int(parts[lo])]
                ends = byte + np.cumsum(size[lo:hi])
                middle = 2 * ends - size[lo:hi]  # twice the middle of the row
                shard[lo:hi] = middle * shards // (2 * total)  # in 64 bits up to 2^58 bytes
                row[lo:hi] = first + np.arange(hi - lo)
                at[int(parts[lo])] = (int(ends[-1]), first + hi - lo)
            np.minimum(shard, shards - 1, out=shard)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("key").cast(pa.int64()),
                    batch.column("size"),
                    batch.column("text_crc32"),
                    pa.array(shard),
                    pa.array(row),
                ],
                names=["key", "size", "text_crc32", "shard", "row"],
            )

    return cut
