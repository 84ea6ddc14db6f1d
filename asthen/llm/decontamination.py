"""Benchmark decontamination: which documents contain which benchmark items.

DataFrame functions only; no Python runs on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from asthen.llm.common import stored

#: Rows of sketches or item shingles that are sent to all executors, at most (32 bytes a row).
#: Above it the same join shuffles.
BROADCAST_ROWS = 500_000


def words(text: Column) -> Column:
    """Runs of letters, marks and digits, lower-cased."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{M}\p{N}]+"), lambda w: w != "")


def _shingles(words: str, n: int) -> Column:
    """All n-word shingles of an array column, as strings; shorter arrays have none."""
    last = F.size(words) - n + 1
    made = F.transform(
        F.sequence(F.lit(1), last), lambda i: F.array_join(F.slice(words, i, n), " ")
    )
    return F.when(last > 0, made).otherwise(F.array().cast("array<string>"))


def _hashes(words: str, n: int) -> Column:
    """The hash of each shingle of `_shingles`, made from its text without gathering the text."""
    last = F.size(words) - n + 1
    made = F.transform(F.sequence(F.lit(1), last), lambda i: F.xxhash64(F.slice(words, i, n)))
    return F.when(last > 0, made).otherwise(F.array().cast("array<bigint>"))


def item_shingles(benchmark: DataFrame, key: str, text: str, n: int) -> DataFrame:
    """(item_id, shingle, hash, n_shingles), a row for each distinct shingle of an item. Rows with
    one id are one item, whose shingles are those of all its texts."""
    rows = benchmark.select(F.col(key).cast("long").alias("item_id"), words(text).alias("words"))
    pairs = F.arrays_zip(_shingles("words", n).alias("shingle"), _hashes("words", n).alias("hash"))
    each = rows.where("item_id is not null").select("item_id", F.explode(pairs).alias("p"))
    each = each.select("item_id", "p.shingle", "p.hash").distinct()
    sizes = each.groupBy("item_id").agg(F.count("*").alias("n_shingles"))
    return each.join(sizes, "item_id")


def sketches(shingles: DataFrame, threshold: float) -> DataFrame:
    """(item_id, hash): the MinHash sketch of each item, as long as its size partition needs.

    Items are partitioned by size, in powers of two. A sketch has the least hashes of its item,
    one more than the shingles that the largest item of the partition may miss at the threshold.
    A document that reaches the threshold thus has at least one hash of the sketch, whatever its
    length: candidates are complete.
    """
    upper = F.pow(F.lit(2), F.ceil(F.log2("n_shingles")))
    length = F.floor(F.round(upper * (1 - threshold), 6)) + 1
    # the rank of a hash within its item: items are short, and each is one window group
    least = shingles.groupBy("item_id", length.alias("length")).agg(
        F.sort_array(F.collect_set("hash")).alias("hashes")
    )
    return least.select("item_id", F.explode(F.slice("hashes", F.lit(1), F.col("length").cast("int"))).alias("hash"))


def _sized(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def contained_items(
    docs: DataFrame,
    benchmark: DataFrame,
    threshold: float = 0.8,
    n: int = 5,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """(key, item_id, n_found, n_shingles, containment) of documents that contain an item.

    The containment of an item in a document is the share of the item's distinct `n`-word
    shingles that occur in the whole document; pairs at or above `threshold` are returned.
    Every document shingle is hashed once and probed against the items' sketches
    (`sketches`), which gives candidates; of documents only keys and hashes take part in this. The
    texts of candidates are then fetched by a second join and verified on the shingles' text. A
    document's own sketch isn't used: it would keep too few of a long text's shingles to find a
    short item.

    Words are lower-cased runs of letters and digits. Items of fewer than `n` words have no
    shingle and are never reported, nor are items with a null id. Null or empty texts contain
    nothing. Rows with a null key are left out; rows that repeat a key are one document whose
    shingles are those of all its texts. Other columns are ignored. Empty tables give no rows.
    """
    items = stored(item_shingles(benchmark, item_key, item_text, n))
    sketch = stored(sketches(items, threshold))
    n_items, n_sketch = items.count(), sketch.count()
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    rows = rows.where("doc_id is not null and text is not null")
    hashed = rows.select("doc_id", words(F.col("text")).alias("words"))
    probes = hashed.select("doc_id", F.explode(_hashes("words", n)).alias("hash"))
    sketch = sketch.withColumnRenamed("hash", "sketch_hash")
    hits = probes.join(_sized(sketch, n_sketch), F.col("hash") == F.col("sketch_hash"))
    pairs = stored(hits.select("doc_id", "item_id").distinct())
    candidates = rows.join(pairs.select("doc_id").distinct(), "doc_id", "left_semi")
    candidates = candidates.select("doc_id", words(F.col("text")).alias("words"))
    parts = candidates.select("doc_id", F.explode(F.array_distinct(_shingles("words", n))).alias("shingle"))
    # only shingles that some item has are of interest
    listed = items.select(F.col("shingle").alias("item_shingle"), F.col("item_id").alias("item"))
    found = (
        parts.join(_sized(listed, n_items), F.col("shingle") == F.col("item_shingle"))
        .groupBy("doc_id", F.col("item").alias("item_id"))
        .agg(F.count_distinct("shingle").alias("n_found"))
    )
    sizes = items.select("item_id", "n_shingles").distinct()
    share = F.col("n_found") / F.col("n_shingles")
    return (
        found.join(pairs, ["doc_id", "item_id"], "left_semi")
        .join(sizes, "item_id")
        .where(share >= threshold)
        .select(
            F.col("doc_id").alias(key),
            "item_id",
            "n_found",
            "n_shingles",
            F.round(share, 6).alias("containment"),
        )
    )


def without_items(
    docs: DataFrame,
    benchmark: DataFrame,
    threshold: float = 0.8,
    n: int = 5,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """The rows of `docs`, whole, that contain no item; rows with a null key stay."""
    found = contained_items(docs, benchmark, threshold, n, key, text).select(key).distinct()
    named = docs.where(F.col(key).isNotNull()).join(found, key, "left_anti")
    return named.select(docs.columns).union(docs.where(F.col(key).isNull()))
