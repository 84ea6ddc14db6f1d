"""A training corpus from raw documents: STAGES are applied in order, each to what the last one kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from asthen.llm.common import stored, table
from asthen.llm.decontamination import without_items
from asthen.llm.linededup import without_repeats
from asthen.llm.packing import pack
from asthen.llm.simhash import one_of_each
from asthen.llm.toxicity import without_toxic


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier calls toxic go."""
    return without_toxic(docs, table(spark, sf_dir, "labels"))


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated passages go from the texts; n_chars, where there is one, is that of the new text."""
    new = without_repeats(docs)
    if "n_chars" in new.columns:
        new = new.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return new


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-equal fingerprints stays."""
    return one_of_each(docs, words=3, distance=2)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    return without_items(docs, table(spark, sf_dir, "benchmark"), threshold=0.8, n=5)


def pack_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents become pieces of token sequences."""
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"), window=2048, end_id=1)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeats),
    ("simhash_near_dedup", near_dedup),
    ("decontamination", decontaminate),
    ("packing", pack_tokens),
]

#: The stages use a trained model, hash bits and token ids, which SQL can't express; the tests hold
#: each stage against its operator and a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each stage is written as Parquet and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs
