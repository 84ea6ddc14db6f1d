"""The registered queries of the subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from asthen.llm.common import table
from asthen.llm.decontamination import contained_items
from asthen.llm.embeddings import near_vectors
from asthen.llm.extraction import extract
from asthen.llm.hardnegatives import hard_negatives
from asthen.llm.linededup import dedup_lines
from asthen.llm.packing import pack
from asthen.llm.pii import find_pii
from asthen.llm.quality import quality
from asthen.llm.runs import run_digests
from asthen.llm.sharding import shard_by_bytes
from asthen.llm.simhash import simhash_components
from asthen.llm.toxicity import toxicity
from asthen.llm.urls import filter_urls

#: Rules on hosts and paths, before the classifier.
URL_RULES = (
    ("block", "net/"),
    ("allow", "example.net/en/"),
    ("block", "example.com/de/"),
    ("allow", "org/fr/"),
)


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return filter_urls(pages, corpus=pages, rules=URL_RULES)


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, removed_words, spans (start:end in code points, comma-joined), text."""
    spans = F.transform("removed_spans", lambda s: F.concat_ws(":", s["start"], s["end"]))
    return dedup_lines(table(spark, sf_dir, "documents")).select(
        "doc_id", "removed_words", F.array_join(spans, ",").alias("spans"), "text"
    )


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_pii(table(spark, sf_dir, "documents"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return contained_items(docs, benchmark, threshold=0.8, n=5)


def op5_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"), least=0.93)


def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(table(spark, sf_dir, "documents"), words=3, distance=2)


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_by_bytes(table(spark, sf_dir, "documents"), shards=16).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))


def op11_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), least=0.3)


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors, moved = table(spark, sf_dir, "embeddings"), (F.col("label") + 1) % 10
    vectors = vectors.withColumn("label", F.when(F.col("vec_id") % 7 == 0, moved).otherwise(F.col("label")))
    return hard_negatives(vectors, anchors=F.col("vec_id") % 100 == 0)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_digests(table(spark, sf_dir, "documents"), plant=True)


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (
        op1_url_filters,
        op2_line_dedup,
        op3_pii,
        op4_decontamination,
        op5_embedding_near_dedup,
        op6_simhash_near_dedup,
        op7_packing,
        op8_toxicity,
        op9_sharding,
        op10_html_extraction,
        op11_quality_classifier,
        op12_hard_negatives,
        op13_periodic_runs,
    )
    return {f.__name__: f for f in found}


_DECONTAMINATION = r"""
WITH shingles AS (
    SELECT kind, id, array_to_string(w[i : i + 4], ' ') AS shingle
    FROM (
        SELECT kind, id, w, unnest(range(1, len(w) - 3)) AS i
        FROM (
            SELECT kind, id,
                list_filter(string_split_regex(lower(text), '[^\p{L}\p{M}\p{N}]+'), lambda x: x <> '') AS w
            FROM (
                SELECT 'doc' AS kind, doc_id AS id, text FROM documents
                UNION ALL
                SELECT 'item', item_id, text FROM benchmark
            )
        )
    )
    GROUP BY ALL
),
sizes AS (SELECT id, count(*) AS n FROM shingles WHERE kind = 'item' GROUP BY id)
SELECT d.id AS doc_id, i.id AS item_id, count(*) AS n_found, any_value(s.n) AS n_shingles,
    round(count(*) / any_value(s.n), 6) AS containment
FROM shingles d
JOIN shingles i ON i.shingle = d.shingle AND i.kind = 'item' AND d.kind = 'doc'
JOIN sizes s ON s.id = i.id
GROUP BY d.id, i.id
HAVING count(*) / any_value(s.n) >= 0.8
"""

_EMBEDDINGS = """
WITH RECURSIVE usable AS (
    SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
    WHERE label IS NOT NULL AND len(embedding) > 0
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        AND len(list_filter(embedding, lambda x: x <> 0)) > 0
),
links AS (
    SELECT a.vec_id AS a, b.vec_id AS b
    FROM usable a JOIN usable b
        ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
    WHERE list_cosine_similarity(a.v, b.v) >= 0.93
),
reach AS (
    SELECT vec_id AS a, vec_id AS b FROM embeddings
    UNION
    SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b
),
least AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, coalesce(c.n, 0) AS n_links, l.component_id, e.vec_id = l.component_id AS kept
FROM embeddings e JOIN least l ON l.a = e.vec_id LEFT JOIN counts c ON c.a = e.vec_id
"""

_HARD_NEGATIVES = """
WITH usable AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scores AS (
    SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
        CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
    FROM usable a JOIN usable b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
    WHERE a.vec_id % 100 = 0
),
positives AS (
    SELECT anchor_id, id, score FROM scores WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
)
SELECT p.anchor_id, p.id AS positive_id,
    CAST(row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY n.score DESC, n.id) AS INTEGER) AS rank,
    n.id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN scores n ON n.anchor_id = p.anchor_id AND NOT n.same
    AND 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY n.score DESC, n.id) <= 10
"""


def all_sql() -> dict[str, str]:
    """The others use trained models, hash bits, token ids or positions, which SQL can't express;
    their tests hold them against brute force."""
    return {
        "op4_decontamination": _DECONTAMINATION,
        "op5_embedding_near_dedup": _EMBEDDINGS,
        "op12_hard_negatives": _HARD_NEGATIVES,
    }
