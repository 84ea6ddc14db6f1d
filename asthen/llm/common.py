"""What the operators of this subpackage share: tables, shared storage, connected components."""

from __future__ import annotations

import tempfile
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder in `spark.checkpoint.dir`; where it is unset (tests), a folder of this process."""
    folder = spark.conf.get("spark.checkpoint.dir", "")
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="llm-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def stored(df: DataFrame) -> DataFrame:
    """`df` written to the shared folder and read again: later jobs start from the files, so a
    lost executor costs no recomputation and no Python pass runs twice."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _star(edges: DataFrame) -> DataFrame:
    """One large-star and one small-star step. Minima are aggregated before any row moves to its
    neighbour, so a vertex with many edges is summed in the map tasks."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    least = least.select("a", F.least("a", "m").alias("m"))
    large = (
        both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    )
    down = large.where("a != b").distinct()  # a > b
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    joined = down.join(least, "a")
    small = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", "m"))
    return small.where("a != b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(vertex, component) for every vertex with an edge; the component is its smallest vertex.

    `edges` has two long columns; loops, repeated and reversed edges and nulls do no harm. Stars
    are rewired until every vertex hangs on its component's least one; each round is stored.
    """
    a, b = edges.columns
    edges = stored(
        edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
        .where("a > b")
        .distinct()
    )
    seen = None
    while True:
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == seen or not now[0]:
            break
        seen, edges = now, stored(_star(edges))
    vertices = edges.select(F.col("a").alias("vertex"), F.col("b").alias("component"))
    roots = edges.select(F.col("b").alias("vertex"), F.col("b").alias("component")).distinct()
    return vertices.union(roots)
