"""Table sinks: full refresh, partition upsert, appended batches, and a versioned type-2 history.

All paths belong to a file system every executor reaches; losing executors costs retried
tasks. Each table keeps its schema beside its files, so no read opens files to learn one and a
table without rows has its columns. Only the type-2 history publishes a run at once; a
refresh or an upsert replaces files in place, and one that failed half-way is run again.
"""

from __future__ import annotations

import json
import tempfile
import uuid
from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from asthen.operators.history import keyed_upsert, scd2_changes, scd2_first_load, with_new_columns


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _fs(spark, path)
    return fs.exists(hadoop_path)


# Beside a table's files; readers skip names that begin with an underscore.
SCHEMA_FILE = "_schema"


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, file = _fs(spark, path)
    out = fs.create(file, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def _read_text(spark: SparkSession, path: str) -> str | None:
    fs, file = _fs(spark, path)
    if not fs.exists(file):
        return None
    stream = fs.open(file)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def save_schema(spark: SparkSession, path: str, schema: T.StructType) -> None:
    _write_text(spark, f"{path}/{SCHEMA_FILE}", schema.json())


def stored_schema(spark: SparkSession, path: str) -> T.StructType | None:
    text = _read_text(spark, f"{path}/{SCHEMA_FILE}")
    return T.StructType.fromJson(json.loads(text)) if text else None


def newest_partition(spark: SparkSession, path: str, column: str) -> date | None:
    """The greatest date among a table's partitions, from their names alone."""
    fs, folder = _fs(spark, path)
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    values = [n.split("=", 1)[1] for n in names if n.startswith(f"{column}=")]
    return max((date.fromisoformat(v) for v in values if v[:1].isdigit()), default=None)


def work_dir(spark: SparkSession) -> str:
    """A new folder in the shared one the cluster names in spark.checkpoint.dir."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder all executors reach")
        shared = tempfile.mkdtemp(prefix="asthen-")
    return f"{shared.rstrip('/')}/{uuid.uuid4().hex}"


def table_path(root: str, layer: str, name: str) -> str:
    return f"{root}/{layer}/{name}"


def _write(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    # rebalance: one file per small partition, several for a large one
    rows = df.hint("rebalance", *partition_by) if partition_by else df
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "static")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def refresh(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Replace the whole table."""
    _write(df, path, partition_by)
    save_schema(df.sparkSession, path, df.schema)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A table with the schema it was last written with; columns that older files lack are null."""
    schema = stored_schema(spark, path)
    if schema is None:  # written by others
        return spark.read.option("mergeSchema", True).parquet(path)
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def append_batch(df: DataFrame, path: str, batch: int, partition_by: Sequence[str]) -> None:
    """Add a numbered batch to a table; writing the same number again replaces it."""
    folder = f"{path}/batch={batch}"
    refresh(df, folder, partition_by)


def read_batches(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def upsert(
    batch: DataFrame, path: str, keys: Sequence[str], partition: str,
    since: Column | None = None, target: DataFrame | None = None,
) -> DataFrame:
    """Keyed upsert that rewrites only the partitions the batch touches; the new table.

    The key must determine the partition. Rows of a touched partition whose key is not
    in the batch are carried over: overwriting the partition with the batch alone would
    lose keys that no longer have source rows. `since`, a literal below every partition
    of the batch, spares finding the touched partitions first; `target`, the table as
    read before, spares reading its schema again.
    """
    spark = batch.sparkSession
    rows = batch
    if target is None and exists(spark, path):
        target = read_table(spark, path)
    if target is not None:
        if since is None:
            # One value per touched partition, i.e. calendar days: small enough to
            # collect, and as literals they prune the scan of the target.
            days = [r[0] for r in batch.select(partition).distinct().collect()]
            is_touched = F.col(partition).isin([d for d in days if d is not None])
            touched = target.filter(is_touched | F.col(partition).isNull() if None in days else is_touched)
        else:
            touched = target.filter(F.col(partition) >= since)
        rows = keyed_upsert(touched, batch, keys)
    (
        rows.hint("rebalance", partition)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition)
        .parquet(path)
    )
    if target is None or target.schema != rows.schema:
        save_schema(spark, path, rows.schema)
    return spark.read.schema(rows.schema).parquet(path).select(*rows.columns)


class HistoryTable:
    """Type-2 history on storage, of which a run writes what changed.

    Keys are spread over buckets by hash. v=N/open=1/bucket=b holds the bucket's versions open
    after run N, for buckets in which run N changed something; v=N/open=0 holds the versions run N
    closed. The history at N is the newest open=1 of each bucket plus v<=N/open=0. A run compares
    keys and change times first, and then reads and writes whole rows of the changed buckets
    only. The schema file of v=N, written after its rows and its list of buckets, publishes
    it; a run that failed before is repeated into the same folder.
    """

    BUCKETS_FILE = "_buckets"

    def __init__(self, spark: SparkSession, path: str, key: str, updated_at: str, buckets: int = 64):
        """`buckets` counts at the first run; a table keeps the number it began with."""
        self.spark, self.path, self.key, self.updated_at, self.buckets = spark, path, key, updated_at, buckets

    def version(self) -> int | None:
        """Newest committed run."""
        fs, folder = _fs(self.spark, self.path)
        if not fs.exists(folder):
            return None
        runs = [str(s.getPath()) for s in fs.listStatus(folder)]
        done = [int(r.rsplit("=", 1)[1]) for r in runs if exists(self.spark, f"{r}/{SCHEMA_FILE}")]
        return max(done, default=None)

    def _written(self, version: int) -> list[int]:
        """For each bucket, the run that last wrote its open versions."""
        return json.loads(_read_text(self.spark, f"{self.path}/v={version}/{self.BUCKETS_FILE}"))

    def _rows(self, version: int) -> DataFrame:
        """All files, with the columns of a run; columns are only ever added."""
        schema = T.StructType([*stored_schema(self.spark, f"{self.path}/v={version}").fields])
        schema = schema.add("v", T.IntegerType())
        return self.spark.read.schema(schema).parquet(self.path).select(*schema.names)

    def _newest(self, version: int, buckets: Sequence[int] | None = None) -> str:
        """The condition on a run's open versions, of some buckets or all: literals, so scans prune
        folders."""
        by_run: dict[int, list[int]] = {}
        for bucket, run in enumerate(self._written(version)):
            if buckets is None or bucket in buckets:
                by_run.setdefault(run, []).append(bucket)
        of_run = [f"(v = {run} and bucket in ({', '.join(map(str, some))}))" for run, some in by_run.items()]
        return f"(open = 1 and ({' or '.join(of_run) or 'false'}))"

    def _open(self, version: int, buckets: Sequence[int] | None = None) -> DataFrame:
        return self._rows(version).filter(self._newest(version, buckets)).drop("v", "open")

    def files(self) -> tuple[T.StructType, tuple[str, ...], str]:
        """What a catalog needs to show the newest run: all columns, the partitions, the condition."""
        version = self.version()
        condition = f"{self._newest(version)} or (open = 0 and v <= {version})"
        return self._rows(version).schema, ("v", "open", "bucket"), condition

    def read(self) -> DataFrame:
        version = self.version()
        if version is None:
            raise FileNotFoundError(f"no committed run at {self.path}")
        return self._rows(version).filter(self.files()[2]).drop("v", "open", "bucket")

    def _changed(self, version: int, source: DataFrame) -> list[int]:
        """Buckets where a key is new, gone or has a newer change time; keys and times alone move."""
        old = self._open(version).select(F.col(self.key).alias("_old"), F.col("valid_from").alias("_from"),
                                         F.col("bucket").alias("_bucket"))
        new = source.select(F.col(self.key).alias("_new"), F.col(self.updated_at).alias("_at"), "bucket")
        both = old.join(new, F.col("_old") == F.col("_new"), "full_outer")
        differs = F.col("_bucket").isNull() | F.col("bucket").isNull() | (F.col("_at") > F.col("_from"))
        touched = both.filter(differs).select(F.coalesce("bucket", "_bucket")).distinct()
        return sorted(r[0] for r in touched.collect())  # a line for each bucket at most

    def snapshot(self, source: DataFrame, as_of: Column) -> int:
        """Take one snapshot of the source; returns the run it committed."""
        version = self.version()
        count = self.buckets if version is None else len(self._written(version))
        bucket = F.pmod(F.xxhash64(self.key), F.lit(count)).cast("int")
        source = source.withColumn("bucket", bucket)
        if version is None:
            run, written = 0, [0] * count
            versions = scd2_first_load(source, self.key, self.updated_at)
        else:
            run, changed = version + 1, self._changed(version, source)
            written = [run if b in changed else r for b, r in enumerate(self._written(version))]
            still_open = with_new_columns(self._open(version, changed), source)
            versions = scd2_changes(
                still_open, source.filter(F.col("bucket").isin(changed)), self.key, self.updated_at, as_of
            )
        versions = versions.withColumn("open", F.col("valid_to").isNull().cast("int"))
        folder = f"{self.path}/v={run}"
        if run in written:
            _write(versions, folder, ["open", "bucket"])
        elif exists(self.spark, folder):  # left by a run that failed
            fs, leftover = _fs(self.spark, folder)
            fs.delete(leftover, True)
        _write_text(self.spark, f"{folder}/{self.BUCKETS_FILE}", json.dumps(written))
        save_schema(self.spark, folder, versions.schema)
        return run

    def expire(self, keep: int = 2) -> None:
        """Delete open versions that none of the newest `keep` runs reads; what runs closed stays."""
        if keep < 1:
            raise ValueError("the newest run's open versions are the table; keep at least 1")
        newest = self.version()
        if newest is None:
            return
        oldest = max(newest - keep + 1, 0)
        needed = {(r, b) for n in range(oldest, newest + 1) for b, r in enumerate(self._written(n))}
        for run in range(oldest):
            fs, folder = _fs(self.spark, f"{self.path}/v={run}/open=1")
            for status in fs.listStatus(folder) if fs.exists(folder) else []:
                if (run, int(status.getPath().getName().split("=")[1])) not in needed:
                    fs.delete(status.getPath(), True)
