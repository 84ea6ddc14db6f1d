"""Layers as databases of the session's catalog, each table switched to its new rows at once.

A table's rows lie in files that are written once, under a name and in a folder of their own. What
readers see, `layer.name`, is a view over these; a refresh or an upsert writes new files first and
then replaces the view, one operation of the catalog. A reader has the old rows or the new
ones, whole; a run that fails before the switch changes nothing. Any session of the catalog sees
the tables.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from asthen.operators.history import keyed_upsert

# The property of a view that lists its parts.
PARTS = "asthen.parts"
# An upserted table of this many parts is written as one by the next upsert.
MOST_PARTS = 8


def _quoted(*names: str) -> str:
    return ".".join(f"`{n}`" for n in names)


class Warehouse:
    """Tables by layer and name. `root` is a folder that every executor reaches."""

    def __init__(self, spark: SparkSession, root: str, prefix: str = ""):
        self.spark, self.root, self.prefix = spark, root.rstrip("/"), prefix

    def exists(self, layer: str, name: str) -> bool:
        return self.spark.catalog.tableExists(f"{self.prefix}{layer}.{name}")

    def table(self, layer: str, name: str) -> DataFrame:
        return self.spark.table(_quoted(self.prefix + layer, name))

    def replace(self, df: DataFrame, layer: str, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
        """Replace the whole table; its columns may be others than before."""
        stored = self._store(df, layer, name, partition_by)
        return self._switch(layer, name, [{"table": stored, "columns": df.columns}], df.schema)

    def upsert(
        self, batch: DataFrame, layer: str, name: str, keys: Sequence[str], partition: str,
        since: Column | None = None,
    ) -> DataFrame:
        """Keyed upsert that writes the partitions the batch touches, as a new part of the table; the
        parts before it are read without these. The key must determine the partition, a date. `since`,
        a literal below every partition of the batch, spares finding them first: all from it on
        are then written. The table that was there keeps its files until `clean`."""
        if not self.exists(layer, name):
            return self.replace(batch, layer, name, [partition])
        target, parts = self.table(layer, name), self._parts(layer, name)
        kept = F.col(partition)
        if len(parts) >= MOST_PARTS:
            touched, condition = target, "false"
        elif since is not None:
            day = str(self.spark.range(1).select(since.cast("date")).first()[0])
            touched, condition = target.filter(kept >= since), f"(`{partition}` is null or `{partition}` < date'{day}')"
        else:
            found = [r[0] for r in batch.select(partition).distinct().collect()]  # calendar days
            days = [d for d in found if d is not None]
            listed = ", ".join(f"date'{d}'" for d in sorted(days)) or "date'0001-01-01'"
            touched = target.filter(kept.isin(days) | (kept.isNull() if None in found else F.lit(False)))
            outside = f"`{partition}` not in ({listed})"
            condition = f"(`{partition}` is not null and {outside})" if None in found else (
                f"(`{partition}` is null or {outside})")
        rows = keyed_upsert(touched, batch, keys)
        stored = self._store(rows, layer, name, [partition])
        if condition == "false":
            parts = []
        for part in parts:
            part["where"] = " and ".join(x for x in (part.get("where"), condition) if x)
        return self._switch(layer, name, [*parts, {"table": stored, "columns": rows.columns}], rows.schema)

    def view(self, layer: str, name: str, files: str, schema, partition_by: Sequence[str], where: str) -> DataFrame:
        """Some rows of files that others write: partitioned Parquet below a folder, by literal conditions."""
        self._database(layer)
        stored = f"{name}__files_{uuid.uuid4().hex[:12]}"
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        self.spark.sql(
            f"CREATE TABLE {_quoted(self.prefix + layer, stored)} ({fields}) USING parquet "
            f"PARTITIONED BY ({', '.join(partition_by)}) LOCATION '{files}'"
        )
        self.spark.sql(f"ALTER TABLE {_quoted(self.prefix + layer, stored)} RECOVER PARTITIONS")
        shown = [f.name for f in schema.fields if f.name not in partition_by]
        part = {"table": stored, "columns": shown, "where": where}
        return self._switch(layer, name, [part], schema, shown)

    def clean(self, layer: str, name: str) -> list[str]:
        """Drop the files no longer in the table, once no reader of an older state is left; their names."""
        used = {p["table"] for p in self._parts(layer, name)}
        names = [t.name for t in self.spark.catalog.listTables(f"`{self.prefix}{layer}`")]
        old = [n for n in names if n.startswith(f"{name}__") and n not in used]
        for n in old:
            self.spark.sql(f"DROP TABLE {_quoted(self.prefix + layer, n)}")
            folder = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{layer}/{n}")
            folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)
        return old

    def _database(self, layer: str) -> None:
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {_quoted(self.prefix + layer)} LOCATION '{self.root}/{layer}'")

    def _store(self, df: DataFrame, layer: str, name: str, partition_by: Sequence[str]) -> str:
        self._database(layer)
        stored = f"{name}__{uuid.uuid4().hex[:12]}"
        rows = df.hint("rebalance", *partition_by) if partition_by else df
        writer = rows.write.format("parquet").option("path", f"{self.root}/{layer}/{stored}")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.saveAsTable(_quoted(self.prefix + layer, stored))
        return stored

    def _parts(self, layer: str, name: str) -> list[dict]:
        shown = self.spark.sql(f"SHOW TBLPROPERTIES {_quoted(self.prefix + layer, name)}")
        return json.loads({r["key"]: r["value"] for r in shown.collect()}[PARTS])

    def _switch(self, layer: str, name: str, parts: list[dict], schema, shown: Sequence[str] | None = None) -> DataFrame:
        """Point the view at its parts: the one operation that changes what readers see."""
        selects = []
        for part in parts:
            # a part from before a column existed shows null
            columns = ", ".join(
                f"`{f.name}`" if f.name in part["columns"] else f"cast(null as {f.dataType.simpleString()}) as `{f.name}`"
                for f in schema.fields if shown is None or f.name in shown
            )
            where = f" WHERE {part['where']}" if part.get("where") else ""
            selects.append(f"SELECT {columns} FROM {_quoted(self.prefix + layer, part['table'])}{where}")
        text = json.dumps(parts).replace("\\", "\\\\").replace("'", "\\'")
        self.spark.sql(
            f"CREATE OR REPLACE VIEW {_quoted(self.prefix + layer, name)} "
            f"TBLPROPERTIES ('{PARTS}' = '{text}') AS {' UNION ALL '.join(selects)}"
        )
        return self.table(layer, name)
