"""Parquet tables: replace, append, partition upsert and versioned replace."""

from __future__ import annotations

import json
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from newsvault.operators.merge import append_synced, last_per_key
from newsvault.operators.pruning import EVENT_DATE, with_event_date
from newsvault.session import scratch_path


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Full replace. The frame must not read from the same path (see VersionedTable)."""
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def append_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    writer = df.write.mode("append")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def append_by_day(df: DataFrame, path: str) -> None:
    """Adds event rows below their day.

    Rows are gathered by day first, so a task writes few files; adaptive execution splits
    a day that holds most rows and merges small ones.
    """
    append_table(with_event_date(df).hint("rebalance", EVENT_DATE), path, [EVENT_DATE])


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int, path: str | None = None) -> None:
    """Catalog table hashed and sorted by a join key: later joins on it need no shuffle.

    Rows are dealt to the buckets first, so each bucket is one sorted file. ``path`` names a folder
    for the files outside the warehouse.
    """
    writer = df.repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key).sortBy(key).format("parquet")
    (writer.option("path", path) if path else writer).saveAsTable(table)


def write_bronze(df: DataFrame, path: str) -> None:
    """Theme-filtered rows as TSV, one folder per feed file; empty files leave none.

    Only the folders of the given files are replaced, so taking a file again is safe.
    """
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("file_ts").option("sep", "\t").option("header", False).option("quote", "").option("escape", "")
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .option("emptyValue", "").csv(path))


def materialize(df: DataFrame, path: str) -> DataFrame:
    """The frame as a written table: cuts the lineage and survives lost executors."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_path(spark: SparkSession, path: str) -> None:
    """Removes a scratch folder of this package."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether the folder holds a finished write."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    return bool(fs.exists(target)) and any(
        not s.getPath().getName().startswith("_temporary") for s in fs.listStatus(target))


def read_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame | None:
    """The table, or None before its first write."""
    return spark.read.schema(schema).parquet(path) if path_exists(spark, path) else None


def read_or_empty(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    found = read_table(spark, path, schema)
    return spark.createDataFrame([], schema) if found is None else found


def ensure_table(spark: SparkSession, path: str, schema: StructType) -> None:
    """Creates an empty table when there is none."""
    if not path_exists(spark, path):
        spark.createDataFrame([], schema).write.parquet(path)


def upsert_partitions(spark: SparkSession, path: str, updates: DataFrame, keys: list[str],
                      partition: str, schema: StructType) -> None:
    """Merges rows into a partitioned table, rewriting only the touched partitions.

    The touched partition values are few (the recomputed weeks) and become a literal list,
    so the scan of the old rows is pruned to them. Moving the partitions in place is not atomic,
    so the merged rows are first written whole to ``<path>__pending``; a later call finds what a
    stopped one left there and finishes its move before it reads anything (``finish_upsert``).
    """
    finish_upsert(spark, path, partition, schema)
    scratch = scratch_path(spark, "updates")
    updates = materialize(last_per_key(updates, keys), scratch)
    stored = read_table(spark, path, schema)
    merged = updates
    if stored is not None:
        touched = [r[0] for r in updates.select(F.col(partition).cast("string"))
                   .distinct().collect()]
        old = stored.where(F.col(partition).isin(
            [F.lit(v).cast(schema[partition].dataType) for v in touched]))
        merged = (old.join(updates.select(*keys), keys, "left_anti")
                  .select(*updates.columns).unionByName(updates))
    merged.write.mode("overwrite").parquet(f"{path}__pending")
    drop_path(spark, scratch)
    finish_upsert(spark, path, partition, schema)


def finish_upsert(spark: SparkSession, path: str, partition: str, schema: StructType) -> None:
    """Moves the merged rows of an upsert that was stopped, if there are any, into place.

    They replace whole partitions, so doing it twice changes nothing.
    """
    pending = f"{path}__pending"
    done = spark._jvm.org.apache.hadoop.fs.Path(f"{pending}/_SUCCESS")
    if done.getFileSystem(spark._jsc.hadoopConfiguration()).exists(done):
        (spark.read.schema(schema).parquet(pending)
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(partition).parquet(path))
        drop_path(spark, pending)


class EvolvingTable:
    """A table whose columns change over time; old files are never rewritten.

    Rows lie in a folder for each schema version, and the versions in a small table of their
    own. Reading puts all rows into the newest columns: those that an older version lacks are
    NULL, those that are gone are left out, and changed types are cast. One writer at a time.
    """

    VERSIONS = StructType([StructField("version", IntegerType()), StructField("columns", StringType())])

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.ledger = VersionedTable(spark, f"{self.path}/schemas", self.VERSIONS)

    def versions(self) -> list[tuple[int, StructType]]:
        """All versions, oldest first."""
        return sorted(((r.version, StructType.fromJson(json.loads(r.columns)))
                       for r in self.ledger.read().collect()), key=lambda v: v[0])

    def ensure(self, schema: StructType) -> int:
        """Creates the table if there is none, takes up new columns, and returns the version in force."""
        known = self.versions()
        shape = [(f.name, f.dataType) for f in schema.fields]
        if known and [(f.name, f.dataType) for f in known[-1][1].fields] == shape:
            return known[-1][0]
        rows = [(v, s.json()) for v, s in known] + [(len(known) + 1, schema.json())]
        self.ledger.replace(self.spark.createDataFrame(rows, self.VERSIONS))
        return len(rows)

    def append(self, df: DataFrame) -> None:
        append_table(df, f"{self.path}/rows/version={self.ensure(df.schema)}")

    def read(self) -> DataFrame:
        """All rows in the newest columns."""
        known = self.versions()
        if not known:
            raise ValueError(f"there is no table at {self.path}")
        out = self.spark.createDataFrame([], known[-1][1])
        for version, schema in known:
            rows = read_table(self.spark, f"{self.path}/rows/version={version}", schema)
            if rows is not None:
                out = append_synced(rows, out) if rows.schema != out.schema else rows.unionByName(out)
        return out


class VersionedTable:
    """A small table replaced as a whole while it is being read.

    Every write goes to a new folder; the newest folder with a job success marker is the
    table. A crash leaves the previous version in force. One writer at a time.
    """

    def __init__(self, spark: SparkSession, path: str, schema: StructType):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema

    def _fs(self):
        root = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        return root.getFileSystem(self.spark._jsc.hadoopConfiguration()), root

    def versions(self) -> list[str]:
        fs, root = self._fs()
        if not fs.exists(root):
            return []
        path_type = self.spark._jvm.org.apache.hadoop.fs.Path
        names = [s.getPath().getName() for s in fs.listStatus(root)]
        return sorted(n for n in names if n.startswith("v")
                      and fs.exists(path_type(f"{self.path}/{n}/_SUCCESS")))

    def read(self) -> DataFrame:
        found = self.versions()
        if not found:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/{found[-1]}")

    def ensure(self) -> None:
        """An empty first version when there is none."""
        if not self.versions():
            self.replace(self.spark.createDataFrame([], self.schema))

    def replace(self, df: DataFrame, keep: int = 3) -> DataFrame:
        """Writes a new version, forgets all but the last ``keep``, returns the table."""
        number = max(time.time_ns(), int(self.versions()[-1][1:]) + 1 if self.versions() else 0)
        df.select(*[F.col(f.name).cast(f.dataType) for f in self.schema.fields]).write.parquet(
            f"{self.path}/v{number:020d}")
        fs, _ = self._fs()
        path_type = self.spark._jvm.org.apache.hadoop.fs.Path
        for old in self.versions()[:-keep]:
            fs.delete(path_type(f"{self.path}/{old}"), True)
        return self.read()
