"""Weekly aggregates over an article stream: open weeks at once, late rows apart, no repeats.

A micro-batch may run twice when a driver or an executor is lost. Three things make that harmless:
the ledger keeps the week from which rows of a batch count, so a repeated batch routes its rows as
before; every stored group remembers the last batch that was added to it; and keys count as seen
only after their rows are stored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampNTZType

from newsvault.functions import ts_lit, utc_instant, week_start
from newsvault.operators.marts import WEEKLY_KEYS, increment_start
from newsvault.operators.merge import one_per_key, unseen
from newsvault.operators.moments import merged_moments, moments, moments_schema
from newsvault.schemas import WEEKLY_FACT
from newsvault.session import scratch_path
from newsvault.sinks.tables import (
    VersionedTable,
    append_table,
    drop_path,
    finish_upsert,
    materialize,
    read_table,
    upsert_partitions,
)
from newsvault.streaming.ingest import run_to_end

LEDGER = StructType([StructField("batch_id", LongType()), StructField("week_bound", StringType())])
SEEN = StructType([StructField("news_hkey", StringType())])
SOURCE_WEEKS = StructType([*moments_schema([StructField("week_date", TimestampNTZType()),
                                            StructField("source_domain", StringType())]).fields,
                           StructField("last_batch", LongType())])
SOURCE_KEYS = ["week_date", "source_domain"]


def drop_repeats(stream: DataFrame, key: str, event_time: str = "event_datetime",
                 delay: str = "7 days") -> DataFrame:
    """One row per key within the delay; state is bounded by the watermark.

    Watermarks take zoned times only, so the event time becomes the instant that shows the
    same clock in UTC. Rows older than the watermark are lost; ``WeeklyStream`` keeps them.
    """
    return (stream.withColumn(event_time, utc_instant(F.col(event_time)))
            .withWatermark(event_time, delay).dropDuplicatesWithinWatermark([key]))


def route_late(rows: DataFrame, bound: Column, event_time: str = "event_datetime"
               ) -> tuple[DataFrame, DataFrame]:
    """Rows of the bounding week or later, and older ones, which come too late."""
    return rows.where(F.col(event_time) >= bound), rows.where(F.col(event_time) < bound)


class BatchLedger:
    """The week bound of each of the last micro-batches, written before the batch changes anything."""

    def __init__(self, spark: SparkSession, path: str, keep: int = 100):
        self.table, self.keep = VersionedTable(spark, path, LEDGER), keep

    def bound(self, batch_id: int, newest: Callable[[], str | None]) -> str | None:
        """The bound of a batch: that of its first run if there was one, else ``newest()``."""
        rows = [tuple(r) for r in self.table.read().collect()]       # ``keep`` at most
        for done, week in rows:
            if done == batch_id:
                return week
        week = newest()
        last = sorted(rows)[-self.keep + 1:] + [(batch_id, week)]
        self.table.replace(self.table.spark.createDataFrame(last, LEDGER))
        return week


class WeeklyStream:
    """Week x source moments of an article stream, late rows and seen keys below one folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root
        self.ledger = BatchLedger(spark, f"{root}/ledger")

    def weeks(self) -> DataFrame | None:
        """The stored groups, open weeks included."""
        finish_upsert(self.spark, f"{self.root}/weeks", "week_date", SOURCE_WEEKS)
        return read_table(self.spark, f"{self.root}/weeks", SOURCE_WEEKS)

    def late(self, schema: StructType) -> DataFrame | None:
        """Rows that came too late, with the batch that brought them."""
        return read_table(self.spark, f"{self.root}/late",
                          StructType([*schema.fields, StructField("batch_id", LongType())]))

    def _newest_week(self) -> str | None:
        weeks = self.weeks()
        if weeks is None:
            return None
        return weeks.agg(F.max("week_date").cast("string").alias("w")).first()["w"]

    def take(self, batch: DataFrame, batch_id: int) -> None:
        """Adds one micro-batch: rows by news_hkey, event_datetime, source_domain, tone_overall."""
        spark, scratch = self.spark, scratch_path(self.spark, "weekly-batch")
        bound = self.ledger.bound(batch_id, self._newest_week)
        seen = read_table(spark, f"{self.root}/seen", SEEN)
        rows = materialize(unseen(one_per_key(batch, ["news_hkey"], ["event_datetime"]), seen, ["news_hkey"]), scratch)
        fresh, late = (rows, rows.limit(0)) if bound is None else route_late(rows, ts_lit(bound))
        (late.withColumn("batch_id", F.lit(batch_id).cast("long")).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(f"{self.root}/late"))
        self._add(moments(fresh.withColumn("week_date", week_start(F.col("event_datetime"))), SOURCE_KEYS,
                          "tone_overall", "source_domain"), batch_id)
        append_table(rows.select("news_hkey"), f"{self.root}/seen")
        drop_path(spark, scratch)

    def _add(self, delta: DataFrame, batch_id: int) -> None:
        """Merges new moments into their weeks; groups that have this batch already stay as they are."""
        stored, delta = self.weeks(), delta.withColumn("last_batch", F.lit(batch_id).cast("long"))
        if stored is not None:
            weeks = [r[0] for r in delta.select(F.col("week_date").cast("string")).distinct().collect()]
            old = stored.where(F.col("week_date").isin([ts_lit(w) for w in weeks]))
            done = old.where(F.col("last_batch") >= batch_id).select(*SOURCE_KEYS)
            delta = delta.join(done, SOURCE_KEYS, "left_anti")
            touched = old.join(delta.select(*SOURCE_KEYS), SOURCE_KEYS, "left_semi")
            delta = merged_moments(touched.unionByName(delta), SOURCE_KEYS) \
                .withColumn("last_batch", F.lit(batch_id).cast("long"))
        upsert_partitions(self.spark, f"{self.root}/weeks", delta.select(SOURCE_WEEKS.fieldNames()), SOURCE_KEYS,
                          "week_date", SOURCE_WEEKS)

    def run(self, stream: DataFrame, checkpoint: str) -> StreamingQuery:
        """Processes everything that has landed, batch by batch."""
        return run_to_end(stream, checkpoint, self.take)


def upsert_each_batch(spark: SparkSession, stream: DataFrame, path: str, checkpoint: str,
                      recompute: Callable[[DataFrame, Column], DataFrame]) -> StreamingQuery:
    """Streaming keyed upsert of the weekly fact, stored by week.

    ``recompute`` gets a batch and the newest stored week, and returns the fact's rows from there
    on; only their weeks are rewritten. Rows are absolute, so a repeated batch changes nothing.
    """
    def each_batch(batch: DataFrame, _: int) -> None:
        finish_upsert(spark, path, "week_date", WEEKLY_FACT)
        since = increment_start(read_table(spark, path, WEEKLY_FACT))
        upsert_partitions(spark, path, recompute(batch, since), WEEKLY_KEYS, "week_date", WEEKLY_FACT)
    return run_to_end(stream, checkpoint, each_batch)
