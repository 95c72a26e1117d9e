"""The 15-minute feed calendar as a distributed range."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsvault.constants import MAX_FILES_PER_RUN, TICK_MINUTES
from newsvault.functions.text import feed_file_name, feed_url
from newsvault.functions.times import compact_ts, ts_lit

_FORMAT = "%Y%m%d%H%M%S"


def feed_calendar(spark: SparkSession, start_ts: int, end_ts: int,
                  base_url: str | None = None) -> DataFrame:
    """One row per tick from start to end inclusive; any length, no driver loop."""
    start = datetime.strptime(str(start_ts), _FORMAT)
    end = datetime.strptime(str(end_ts), _FORMAT)
    ticks = max(0, int((end - start).total_seconds() // (TICK_MINUTES * 60)) + 1)
    step = F.make_dt_interval(mins=(F.col("id") * TICK_MINUTES).cast("int"))
    out = (spark.range(ticks)
           .select((ts_lit(start) + step).alias("tick_at"))
           .select(compact_ts(F.col("tick_at")).alias("file_ts"), "tick_at"))
    out = out.withColumn("filename", feed_file_name(F.col("file_ts")))
    return out.withColumn("url", feed_url(F.col("file_ts"), base_url)) if base_url else out


def capped(calendar: DataFrame, max_files: int = MAX_FILES_PER_RUN) -> DataFrame:
    """The oldest ``max_files`` ticks: the per-run cap of the ingest."""
    return calendar.orderBy("file_ts").limit(max_files)


def dataset_calendars(bounds: DataFrame) -> DataFrame:
    """Every tick of every dataset, from rows of (dataset, start_at, end_at)."""
    step = F.expr(f"INTERVAL {TICK_MINUTES} MINUTES")
    return (bounds.select("dataset", F.explode(F.sequence("start_at", "end_at", step))
                          .alias("tick_at"))
            .select("dataset", compact_ts(F.col("tick_at")).alias("file_ts"), "tick_at"))


def tick_of(ts: Column) -> Column:
    """Start of the tick a time falls into."""
    minutes = F.minute(ts) - F.minute(ts) % TICK_MINUTES
    hour = F.date_trunc("hour", ts).cast("timestamp_ntz")
    return hour + F.make_dt_interval(mins=minutes)
