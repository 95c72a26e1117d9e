"""The most negative articles of each day, stored beside the article fact.

A day's table has its ``keep`` lowest rows. The k lowest articles of whole days are among the days'
lowest, so a ranking reads ``keep`` rows a day and not the days themselves; rows of a part of a
day are read from the fact, and only those below the k-th value found so far.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from newsvault.functions import ts_lit
from newsvault.operators.marts import top_negative
from newsvault.operators.merge import one_per_key
from newsvault.operators.pruning import EVENT_DATE, dated, with_event_date
from newsvault.schemas import ARTICLE_FACT
from newsvault.session import scratch_path
from newsvault.sinks.tables import drop_path, materialize, read_table

KEEP = 100


def lowest_per_day(rows: DataFrame, keep: int = KEEP) -> DataFrame:
    """The ``keep`` most negative articles of each day, ties by key. Each task first keeps as many
    of its own rows a day, so a day that holds most rows moves few of them."""
    place = F.row_number().over(Window.partitionBy(EVENT_DATE).orderBy("tone_overall", "news_hkey"))
    usable = with_event_date(rows).where("tone_overall IS NOT NULL AND event_datetime IS NOT NULL")
    return usable.withColumn("_place", place).where(F.col("_place") <= keep).drop("_place")


def add_lowest(spark: SparkSession, path: str, new_rows: DataFrame, keep: int = KEEP) -> None:
    """Takes new articles into the days' tables; only their days are rewritten. Rows are merged by
    key, so adding them again changes nothing."""
    scratch = scratch_path(spark, "lowest")
    new = lowest_per_day(new_rows, keep)
    stored = read_table(spark, path, dated(ARTICLE_FACT))
    if stored is not None:
        days = new.select(EVENT_DATE).distinct()
        new = one_per_key(stored.join(days, EVENT_DATE, "left_semi").unionByName(new), ["news_hkey"],
                          ["event_datetime"])
        new = lowest_per_day(new.drop(EVENT_DATE), keep)
    merged = materialize(new, scratch)
    (merged.repartition(EVENT_DATE).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(EVENT_DATE).parquet(path))
    drop_path(spark, scratch)


def read_lowest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(dated(ARTICLE_FACT)).parquet(path)


def stored_top_negative(lows: DataFrame, fact: DataFrame, k: int, since: datetime | None = None,
                        keep: int = KEEP) -> DataFrame:
    """``marts.top_negative`` over the whole fact or from ``since`` on, mostly from the days' tables."""
    since_column = None if since is None else ts_lit(since)
    if k > keep:
        return top_negative(fact, k, since_column)
    if since is None:
        return top_negative(lows, k).select(ARTICLE_FACT.fieldNames())
    if since == datetime.combine(since.date(), datetime.min.time()):
        return top_negative(lows.where(F.col(EVENT_DATE) >= F.lit(since.date())), k).select(ARTICLE_FACT.fieldNames())
    # the first day counts from an hour on: its rows come from the fact, below the k-th value so far
    full = top_negative(lows.where(F.col(EVENT_DATE) > F.lit(since.date())), k)
    tones = [r.tone_overall for r in full.select("tone_overall").collect()]          # k at most
    first = with_event_date(fact.drop(EVENT_DATE)) if EVENT_DATE not in fact.columns else fact
    first = first.where((F.col(EVENT_DATE) == F.lit(since.date())) & (F.col("event_datetime") >= since_column))
    if len(tones) == k:
        first = first.where(F.col("tone_overall") <= max(tones))
    columns = ARTICLE_FACT.fieldNames()
    return top_negative(full.select(columns).unionByName(first.select(columns)), k)
