"""File-series ingest and incremental vault load as streams."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from newsvault.operators import vault
from newsvault.operators.merge import unseen
from newsvault.operators.staging import parse, theme_filter
from newsvault.schemas import (
    HUB_COUNTRY,
    HUB_NEWS,
    LINK_NEWS_COUNTRY,
    RAW27,
    SAT_NEWS_TONE,
)
from newsvault.session import scratch_path
from newsvault.sinks.tables import append_by_day, append_table, drop_path, materialize, read_table
from newsvault.sources.feed_files import with_source_file


def raw_stream(spark: SparkSession, path: str, max_files: int | None = None,
               name_glob: str | None = None) -> DataFrame:
    """New feed files as they land, at most ``max_files`` per micro-batch.

    The checkpoint of the query is the file ledger: each file is taken once.
    """
    reader = (spark.readStream.schema(RAW27).option("sep", "\t").option("header", False)
              .option("quote", "").option("mode", "PERMISSIVE"))
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if name_glob:
        reader = reader.option("pathGlobFilter", name_glob)
    return with_source_file(reader.csv(path))


def staged_stream(raw: DataFrame, load_datetime: Column) -> DataFrame:
    return parse(theme_filter(raw), load_datetime)


def load_vault(spark: SparkSession, staged: DataFrame, root: str) -> None:
    """Adds one batch of staging rows to the four vault tables.

    Every table takes only unseen keys, so a batch that is replayed after a lost driver
    or executor adds nothing twice.
    """
    loads = [
        ("hub_news", HUB_NEWS, vault.hub_news(staged), ["news_hkey"]),
        ("hub_country", HUB_COUNTRY, vault.hub_country(staged), ["country_hkey"]),
        ("link_news_country", LINK_NEWS_COUNTRY, vault.link_news_country(staged),
         ["news_country_hkey"]),
        ("sat_news_tone", SAT_NEWS_TONE, vault.sat_news_tone(staged),
         ["news_hkey", "hashdiff"]),
    ]
    for name, schema, rows, keys in loads:
        target = read_table(spark, f"{root}/{name}", schema)
        if target is not None:      # read twice: once for the keys to look for, once for the rows
            scratch = scratch_path(spark, name)
            rows = unseen(materialize(rows, scratch), target, keys)
        append = append_by_day if name == "sat_news_tone" else append_table
        append(rows.select(*schema.fieldNames()), f"{root}/{name}")
        if target is not None:
            drop_path(spark, scratch)


def run_to_end(stream: DataFrame, checkpoint: str,
               each_batch: Callable[[DataFrame, int], None]) -> StreamingQuery:
    """Processes everything that has landed, batch by batch, then stops."""
    query = (stream.writeStream.option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).foreachBatch(each_batch).start())
    query.awaitTermination()
    return query


def stream_into_vault(staged: DataFrame, root: str, checkpoint: str) -> StreamingQuery:
    """Streaming vault load: the batch load, once per micro-batch."""
    def each_batch(batch: DataFrame, _: int) -> None:
        # The four loads read the batch; keep it so the files are parsed once.
        batch.persist()
        try:
            load_vault(batch.sparkSession, batch, root)
        finally:
            batch.unpersist()
    return run_to_end(staged, checkpoint, each_batch)
