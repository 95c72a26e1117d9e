"""The whole chain over one warehouse folder, stage by stage.

Stages are plain functions in a fixed order; when they run is up to any scheduler. Every
stage can be repeated: data is written before its watermark, and all writes go by key.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, LongType, StringType, StructField, StructType

from newsvault.constants import DATASET, FEED_START_TS, MAX_FILES_PER_RUN
from newsvault.functions import date_lit, ts_lit
from newsvault.operators import control, enrich, marts, quality, staging
from newsvault.operators.lowest import add_lowest, read_lowest, stored_top_negative
from newsvault.operators.pruning import dated
from newsvault.schemas import (
    ARTICLE_FACT,
    HUB_COUNTRY,
    HUB_NEWS,
    LINK_NEWS_COUNTRY,
    RAW27,
    SAT_NEWS_TONE,
    STAGING,
    WEEKLY_FACT,
)
from newsvault.session import scratch_path
from newsvault.sinks.export import EXPORT_ORDER, export_csv
from newsvault.sinks.tables import (
    VersionedTable,
    append_by_day,
    append_table,
    drop_path,
    ensure_table,
    finish_upsert,
    materialize,
    read_or_empty,
    read_table,
    upsert_partitions,
    write_bronze,
)
from newsvault.sources.calendar import capped, feed_calendar
from newsvault.sources.feed_files import (
    accepted_lines,
    file_coverage,
    file_states,
    listed_files,
    read_zip_lines,
    rejected_lines,
    split_lines,
)
from newsvault.streaming.ingest import load_vault

STAGED_FILES = StructType([StructField("file_ts", LongType()), StructField("content", StringType())])
FEED_URL = "http://feed.example.com/v2"


class Warehouse:
    """Paths and tables below one root folder."""

    def __init__(self, spark: SparkSession, root: str, now: datetime | None = None):
        self.spark, self.root = spark, root.rstrip("/")
        self.now = now or datetime.now().replace(microsecond=0)

    @property
    def stamp(self) -> Column:
        return ts_lit(self.now)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def control(self, name: str) -> VersionedTable:
        return VersionedTable(self.spark, self.path(f"control/{name}"),
                              control.CONTROL_TABLES[name])

    def create_tables(self) -> None:
        """Creates the control tables, hubs and link that are not there yet."""
        for name in control.CONTROL_TABLES:
            self.control(name).ensure()
        for name, schema in (("hub_news", HUB_NEWS), ("hub_country", HUB_COUNTRY),
                             ("link_news_country", LINK_NEWS_COUNTRY)):
            ensure_table(self.spark, self.path(name), schema)

    def table(self, name: str, schema) -> DataFrame:
        return read_or_empty(self.spark, self.path(name), schema).select(schema.fieldNames())

    # Ingest -----------------------------------------------------------------------

    def ingest(self, landed: str, run_id: str, max_files: int = MAX_FILES_PER_RUN,
               start_from: int | None = None, base_url: str = FEED_URL) -> DataFrame:
        """Takes up to ``max_files`` ticks of landed zip files into bronze.

        One job reads, filters and writes all files; one more classifies the ticks. The
        watermark moves after the bronze write. Returns the outcomes.
        """
        spark, now_ts = self.spark, int(self.now.strftime("%Y%m%d%H%M%S"))
        runs, files = self.control("ingestion_runs"), self.control("ingestion_files")
        marks = self.control("ingestion_watermark")
        # A repeated run id replaces its ledger row.
        new_run = spark.createDataFrame(
            [(run_id, DATASET, max_files)],
            "run_id string, dataset string, max_files_per_run int")
        others = runs.read().where(F.col("run_id") != run_id)
        runs.replace(control.open_runs(others, new_run, self.stamp))

        mark = control.last_watermark(marks.read(), DATASET)
        asked = spark.createDataFrame([(DATASET, mark, start_from)],
                                      "dataset string, watermark long, explicit_start long")
        start = control.resolve_start(asked).first()["start_ts"]
        horizon = int((self.now + timedelta(minutes=15)).strftime("%Y%m%d%H%M%S"))
        if start > horizon:
            horizon = start
        ticks = (capped(feed_calendar(spark, start, horizon, base_url), max_files)
                 .select(F.lit(DATASET).alias("dataset"), "file_ts", "url", "filename"))

        started = self.now
        try:
            outcomes = self._take_files(landed, ticks, now_ts)
        except Exception as error:
            failed = spark.createDataFrame(
                [(run_id, control.RUN_FAILED, str(error))],
                "run_id string, status string, error_message string")
            runs.replace(control.update_runs(runs.read(), failed, self.stamp))
            raise
        ledger = control.register_files(
            files.read(), ticks.join(outcomes.select("dataset", "file_ts"),
                                     control.FILE_KEYS, "left_semi")
            .withColumn("run_id", F.lit(run_id)), self.stamp)
        begun = outcomes.select("dataset", "file_ts", F.lit(control.FILE_DOWNLOADING).alias("status"))
        ledger = control.update_files(ledger, begun, ts_lit(started))
        ledger = control.update_files(
            ledger, outcomes.select("dataset", "file_ts", "status", "bytes",
                                    "error_message"), self.stamp)
        files.replace(ledger)
        done = control.moves_watermark(outcomes).withColumn("run_id", F.lit(run_id))
        marks.replace(control.advance_watermarks(marks.read(), done, self.stamp))
        of_run = files.read().where(F.col("run_id") == run_id)
        runs.replace(control.update_runs(runs.read(), control.run_results(of_run),
                                         self.stamp))
        return outcomes

    def _take_files(self, landed: str, ticks: DataFrame, now_ts: int) -> DataFrame:
        spark = self.spark
        file_ts = F.regexp_extract("source_file", r"(\d{14})[^/]*$", 1).try_cast("long")
        # Only the days of this run are listed: at most the run's cap of ticks, not all that ever
        # landed. Of several archives of a tick the last by name is taken.
        days = [str(r[0]) for r in ticks.select(F.expr("file_ts div 1000000")).distinct().collect()]
        wanted = (listed_files(spark, landed, "*{" + ",".join(sorted(days)) + "}*.zip")
                  .withColumn("file_ts", file_ts)
                  .join(ticks.select("file_ts"), "file_ts", "left_semi")
                  .groupBy("file_ts").agg(F.max(F.struct("source_file", "bytes")).alias("f"))
                  .select("file_ts", "f.*"))
        # Names only, at most the run's cap of them, so that other archives stay unread.
        paths = [r.source_file for r in wanted.select("source_file").collect()]
        if not paths:
            none = wanted.limit(0).select(
                F.lit(DATASET).alias("dataset"), "file_ts", F.lit(0).alias("matched_rows"),
                "bytes", F.lit(None).cast("string").alias("error"))
            return materialize(control.classify_files(ticks, none, now_ts),
                               scratch_path(spark, "outcomes"))
        # Unpacking is the slow part; its result is written once and read three times.
        scratch = scratch_path(spark, "unzipped")
        read_zip_lines(spark, paths).withColumn("file_ts", file_ts).write.parquet(scratch)
        lines = spark.read.parquet(scratch)
        # A damaged archive fails as a whole: none of its rows are kept.
        broken = lines.where("error IS NOT NULL").select("file_ts").distinct()
        whole = lines.join(broken, "file_ts", "left_anti")
        matching = staging.theme_filter(split_lines(accepted_lines(whole), keep=["file_ts"]))
        # Lines that would lose their tail are kept whole, beside bronze; a tick replaces its own.
        (rejected_lines(whole).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("file_ts").parquet(self.path("rejects")))
        write_bronze(matching.select("file_ts", *RAW27.fieldNames()), self.path("bronze"))
        counts = matching.groupBy("file_ts").agg(F.count(F.lit(1)).alias("matched_rows"))
        errors = lines.groupBy("file_ts").agg(F.max("error").alias("error"))
        found = (wanted.join(errors, "file_ts", "left").join(counts, "file_ts", "left")
                 .select(F.lit(DATASET).alias("dataset"), "file_ts",
                         F.coalesce("matched_rows", F.lit(0)).alias("matched_rows"),
                         "bytes", F.when(F.col("bytes") == 0, "empty file")
                         .otherwise(F.col("error")).alias("error")))
        outcomes = materialize(control.classify_files(ticks, found, now_ts),
                               scratch_path(spark, "outcomes"))
        drop_path(spark, scratch)
        return outcomes

    def reset_watermark(self) -> None:
        marks = self.control("ingestion_watermark")
        one = self.spark.createDataFrame([(DATASET,)], "dataset string")
        marks.replace(control.reset_watermarks(marks.read(), one, self.stamp))

    # Staging and vault ------------------------------------------------------------

    def stage(self, since_file_ts: int | None = None, start_file_ts: int = FEED_START_TS,
              full: bool = False) -> DataFrame:
        """Bronze to staging: all feed files that are not staged as they are now.

        The ingest ledger says which files were taken and when, so bronze is never listed: a
        ledger of staged files holds each of them with its taking, and a file that comes late or
        anew is staged whatever its time. Staging is stored by feed file, so it replaces its own
        rows. The ledger is written after the rows. ``since_file_ts`` stages all files above a mark
        and ``full`` all files, from ``start_file_ts`` on.
        """
        spark, root = self.spark, self.path("bronze")
        ledger = VersionedTable(spark, self.path("control/staged_files"), STAGED_FILES)
        taking = F.concat_ws("/", "run_id", F.col("download_ended_at").cast("string"), F.col("bytes").cast("string"))
        wanted = (self.control("ingestion_files").read()
                  .where((F.col("dataset") == DATASET) & (F.col("status") == control.FILE_DOWNLOADED)
                         & (F.col("file_ts") >= start_file_ts))
                  .select("file_ts", taking.alias("content")))
        if since_file_ts is not None:
            wanted = wanted.where(F.col("file_ts") > since_file_ts)
        elif not full:
            wanted = wanted.join(ledger.read(), STAGED_FILES.fieldNames(), "left_anti")
        # Names only, as in _take_files; they are settled before bronze is read.
        found = [(r.file_ts, r.content) for r in wanted.collect()]
        if not found:
            return self.table("staging", STAGING)
        # A run of all files reads the whole folder; else the folders of the files, and no others.
        whole = full or since_file_ts is not None
        folders = [root] if whole else [f"{root}/file_ts={ts}" for ts, _ in found]
        bronze = (spark.read.schema(_with(RAW27, "file_ts", LongType())).option("basePath", root)
                  .option("sep", "\t").option("quote", "").option("ignoreCorruptFiles", True)
                  .option("ignoreMissingFiles", True).csv(folders)
                  .where((F.col("file_ts") >= start_file_ts) & (F.col("file_ts") > (since_file_ts or 0))))
        raw = bronze.select(*[c for c in bronze.columns if c.startswith("_c")],
                            F.col("_metadata.file_path").alias("source_file"))
        parsed = staging.parse(raw, self.stamp).withColumn(
            "file_ts", F.regexp_extract("source_file", r"file_ts=(\d+)", 1).cast("long"))
        self._note_skipped(folders)
        (parsed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("file_ts").parquet(self.path("staging")))
        done = spark.createDataFrame(found, STAGED_FILES)
        ledger.replace(ledger.read().join(done, "file_ts", "left_anti").unionByName(done))
        return self.table("staging", STAGING)

    def _note_skipped(self, folders: list[str]) -> None:
        """Keeps a list of the bronze files of these folders that were not read to their end; the stage
        goes on without them, and fails if not one file could be read."""
        spark, scratch = self.spark, scratch_path(self.spark, "states")
        states = materialize(file_states(listed_files(spark, folders, "*.csv"),
                                         file_coverage(spark, folders, "*.csv")), scratch)
        found = {r.state: r["count"] for r in states.groupBy("state").count().collect()}     # five states
        if set(found) - {"complete"}:
            append_table(states.where("state <> 'complete'").withColumn("seen_at", self.stamp),
                         self.path("skipped_files"))
        drop_path(spark, scratch)
        if not set(found) - {"unread", "empty"}:
            raise ValueError(f"no rows could be read from {self.path('bronze')}")

    def load_vault(self) -> None:
        load_vault(self.spark, self.table("staging", STAGING), self.root)

    # Insights ---------------------------------------------------------------------

    def insights(self, pages: DataFrame, build_scorer=None, last_day: str | None = None,
                 subjects: list[str] = enrich.SUBJECTS, only_complete_days: bool = False
                 ) -> DataFrame:
        """Scores the next day, or all days up to ``last_day`` as one job.

        The day mark moves after the article fact is written. Returns counts per day.
        """
        spark, marks = self.spark, self.control("ai_insights_watermark")
        process = spark.createDataFrame([(control.DEFAULT_PROCESS,)], "process_name string")
        first = control.next_days(marks.read(), process).first()["next_day"]
        limit = self.now.date() - timedelta(days=1 if only_complete_days else 0)
        last = min(datetime.fromisoformat(last_day).date() if last_day else first, limit)
        if first > last:
            return enrich.outcome_counts(
                enrich.judge(self._no_articles()))
        states = enrich.day_slice(self.table("sat_news_tone", dated(SAT_NEWS_TONE)),
                                  str(first), str(last))
        articles = enrich.with_page_text(states, pages)
        # A model's answers are kept as they come; the default scorer is a column expression.
        scored = (enrich.score_articles(articles, None, subjects) if build_scorer is None
                  else enrich.score_resumable(articles, self.path("responses"), build_scorer))
        # Scoring may be slow and must not run twice: rows are written, then counted.
        done = scratch_path(spark, "scored")
        scored.write.parquet(done)
        scored = spark.read.parquet(done)
        fact = read_table(spark, self.path("fact_ai_news_insights"), ARTICLE_FACT)
        new = marts.new_articles(enrich.insights(scored, self.stamp), fact)
        add_lowest(spark, self.path("lowest_by_day"), new)
        append_by_day(new, self.path("fact_ai_news_insights"))
        closed = process.withColumn("last_processed_date", date_lit(last))
        marks.replace(control.close_days(marks.read(), closed, self.stamp))
        return enrich.outcome_counts(scored)

    def most_negative(self, k: int, since: datetime | None = None) -> DataFrame:
        """The k most negative articles, ties by key."""
        fact = self.table("fact_ai_news_insights", dated(ARTICLE_FACT))
        return stored_top_negative(read_lowest(self.spark, self.path("lowest_by_day")), fact, k, since)

    def _no_articles(self) -> DataFrame:
        return self.spark.createDataFrame(
            [], _with(_with(SAT_NEWS_TONE, "article_text", StringType()),
                      "response", StringType()))

    # Weekly fact, export, checks --------------------------------------------------

    def weekly(self, dim: DataFrame, lookback_weeks: int = 0) -> DataFrame:
        """Recomputes from the newest stored week on and merges."""
        spark, path = self.spark, self.path("fact_countries")
        finish_upsert(spark, path, "week_date", WEEKLY_FACT)
        since = marts.increment_start(read_table(spark, path, WEEKLY_FACT), lookback_weeks)
        changed = marts.weekly_fact(
            self.table("fact_ai_news_insights", dated(ARTICLE_FACT)),
            self.table("link_news_country", LINK_NEWS_COUNTRY),
            self.table("hub_country", HUB_COUNTRY), dim, self.stamp, since,
            unique_articles=True)
        upsert_partitions(spark, path, changed, marts.WEEKLY_KEYS, "week_date", WEEKLY_FACT)
        return self.table("fact_countries", WEEKLY_FACT)

    def tables(self, dim: DataFrame) -> dict[str, DataFrame]:
        return {"hub_news": self.table("hub_news", HUB_NEWS),
                "hub_country": self.table("hub_country", HUB_COUNTRY),
                "link_news_country": self.table("link_news_country", LINK_NEWS_COUNTRY),
                "sat_news_tone": self.table("sat_news_tone", SAT_NEWS_TONE),
                "fact_ai_news_insights": self.table("fact_ai_news_insights", ARTICLE_FACT),
                "fact_countries": self.table("fact_countries", WEEKLY_FACT),
                "dim_country": dim}

    def export(self, dim: DataFrame) -> dict[str, int]:
        tables = self.tables(dim)
        return {name: export_csv(tables[name], self.path(f"export/{name}"), order)
                for name, order in EXPORT_ORDER.items()}

    def check(self, dim: DataFrame, strict: bool = False) -> DataFrame:
        results = quality.run_checks(self.tables(dim))
        return quality.enforce(results) if strict else results

    def run_all(self, landed: str, run_id: str, pages: DataFrame, dim: DataFrame,
                last_day: str | None = None, **ingest) -> DataFrame:
        """All stages in order; returns the check results."""
        self.create_tables()
        self.ingest(landed, run_id, **ingest)
        self.stage()
        self.load_vault()
        self.insights(pages, last_day=last_day)
        self.weekly(dim)
        self.export(dim)
        return self.check(dim)


def _with(schema: StructType, name: str, dtype: DataType) -> StructType:
    return StructType([*schema.fields, StructField(name, dtype)])
