"""Watermarks and ledgers over sets of files, runs and datasets.

Control tables are small, yet every operator works on whole sets: one job registers,
classifies or closes any number of files, with no loop on the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from newsvault.constants import (
    DAY_PROCESS_NAME,
    FEED_START_DATE,
    FEED_START_TS,
    FILE_DOWNLOADED,
    FILE_DOWNLOADING,
    FILE_FAILED,
    FILE_QUEUED,
    FILE_SKIPPED,
    MSG_FUTURE,
    MSG_MISSING,
    MSG_NO_THEMES,
    RUN_FAILED,
    RUN_FINAL_STATES,
    RUN_PARTIAL,
    RUN_RUNNING,
    RUN_SUCCESS,
)
from newsvault.functions import date_lit, day_coverage, next_tick, percent
from newsvault.operators.merge import partial_update, upsert
from newsvault.schemas import (
    DAY_WATERMARK,
    INGESTION_FILES,
    INGESTION_RUNS,
    INGESTION_WATERMARK,
)

CONTROL_TABLES: dict[str, StructType] = {
    "ingestion_watermark": INGESTION_WATERMARK,
    "ingestion_runs": INGESTION_RUNS,
    "ingestion_files": INGESTION_FILES,
    "ai_insights_watermark": DAY_WATERMARK,
}
FILE_KEYS = ["dataset", "file_ts"]


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Columns in schema order and type; missing ones NULL."""
    have = set(df.columns)
    return df.select(*[(F.col(f.name) if f.name in have else F.lit(None))
                       .cast(f.dataType).alias(f.name) for f in schema.fields])


def empty_control_tables(spark: SparkSession) -> dict[str, DataFrame]:
    return {n: spark.createDataFrame([], s) for n, s in CONTROL_TABLES.items()}


# Watermarks ---------------------------------------------------------------------------

def last_watermarks(watermarks: DataFrame, datasets: DataFrame) -> DataFrame:
    """(dataset, watermark) for every dataset asked for; 0 where none is stored."""
    stored = watermarks.groupBy("dataset").agg(
        F.max("last_successful_file_ts").alias("watermark"))
    return (datasets.select("dataset").join(stored, "dataset", "left")
            .select("dataset", F.coalesce("watermark", F.lit(0)).alias("watermark")))


def last_watermark(watermarks: DataFrame, dataset: str) -> int:
    """The watermark of one dataset as a number; 0 where none is stored."""
    row = (watermarks.where(F.col("dataset") == dataset)
           .agg(F.coalesce(F.max("last_successful_file_ts"), F.lit(0)).alias("w")).first())
    return int(row["w"])


def resolve_start(watermarks: DataFrame, floor: int = FEED_START_TS) -> DataFrame:
    """Adds ``start_ts``: explicit start, else the floor for an old mark, else the next tick.

    Takes rows with ``watermark`` and, optionally, ``explicit_start``.
    """
    mark = F.col("watermark")
    start = F.when(mark < floor, F.lit(floor)).otherwise(next_tick(mark))
    if "explicit_start" in watermarks.columns:
        start = F.coalesce(F.col("explicit_start"), start)
    return watermarks.withColumn("start_ts", start.cast("long"))


def advance_watermarks(watermarks: DataFrame, done: DataFrame, now: Column,
                       monotonic: bool = False) -> DataFrame:
    """Watermark table after the files in ``done`` (dataset, file_ts, run_id).

    The newest file of a dataset wins, even below the stored mark, unless ``monotonic``.
    """
    last = F.max(F.struct("file_ts", "run_id")).alias("_last")
    updates = done.groupBy("dataset").agg(last).select(
        "dataset", F.col("_last.file_ts").alias("last_successful_file_ts"),
        now.alias("updated_at"), F.col("_last.run_id").alias("last_run_id"))
    if monotonic:
        old = watermarks.select("dataset", F.col("last_successful_file_ts").alias("_old"))
        updates = (updates.join(old, "dataset", "left")
                   .where("_old IS NULL OR last_successful_file_ts > _old").drop("_old"))
    return upsert(watermarks, conform(updates, INGESTION_WATERMARK), ["dataset"])


def reset_watermarks(watermarks: DataFrame, datasets: DataFrame, now: Column) -> DataFrame:
    """Watermark table with the given datasets set to 0, run id kept."""
    kept = watermarks.select("dataset", "last_run_id")
    updates = (datasets.select("dataset").distinct().join(kept, "dataset", "left")
               .withColumns({"last_successful_file_ts": F.lit(0), "updated_at": now}))
    return upsert(watermarks, conform(updates, INGESTION_WATERMARK), ["dataset"])


# Runs ---------------------------------------------------------------------------------

def open_runs(runs: DataFrame | None, new: DataFrame, now: Column) -> DataFrame:
    """Run ledger with the runs in ``new`` (run_id, dataset, max_files_per_run) added."""
    rows = new.withColumns({
        "started_at": now, "catalog_snapshot_at": now, "status": F.lit(RUN_RUNNING),
        **{c: F.lit(0) for c in ("files_detected", "files_selected", "files_downloaded",
                                 "files_failed")}})
    rows = conform(rows, INGESTION_RUNS)
    return rows if runs is None else runs.unionByName(rows)


def update_runs(runs: DataFrame, updates: DataFrame, now: Column) -> DataFrame:
    """Run ledger with the given fields changed; a final state stamps the end."""
    ended = F.when(F.col("new_status").isin(RUN_FINAL_STATES), now).otherwise(
        F.col("ended_at"))
    return partial_update(runs, updates, ["run_id"], {"ended_at": ended})


def run_results(files: DataFrame) -> DataFrame:
    """Final state and counters per run from the file ledger.

    ``files_selected`` repeats the downloaded count, as ledgers of this layout do.
    """
    failed = F.count_if(F.col("status") == FILE_FAILED)
    downloaded = F.count_if(F.col("status") == FILE_DOWNLOADED)
    return files.groupBy("run_id").agg(
        final_status(failed).alias("status"),
        F.count(F.lit(1)).cast("int").alias("files_detected"),
        downloaded.cast("int").alias("files_selected"),
        downloaded.cast("int").alias("files_downloaded"),
        failed.cast("int").alias("files_failed"))


def final_status(failed: Column, run_error: Column | None = None) -> Column:
    """failed on a run error, partial when a file failed, else success."""
    status = F.when(failed > 0, RUN_PARTIAL).otherwise(RUN_SUCCESS)
    return status if run_error is None else F.when(
        run_error.isNotNull(), RUN_FAILED).otherwise(status)


def run_summary(files: DataFrame, saved: DataFrame | None = None) -> DataFrame:
    """Per run: files, files with data, share, failures, days covered, rows saved.

    ``saved`` is (dataset, file_ts, rows) from the bronze data; the ledger has no row
    counts.
    """
    rows = files
    if saved is not None:
        rows = files.join(saved.select(*FILE_KEYS, F.col("rows").alias("_rows")),
                          FILE_KEYS, "left")
    aggs = [F.count(F.lit(1)).alias("files_processed"),
            F.count_if(F.col("status") == FILE_DOWNLOADED).alias("files_with_data"),
            F.count_if(F.col("status") == FILE_FAILED).alias("files_failed")]
    if saved is not None:
        aggs.append(F.coalesce(F.sum("_rows"), F.lit(0)).alias("rows_saved"))
    return (rows.groupBy("run_id").agg(*aggs)
            .withColumns({
                "pct_with_data": percent(F.col("files_with_data"), F.col("files_processed")),
                "days_covered": day_coverage(F.col("files_processed")),
                "final_status": final_status(F.col("files_failed"))}))


# Files --------------------------------------------------------------------------------

def register_files(files: DataFrame, new: DataFrame, now: Column) -> DataFrame:
    """File ledger with ``new`` (dataset, file_ts, url, filename, run_id) queued.

    A known file keeps its other fields; only run, state and stamp change.
    """
    status = F.col("status") if "status" in new.columns else F.lit(FILE_QUEUED)
    arriving = new.select(*FILE_KEYS, "url", "filename", "run_id", status.alias("status"))
    updates = arriving.select(*FILE_KEYS, "run_id", "status").withColumn("updated_at", now)
    fresh = (arriving.join(files.select(*FILE_KEYS), FILE_KEYS, "left_anti")
             .withColumns({"inserted_at": now, "updated_at": now}))
    return (partial_update(files, updates, FILE_KEYS)
            .unionByName(conform(fresh, INGESTION_FILES)))


def update_files(files: DataFrame, updates: DataFrame, now: Column) -> DataFrame:
    """File ledger after state changes (status, bytes?, checksum?, error_message?)."""
    status = F.col("new_status")
    return partial_update(files, updates, FILE_KEYS, {
        "updated_at": now,
        "download_started_at": F.when(status == FILE_DOWNLOADING, now)
        .otherwise(F.col("download_started_at")),
        "download_ended_at": F.when(status.isin(FILE_DOWNLOADED, FILE_FAILED), now)
        .otherwise(F.col("download_ended_at"))})


def files_by_status(files: DataFrame, run_id: str, status: str) -> DataFrame:
    return (files.where((F.col("run_id") == run_id) & (F.col("status") == status))
            .select(*FILE_KEYS, "url", "filename", "status", "bytes", "checksum",
                    "error_message")
            .orderBy("file_ts"))


def classify_files(ticks: DataFrame, landed: DataFrame, now_ts: int) -> DataFrame:
    """Outcome of every tick of a run.

    ``ticks`` is (dataset, file_ts); ``landed`` is (dataset, file_ts, matched_rows, bytes,
    error). The first missing tick after ``now_ts`` ends the run: it is reported, later
    ones are not processed.
    """
    found = landed.select(*FILE_KEYS, "matched_rows", "bytes", "error",
                          F.lit(True).alias("_landed"))
    seen = ticks.join(found, FILE_KEYS, "left")
    missing = F.col("_landed").isNull()
    future = missing & (F.col("file_ts") > now_ts)
    judged = seen.select(
        *FILE_KEYS, "bytes", "matched_rows", future.alias("_future"),
        F.when(missing, FILE_SKIPPED)
        .when(F.col("error").isNotNull(), FILE_FAILED)
        .when(F.col("matched_rows") > 0, FILE_DOWNLOADED)
        .otherwise(FILE_SKIPPED).alias("status"),
        F.when(future, MSG_FUTURE).when(missing, MSG_MISSING)
        .when(F.col("error").isNotNull(), F.col("error"))
        .when(F.col("matched_rows") > 0, F.lit(None))
        .otherwise(MSG_NO_THEMES).alias("error_message"))
    # One row per dataset comes to the driver, so the ticks of one dataset need not meet in a join.
    stops = judged.where("_future").groupBy("dataset").agg(F.min("file_ts").alias("stop")).collect()
    after = F.lit(False)
    for r in stops:
        after = after | (F.col("dataset").eqNullSafe(F.lit(r.dataset)) & (F.col("file_ts") > r.stop))
    return (judged.where(~after)
            .select(*FILE_KEYS, "status", "bytes", "matched_rows", "error_message"))


def moves_watermark(outcomes: DataFrame) -> DataFrame:
    """Outcomes that advance the mark: everything but failures and the future stop."""
    return outcomes.where(
        (F.col("status") != FILE_FAILED)
        & ~F.col("error_message").eqNullSafe(F.lit(MSG_FUTURE)))


def feed_gaps(ticks: DataFrame, files: DataFrame, marks: DataFrame) -> DataFrame:
    """Ticks up to their dataset's watermark that were never fetched or failed: retry candidates.

    ``marks`` is (dataset, last_successful_file_ts); a dataset without a mark has no gaps.
    """
    fine = files.where(F.col("status").isin(FILE_DOWNLOADED, FILE_SKIPPED))
    newest = marks.groupBy("dataset").agg(F.max("last_successful_file_ts").alias("_mark"))
    return (ticks.join(newest, "dataset").where("file_ts <= _mark").drop("_mark")
            .join(fine.select(*FILE_KEYS), FILE_KEYS, "left_anti"))


# Days ---------------------------------------------------------------------------------

def next_days(day_marks: DataFrame, processes: DataFrame,
              first_day: str = FEED_START_DATE) -> DataFrame:
    """(process_name, next_day): the day after the last closed one."""
    last = day_marks.groupBy("process_name").agg(F.max("last_processed_date").alias("_d"))
    return (processes.select("process_name").join(last, "process_name", "left")
            .select("process_name",
                    F.coalesce(F.date_add("_d", 1), date_lit(first_day)).alias("next_day")))


def is_due(next_day: Column, today: Column, only_complete_days: bool = False) -> Column:
    """Whether a day may be processed; today counts unless only complete days do."""
    return next_day < today if only_complete_days else next_day <= today


def close_days(day_marks: DataFrame, closed: DataFrame, now: Column) -> DataFrame:
    """Day marks after closing ``closed`` (process_name, last_processed_date)."""
    rows = closed.groupBy("process_name").agg(
        F.max("last_processed_date").alias("last_processed_date")).withColumn(
            "updated_at", now)
    return upsert(day_marks, conform(rows, DAY_WATERMARK), ["process_name"])


def days_behind_by_process(day_marks: DataFrame, today: Column) -> DataFrame:
    return day_marks.select("process_name", "last_processed_date", "updated_at",
                            F.date_diff(today, "last_processed_date").alias("days_behind"))


DEFAULT_PROCESS = DAY_PROCESS_NAME
