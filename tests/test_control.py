from datetime import date, datetime

from pyspark.sql import functions as F

from newsvault.functions import date_lit, ts_lit
from newsvault.operators import control
from newsvault.sources import calendar
from tests.helpers import DAY1, DAY2, rows

T0, T1, T2, T3 = 20260101000000, 20260101001500, 20260101003000, 20260101004500


def empty(spark, name):
    return control.empty_control_tables(spark)[name]


def marks(spark, *pairs):
    done = spark.createDataFrame([(d, t, "r") for d, t in pairs],
                                 "dataset string, file_ts long, run_id string")
    return control.advance_watermarks(empty(spark, "ingestion_watermark"), done, ts_lit(DAY1))


def test_calendar(spark):
    got = calendar.feed_calendar(spark, 20260228233000, 20260301001500, "http://h.example")
    assert [r.file_ts for r in got.orderBy("file_ts").collect()] == [
        20260228233000, 20260228234500, 20260301000000, 20260301001500]
    assert got.orderBy("file_ts").first().url == \
        "http://h.example/20260228233000.gkg.csv.zip"
    assert calendar.feed_calendar(spark, T1, T0).count() == 0
    assert [r.file_ts for r in calendar.capped(got, 2).collect()] == [
        20260228233000, 20260228234500]


def test_watermark_default_and_reading(spark):
    stored = marks(spark, ("gkg", T1), ("gkg", T0))
    assert control.last_watermark(stored, "gkg") == T1
    assert control.last_watermark(stored, "other") == 0


def test_watermark_can_move_back_unless_monotonic(spark):
    stored = marks(spark, ("gkg", T3))
    done = spark.createDataFrame([("gkg", T1, "r2")],
                                 "dataset string, file_ts long, run_id string")
    back = control.advance_watermarks(stored, done, ts_lit(DAY2))
    assert control.last_watermark(back, "gkg") == T1
    kept = control.advance_watermarks(stored, done, ts_lit(DAY2), monotonic=True)
    assert control.last_watermark(kept, "gkg") == T3


def test_resolve_start(spark):
    asked = spark.createDataFrame(
        [("new", 0, None), ("old", 20250101000000, None), ("next", T3, None),
         ("forced", T3, T0)], "dataset string, watermark long, explicit_start long")
    got = {r.dataset: r.start_ts for r in control.resolve_start(asked).collect()}
    assert got == {"new": T0, "old": T0, "next": 20260101010000, "forced": T0}


def test_reset_keeps_the_run(spark):
    one = spark.createDataFrame([("gkg",)], "dataset string")
    row = control.reset_watermarks(marks(spark, ("gkg", T2)), one, ts_lit(DAY2)).first()
    assert (row.last_successful_file_ts, row.last_run_id) == (0, "r")


def test_run_lifecycle(spark):
    new = spark.createDataFrame([("r1", "gkg", 5)],
                                "run_id string, dataset string, max_files_per_run int")
    opened = control.open_runs(None, new, ts_lit(DAY1))
    assert opened.first().status == "running" and opened.first().ended_at is None
    step = spark.createDataFrame([("r1", "running", 3)],
                                 "run_id string, status string, files_detected int")
    midway = control.update_runs(opened, step, ts_lit(DAY2)).first()
    assert (midway.files_detected, midway.ended_at) == (3, None)
    end = spark.createDataFrame([("r1", "failed", "boom")],
                                "run_id string, status string, error_message string")
    closed = control.update_runs(opened, end, ts_lit(DAY2)).first()
    assert (closed.status, closed.error_message, closed.ended_at, closed.files_detected) == (
        "failed", "boom", datetime(2026, 1, 3), 0)


def test_file_ledger(spark):
    new = spark.createDataFrame(
        [("gkg", T0, "u0", "f0", "r1"), ("gkg", T1, "u1", "f1", "r1")],
        "dataset string, file_ts long, url string, filename string, run_id string")
    ledger = control.register_files(empty(spark, "ingestion_files"), new, ts_lit(DAY1))
    assert {r.status for r in ledger.collect()} == {"queued"}
    step = spark.createDataFrame([("gkg", T0, "downloading")],
                                 "dataset string, file_ts long, status string")
    started = control.update_files(ledger, step, ts_lit(DAY2)).where(f"file_ts = {T0}").first()
    assert started.download_started_at == datetime(2026, 1, 3)
    assert started.download_ended_at is None
    done = spark.createDataFrame([("gkg", T0, "downloaded", 77)],
                                 "dataset string, file_ts long, status string, bytes long")
    after = control.update_files(ledger, done, ts_lit(DAY2))
    assert [tuple(r)[:2] for r in control.files_by_status(after, "r1", "downloaded").collect()
            ] == [("gkg", T0)]
    again = control.register_files(after, new.withColumn("run_id", F.lit("r2")), ts_lit(DAY2))
    assert again.count() == 2
    row = again.where(f"file_ts = {T0}").first()
    assert (row.run_id, row.status, row.bytes) == ("r2", "queued", 77)
    assert row.inserted_at == datetime(2026, 1, 2)


def test_outcomes_and_results(spark):
    ticks = spark.createDataFrame([("gkg", t) for t in (T0, T1, T2, T3, 20260101010000,
                                                        20260101011500)],
                                  "dataset string, file_ts long")
    landed = spark.createDataFrame(
        [("gkg", T0, 4, 10, None), ("gkg", T1, 0, 10, None), ("gkg", T3, 0, 10, "broken")],
        "dataset string, file_ts long, matched_rows long, bytes long, error string")
    out = control.classify_files(ticks, landed, T3)
    got = [(r.file_ts, r.status, r.error_message) for r in out.orderBy("file_ts").collect()]
    assert got == [
        (T0, "downloaded", None), (T1, "skipped", "No AML themes found"),
        (T2, "skipped", "404 Not Found"), (T3, "failed", "broken"),
        (20260101010000, "skipped", "404 - Future date")]
    moved = control.moves_watermark(out)
    assert moved.agg(F.max("file_ts")).first()[0] == T2
    files = out.withColumn("run_id", F.lit("r"))
    result = control.run_results(files).first()
    assert (result.status, result.files_detected, result.files_selected,
            result.files_failed) == ("partial", 5, 1, 1)
    summary = control.run_summary(files).first()
    assert (summary.pct_with_data, summary.final_status) == (20.0, "partial")
    fine = control.run_results(files.where("status <> 'failed'")).first()
    assert fine.status == "success"
    marks = spark.createDataFrame([("gkg", T3), ("other", T0)], "dataset string, last_successful_file_ts long")
    gaps = control.feed_gaps(ticks, files, marks)
    assert rows(gaps) == [("gkg", T3)]


def test_days(spark):
    process = spark.createDataFrame([("daily",), ("other",)], "process_name string")
    closed = spark.createDataFrame([("daily", date(2026, 1, 31))],
                                   "process_name string, last_processed_date date")
    stored = control.close_days(empty(spark, "ai_insights_watermark"), closed, ts_lit(DAY1))
    days = control.next_days(stored, process)
    assert {r.process_name: r.next_day for r in days.collect()} == {
        "daily": date(2026, 2, 1), "other": date(2026, 1, 1)}
    due = lambda today, **o: days.where("process_name = 'daily'").select(
        control.is_due(F.col("next_day"), date_lit(today), **o)).first()[0]
    assert due("2026-02-01") and not due("2026-01-31")
    assert not due("2026-02-01", only_complete_days=True)
    behind = control.days_behind_by_process(stored, date_lit("2026-02-03")).first()
    assert behind.days_behind == 3


def test_calendars_of_several_datasets(spark):
    bounds = spark.sql("SELECT 'a' AS dataset, TIMESTAMP_NTZ'2026-01-01 00:00:00' AS start_at, "
                       "TIMESTAMP_NTZ'2026-01-01 00:30:00' AS end_at UNION ALL "
                       "SELECT 'b', TIMESTAMP_NTZ'2026-01-01 00:15:00', "
                       "TIMESTAMP_NTZ'2026-01-01 00:15:00'")
    got = calendar.dataset_calendars(bounds).select("dataset", "file_ts")
    assert rows(got) == [("a", T0), ("a", T1), ("a", T2), ("b", T1)]
    at = spark.sql("SELECT TIMESTAMP_NTZ'2026-01-01 00:44:59.5' AS t").select(
        calendar.tick_of(F.col("t")).alias("t")).first()["t"]
    assert at == datetime(2026, 1, 1, 0, 30)
