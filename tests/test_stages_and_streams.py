import shutil
import zipfile
from datetime import datetime

from newsvault.operators import control, marts
from newsvault.operators.pruning import dated
from newsvault.plans.feed_drops import write_drop
from newsvault.plans.stages import Warehouse
from newsvault.schemas import (
    ARTICLE_FACT,
    DIM_COUNTRY,
    HUB_COUNTRY,
    HUB_NEWS,
    LINK_NEWS_COUNTRY,
    SAT_NEWS_TONE,
    STAGING,
    WEEKLY_FACT,
)
from newsvault.sinks.tables import read_table
from newsvault.streaming import ingest
from newsvault.streaming.weekly import WeeklyStream, drop_repeats, route_late
from newsvault.functions import ts_lit
from tests.helpers import DAY1, article, raw, raw_row, rows, staged

BODY = "<article>" + "fraud and more " * 20 + "</article>"


def land(folder, ts, *records):
    folder.mkdir(exist_ok=True)
    with zipfile.ZipFile(folder / f"{ts}.gkg.csv.zip", "w") as z:
        z.writestr("x.csv", "\n".join("\t".join(c or "" for c in r) for r in records))


def pages(spark, *urls):
    return spark.createDataFrame([(i, u, BODY) for i, u in enumerate(urls)],
                                 "page_id long, url string, html string")


def dim(spark):
    return spark.createDataFrame([("US", "United States", None, None, None, "NA", None),
                                  ("CA", "Canada", None, None, None, "NA", None)], DIM_COUNTRY)


def test_whole_chain_twice(spark, tmp_path):
    landed = tmp_path / "landed"
    other = raw_row(c0="z", c8="TAX")
    land(landed, 20260101000000, article("a", ts="20260101000000", url="u1"), other)
    land(landed, 20260101001500, other)
    (landed / "20260101003000.gkg.csv.zip").write_bytes(b"")
    land(landed, 20260101010000, article("b", ts="20260101010000", url="u2",
                                         locations="1#a#CA#", tone="-3,1,1,1,1,1,1"))
    house = Warehouse(spark, f"{tmp_path}/house", datetime(2026, 1, 1, 1, 5))
    checks = house.run_all(str(landed), "r1", pages(spark, "u1", "u2"), dim(spark))
    assert checks.where("failures > 0").count() == 0

    files = house.control("ingestion_files").read()
    got = [(r.file_ts, r.status, r.error_message) for r in files.orderBy("file_ts").collect()]
    assert got == [
        (20260101000000, "downloaded", None), (20260101001500, "skipped", "No AML themes found"),
        (20260101003000, "failed", "empty file"), (20260101004500, "skipped", "404 Not Found"),
        (20260101010000, "downloaded", None), (20260101011500, "skipped", "404 - Future date")]
    run = house.control("ingestion_runs").read().first()
    assert (run.status, run.files_detected, run.files_downloaded, run.files_failed) == (
        "partial", 6, 2, 1)
    marks = house.control("ingestion_watermark").read()
    assert control.last_watermark(marks, "gkg") == 20260101010000
    fact = house.table("fact_ai_news_insights", dated(ARTICLE_FACT))
    assert fact.count() == 2 and fact.where("event_date = DATE'2026-01-01'").count() == 2
    weekly = house.table("fact_countries", WEEKLY_FACT)
    assert {(r.country_name, r.article_count) for r in weekly.collect()} == {
        ("United States", 1), ("Canada", 1)}
    day = house.control("ai_insights_watermark").read().first()
    assert str(day.last_processed_date) == "2026-01-01"

    # Nothing new landed: the second run adds nothing and finds no day to process.
    again = Warehouse(spark, f"{tmp_path}/house", datetime(2026, 1, 1, 1, 10))
    again.run_all(str(landed), "r2", pages(spark, "u1", "u2"), dim(spark))
    assert again.table("hub_news", HUB_NEWS).count() == 2
    assert again.table("sat_news_tone", SAT_NEWS_TONE).count() == 2
    assert again.table("fact_ai_news_insights", ARTICLE_FACT).count() == 2

    # The next day brings one article and a repeat of an old file.
    land(landed, 20260101011500, article("c", ts="20260102010000", url="u3"))
    next_day = Warehouse(spark, f"{tmp_path}/house", datetime(2026, 1, 2, 2, 0))
    next_day.run_all(str(landed), "r3", pages(spark, "u3"), dim(spark))
    weekly = next_day.table("fact_countries", WEEKLY_FACT)
    assert {(r.country_name, r.article_count) for r in weekly.collect()} == {
        ("United States", 2), ("Canada", 1)}
    exported = spark.read.option("header", True).csv(f"{tmp_path}/house/export/fact_countries")
    assert exported.count() == 2
    next_day.reset_watermark()
    assert control.last_watermark(next_day.control("ingestion_watermark").read(), "gkg") == 0
    next_day.ingest(str(landed), "r4", max_files=1)
    assert next_day.control("ingestion_runs").read().where("run_id = 'r4'").first()[
        "files_detected"] == 1


def test_backfill_equals_day_by_day(spark, tmp_path):
    records = [article(f"n{i}", ts=f"2026010{1 + i % 3}120000", url=f"u{i}") for i in range(9)]
    facts = []
    for name, steps in (("days", [None] * 3), ("span", ["2026-01-03"])):
        house = Warehouse(spark, f"{tmp_path}/{name}", datetime(2026, 1, 5))
        ingest.load_vault(spark, staged(spark, *records), house.root)
        for last_day in steps:
            house.insights(pages(spark, *[f"u{i}" for i in range(5)]), last_day=last_day)
        facts.append(rows(house.table("fact_ai_news_insights", ARTICLE_FACT)
                          .drop("generated_at")))
        mark = house.control("ai_insights_watermark").read().first()
        assert str(mark.last_processed_date) == "2026-01-03"
    assert facts[0] == facts[1] and len(facts[0]) == 5


def test_complete_days_only(spark, tmp_path):
    house = Warehouse(spark, f"{tmp_path}/h", datetime(2026, 1, 1, 12))
    ingest.load_vault(spark, staged(spark, article("a", ts="20260101000000", url="u")),
                      house.root)
    assert house.insights(pages(spark, "u"), only_complete_days=True).count() == 0
    assert house.insights(pages(spark, "u")).first().saved == 1


def test_stream_equals_batch_and_reads_each_file_once(spark, tmp_path):
    landed, root = f"{tmp_path}/landed", f"{tmp_path}/vault"
    drops = [[article("a"), article("b", locations="1#x#CA#")],
             [article("b", locations="1#x#CA#"), article("c", locations=None)],
             [article("d", tone="9,9,9,9,9,9,9"), raw_row(c0="z", c8="TAX")]]
    seen = []
    for drop in drops:
        write_drop(raw(spark, *drop).coalesce(1), landed)
        stream = ingest.staged_stream(ingest.raw_stream(spark, landed, max_files=1),
                                      ts_lit(DAY1))
        query = ingest.stream_into_vault(stream, root, f"{tmp_path}/checkpoint")
        seen.append(sum(p["numInputRows"] for p in query.recentProgress))
    assert seen == [2, 2, 2]
    batch = f"{tmp_path}/batch"
    ingest.load_vault(spark, staged(spark, *[r for d in drops for r in d if r[0] != "z"]), batch)
    for name, schema in (("hub_news", HUB_NEWS), ("hub_country", HUB_COUNTRY),
                         ("link_news_country", LINK_NEWS_COUNTRY),
                         ("sat_news_tone", SAT_NEWS_TONE)):
        assert rows(read_table(spark, f"{root}/{name}", schema).drop("source_file")) == rows(
            read_table(spark, f"{batch}/{name}", schema))


def test_replayed_batch_adds_nothing(spark, tmp_path):
    src, root = staged(spark, article("a"), article("b")), f"{tmp_path}/v"
    for _ in range(2):
        ingest.load_vault(spark, src, root)
    assert read_table(spark, f"{root}/link_news_country", LINK_NEWS_COUNTRY).count() == 2


def test_repeats_on_a_stream(spark, tmp_path):
    landed = f"{tmp_path}/landed"
    write_drop(raw(spark, article("a"), article("a"), article("b")), landed)
    stream = drop_repeats(ingest.staged_stream(ingest.raw_stream(spark, landed), ts_lit(DAY1)),
                          "gkg_record_id")
    got = []
    ingest.run_to_end(stream, f"{tmp_path}/c",
                      lambda batch, _: got.extend(r.gkg_record_id for r in batch.collect()))
    assert sorted(got) == ["a", "b"]


ARTICLES = "news_hkey string, event_datetime timestamp_ntz, source_domain string, tone_overall double"


def articles(spark, *rows):
    return spark.createDataFrame([(k, datetime.fromisoformat(t), s, v) for k, t, s, v in rows], ARTICLES)


def stored(weekly):
    return sorted((str(r.week_date)[:10], r.source_domain, r.n, float(r.total), r.low, r.high, r.last_batch)
                  for r in weekly.weeks().collect())


def test_late_rows_of_a_batch(spark):
    src = articles(spark, ("a", "2026-01-05 00:00:00", "s", 1.0), ("b", "2026-01-04 23:59:59", "s", 1.0))
    fresh, late = route_late(src, ts_lit("2026-01-05 00:00:00"))
    assert [r.news_hkey for r in fresh.collect()] == ["a"] and [r.news_hkey for r in late.collect()] == ["b"]
    start = src.select(marts.increment_start(None).alias("s")).first()["s"]
    assert start == datetime(1900, 1, 1)


def test_weekly_stream_keeps_open_weeks_late_rows_and_no_repeats(spark, tmp_path):
    weekly = WeeklyStream(spark, f"{tmp_path}/w")
    weekly.take(articles(spark, ("a", "2026-01-06 10:00:00", "s", 1.0), ("a", "2026-01-06 09:00:00", "s", 2.0),
                         ("b", "2026-01-07 10:00:00", "t", -3.5)), 0)
    assert stored(weekly) == [("2026-01-05", "s", 1, 2.0, 2.0, 2.0, 0), ("2026-01-05", "t", 1, -3.5, -3.5, -3.5, 0)]
    # the open week grows, a new one begins, a repeat of long ago and a late row come
    second = articles(spark, ("c", "2026-01-11 23:00:00", "s", 4.0), ("d", "2026-03-02 00:00:00", "s", 5.0),
                      ("a", "2026-03-02 10:00:00", "s", 9.0), ("e", "2026-01-04 10:00:00", "s", 6.0))
    weekly.take(second, 1)
    want = [("2026-01-05", "s", 2, 6.0, 2.0, 4.0, 1), ("2026-01-05", "t", 1, -3.5, -3.5, -3.5, 0),
            ("2026-03-02", "s", 1, 5.0, 5.0, 5.0, 1)]
    assert stored(weekly) == want
    late = [(r.news_hkey, r.batch_id) for r in weekly.late(second.schema).collect()]
    assert late == [("e", 1)]


def test_replayed_weekly_batch_changes_nothing(spark, tmp_path, monkeypatch):
    """A batch is stopped at each of its steps and run again: rows, routes and sums are as without a stop."""
    first = articles(spark, ("a", "2026-01-06 10:00:00", "s", 1.0))
    batch = articles(spark, ("b", "2026-01-07 10:00:00", "s", 2.0), ("c", "2026-01-20 10:00:00", "s", 3.0),
                     ("d", "2025-12-01 10:00:00", "s", 4.0))
    whole = WeeklyStream(spark, f"{tmp_path}/whole")
    whole.take(first, 0)
    whole.take(batch, 1)
    for step in ("append_table", "drop_path", "none"):
        weekly = WeeklyStream(spark, f"{tmp_path}/{step}")
        weekly.take(first, 0)
        if step != "none":
            with monkeypatch.context() as m:
                def stop(*_, **__):
                    raise RuntimeError("lost")
                m.setattr(f"newsvault.streaming.weekly.{step}", stop)
                try:
                    weekly.take(batch, 1)
                except RuntimeError:
                    pass
        weekly.take(batch, 1)
        weekly.take(batch, 1)
        assert stored(weekly) == stored(whole)
        assert sorted(r.news_hkey for r in weekly.late(batch.schema).collect()) == ["d"]


def test_bad_archives_fail_alone_and_leave_no_rows(spark, tmp_path):
    """Damaged bytes, a damaged checksum, a password flag, no zip: each fails; others are taken."""
    landed = tmp_path / "landed"
    for k, ts in enumerate((20260101000000, 20260101001500, 20260101003000, 20260101004500)):
        land(landed, ts, *[article(f"n{k}_{i}", ts=str(ts), url=f"u{k}{i}") for i in range(40)])
    raw = {k: bytearray((landed / f"{t}.gkg.csv.zip").read_bytes()) for k, t in
           ((1, 20260101001500), (2, 20260101003000), (3, 20260101004500))}
    raw[1] = raw[1].replace(b"ECON", b"XCON")                 # stored member: the checksum is wrong
    raw[2][6] |= 1                                            # encrypted, in both headers
    raw[2][raw[2].index(b"PK\x01\x02") + 8] |= 1
    raw[3] = bytearray(b"PK\x03\x04 no archive")
    for k, ts in ((1, 20260101001500), (2, 20260101003000), (3, 20260101004500)):
        (landed / f"{ts}.gkg.csv.zip").write_bytes(bytes(raw[k]))
    with zipfile.ZipFile(landed / "20260101010000.gkg.csv.zip", "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("x.csv", "\n".join("\t".join(c or "" for c in article(f"d{i}", url=f"d{i}")) for i in range(4000)))
    whole = bytearray((landed / "20260101010000.gkg.csv.zip").read_bytes())
    whole[len(whole) // 2] ^= 0xFF
    (landed / "20260101010000.gkg.csv.zip").write_bytes(bytes(whole))
    # one tick landed twice
    (landed / "again").mkdir()
    land(landed / "again", 20260101000000, article("other", ts="20260101000000", url="v"))
    house = Warehouse(spark, f"{tmp_path}/house", datetime(2026, 1, 1, 1, 5))
    outcomes = {r.file_ts: r for r in house.ingest(str(landed), "r1").collect()}
    assert [outcomes[t].status for t in sorted(outcomes)][:5] == ["downloaded", "failed", "failed", "failed", "failed"]
    ledger = house.control("ingestion_files").read()
    assert ledger.count() == ledger.select("dataset", "file_ts").distinct().count() == len(outcomes)
    assert ledger.where("download_started_at is null").count() == 0
    staging = house.stage()
    assert staging.count() in (1, 40) and staging.select("source_file").distinct().count() == 1


def test_staging_reads_new_files_of_any_year(spark, tmp_path):
    landed = tmp_path / "landed"
    land(landed, 20261231234500, article("a", ts="20261231234500", url="u1"))
    house = Warehouse(spark, f"{tmp_path}/house", datetime(2027, 1, 1, 0, 10))
    assert house.stage().count() == 0
    house.ingest(str(landed), "r1", start_from=20261231234500)
    assert house.stage().count() == 1
    land(landed, 20270101001500, article("b", ts="20270101001500", url="u2"))
    house = Warehouse(spark, f"{tmp_path}/house", datetime(2027, 1, 1, 0, 20))
    house.ingest(str(landed), "r2")
    shutil.rmtree(tmp_path / "house/bronze/file_ts=20261231234500")     # not read again
    assert {r.gkg_record_id for r in house.stage().collect()} == {"a", "b"}
    assert house.stage(full=True).count() == 2


def test_files_taken_late_or_again_are_staged(spark, tmp_path, monkeypatch):
    """A tick that failed once and is taken below the mark comes through run_all, as does a new content."""
    landed = tmp_path / "landed"
    land(landed, 20260101000000, article("a", ts="20260101000000", url="u1"))
    (landed / "20260101001500.gkg.csv.zip").write_bytes(b"")
    land(landed, 20260101003000, article("c", ts="20260101003000", url="u3"))
    house = Warehouse(spark, f"{tmp_path}/house", datetime(2026, 1, 1, 0, 35))
    house.ingest(str(landed), "r1", max_files=3)
    assert house.stage().count() == 2
    land(landed, 20260101001500, article("b", ts="20260101001500", url="u2"))
    for later in ("insights", "weekly", "export", "check"):
        monkeypatch.setattr(house, later, lambda *_, **__: None)
    house.run_all(str(landed), "r2", None, None, start_from=20260101001500, max_files=1)
    assert {r.gkg_record_id for r in house.table("staging", STAGING).collect()} == {"a", "b", "c"}
    assert house.table("hub_news", HUB_NEWS).count() == 3
    land(landed, 20260101001500, article("b", ts="20260101001500", url="u2"), article("d", ts="20260101001500", url="u4"))
    house.ingest(str(landed), "r3", start_from=20260101001500, max_files=1)
    staged_now = house.stage()
    assert sorted(r.gkg_record_id for r in staged_now.collect()) == ["a", "b", "c", "d"]
