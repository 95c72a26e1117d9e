"""Every operator as a query over the demonstration tables.

Each entry takes (spark, folder of the tables) and returns a frame over whole tables.
Queries about writes, files and streams put their data below the shared folder.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsvault.constants import FALLBACK_ABSTRACT, MAX_FILES_PER_RUN
from newsvault.functions import (
    compact_ts,
    date_lit,
    feed_file_name,
    feed_url,
    keep_if_longer,
    next_tick,
    pg_array_size,
    squish,
    theme_match,
    ts_lit,
    two_decimals,
    week_start,
)
from newsvault.operators import control, enrich, marts, merge, moments, quality, staging, vault
from newsvault.operators.lowest import add_lowest, read_lowest, stored_top_negative
from newsvault.operators.numbering import with_position
from newsvault.operators.pruning import dated
from newsvault.plans import event_feed as feed
from newsvault.plans.feed_drops import (
    cut_archive,
    put_file,
    tsv_line,
    write_drop,
    write_zip_drop,
    write_zip_lines,
)
from newsvault.schemas import (
    ARTICLE_FACT,
    HUB_COUNTRY,
    HUB_NEWS,
    LINK_NEWS_COUNTRY,
    SAT_NEWS_TONE,
    STAGING,
    WEEKLY_FACT,
)
from newsvault.session import scratch_path
from newsvault.sinks import export as exports
from newsvault.sinks.tables import (
    EvolvingTable,
    VersionedTable,
    append_by_day,
    append_table,
    drop_path,
    materialize,
    read_or_empty,
    read_table,
    upsert_partitions,
    write_bronze,
    write_bucketed,
    write_table,
)
from newsvault.sources import calendar, feed_files, tables
from newsvault.streaming import ingest as stream_ingest
from newsvault.streaming import weekly as stream_weekly

Query = Callable[[SparkSession, str], DataFrame]

BASE_URL = "http://feed.example.com/v2"
DOC_SUBJECTS = ["secret", "password", "license", "contact"]
PAGE_SUBJECTS = ["money", "bank", "the"]


def _l1():
    return ts_lit(feed.LOAD_TIME)


def _l2():
    return ts_lit(feed.SECOND_LOAD_TIME)


# Building blocks ----------------------------------------------------------------------

def _staging_table(spark: SparkSession, d: str) -> DataFrame:
    """Staging as a written table, for queries that read it several times.

    Parsing text is the dear part; it is done once, and each reader then scans only its
    columns.
    """
    return materialize(feed.staged(spark, d), scratch_path(spark, "staging"))


def _states(staged: DataFrame) -> DataFrame:
    """Rows that can become articles, straight from staging."""
    return (staged.where("source_url IS NOT NULL AND tone_overall IS NOT NULL "
                         "AND event_datetime IS NOT NULL")
            .withColumn("news_hkey", vault.hash_key(F.col("gkg_record_id"))))


def _fact(staged: DataFrame, stamp) -> DataFrame:
    abstract = F.concat(F.lit(FALLBACK_ABSTRACT), two_decimals(F.col("tone_overall")))
    rows = marts.article_rows(_states(staged), abstract, stamp)
    return marts.new_articles(rows, None)


def _weekly(spark: SparkSession, d: str, fact: DataFrame | None = None, **options
            ) -> DataFrame:
    staged = _staging_table(spark, d)
    fact = _fact(staged, _l1()) if fact is None else fact
    return marts.weekly_fact(fact, vault.link_news_country(staged),
                             vault.hub_country(staged), feed.dim_country(spark, d), _l1(),
                             unique_articles=True, **options)


def _field_view(raw: DataFrame) -> DataFrame:
    return raw.select(F.col("_c0").alias("record_id"), F.col("_c1").alias("event_text"),
                      F.col("_c3").alias("source_domain"), F.col("_c4").alias("source_url"),
                      F.col("_c8").alias("themes"), F.col("_c9").alias("locations_raw"),
                      F.col("_c15").alias("tone_raw"))


# Sources, staging ---------------------------------------------------------------------

def bronze_theme_filter(spark, d):
    return _field_view(feed.bronze_feed(spark, d))


def stg_parse(spark, d):
    return feed.staged(spark, d).select(
        "gkg_record_id", "event_datetime", "source_domain", "source_url",
        *staging.TONE_PARTS, "word_count", "load_datetime")


def stg_countries(spark, d):
    text = staging.with_pg_countries(feed.staged(spark, d))
    return text.select("gkg_record_id", "countries",
                       pg_array_size(F.col("countries")).alias("n_countries"))


def stg_load_stats(spark, d):
    return staging.load_statistics(feed.staged(spark, d))


def pg_array_explode(spark, d):
    return vault.news_countries_from_text(staging.with_pg_countries(feed.staged(spark, d)))


def tsv_scan(spark, d):
    path = scratch_path(spark, "tsv")
    write_drop(feed.raw_feed(spark, d), path)
    return _field_view(feed_files.read_tsv(spark, path))


def zip_tsv_scan(spark, d):
    path = scratch_path(spark, "zip")
    write_zip_drop(feed.raw_feed(spark, d), path)
    return _field_view(staging.theme_filter(feed_files.read_zip(spark, path)))


def tsv_width_check(spark, d):
    path = scratch_path(spark, "width")
    write_drop(feed.raw_feed(spark, d), path)
    checked = feed_files.check_width(feed_files.read_lines(spark, path))
    return checked.groupBy("fields", "width_ok").agg(F.count(F.lit(1)).alias("n"))


def rejected_lines(spark, d):
    """Archives with lines of 26 and of 28 fields: what fits goes on, the others are kept whole."""
    path = scratch_path(spark, "rejects")
    raw = feed.raw_feed(spark, d, ["event_id"])
    width = F.col("event_id") % 50
    value = F.when(width == 1, tsv_line(26)).when(width == 2, tsv_line(28)).otherwise(tsv_line())
    write_zip_lines(raw.select(value.alias("value")), path)
    lines = materialize(feed_files.read_zip_lines(spark, path), f"{path}-lines")
    good = feed_files.split_lines(feed_files.accepted_lines(lines, allow_short=False))
    bad = feed_files.rejected_lines(lines, allow_short=False)
    none = F.lit(None).cast("string")
    return good.select(F.lit("accepted").alias("route"), F.col("_c0").alias("record_id"), F.lit(27).alias("fields"),
                       none.alias("reason"), F.lit(True).alias("placed")).unionByName(
        bad.select(F.lit("rejected").alias("route"), F.substring_index("line", "\t", 1).alias("record_id"), "fields",
                   "reason", ((F.col("line_no") > 0) & F.col("source_file").isNotNull()).alias("placed")))


def damaged_archives(spark, d):
    """Good archives beside one that is no zip, one whose stream is cut and an empty one: lines and errors."""
    path = scratch_path(spark, "archives")
    write_zip_drop(feed.raw_feed(spark, d), path)
    for name, content in (("none", b"no archive"), ("empty", b""), ("cut", cut_archive(["a\tb"] * 1000))):
        put_file(spark, f"{path}/damaged-{name}.zip", content)
    found = feed_files.archive_outcomes(feed_files.listed_files(spark, path, "*.zip"),
                                        feed_files.read_zip_lines(spark, path))
    kind = F.regexp_extract("source_file", r"damaged-([a-z]+)\.zip$", 1)
    return found.groupBy(kind.alias("kind"), F.regexp_extract("error", "^[^:]+", 0).alias("error")).agg(
        F.sum("n_lines").alias("n_lines"))


def skipped_files(spark, d):
    """Delivered files by day, an empty one and one that ends inside a line: state and lines of each."""
    path = scratch_path(spark, "coverage")
    raw = feed.raw_feed(spark, d, ["event_id", "ts"])
    (raw.select(tsv_line().alias("value"), F.date_format("ts", "yyyyMMdd").alias("day"))
     .write.partitionBy("day").text(f"{path}/kind=good"))
    few = raw.where("event_id < 3").agg(F.array_join(F.sort_array(F.collect_list(tsv_line())), "\n").alias("value"))
    few.write.option("lineSep", "\x01").text(f"{path}/kind=cut")         # no newline at the end
    spark.range(0).select(F.lit("").alias("value")).write.text(f"{path}/kind=empty")
    states = feed_files.file_states(feed_files.listed_files(spark, path, "*.txt"),
                                    feed_files.file_coverage(spark, path, "*.txt"))
    folder = (lambda name, what: F.regexp_extract("source_file", f"{name}=({what})/", 1))
    return states.groupBy(folder("kind", "[a-z]+").alias("kind"), folder("day", "[0-9]+").alias("day"), "state").agg(
        F.sum("n_lines").alias("n_lines"))


def file_provenance(spark, d):
    path = scratch_path(spark, "bronze")
    by_day = feed.bronze_feed(spark, d, ["ts"]).withColumn(
        "file_ts", F.date_format("ts", "yyyyMMdd000000").cast("long")).drop("ts")
    write_bronze(by_day, path)
    rows = feed_files.read_tsv(spark, path)
    folder = F.regexp_extract("source_file", r"file_ts=(\d+)", 1)
    return rows.groupBy(F.lit("bronze").alias("kind")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("source_file").isNotNull()).alias("with_source"),
        F.count_distinct(folder).alias("n_folders"))


def seed_dim_scan(spark, d):
    path = scratch_path(spark, "seed")
    none = F.lit(None).cast("string")
    dim = feed.dim_country(spark, d).select(
        "country_code", "country_name", none.alias("capital_city"),
        none.alias("capital_latitude"), none.alias("capital_longitude"), "continent",
        none.alias("region"))
    dim.write.option("header", True).csv(path)
    registry = tables.TableRegistry(spark)
    registry.add_view("gold", "dim_country", tables.read_seed(spark, path))
    return registry.table("gold", "dim_country").select("country_code", "country_name",
                                                        "continent")


# Vault --------------------------------------------------------------------------------

def hub_news(spark, d):
    return vault.hub_news(feed.staged(spark, d))


def hub_country(spark, d):
    return vault.hub_country(feed.staged(spark, d))


def link_news_country(spark, d):
    return vault.link_news_country(feed.staged(spark, d))


def sat_news_tone(spark, d):
    return vault.sat_news_tone(feed.staged(spark, d))


def _loaded(spark, rows: DataFrame) -> DataFrame:
    """The rows of one load, parsed and hashed once, as a load finds and leaves them."""
    return materialize(rows, scratch_path(spark, "load"))


def _after_two_loads(build, keys, schema):
    def run(spark, d):
        target, arriving = (_loaded(spark, build(staged)) for staged in (feed.staged_first(spark, d),
                                                                         feed.staged_second(spark, d)))
        return (target.unionByName(merge.unseen(arriving, target, keys))
                .select(*schema.fieldNames()))
    return run


def sat_increment(spark, d):
    target = _loaded(spark, vault.sat_news_tone(feed.staged_first(spark, d)))
    arriving = _loaded(spark, vault.sat_news_tone(feed.staged_changed(spark, d)))
    return target.unionByName(vault.unseen_states(arriving, target, "news_hkey"))


def vault_customer_hub(spark, d):
    src = feed.table(spark, d, "customer").withColumn("load_datetime", _l1())
    return vault.hub(src, "c_custkey", "customer_hkey", "crm")


def vault_orders_link(spark, d):
    src = feed.table(spark, d, "orders").withColumn("load_datetime", _l1())
    return vault.link(src, {"order_hkey": "o_orderkey", "customer_hkey": "o_custkey"},
                      "order_customer_hkey", "shop")


def vault_orders_sat(spark, d):
    src = feed.table(spark, d, "orders").withColumn("load_datetime", _l1())
    return vault.satellite(src, "o_orderkey", "order_hkey",
                           ["o_orderstatus", "o_totalprice", "o_orderpriority"],
                           ["o_orderstatus", "o_totalprice"], "shop")


# Facts --------------------------------------------------------------------------------

def article_fact(spark, d):
    rows = _fact(feed.staged(spark, d), _l1())
    return merge.append_synced(marts.empty_article_fact(spark), rows)


def insert_if_absent(spark, d):
    target = _loaded(spark, _fact(feed.staged_first(spark, d), _l1()))
    arriving = _loaded(spark, _fact(feed.staged_second(spark, d), _l2()))
    return target.unionByName(marts.new_articles(arriving, target))


def curated_articles(spark, d):
    staged = _staging_table(spark, d)
    return marts.curated_articles(
        _fact(staged, _l1()), vault.link_news_country(staged), vault.hub_country(staged),
        feed.dim_country(spark, d))


def weekly_country_fact(spark, d):
    return _weekly(spark, d)


def weekly_dedup_country(spark, d):
    return _weekly(spark, d, dedupe_country=True)


def _late_weekly(lookback: int):
    def run(spark, d):
        early = feed.bronze_feed(spark, d, ["ts", "event_type"]).where(
            (F.col("ts") < ts_lit(feed.SECOND_LOAD_FROM))
            & (F.col("event_type") != "purchase"))
        first = staging.parse(early, _l1())
        stored = materialize(_weekly(spark, d, _fact(first, _l1())),
                             scratch_path(spark, "weekly"))
        since = marts.increment_start(stored, lookback)
        changed = _weekly(spark, d, since=since)
        return marts.merged_weekly(stored, changed)
    return run


def sentiment_bands(spark, d):
    return _weekly(spark, d).groupBy("sentiment_category").agg(
        F.count(F.lit(1)).alias("n"), F.min("avg_tone_overall").alias("low"),
        F.max("avg_tone_overall").alias("high"))


def volatility_bands(spark, d):
    return _weekly(spark, d).groupBy("sentiment_volatility").agg(
        F.count(F.lit(1)).alias("n"), F.min("stddev_tone_overall").alias("low"),
        F.max("stddev_tone_overall").alias("high"))


def risk_ranking(spark, d):
    return (_weekly(spark, d).groupBy("country_name")
            .agg(F.max("risk_intensity_score").alias("peak_risk"),
                 F.sum("article_count").alias("articles"))
            .orderBy(F.desc("peak_risk"), "country_name"))


def day_slice_negative_first(spark, d):
    states = vault.sat_news_tone(feed.staged(spark, d))
    return enrich.most_negative_first(enrich.day_slice(states, "2024-01-15"))


def top_negative_k(spark, d):
    return marts.top_negative(_fact(feed.staged(spark, d), _l1()), 5)


def top_negative_last7d(spark, d):
    return marts.top_negative(_fact(feed.staged(spark, d), _l1()), 10,
                              ts_lit("2024-01-24 00:00:00"))


def top_negative_stored(spark, d):
    """The same ranking from the days' lowest rows, which two loads have kept up to date."""
    base = scratch_path(spark, "lowest")
    first = materialize(_fact(feed.staged_first(spark, d), _l1()), f"{base}/first")
    rest = materialize(marts.new_articles(_fact(feed.staged(spark, d), _l1()), first), f"{base}/rest")
    for rows in (first, rest):
        append_by_day(rows, f"{base}/fact")
        add_lowest(spark, f"{base}/days", rows)
    fact = read_table(spark, f"{base}/fact", dated(ARTICLE_FACT))
    return stored_top_negative(read_lowest(spark, f"{base}/days"), fact, 10, datetime(2024, 1, 24))


def weekly_co_located(spark, d):
    """The weekly fact from a fact and a link table that are stored in equal buckets."""
    base = scratch_path(spark, "buckets")
    t = _bucketed_tables(spark, _model_tables(spark, d), base)
    return marts.weekly_fact(t["fact"], t["link"], t["hub_country"], t["dim_country"], _l1(),
                             unique_articles=True, co_located=True)


def _bucketed_tables(spark, tables: dict[str, DataFrame], base: str, buckets: int = 8) -> dict[str, DataFrame]:
    out = dict(tables)
    for name, source in (("fact", "fact_ai_news_insights"), ("link", "link_news_country")):
        table = f"{name}_{base.rsplit('-', 1)[1]}"
        write_bucketed(tables[source], table, "news_hkey", buckets, f"{base}/{name}")
        out[name] = spark.table(table)
    return out


def articles_per_day(spark, d):
    return marts.articles_per_day(_fact(feed.staged(spark, d), _l1()))


# Control ------------------------------------------------------------------------------

class _Control:
    """Control tables of one query call. What several parts read is written once for the call."""

    def __init__(self, spark: SparkSession, d: str):
        self.spark, self.d = spark, d

    @cached_property
    def ticks(self) -> DataFrame:
        """Feed files per dataset (the event type): tick, rows, matching rows, damage."""
        rows = feed.raw_feed(self.spark, self.d, ["event_id", "ts", "event_type"])
        return self._written("ticks", rows.groupBy(
            F.col("event_type").alias("dataset"), calendar.tick_of(F.col("ts")).alias("tick_at"))
            .agg(F.count(F.lit(1)).alias("n_rows"),
                 F.count_if(theme_match(F.col("_c8"))).alias("matched_rows"),
                 (F.count_if(F.col("event_id") % 101 == 0) > 0).alias("broken"))
            .withColumn("file_ts", compact_ts(F.col("tick_at"))))

    @cached_property
    def bounds(self) -> DataFrame:
        return self.ticks.groupBy("dataset").agg(F.min("tick_at").alias("start_at"),
                                                 F.max("tick_at").alias("end_at"))

    @property
    def calendar(self) -> DataFrame:
        return calendar.dataset_calendars(
            self.bounds.withColumn("end_at", F.col("end_at") + F.expr("INTERVAL 30 MINUTES")))

    @cached_property
    def outcomes(self) -> DataFrame:
        now_ts = self.bounds.agg(compact_ts(F.max("end_at")).alias("n")).first()["n"]
        landed = self.ticks.select("dataset", "file_ts", "matched_rows",
                                   (F.col("n_rows") * 100).alias("bytes"),
                                   F.when(F.col("broken"), "unreadable").alias("error"))
        return self._written("outcomes", control.classify_files(self.calendar, landed, now_ts))

    @property
    def files(self) -> DataFrame:
        new = self.outcomes.select(
            "dataset", "file_ts", feed_url(F.col("file_ts"), BASE_URL).alias("url"),
            feed_file_name(F.col("file_ts")).alias("filename"), _run_id().alias("run_id"))
        ledger = control.register_files(
            control.empty_control_tables(self.spark)["ingestion_files"], new, _l1())
        return control.update_files(ledger, self.outcomes.select(
            "dataset", "file_ts", "status", "bytes", "error_message"), _l1())

    def marks(self, stamp) -> DataFrame:
        done = control.moves_watermark(self.outcomes).withColumn("run_id", _run_id())
        empty = control.empty_control_tables(self.spark)["ingestion_watermark"]
        return control.advance_watermarks(empty, done, stamp)

    def day_marks(self, stamp) -> DataFrame:
        closed = self.bounds.select(
            F.col("dataset").alias("process_name"),
            F.col("end_at").cast("date").alias("last_processed_date"))
        empty = control.empty_control_tables(self.spark)["ai_insights_watermark"]
        return control.close_days(empty, closed, stamp)

    def _written(self, name: str, df: DataFrame) -> DataFrame:
        return materialize(df, scratch_path(self.spark, name))


def _run_id():
    return F.concat(F.lit("run_"), F.col("dataset"))


def _priorities(spark, d) -> DataFrame:
    return feed.table(spark, d, "orders").select(F.col("o_orderpriority").alias("dataset")
                                                 ).distinct()


def feed_calendar(spark, d):
    run = _Control(spark, d)
    span = run.bounds.agg(
        compact_ts(F.min("start_at")).alias("a"), compact_ts(F.max("end_at")).alias("b")
    ).first()
    return calendar.feed_calendar(spark, span["a"], span["b"], BASE_URL)


def next_ticks(spark, d):
    run = _Control(spark, d)
    return run.ticks.select("dataset", "file_ts",
                                   next_tick(F.col("file_ts")).alias("next_ts"))


def feed_gaps(spark, d):
    run = _Control(spark, d)
    ticks = run.calendar.select("dataset", "file_ts")
    # a ledger with holes: some ticks were never taken
    ledger = run.files.where("pmod(file_ts div 100, 7) <> 3")
    return control.feed_gaps(ticks, ledger, run.marks(_l1()))


def read_watermarks(spark, d):
    run = _Control(spark, d)
    asked = run.ticks.select("dataset").distinct().unionByName(_priorities(spark, d))
    return control.last_watermarks(run.marks(_l1()), asked)


def resolve_start(spark, d):
    run = _Control(spark, d)
    marks = run.ticks.select(
        "dataset", F.col("file_ts").alias("watermark"),
        F.when(F.col("n_rows") > 2, F.lit(20240101000000)).alias("explicit_start"))
    return control.resolve_start(marks, floor=20240120000000)


def next_day(spark, d):
    run = _Control(spark, d)
    asked = (run.bounds.select(F.col("dataset").alias("process_name"))
             .unionByName(_priorities(spark, d).withColumnRenamed("dataset",
                                                                  "process_name")))
    days = control.next_days(run.day_marks(_l1()), asked)
    return days.withColumn("due", control.is_due(F.col("next_day"), date_lit("2024-01-31")))


def close_day(spark, d):
    run = _Control(spark, d)
    older = run.day_marks(_l1()).withColumn(
        "last_processed_date", F.date_sub("last_processed_date", 1))
    closed = run.bounds.select(
        F.col("dataset").alias("process_name"),
        F.col("end_at").cast("date").alias("last_processed_date"))
    return control.close_days(older, closed, _l2())


def days_behind(spark, d):
    run = _Control(spark, d)
    return control.days_behind_by_process(run.day_marks(_l1()),
                                          date_lit("2024-02-05"))


def file_outcomes(spark, d):
    run = _Control(spark, d)
    return run.outcomes


def run_summary(spark, d):
    run = _Control(spark, d)
    saved = (control.moves_watermark(run.outcomes)
             .where("status = 'downloaded'")
             .select("dataset", "file_ts", F.col("matched_rows").alias("rows")))
    return control.run_summary(run.files, saved)


def files_by_status(spark, d):
    run = _Control(spark, d)
    return control.files_by_status(run.files, "run_error", "downloaded")


def batch_cap(spark, d):
    run = _Control(spark, d)
    return calendar.capped(run.ticks.select("file_ts").distinct(), 96)


def register_files(spark, d):
    run = _Control(spark, d)
    files = run.files
    again = files.select("dataset", "file_ts", "url", "filename",
                         F.lit("rerun").alias("run_id"))
    return control.register_files(files, again, _l2())


def update_files(spark, d):
    run = _Control(spark, d)
    files = run.files
    retry = files.where("status = 'failed'").select(
        "dataset", "file_ts", F.lit("downloading").alias("status"),
        F.md5("filename").alias("checksum"))
    return control.update_files(files, retry, _l2())


def advance_watermarks(spark, d):
    run = _Control(spark, d)
    older = run.marks(_l1()).withColumn(
        "last_successful_file_ts", F.lit(20240101000000))
    done = control.moves_watermark(run.outcomes).withColumn("run_id", _run_id())
    return control.advance_watermarks(older, done, _l2(), monotonic=True)


def reset_watermarks(spark, d):
    run = _Control(spark, d)
    marks = run.marks(_l1())
    return control.reset_watermarks(marks, marks.where("dataset < 'm'"), _l2())


def run_lifecycle(spark, d):
    run = _Control(spark, d)
    files = run.files
    new = files.select("run_id", "dataset").distinct().withColumn(
        "max_files_per_run", F.lit(MAX_FILES_PER_RUN))
    opened = control.open_runs(None, new, _l1())
    return control.update_runs(opened, control.run_results(files), _l2())


# Tables, exports, checks --------------------------------------------------------------

def _model_tables(spark, d) -> dict[str, DataFrame]:
    """The model's tables, written once and read back."""
    root = scratch_path(spark, "model")

    def put(name: str, df: DataFrame) -> DataFrame:
        return materialize(df, f"{root}/{name}")
    staged = put("staging", feed.staged(spark, d))
    out = {"hub_news": put("hub_news", vault.hub_news(staged)),
           "hub_country": put("hub_country", vault.hub_country(staged)),
           "link_news_country": put("link", vault.link_news_country(staged)),
           "sat_news_tone": put("sat", vault.sat_news_tone(staged)),
           "fact_ai_news_insights": put("fact", _fact(staged, _l1())),
           "dim_country": put("dim", feed.dim_country(spark, d))}
    out["fact_countries"] = put("weekly", marts.weekly_fact(
        out["fact_ai_news_insights"], out["link_news_country"], out["hub_country"],
        out["dim_country"], _l1(), unique_articles=True))
    return out


def table_roundtrip(spark, d):
    root, staged = scratch_path(spark, "tables"), feed.staged(spark, d)
    write_table(staged, f"{root}/staging")
    stored = read_table(spark, f"{root}/staging", STAGING)
    append_table(vault.hub_news(stored), f"{root}/hub_news")
    fact = VersionedTable(spark, f"{root}/fact", ARTICLE_FACT)
    fact.replace(fact.read())
    fact.replace(merge.upsert(fact.read(), _fact(stored, _l1()), ["news_hkey"]))
    return exports.row_counts({
        "staging": stored, "hub_news": read_table(spark, f"{root}/hub_news", HUB_NEWS),
        "fact_ai_news_insights": fact.read()})


def weekly_partition_upsert(spark, d):
    path = scratch_path(spark, "upsert")
    first = _weekly(spark, d, _fact(feed.staged_first(spark, d), _l1()))
    for rows in (first, _weekly(spark, d)):
        upsert_partitions(spark, path, rows, marts.WEEKLY_KEYS, "week_date", WEEKLY_FACT)
    return read_table(spark, path, WEEKLY_FACT).select(*WEEKLY_FACT.fieldNames())


def dq_not_null(spark, d):
    return quality.check_not_null(
        feed.staged(spark, d), "stg",
        ["gkg_record_id", "event_datetime", "source_url", "tone_negative"])


def dq_unique(spark, d):
    staged = _staging_table(spark, d)
    return quality.check_unique(vault.hub_news(staged), "hub_news", "news_hkey").unionByName(
        quality.check_unique(vault.link_news_country(staged), "link_news_country",
                             "news_hkey"))


def dq_orphans(spark, d):
    staged = _staging_table(spark, d)
    return quality.check_reference(
        vault.link_news_country(staged), "link_news_country", "news_hkey",
        _fact(staged, _l1()), "news_hkey").unionByName(
        quality.check_reference(vault.hub_country(staged), "hub_country", "country_code",
                                feed.dim_country(spark, d), "country_code"))


def dq_model(spark, d):
    return quality.run_checks(_model_tables(spark, d))


def export_order(spark, d):
    return exports.ordered(_weekly(spark, d), "fact_countries").select(
        "week_date", "country_name", "continent", "article_count", "risk_intensity_score",
        "sentiment_category")


def export_csv(spark, d):
    path = scratch_path(spark, "export")
    exports.export_csv(_fact(feed.staged(spark, d), _l1()), path,
                       exports.EXPORT_ORDER["fact_ai_news_insights"])
    back = (spark.read.schema(ARTICLE_FACT).option("header", True).option("escape", '"')
            .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss[.SSSSSS]").csv(path))
    return back.select("news_hkey", "event_datetime", "source_url", "tone_overall",
                       "ai_abstract")


def schema_versions(spark, d):
    """Rows stored under two sets of columns and read as one table."""
    table = EvolvingTable(spark, scratch_path(spark, "evolving"))
    first = _fact(feed.staged_first(spark, d), _l1())
    table.append(first)
    fresh = marts.new_articles(_fact(feed.staged_second(spark, d), _l2()), table.read())
    table.append(fresh.select("news_hkey", "event_datetime", "tone_overall", F.lit("en").alias("language")))
    return table.read()


def schema_sync(spark, d):
    target = _fact(feed.staged_first(spark, d), _l1())
    fresh = marts.new_articles(_fact(feed.staged_second(spark, d), _l2()), target)
    incoming = fresh.select("news_hkey", "event_datetime", "tone_overall",
                            F.lit("en").alias("language"))
    return merge.append_synced(target, incoming)


# Enrichment ---------------------------------------------------------------------------

def _documents(spark, d) -> DataFrame:
    # Two steps, so that the normalised text is made once and then tested.
    clean = feed.table(spark, d, "documents").withColumn("text", squish(F.col("text")))
    return clean.select(
        "doc_id", "source", (F.col("doc_id") % 21 - 10).cast("double").alias("tone_overall"),
        keep_if_longer(F.col("text"), 100).alias("article_text"))


def article_prompt(spark, d):
    docs = _documents(spark, d)
    asked = enrich.prompt(F.col("article_text"), F.col("tone_overall"))
    head = enrich.prompt(F.lit(""), F.col("tone_overall"))
    return docs.select("doc_id", (F.length(asked) - F.length(head)).alias("n_prompt_chars"),
                       two_decimals(F.col("tone_overall")).alias("tone_text"))


def article_score(spark, d):
    return enrich.score_articles(_documents(spark, d), subjects=DOC_SUBJECTS).select(
        "doc_id", "is_relevant", "ai_abstract", "outcome")


def _letter_scorer():
    """A plug-in that answers with a fresh index and cannot read some texts."""
    def scorer(prompts, texts):
        if (texts.str.len() % 7 == 0).any():
            raise ValueError("cannot read this")
        return [f"{len(t)} characters" for t in texts]
    return scorer


def article_score_plugin(spark, d):
    return enrich.model_responses(_documents(spark, d), _letter_scorer).select(
        "doc_id", "response", F.col("response_error").isNotNull().alias("failed"))


def score_counters(spark, d):
    scored = enrich.score_articles(_documents(spark, d), subjects=DOC_SUBJECTS)
    return scored.groupBy("source").agg(*enrich.outcome_aggregates())


def page_main_text(spark, d):
    return enrich.page_texts(feed.table(spark, d, "pages")).select("page_id", "article_text")


def daily_backfill(spark, d):
    pages = feed.table(spark, d, "pages")
    n_pages = pages.count()
    urls = pages.select(F.col("page_id").alias("_page"), F.col("url").alias("_url"))
    raw = feed.bronze_feed(spark, d, ["event_id"])
    raw = (raw.withColumn("_page", F.col("event_id") % n_pages).join(urls, "_page")
           .withColumn("_c4", F.when(F.col("_c4").isNotNull(), F.col("_url"))))
    states = vault.sat_news_tone(staging.parse(raw, _l1()))
    span = enrich.scorable(states)
    scored = enrich.score_articles(enrich.with_page_text(span, pages),
                                   subjects=PAGE_SUBJECTS)
    return enrich.outcome_counts(scored)


# Streams ------------------------------------------------------------------------------

def _drops(spark, d) -> list[DataFrame]:
    """The feed as three deliveries in time order."""
    edges = ["1900-01-01", "2024-01-11", "2024-01-21", "9999-01-01"]
    raw = feed.raw_feed(spark, d, ["ts"])
    return [raw.where((F.col("ts") >= ts_lit(f"{a} 00:00:00"))
                      & (F.col("ts") < ts_lit(f"{b} 00:00:00")))
            for a, b in zip(edges, edges[1:])]


def stream_vault(spark, d):
    base = scratch_path(spark, "stream_vault")
    for drop in _drops(spark, d):
        write_drop(drop, f"{base}/landed")
    staged = stream_ingest.staged_stream(
        stream_ingest.raw_stream(spark, f"{base}/landed", max_files=2), _l1())
    stream_ingest.stream_into_vault(staged, f"{base}/vault", f"{base}/checkpoint")
    keys = [("hub_news", HUB_NEWS, "news_hkey"), ("hub_country", HUB_COUNTRY, "country_hkey"),
            ("link_news_country", LINK_NEWS_COUNTRY, "news_country_hkey"),
            ("sat_news_tone", SAT_NEWS_TONE, "hashdiff")]
    parts = [read_or_empty(spark, f"{base}/vault/{name}", schema).select(
        F.lit(name).alias("table_name"), F.col(key).alias("key"))
        for name, schema, key in keys]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def stream_weekly_upsert(spark, d):
    base = scratch_path(spark, "stream_weekly")
    dim = feed.dim_country(spark, d)

    def recompute(batch: DataFrame, since) -> DataFrame:
        scratch = scratch_path(spark, "batch")
        usable = materialize(batch, scratch)
        stream_ingest.load_vault(spark, usable, f"{base}/vault")
        fact = read_table(spark, f"{base}/fact", ARTICLE_FACT)
        append_table(marts.new_articles(_fact(usable, _l1()), fact), f"{base}/fact")
        drop_path(spark, scratch)
        return marts.weekly_fact(
            read_table(spark, f"{base}/fact", ARTICLE_FACT),
            read_table(spark, f"{base}/vault/link_news_country", LINK_NEWS_COUNTRY),
            read_table(spark, f"{base}/vault/hub_country", HUB_COUNTRY), dim, _l1(), since,
            unique_articles=True)

    # One run per delivery: each goes on from the checkpoint of the one before.
    for drop in _drops(spark, d):
        write_drop(drop, f"{base}/landed")
        staged = stream_ingest.staged_stream(
            stream_ingest.raw_stream(spark, f"{base}/landed"), _l1())
        stream_weekly.upsert_each_batch(spark, staged, f"{base}/weekly", f"{base}/checkpoint", recompute)
    return read_table(spark, f"{base}/weekly", WEEKLY_FACT).select(*WEEKLY_FACT.fieldNames())


_ARTICLE_COLUMNS = ["news_hkey", "event_datetime", "source_domain", "tone_overall"]


def _streamed(spark, d, drops: list[DataFrame]) -> stream_weekly.WeeklyStream:
    """The drops taken one after the other, each by a stream that goes on where the last one ended."""
    base = scratch_path(spark, "stream_window")
    weekly = stream_weekly.WeeklyStream(spark, f"{base}/weekly")
    for drop in drops:
        write_drop(drop, f"{base}/landed")
        staged = stream_ingest.staged_stream(stream_ingest.raw_stream(spark, f"{base}/landed"), _l1())
        weekly.run(_states(staged).select(*_ARTICLE_COLUMNS), f"{base}/checkpoint")
    return weekly


def _week_rows(weekly: stream_weekly.WeeklyStream) -> DataFrame:
    return weekly.weeks().select(
        "week_date", "source_domain", F.col("n").alias("article_count"), moments.mean().alias("avg_tone"),
        moments.deviation().alias("stddev_tone"))


def stream_weekly_window(spark, d):
    """Every week of the feed, the open one included."""
    return _week_rows(_streamed(spark, d, _drops(spark, d)))


def stream_repeats(spark, d):
    """Each delivery brings all older records again, weeks after they were first seen."""
    edges = ["2024-01-11", "2024-01-21", "9999-01-01"]
    raw = feed.raw_feed(spark, d, ["ts"])
    return _week_rows(_streamed(spark, d, [raw.where(F.col("ts") < ts_lit(f"{e} 00:00:00")) for e in edges]))


def stream_late_rows(spark, d):
    """Weeks and late rows where purchases of the first days come with the second delivery only."""
    raw = feed.raw_feed(spark, d, ["ts", "event_type"])
    early = (F.col("ts") < ts_lit(feed.SECOND_LOAD_FROM)) & (F.col("event_type") != "purchase")
    weekly = _streamed(spark, d, [raw.where(early), raw.where(~early)])
    columns = spark.createDataFrame([], ARTICLE_FACT).select(*_ARTICLE_COLUMNS).schema
    late = weekly.late(columns).select(
        week_start(F.col("event_datetime")).alias("week_date"), "source_domain", "tone_overall")
    counted = [(weekly.weeks().select("week_date", "source_domain", F.col("n").alias("n"), "low"), "on time"),
               (late.groupBy("week_date", "source_domain").agg(F.count(F.lit(1)).alias("n"),
                                                              F.min("tone_overall").alias("low")), "late")]
    return counted[0][0].withColumn("route", F.lit(counted[0][1])).unionByName(
        counted[1][0].withColumn("route", F.lit(counted[1][1])))


def weekly_moments(spark, d):
    """Source weeks kept as mergeable moments: a second load adds its new articles to stored groups."""
    base = scratch_path(spark, "moments")
    keys = ["week_date", "source_domain"]

    def parts(fact: DataFrame) -> DataFrame:
        rows = fact.select(week_start(F.col("event_datetime")).alias("week_date"), "source_domain", "tone_overall",
                           "source_url")
        return moments.moments(rows, keys, "tone_overall", "source_url")
    first = materialize(_fact(feed.staged_first(spark, d), _l1()), f"{base}/fact")
    stored = materialize(parts(first), f"{base}/stored")
    added = parts(marts.new_articles(_fact(feed.staged_second(spark, d), _l2()), first))
    merged = moments.merged_moments(stored.unionByName(added), keys)
    exact = F.col("n")                     # every article has a URL of its own
    return merged.select(
        *keys, F.col("n").alias("article_count"), moments.mean().alias("avg_tone"),
        moments.deviation().alias("stddev_tone"), F.col("low").alias("min_tone"), F.col("high").alias("max_tone"),
        (F.abs(moments.distinct_estimate() - exact) <= 0.07 * exact).alias("sketch_close"))


def weekly_ordered(spark, d):
    """The weekly fact in its own order, with the place of each row."""
    order = [*exports.sort_columns(exports.WEEKLY_ORDER), F.asc("country_name")]
    return with_position(_weekly(spark, d), order).select(
        (F.col("position") + 1).alias("place"), "week_date", "country_name", "article_count", "risk_intensity_score")


QUERIES: dict[str, Query] = {
    f.__name__: f for f in (
        weekly_country_fact, bronze_theme_filter, stg_parse, stg_countries, stg_load_stats,
        pg_array_explode, hub_news, hub_country, link_news_country, sat_news_tone,
        sat_increment, article_fact, insert_if_absent, curated_articles,
        weekly_dedup_country, sentiment_bands, volatility_bands, risk_ranking,
        day_slice_negative_first, top_negative_k, top_negative_last7d, articles_per_day,
        days_behind, feed_calendar, next_ticks, feed_gaps, read_watermarks, resolve_start,
        next_day, close_day, file_outcomes, run_summary, files_by_status, batch_cap,
        register_files, update_files, advance_watermarks, reset_watermarks, run_lifecycle,
        seed_dim_scan, table_roundtrip, weekly_partition_upsert, dq_not_null, dq_unique,
        dq_orphans, dq_model, export_order, export_csv, schema_sync, tsv_scan, zip_tsv_scan,
        tsv_width_check, rejected_lines, skipped_files, damaged_archives, file_provenance, article_prompt, article_score, article_score_plugin, score_counters,
        page_main_text, daily_backfill, stream_vault, stream_weekly_window, stream_repeats,
        stream_late_rows, weekly_moments, weekly_ordered,
        weekly_co_located, top_negative_stored, schema_versions,
        vault_customer_hub, vault_orders_link, vault_orders_sat)
}
QUERIES.update({
    "hub_increment": _after_two_loads(vault.hub_news, ["news_hkey"], HUB_NEWS),
    "hub_country_increment": _after_two_loads(vault.hub_country, ["country_hkey"],
                                              HUB_COUNTRY),
    "link_increment": _after_two_loads(vault.link_news_country, ["news_country_hkey"],
                                       LINK_NEWS_COUNTRY),
    "weekly_increment": _late_weekly(0),
    "weekly_lookback": _late_weekly(1),
    "stream_weekly": stream_weekly_upsert,
})
