"""Physical plans that have to hold at any size."""

import uuid

from pyspark.sql import functions as F

from newsvault.operators import enrich, marts, merge, vault
from newsvault.operators.pruning import dated
from newsvault.plans import catalogue
from newsvault.schemas import SAT_NEWS_TONE
from newsvault.sinks.tables import append_by_day, read_table, write_bucketed, write_table
from newsvault.functions import ts_lit

LIMIT = "spark.sql.autoBroadcastJoinThreshold"
SMALL = {LIMIT: "-1", "spark.sql.adaptive.enabled": "false"}


class shuffling:
    """Plans as if only what is below ``limit`` bytes were small enough to broadcast."""

    def __init__(self, spark, limit="-1"):
        self.spark, self.limit = spark, limit

    def __enter__(self):
        self.before = {k: self.spark.conf.get(k) for k in SMALL}
        for key, value in {**SMALL, LIMIT: self.limit}.items():
            self.spark.conf.set(key, value)

    def __exit__(self, *_):
        for key, value in self.before.items():
            self.spark.conf.set(key, value)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def vault_frame(spark, n=100):
    return spark.range(n).select(
        F.col("id").cast("string").alias("gkg_record_id"),
        F.array(F.lit("US")).alias("countries"), ts_lit("2026-01-01 00:00:00").alias(
            "load_datetime"),
        ts_lit("2026-01-05 00:00:00").alias("event_datetime"), F.lit("d").alias(
            "source_domain"), F.lit("u").alias("source_url"),
        *[F.lit(1.0).alias(f"tone_{t}") for t in ("overall", "positive", "negative",
                                                  "polarity", "activity")],
        F.lit(1).alias("word_count"))


def stored(spark, tmp_path, name, df):
    write_table(df, f"{tmp_path}/{name}")
    return spark.read.parquet(f"{tmp_path}/{name}")


def test_vault_increments_do_not_shuffle_the_target(spark, tmp_path):
    src = stored(spark, tmp_path, "s", vault_frame(spark))
    hub = stored(spark, tmp_path, "h", vault.hub_news(src))
    sat = stored(spark, tmp_path, "x", vault.sat_news_tone(src))
    loads = [(vault.hub_news(src), lambda new: merge.unseen(new, hub, ["news_hkey"])),
             (vault.sat_news_tone(src), lambda new: vault.unseen_states(new, sat, "news_hkey"))]
    for new, load in loads:
        text = plan(load(new))
        assert "NestedLoop" not in text and "Cartesian" not in text
        # A small batch: its keys are sent to the target, which stays where it is.
        assert text.count("BroadcastHashJoin") == 2 and "LeftSemi" in text
        own = plan(new.select("news_hkey").distinct()).count("Exchange hashpartitioning")
        assert text.count("Exchange hashpartitioning") <= 2 * max(own, 1)
        with shuffling(spark):
            text = plan(load(new))
            assert "NestedLoop" not in text and "Cartesian" not in text


def test_weekly_join_shuffles_each_side_once_and_needs_no_expand(spark, tmp_path):
    src = stored(spark, tmp_path, "s", vault_frame(spark))
    states = src.withColumn("news_hkey", vault.hash_key(F.col("gkg_record_id")))
    fact = stored(spark, tmp_path, "f", marts.article_rows(
        states, F.lit("t"), ts_lit("2026-01-01 00:00:00")))
    link = stored(spark, tmp_path, "l", vault.link_news_country(src))
    hub = stored(spark, tmp_path, "h", vault.hub_country(src))
    dim = stored(spark, tmp_path, "d", spark.createDataFrame(
        [("US", "United States", "C")],
        "country_code string, country_name string, continent string"))
    with shuffling(spark, "3000"):      # lookups are below it, articles and links above
        text = plan(marts.weekly_fact(fact, link, hub, dim, ts_lit("2026-01-01 00:00:00"),
                                      unique_articles=True))
    assert "Expand" not in text and "NestedLoop" not in text
    assert text.count("SortMergeJoin") == 1
    # fact and mentions by article, then the two steps of the distinct-source aggregate
    assert text.count("Exchange hashpartitioning") == 4


def test_bucketed_article_tables_join_without_shuffle(spark, tmp_path):
    src = stored(spark, tmp_path, "s", vault_frame(spark))
    states = src.withColumn("news_hkey", vault.hash_key(F.col("gkg_record_id")))
    hub = stored(spark, tmp_path, "h", vault.hub_country(src))
    dim = stored(spark, tmp_path, "d", spark.createDataFrame(
        [("US", "United States", "C")], "country_code string, country_name string, continent string"))
    t_fact, t_link = (f"{t}_{uuid.uuid4().hex[:8]}" for t in ("t_fact", "t_link"))
    for name, df in ((t_fact, marts.article_rows(states, F.lit("t"), ts_lit(
            "2026-01-01 00:00:00"))), (t_link, vault.link_news_country(src))):
        write_bucketed(df, name, "news_hkey", 4)
    weekly = marts.weekly_fact(spark.table(t_fact), spark.table(t_link), hub, dim,
                               ts_lit("2026-01-01 00:00:00"), unique_articles=True,
                               co_located=True)
    with shuffling(spark, "3000"):      # lookups are below it, articles and links above
        text = plan(weekly.select("*"))
    # Only the two steps of the distinct-source aggregate are left.
    assert text.count("Exchange hashpartitioning") == 2
    assert weekly.first().article_count == 100
    for name in (t_fact, t_link):
        spark.sql(f"DROP TABLE {name}")


def test_cut_off_and_day_slice_reach_the_scan(spark, tmp_path):
    src = stored(spark, tmp_path, "s", vault_frame(spark))
    append_by_day(vault.sat_news_tone(src), f"{tmp_path}/x")
    sat = read_table(spark, f"{tmp_path}/x", dated(SAT_NEWS_TONE))

    def partition_filters(df):
        text = plan(df)
        return text[text.index("PartitionFilters: ["):].split("]")[0]
    got = partition_filters(enrich.day_slice(sat, "2026-01-05").select("news_hkey"))
    assert "event_date" in got and ">= 2026-01-05" in got and "<= 2026-01-06" in got
    late = marts.usable_articles(sat, ts_lit("2026-01-05 00:00:00"))
    assert ">= 2026-01-05" in partition_filters(late)
    assert enrich.day_slice(sat, "2026-01-05").count() == 100
    assert enrich.day_slice(sat, "2026-01-06").count() == 0


def test_staging_stays_in_generated_code(spark, sf_dir):
    with shuffling(spark):
        text = plan(catalogue.stg_parse(spark, sf_dir))
    assert "Python" not in text and "lambda" not in text


def test_top_k_is_not_a_full_sort(spark, sf_dir):
    assert "TakeOrderedAndProject" in plan(catalogue.top_negative_k(spark, sf_dir))


def test_co_located_weekly_fact_shuffles_neither_fact_nor_link(spark, sf_dir):
    """On stored buckets the join of articles and links has no exchange; only partial groups move."""
    with shuffling(spark, "10485760"):
        text = plan(catalogue.weekly_co_located(spark, sf_dir))
    assert "SelectedBucketsCount: 8 out of 8" in text
    for exchange in (line for line in text.splitlines() if "Exchange hashpartitioning(" in line):
        assert "hashpartitioning(news_hkey" not in exchange


def test_stored_ranking_reads_the_days_tables_only(spark, sf_dir):
    text = plan(catalogue.top_negative_stored(spark, sf_dir))
    assert text.count("Scan parquet") == 1 and "/days" in text and "PartitionFilters: [isnotnull(event_date" in text
