"""Article fact, curated articles and the weekly country fact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from newsvault.constants import EMPTY_TARGET_WEEK
from newsvault.functions import (
    risk_score,
    round2,
    sentiment_band,
    ts_lit,
    volatility_band,
    week_start,
)
from newsvault.operators.merge import insert_if_absent, upsert
from newsvault.operators.pruning import in_time
from newsvault.schemas import ARTICLE_FACT, WEEKLY_FACT

WEEKLY_KEYS = ["week_date", "country_name"]
_MEASURES = ["tone_overall", "tone_positive", "tone_negative", "tone_polarity"]


def empty_article_fact(spark: SparkSession) -> DataFrame:
    """The article fact before the first insight: schema only."""
    return spark.createDataFrame([], ARTICLE_FACT)


def article_rows(states: DataFrame, abstract: Column, generated_at: Column) -> DataFrame:
    """Satellite rows in the shape of the article fact."""
    return states.select(
        "news_hkey", "event_datetime", "source_domain", "source_url", *_MEASURES,
        abstract.cast("string").alias("ai_abstract"), generated_at.alias("generated_at"))


def new_articles(rows: DataFrame, fact: DataFrame | None) -> DataFrame:
    """Article rows to append: one per article not stored yet."""
    return insert_if_absent(rows, fact, ["news_hkey"], ["event_datetime"])


def mentions(link: DataFrame, hub_country: DataFrame, dim: DataFrame,
             co_located: bool = False, articles: DataFrame | None = None) -> DataFrame:
    """(news_hkey, country_name, continent, first_mention) per link row and dimension row.

    ``articles`` are those that are wanted: links of others go before anything is sorted, so an
    increment sorts its own links and not all of history.

    A country with several codes can appear more than once for an article;
    ``first_mention`` marks one of those rows. The window runs on the partitioning and
    order that the article join needs next, so it adds no shuffle and no sort. Its groups
    are one article's rows of one country: at most the codes of that country.
    ``co_located`` says that the link table is bucketed by ``news_hkey`` like the article
    fact; then the link, which grows with the vault, is not shuffled at all.
    """
    link = link.select("news_hkey", "country_hkey")
    if articles is not None:
        link = link.join(articles.select("news_hkey").distinct(), "news_hkey", "left_semi")
    # One small table after the other: each is broadcast, or not, by its own size in bytes.
    named = (link.join(hub_country.select("country_hkey", "country_code"), "country_hkey")
             .join(dim.select("country_code", "country_name", "continent"), "country_code")
             .select("news_hkey", "country_name", "continent", "country_code"))
    same = (Window.partitionBy("news_hkey", "country_name", "continent")
            .orderBy("country_code"))
    placed = named if co_located else named.repartition("news_hkey")
    return (placed.withColumn("first_mention", F.row_number().over(same) == 1)
            .select("news_hkey", "country_name", "continent", "first_mention"))


def usable_articles(fact: DataFrame, since: Column | None = None) -> DataFrame:
    """Articles with a tone and a time, from ``since`` on.

    The cut-off is a Monday, so comparing the time itself equals comparing its week and
    lets the scan skip days.
    """
    rows = fact.where("tone_overall IS NOT NULL AND event_datetime IS NOT NULL")
    if since is not None:
        rows = in_time(rows, since)
    return rows.select("news_hkey", "event_datetime", *_MEASURES, "source_domain")


def curated_articles(fact: DataFrame, link: DataFrame, hub_country: DataFrame,
                     dim: DataFrame, since: Column | None = None,
                     co_located: bool = False) -> DataFrame:
    """One row per article and dimension row of its countries."""
    articles = usable_articles(fact, since)
    wanted = articles if since is not None else None
    return articles.join(mentions(link, hub_country, dim, co_located, wanted), "news_hkey")


def weekly_measures(curated: DataFrame, unique_articles: bool = False,
                    dedupe_country: bool = False, approximate: bool = False) -> DataFrame:
    """Week x country aggregate with rounded measures.

    ``unique_articles`` says that the article fact has one row per ``news_hkey``; the
    article count is then the number of first mentions, and only the distinct sources
    are left to a two-step aggregate. Otherwise both counts are distinct counts.
    ``dedupe_country`` weighs an article once per country whatever its number of codes.
    """
    rows = curated.where("first_mention") if dedupe_country else curated
    if approximate:
        articles, sources = (F.approx_count_distinct("news_hkey"),
                             F.approx_count_distinct("source_domain"))
    else:
        articles = (F.count_if("first_mention") if unique_articles
                    else F.count_distinct("news_hkey"))
        sources = F.count_distinct("source_domain")
    return (rows.groupBy(week_start(F.col("event_datetime")).alias("week_date"),
                         "country_name", "continent")
            .agg(articles.alias("article_count"), sources.alias("unique_sources"),
                 *[round2(F.avg(m)).alias(f"avg_{m}") for m in _MEASURES],
                 round2(F.min("tone_overall")).alias("min_tone_overall"),
                 round2(F.max("tone_overall")).alias("max_tone_overall"),
                 round2(F.stddev_samp("tone_overall")).alias("stddev_tone_overall")))


def score(weekly: DataFrame, created_at: Column) -> DataFrame:
    """Risk score and bands from the rounded measures."""
    return weekly.select(
        "*",
        risk_score(F.col("avg_tone_overall")).alias("risk_intensity_score"),
        sentiment_band(F.col("avg_tone_overall")).alias("sentiment_category"),
        volatility_band(F.col("stddev_tone_overall")).alias("sentiment_volatility"),
        created_at.alias("fact_created_at")).select(*WEEKLY_FACT.fieldNames())


def weekly_fact(fact: DataFrame, link: DataFrame, hub_country: DataFrame, dim: DataFrame,
                created_at: Column, since: Column | None = None,
                unique_articles: bool = False, dedupe_country: bool = False,
                approximate: bool = False,
                co_located: bool = False) -> DataFrame:
    """The weekly fact, or its part from ``since`` on."""
    curated = curated_articles(fact, link, hub_country, dim, since, co_located)
    return score(weekly_measures(curated, unique_articles, dedupe_country, approximate),
                 created_at)


def increment_start(target: DataFrame | None, lookback_weeks: int = 0) -> Column:
    """First week to recompute, as a literal: the newest stored week, or earlier.

    One aggregate over one column; without target or rows the epoch of the model.
    """
    newest = None
    if target is not None:
        newest = target.agg(F.max("week_date").cast("string").alias("w")).first()["w"]
    if newest is None:
        return ts_lit(f"{EMPTY_TARGET_WEEK} 00:00:00")
    start = ts_lit(newest)
    return start - F.make_dt_interval(F.lit(7 * lookback_weeks)) if lookback_weeks else start


def merged_weekly(target: DataFrame | None, changed: DataFrame) -> DataFrame:
    """The stored weekly fact after the upsert of recomputed rows."""
    return upsert(target, changed, WEEKLY_KEYS)


def top_negative(fact: DataFrame, k: int, since: Column | None = None) -> DataFrame:
    """The k most negative articles, ties by key."""
    rows = fact.where("tone_overall IS NOT NULL")
    if since is not None:
        rows = in_time(rows, since)
    return rows.orderBy("tone_overall", "news_hkey").limit(k)


def articles_per_day(fact: DataFrame) -> DataFrame:
    return (fact.groupBy(F.col("event_datetime").cast("date").alias("date"))
            .agg(F.count(F.lit(1)).alias("articles"))
            .orderBy(F.desc("date")))
