"""Hubs, links and satellites from column lists; the news tables are one instance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsvault.constants import VAULT_RECORD_SOURCE
from newsvault.functions import change_hash, composite_key, from_pg_array, hash_key
from newsvault.operators.merge import one_per_key, unseen

# Attributes of the news satellite and the part of them that is hashed
# (the url is stored but does not count as a change).
NEWS_ATTRS = ["event_datetime", "source_domain", "source_url", "tone_overall",
              "tone_positive", "tone_negative", "tone_polarity", "tone_activity",
              "word_count"]
NEWS_HASHED = [c for c in NEWS_ATTRS if c != "source_url"]


def hub(src: DataFrame, business_key: str, hkey: str, record_source: str,
        load_column: str = "load_datetime") -> DataFrame:
    """One row per business key, first load time kept.

    Grouped by the hash key alone, so the insert-only anti join that follows reuses the
    same partitioning.
    """
    return (src.where(F.col(business_key).isNotNull())
            .select(hash_key(F.col(business_key)).alias(hkey), business_key,
                    F.col(load_column).alias("load_datetime"))
            .groupBy(hkey)
            .agg(F.min(business_key).alias(business_key),
                 F.min("load_datetime").alias("load_datetime"))
            .withColumn("record_source", F.lit(record_source)))


def link(src: DataFrame, keys: dict[str, str], link_hkey: str, record_source: str,
         load_column: str = "load_datetime") -> DataFrame:
    """One row per combination of business keys (``hash column -> business key``)."""
    hkeys = list(keys)
    usable = src
    for business_key in keys.values():
        usable = usable.where(F.col(business_key).isNotNull())
    hashed = usable.select(*[hash_key(F.col(b)).alias(h) for h, b in keys.items()],
                           F.col(load_column).alias("load_datetime"))
    return (hashed.withColumn(link_hkey, composite_key(*[F.col(h) for h in hkeys]))
            .groupBy(link_hkey)
            .agg(*[F.min(h).alias(h) for h in hkeys],
                 F.min("load_datetime").alias("load_datetime"))
            .withColumn("record_source", F.lit(record_source)))


def satellite(src: DataFrame, business_key: str, hkey: str, attrs: list[str],
              hashed: list[str], record_source: str, load_column: str = "load_datetime",
              keep_duplicates: bool = False) -> DataFrame:
    """Attribute rows with their change hash.

    Equal states of one key inside a batch are kept once unless ``keep_duplicates``.
    """
    rows = (src.where(F.col(business_key).isNotNull())
            .select(hash_key(F.col(business_key)).alias(hkey),
                    F.col(load_column).alias("load_datetime"), *attrs,
                    change_hash(src, hashed).alias("hashdiff")))
    if not keep_duplicates:
        rows = one_per_key(rows, [hkey, "hashdiff"], ["load_datetime"])
    return rows.select(hkey, "load_datetime", *attrs, "hashdiff",
                       F.lit(record_source).alias("record_source"))


def unseen_states(rows: DataFrame, target: DataFrame | None, hkey: str,
                  compare: str = "history") -> DataFrame:
    """Satellite rows to append.

    ``history`` compares with every stored state, so going back to an old state is not
    recorded. ``latest`` compares with the newest stored state only; a batch then carries
    one state per key, which is what one load per run gives.
    """
    if target is None or compare == "history":
        return unseen(rows, target, [hkey, "hashdiff"])
    if compare != "latest":
        raise ValueError(f"unknown compare mode: {compare}")
    newest = (target.groupBy(hkey)
              .agg(F.max(F.struct("load_datetime", "hashdiff")).alias("_last"))
              .select(hkey, F.col("_last.hashdiff").alias("hashdiff")))
    return unseen(rows, newest, [hkey, "hashdiff"])


def news_countries(staged: DataFrame) -> DataFrame:
    """One row per record and country code; records without codes give none."""
    return staged.select("gkg_record_id", F.explode("countries").alias("country_code"),
                         "load_datetime")


def news_countries_from_text(staged: DataFrame) -> DataFrame:
    """The same from the '{A,B}' text form."""
    return staged.select("gkg_record_id",
                         F.explode(from_pg_array(F.col("countries"))).alias("country_code"),
                         "load_datetime")


def hub_news(staged: DataFrame) -> DataFrame:
    return hub(staged, "gkg_record_id", "news_hkey", VAULT_RECORD_SOURCE)


def hub_country(staged: DataFrame) -> DataFrame:
    return hub(news_countries(staged), "country_code", "country_hkey", VAULT_RECORD_SOURCE)


def link_news_country(staged: DataFrame) -> DataFrame:
    return link(news_countries(staged),
                {"news_hkey": "gkg_record_id", "country_hkey": "country_code"},
                "news_country_hkey", VAULT_RECORD_SOURCE)


def sat_news_tone(staged: DataFrame, keep_duplicates: bool = False) -> DataFrame:
    return satellite(staged, "gkg_record_id", "news_hkey", NEWS_ATTRS, NEWS_HASHED,
                     VAULT_RECORD_SOURCE, keep_duplicates=keep_duplicates)
