"""The raw feed that the demonstration tables give: 27 text columns per event.

``events`` become records, ``nation`` and ``region`` become countries. Numbers are written
digit by digit, so their text is the same in every engine. The feed holds bad dates, NULL
and non-matching themes, missing locations, invalid and doubled country codes, and
non-numeric tones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsvault.constants import RAW_WIDTH
from newsvault.functions import ts_lit
from newsvault.operators.staging import parse, theme_filter

LOAD_TIME = "2026-02-01 06:00:00"
SECOND_LOAD_TIME = "2026-02-02 06:00:00"
SECOND_LOAD_FROM = "2024-01-16 00:00:00"


# Columns of the demonstration tables in use; declared, so no footer is read to plan.
_TABLES = {
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
              "o_orderpriority string",
    "customer": "c_custkey long, c_name string",
    "documents": "doc_id long, text string, source string",
    "pages": "page_id long, url string, html string",
}


_CODE = "char(65 + n_nationkey) || char(65 + n_regionkey)"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(_TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(k, code, name, continent): 25 countries on five continents."""
    return (table(spark, sf_dir, "nation")
            .join(table(spark, sf_dir, "region"), F.expr("n_regionkey = r_regionkey"))
            .selectExpr("n_nationkey AS k", f"{_CODE} AS code", "n_name AS name",
                        "r_name AS continent"))


def dim_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Country dimension; the first five countries have a second code."""
    codes = "explode(IF(k < 5, array(code, 'Z' || char(65 + k)), array(code)))"
    return countries(spark, sf_dir).selectExpr(f"{codes} AS country_code",
                                               "name AS country_name", "continent")


# Raw columns that the feed fills, in terms of the event and two country codes.
_FILLED = {
    0: "stamp || '-' || event_id",
    1: "IF(event_id % 97 = 0, 'bad', stamp)",
    3: "'site' || (user_id % 20) || '.example.com'",
    4: "IF(event_id % 89 <> 0, 'http://news.example.com/' || event_id, NULL)",
    8: "CASE event_type WHEN 'error' THEN 'ECON_MONEYLAUNDERING,12;TAX,3' "
       "WHEN 'purchase' THEN 'WB_2076_MONEY_LAUNDERING,5' WHEN 'click' THEN NULL "
       "ELSE 'EDUCATION,9' END",
    9: "IF(event_id % 13 <> 0, '1#p#' || code_a || '#r#0#0#f;4#q#' || code_b || "
       "'#r#0#0#f;1#p#' || IF(event_id % 25 < 5, 'Z' || char(65 + event_id % 25), 'x1') || "
       "'#r#0#0#f', NULL)",
    15: "concat_ws(',', (event_id % 25 - 12) || '.' || lpad(event_id % 100, 2, '0'), "
        "event_id % 10, IF(event_id % 31 = 0, 'x', string(event_id % 7)), '1.5', '2', '0', "
        "event_id % 900)",
}


def raw_feed(spark: SparkSession, sf_dir: str, keep: list[str] | None = None) -> DataFrame:
    """27 text columns, unused ones NULL; ``keep`` adds columns of the event."""
    nation = table(spark, sf_dir, "nation")
    first, second = (nation.selectExpr(f"CAST(n_nationkey AS LONG) AS k{x}",
                                       f"{_CODE} AS code_{x}") for x in "ab")
    stamped = table(spark, sf_dir, "events").selectExpr(
        "*", "date_format(ts, 'yyyyMMddHHmmss') AS stamp")
    joined = (stamped.join(first, F.expr("event_id % 25 = ka"))
              .join(second, F.expr("(event_id * 7) % 25 = kb")))
    return joined.selectExpr(
        *[f"CAST({_FILLED.get(i, 'NULL')} AS STRING) AS _c{i}" for i in range(RAW_WIDTH)],
        *(keep or []))


def bronze_feed(spark: SparkSession, sf_dir: str, keep: list[str] | None = None) -> DataFrame:
    return theme_filter(raw_feed(spark, sf_dir, keep))


def staged(spark: SparkSession, sf_dir: str, load_datetime: Column | None = None) -> DataFrame:
    """The typed staging rows of the whole feed."""
    stamp = ts_lit(LOAD_TIME) if load_datetime is None else load_datetime
    return parse(bronze_feed(spark, sf_dir), stamp)


def staged_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the first of two deliveries holds: events before the second one starts."""
    early = bronze_feed(spark, sf_dir, ["ts"]).where(
        F.col("ts") < ts_lit(SECOND_LOAD_FROM))
    return parse(early, ts_lit(LOAD_TIME))


def staged_second(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second delivery: the whole feed again, under a later load time."""
    return staged(spark, sf_dir, ts_lit(SECOND_LOAD_TIME))


def staged_changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second delivery with one word more in records that have a domain ending in 0."""
    return staged_second(spark, sf_dir).withColumn(
        "word_count", F.when(F.col("source_domain").endswith("0.example.com"),
                             F.col("word_count") + 1).otherwise(F.col("word_count")))
