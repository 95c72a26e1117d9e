"""Every table schema of the model, declared once.

Timestamps are ``TIMESTAMP_NTZ``: the data model holds plain wall-clock times, so results
must not move with the session time zone.
"""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    DateType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

from newsvault.constants import RAW_WIDTH

_STR, _DBL, _INT, _LONG, _TS = (
    StringType(), DoubleType(), IntegerType(), LongType(), TimestampNTZType())
_MONEY = DecimalType(18, 2)


def _table(*fields: tuple) -> StructType:
    return StructType([StructField(name, dtype, True) for name, dtype in fields])


RAW27 = _table(*[(f"_c{i}", _STR) for i in range(RAW_WIDTH)])

STAGING = _table(
    ("gkg_record_id", _STR), ("event_datetime", _TS), ("source_domain", _STR),
    ("source_url", _STR), ("locations_raw", _STR), ("tone_raw", _STR),
    ("source_file", _STR), ("tone_overall", _DBL), ("tone_positive", _DBL),
    ("tone_negative", _DBL), ("tone_polarity", _DBL), ("tone_activity", _DBL),
    ("word_count", _INT), ("countries", ArrayType(_STR)), ("load_datetime", _TS),
    ("record_source", _STR))

HUB_NEWS = _table(
    ("news_hkey", _STR), ("gkg_record_id", _STR), ("load_datetime", _TS),
    ("record_source", _STR))

HUB_COUNTRY = _table(
    ("country_hkey", _STR), ("country_code", _STR), ("load_datetime", _TS),
    ("record_source", _STR))

LINK_NEWS_COUNTRY = _table(
    ("news_country_hkey", _STR), ("news_hkey", _STR), ("country_hkey", _STR),
    ("load_datetime", _TS), ("record_source", _STR))

SAT_NEWS_TONE = _table(
    ("news_hkey", _STR), ("load_datetime", _TS), ("event_datetime", _TS),
    ("source_domain", _STR), ("source_url", _STR), ("tone_overall", _DBL),
    ("tone_positive", _DBL), ("tone_negative", _DBL), ("tone_polarity", _DBL),
    ("tone_activity", _DBL), ("word_count", _INT), ("hashdiff", _STR),
    ("record_source", _STR))

ARTICLE_FACT = _table(
    ("news_hkey", _STR), ("event_datetime", _TS), ("source_domain", _STR),
    ("source_url", _STR), ("tone_overall", _DBL), ("tone_positive", _DBL),
    ("tone_negative", _DBL), ("tone_polarity", _DBL), ("ai_abstract", _STR),
    ("generated_at", _TS))

WEEKLY_FACT = _table(
    ("week_date", _TS), ("country_name", _STR), ("continent", _STR),
    ("article_count", _LONG), ("unique_sources", _LONG), ("avg_tone_overall", _MONEY),
    ("avg_tone_positive", _MONEY), ("avg_tone_negative", _MONEY),
    ("avg_tone_polarity", _MONEY), ("min_tone_overall", _MONEY),
    ("max_tone_overall", _MONEY), ("stddev_tone_overall", _MONEY),
    ("risk_intensity_score", _MONEY), ("sentiment_category", _STR),
    ("sentiment_volatility", _STR), ("fact_created_at", _TS))

DIM_COUNTRY = _table(
    ("country_code", _STR), ("country_name", _STR), ("capital_city", _STR),
    ("capital_latitude", _DBL), ("capital_longitude", _DBL), ("continent", _STR),
    ("region", _STR))

INGESTION_WATERMARK = _table(
    ("dataset", _STR), ("last_successful_file_ts", _LONG), ("updated_at", _TS),
    ("last_run_id", _STR))

INGESTION_RUNS = _table(
    ("run_id", _STR), ("dataset", _STR), ("started_at", _TS), ("ended_at", _TS),
    ("status", _STR), ("max_files_per_run", _INT), ("catalog_snapshot_at", _TS),
    ("files_detected", _INT), ("files_selected", _INT), ("files_downloaded", _INT),
    ("files_failed", _INT), ("error_message", _STR))

INGESTION_FILES = _table(
    ("dataset", _STR), ("file_ts", _LONG), ("url", _STR), ("filename", _STR),
    ("run_id", _STR), ("status", _STR), ("bytes", _LONG), ("checksum", _STR),
    ("download_started_at", _TS), ("download_ended_at", _TS), ("error_message", _STR),
    ("inserted_at", _TS), ("updated_at", _TS))

DAY_WATERMARK = _table(
    ("process_name", _STR), ("last_processed_date", DateType()), ("updated_at", _TS))
