"""Raw feed rows to typed staging rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsvault.constants import STAGING_RECORD_SOURCE
from newsvault.functions import (
    country_codes,
    parse_compact_ts,
    theme_match,
    to_double,
    to_int_or_zero,
    to_pg_array,
)
from newsvault.sources.feed_files import blank_na

# Position of the fields in a raw record.
RAW_FIELDS = {
    "gkg_record_id": "_c0",
    "event_text": "_c1",
    "source_domain": "_c3",
    "source_url": "_c4",
    "locations_raw": "_c9",
    "tone_raw": "_c15",
}
RAW_THEMES = "_c8"
TONE_PARTS = ["tone_overall", "tone_positive", "tone_negative", "tone_polarity",
              "tone_activity"]
TONE_MAX_PARTS = 7
WORD_COUNT_PART = 6


def theme_filter(raw: DataFrame, codes: list[str] | None = None) -> DataFrame:
    """Records that carry one of the theme codes: the bronze rows."""
    return raw.where(theme_match(F.col(RAW_THEMES), codes))


def name_fields(raw: DataFrame) -> DataFrame:
    """The used raw columns under their names, provenance kept."""
    source = (F.col("source_file") if "source_file" in raw.columns
              else F.lit(None).cast("string").alias("source_file"))
    return raw.select(*[F.col(c).alias(n) for n, c in RAW_FIELDS.items()], source)


def parse_tone(tone: Column) -> dict[str, Column]:
    """The five measures and the word count of a tone text.

    At most seven parts are cut, so surplus text stays glued to the word count.
    """
    parts = F.split(tone, ",", TONE_MAX_PARTS)
    out = {name: to_double(F.get(parts, F.lit(i))) for i, name in enumerate(TONE_PARTS)}
    out["word_count"] = to_int_or_zero(F.get(parts, F.lit(WORD_COUNT_PART)))
    return out


def parse(raw: DataFrame, load_datetime: Column, na_as_null: bool = True) -> DataFrame:
    """Typed staging rows; bad dates and numbers become NULL, rows without id go."""
    named = name_fields(raw)
    if na_as_null:
        named = blank_na(named, list(RAW_FIELDS))
    tone = parse_tone(F.col("tone_raw"))
    return (named.where("gkg_record_id IS NOT NULL")
            .select("gkg_record_id",
                    parse_compact_ts(F.col("event_text")).alias("event_datetime"),
                    "source_domain", "source_url", "locations_raw", "tone_raw",
                    "source_file",
                    *[column.alias(name) for name, column in tone.items()],
                    country_codes(F.col("locations_raw")).alias("countries"),
                    load_datetime.alias("load_datetime"),
                    F.lit(STAGING_RECORD_SOURCE).alias("record_source")))


def with_pg_countries(staged: DataFrame) -> DataFrame:
    """Staging with ``countries`` in its '{A,B}' text form."""
    return staged.withColumn("countries", to_pg_array(F.col("countries")))


def load_statistics(staged: DataFrame) -> DataFrame:
    """One row: rows, first and last event, country mentions."""
    return staged.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min("event_datetime").alias("first_event"),
        F.max("event_datetime").alias("last_event"),
        F.coalesce(F.sum(F.size("countries")), F.lit(0)).alias("country_mentions"))
