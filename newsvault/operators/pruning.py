"""Time ranges that skip files.

Parquet keeps no usable statistics for zone-free timestamps, so stored event tables carry
``event_date`` as a partition column; a range on the time then comes with the same range on
the day, and only the folders of those days are listed and read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType

EVENT_DATE = "event_date"


def dated(schema: StructType) -> StructType:
    """The schema as stored: with the day as last column."""
    return StructType([*schema.fields, StructField(EVENT_DATE, DateType())])


def with_event_date(df: DataFrame) -> DataFrame:
    return df.withColumn(EVENT_DATE, F.col("event_datetime").cast("date"))


def in_time(df: DataFrame, start: Column, end: Column | None = None) -> DataFrame:
    """Rows with ``start <= event_datetime < end``, by day first where days are stored."""
    when = F.col("event_datetime")
    rows = df.where(when >= start if end is None else (when >= start) & (when < end))
    if EVENT_DATE in df.columns:
        day = F.col(EVENT_DATE)
        rows = rows.where(day >= start.cast("date"))
        if end is not None:
            rows = rows.where(day <= end.cast("date"))
    return rows
