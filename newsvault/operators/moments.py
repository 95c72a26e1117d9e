"""Aggregates that merge: counts, sums and squares as exact decimals, and distinct sketches.

A stored row per group holds what is needed to add more rows later without reading the old ones
again. Sums are decimals, so the order in which parts arrive changes no digit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BinaryType,
    DecimalType,
    DoubleType,
    LongType,
    StructField,
    StructType,
)

from newsvault.functions import round2

VALUE = DecimalType(18, 6)
SUM = DecimalType(38, 6)
SQUARES = DecimalType(38, 12)
SKETCH_BITS = 12          # a relative error of 1.04 / sqrt(2 ** 12), and exact for small groups

MOMENTS = [StructField("n", LongType()), StructField("total", SUM), StructField("squares", SQUARES),
           StructField("low", DoubleType()), StructField("high", DoubleType()),
           StructField("sketch", BinaryType())]


def moments_schema(keys: list[StructField]) -> StructType:
    return StructType([*keys, *MOMENTS])


def moments(rows: DataFrame, keys: list[str], value: str, distinct: str) -> DataFrame:
    """One row per group: n, total, squares, low and high of ``value``, a sketch of ``distinct``."""
    x = F.col(value).cast(VALUE)
    return rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.sum(x).cast(SUM).alias("total"),
        F.sum((x * x).cast(SQUARES)).cast(SQUARES).alias("squares"),
        F.min(value).alias("low"), F.max(value).alias("high"),
        F.hll_sketch_agg(distinct, SKETCH_BITS).alias("sketch"))


def merged_moments(parts: DataFrame, keys: list[str]) -> DataFrame:
    """The groups of several parts put together."""
    return parts.groupBy(*keys).agg(
        F.sum("n").alias("n"), F.sum("total").cast(SUM).alias("total"),
        F.sum("squares").cast(SQUARES).alias("squares"), F.min("low").alias("low"),
        F.max("high").alias("high"), F.hll_union_agg("sketch").alias("sketch"))


def mean() -> Column:
    return round2(F.col("total").cast("double") / F.col("n"))


def deviation() -> Column:
    """Sample standard deviation; null for a single row."""
    n = F.col("n").cast("double")
    spread = (F.col("squares").cast("double") - F.col("total").cast("double") ** 2 / n) / (n - 1)
    return round2(F.when(F.col("n") > 1, F.sqrt(F.greatest(spread, F.lit(0.0)))))


def distinct_estimate() -> Column:
    return F.hll_sketch_estimate("sketch")
