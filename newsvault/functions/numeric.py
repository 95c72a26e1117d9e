"""Coercion, rounding and banding of tone numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsvault.constants import FILES_PER_DAY

# Plain decimal or exponent notation. Spark's own cast would also take '1.5d' and 'NaN'.
_NUMBER = r"^\s*[-+]?(\d+\.?\d*|\.\d+)([eE][-+]?\d+)?\s*$"


def to_double(c: Column) -> Column:
    """Text to double; anything that is not a finite number becomes NULL."""
    return F.when(c.rlike(_NUMBER), c.try_cast("double"))


def to_int_or_zero(c: Column) -> Column:
    """Text to int through double, truncating; NULL and junk become 0."""
    return F.coalesce(to_double(c).try_cast("int"), F.lit(0))


def round2(c: Column) -> Column:
    """Round to three places, then to two: 2.3447 gives 2.35."""
    return F.round(c.cast("decimal(18,3)"), 2).cast("decimal(18,2)")


def risk_score(avg_tone: Column) -> Column:
    """0 for a non-negative average, else ten times its magnitude (not capped)."""
    score = F.when(avg_tone >= 0, F.lit(0)).otherwise(F.abs(avg_tone) * 10)
    return F.round(score, 2).cast("decimal(18,2)")


def sentiment_band(avg_tone: Column) -> Column:
    # Band limits and names.
    return (F.when(avg_tone < -5, "Very Negative")
            .when(avg_tone < -2, "Negative")
            .when(avg_tone < 2, "Neutral")
            .when(avg_tone < 5, "Positive")
            .otherwise("Very Positive"))


def volatility_band(stddev_tone: Column) -> Column:
    # Band limits and names.
    return (F.when(stddev_tone.isNull(), "Unknown")
            .when(stddev_tone > 3, "High Volatility")
            .when(stddev_tone > 1.5, "Moderate Volatility")
            .otherwise("Low Volatility"))


def two_decimals(c: Column) -> Column:
    """Number as text with two decimals, as in ``-3.10``."""
    return F.format_string("%.2f", c)


def percent(part: Column, whole: Column) -> Column:
    """100 * part / whole; NULL when whole is 0."""
    return F.try_divide(part * F.lit(100.0), whole)


def day_coverage(files: Column) -> Column:
    """Number of feed files expressed in days."""
    return files / F.lit(float(FILES_PER_DAY))
