"""Ordered CSV exports with row counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

# Sort order of the exported tables.
WEEKLY_ORDER = [("week_date", "desc"), ("article_count", "desc")]
EXPORT_ORDER = {
    "fact_ai_news_insights": [("event_datetime", "desc")],
    "fact_countries": [("week_date", "desc"), ("country_name", "asc")],
    "dim_country": [("country_name", "asc")],
}


def sort_columns(order: list[tuple[str, str]]) -> list[Column]:
    return [F.desc(c) if direction == "desc" else F.asc(c) for c, direction in order]


def ordered(df: DataFrame, table: str) -> DataFrame:
    """The table in its export order."""
    return df.orderBy(*sort_columns(EXPORT_ORDER[table]))


def export_csv(df: DataFrame, path: str, order: list[tuple[str, str]]) -> int:
    """Writes sorted CSV with header and returns the row count.

    The sort is a range partitioning, so part files follow each other in order. The count
    comes from the write itself. Text is written as it is, blanks at its ends included.
    """
    out = df.orderBy(*sort_columns(order))
    seen = Observation("export")
    (out.observe(seen, F.count(F.lit(1)).alias("rows"))
     .write.mode("overwrite").option("header", True).option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss[.SSSSSS]").csv(path))
    return int(seen.get["rows"])


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, n_rows) of several tables in one frame."""
    parts = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(t).alias("table_name"),
                                                              "n_rows")
             for t, df in tables.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
