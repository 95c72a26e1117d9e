"""Data-quality checks as one result table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RESULT_COLUMNS = ["table_name", "column_name", "test", "failures", "status"]

# The declared column tests of the model.
NOT_NULL = {
    "hub_news": ["news_hkey"],
    "hub_country": ["country_hkey"],
    "sat_news_tone": ["news_hkey", "load_datetime"],
    "link_news_country": ["news_country_hkey", "news_hkey", "country_hkey"],
    "dim_country": ["country_code", "country_name"],
    "fact_ai_news_insights": ["news_hkey", "event_datetime", "source_domain", "source_url",
                              "tone_overall", "ai_abstract", "generated_at"],
    "fact_countries": ["week_date", "country_name"],
}
UNIQUE = {
    "hub_news": ["news_hkey"],
    "hub_country": ["country_hkey"],
    "link_news_country": ["news_country_hkey"],
    "fact_ai_news_insights": ["news_hkey"],
}
# child table, child column, parent table, parent column
REFERENCES = [
    ("link_news_country", "news_hkey", "hub_news", "news_hkey"),
    ("link_news_country", "country_hkey", "hub_country", "country_hkey"),
    ("hub_country", "country_code", "dim_country", "country_code"),
]


def _result(rows: DataFrame) -> DataFrame:
    status = F.when(F.col("failures") > 0, "fail").otherwise("pass")
    return rows.withColumn("status", status).select(*RESULT_COLUMNS)


def check_not_null(df: DataFrame, table: str, columns: list[str]) -> DataFrame:
    """One row per column with its NULL count; one pass over the table."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    long = counts.unpivot([], columns, "column_name", "failures")
    return _result(long.withColumns({"table_name": F.lit(table), "test": F.lit("not_null")}))


def check_unique(df: DataFrame, table: str, column: str) -> DataFrame:
    """Number of non-null key values that occur more than once."""
    repeated = (df.where(F.col(column).isNotNull()).groupBy(column)
                .agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    return _result(repeated.agg(F.count(F.lit(1)).alias("failures")).withColumns({
        "table_name": F.lit(table), "column_name": F.lit(column), "test": F.lit("unique")}))


def check_reference(child: DataFrame, table: str, column: str, parent: DataFrame,
                    parent_column: str) -> DataFrame:
    """Number of distinct child values without a parent.

    Child values are made distinct first, so a hot value joins once.
    """
    values = child.select(F.col(column).alias("_v")).where("_v IS NOT NULL").distinct()
    known = parent.select(F.col(parent_column).alias("_v"))
    orphans = values.join(known, "_v", "left_anti")
    return _result(orphans.agg(F.count(F.lit(1)).alias("failures")).withColumns({
        "table_name": F.lit(table), "column_name": F.lit(column),
        "test": F.lit("relationships")}))


def run_checks(tables: dict[str, DataFrame], not_null: dict[str, list[str]] = NOT_NULL,
               unique: dict[str, list[str]] = UNIQUE,
               references: list[tuple] = REFERENCES) -> DataFrame:
    """All checks whose tables are given, as one frame."""
    parts = [check_not_null(tables[t], t, cols) for t, cols in not_null.items()
             if t in tables]
    parts += [check_unique(tables[t], t, c) for t, cols in unique.items()
              if t in tables for c in cols]
    parts += [check_reference(tables[c], c, col, tables[p], pcol)
              for c, col, p, pcol in references if c in tables and p in tables]
    return reduce(DataFrame.unionByName, parts)


def enforce(results: DataFrame) -> DataFrame:
    """Raises when a check failed; the message names the failed checks."""
    failed = results.where("failures > 0").select("table_name", "column_name", "test",
                                                  "failures").collect()
    if failed:
        raise AssertionError("; ".join(
            f"{r.table_name}.{r.column_name} {r.test}: {r.failures}" for r in failed))
    return results


def empty_results(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        [], "table_name string, column_name string, test string, failures long, "
            "status string")
