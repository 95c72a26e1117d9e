"""Small frames for tests."""

from pyspark.sql import functions as F

from newsvault.constants import RAW_WIDTH
from newsvault.functions import ts_lit
from newsvault.operators.staging import parse
from newsvault.schemas import RAW27

DAY1, DAY2, DAY3 = "2026-01-02 00:00:00", "2026-01-03 00:00:00", "2026-01-04 00:00:00"


def raw_row(**fields):
    """A raw record; keys are column numbers as c0, c1, ..."""
    row = [None] * RAW_WIDTH
    for name, value in fields.items():
        row[int(name[1:])] = value
    return tuple(row)


def raw(spark, *rows):
    return spark.createDataFrame(list(rows), RAW27)


def article(rid, ts="20260105120000", tone="1.5,2,3,4,5,6,7", locations="1#a#US#r#0#0#f",
            domain="d.example.com", url="http://x.example.com/1"):
    return raw_row(c0=rid, c1=ts, c3=domain, c4=url, c8="ECON_MONEYLAUNDERING", c9=locations,
                   c15=tone)


def staged(spark, *rows, load=DAY1):
    return parse(raw(spark, *rows), ts_lit(load))


def one(df, expression):
    """The single value of a column over a one-row frame."""
    return df.select(expression.alias("v")).first()["v"]


def values(spark, items, column, ddl="c string"):
    """A column function applied to literal inputs, in order."""
    df = spark.createDataFrame([(i, v) for i, v in enumerate(items)], f"i int, {ddl}")
    return [r["v"] for r in df.select("i", column(F.col("c")).alias("v")).orderBy("i").collect()]


def rows(df):
    return sorted(tuple(r) for r in df.collect())
