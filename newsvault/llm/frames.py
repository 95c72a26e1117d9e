"""Helpers on frames: written tables in the shared folder, and clash-free columns."""

from __future__ import annotations

import os
import sys

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

# Functions that run in tasks are sent by value, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__package__])


ROWS_A_TASK = 50_000


def gathered(df: DataFrame, rows: int, a_task: int = ROWS_A_TASK) -> DataFrame:
    """The frame in as many partitions as there are cores, or as hold ``a_task`` of its at most ``rows`` rows.

    Nothing is shuffled, and a frame of fewer partitions keeps them. So small tables take few tasks
    and files, however many shuffle partitions the session has.
    """
    return df.coalesce(max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // a_task)))


def written(df: DataFrame, name: str, rows: int | None = None, a_task: int = ROWS_A_TASK) -> DataFrame:
    """The frame as a Parquet table in the shared folder, read back; ``gathered`` if ``rows`` is known.

    It cuts the lineage, survives lost executors and is computed once.
    """
    spark = df.sparkSession
    if rows is not None:
        df = gathered(df, rows, a_task)
    path = scratch_path(spark, f"llm-{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def drop_scratch(df: DataFrame) -> None:
    """Delete the files behind a frame made by ``written`` once nothing reads it any more."""
    jvm = df.sparkSession._jvm
    conf = df.sparkSession._jsc.hadoopConfiguration()
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)


def components(edges: DataFrame, most: int = 60) -> DataFrame:
    """(node, root): smallest node reachable over the undirected links (a, b).

    Alternates large-star and small-star steps on written tables until the links stop
    changing. Each step is a grouped minimum, combined before its shuffle, and one join, so
    a node with very many links is no single task's group; skewed join keys are split by
    adaptive execution. Only the number of changed links comes to the driver.
    """
    links = (edges.where("a is not null and b is not null and a <> b")
             .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    links = written(links, "links")
    n = links.count()       # no step makes more than two links of one
    for _ in range(most):
        # large star: every larger neighbour of a node is tied to the node's smallest one
        both = links.union(links.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (both.where("v > u").join(least, "u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        large = written(large, "large", 2 * n)
        # small star: a node and its smaller neighbours are tied to the smallest of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u")
                 .select(F.explode(F.array(F.struct("u", F.col("m").alias("v")),
                                           F.struct(F.col("v").alias("u"), F.col("m").alias("v"))))
                         .alias("x")).select("x.*").where("u <> v").distinct())
        small = written(small, "small", 2 * n)
        # a star forest: nothing that is pointed at points on
        again = small.select(F.col("v").alias("u")).join(small, "u", "left_semi").limit(1).count()
        multi = small.groupBy("u").count().where("count > 1").limit(1).count()
        drop_scratch(large)
        drop_scratch(links)
        links = small
        if not again and not multi:
            return links.select(F.col("u").alias("node"), F.col("v").alias("root"))
    raise RuntimeError("the components did not settle")
