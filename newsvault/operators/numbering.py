"""Positions and running sums over a whole frame, without a window in one task.

Rows go to range partitions and are sorted there. What comes before a partition is a prefix sum
over one small row per partition; only positions inside a partition are counted in its own task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsvault.session import scratch_path
from newsvault.sinks.tables import materialize

ROW_BITS = 33       # monotonically_increasing_id holds the row of a partition in its low bits
BLOCK_BITS = 16     # rows of a block of the running sum

_BEFORE = (Window.unboundedPreceding, -1)


def in_order(df: DataFrame, order: list[Column]) -> DataFrame:
    """The rows with ``_place``, which rises with the order; a written table.

    Rows that are equal in ``order`` meet in one partition, so the order should end in something
    that tells rows apart when one value may hold many of them.
    """
    placed = (df.repartitionByRange(*order).sortWithinPartitions(*order)
              .withColumn("_place", F.monotonically_increasing_id()))
    return materialize(placed, scratch_path(df.sparkSession, "in-order"))


def _sums_before(sums: DataFrame, key: str, value: str) -> DataFrame:
    """Sum of ``value`` over all smaller keys; for one row per partition."""
    total = F.sum(value).over(Window.orderBy(key).rowsBetween(*_BEFORE))
    return sums.select(key, F.coalesce(total, F.lit(0)).alias("_before"))


def positions(placed: DataFrame, column: str = "position") -> DataFrame:
    """Rows of ``in_order`` with their place in the whole order, counted from 0."""
    parts = placed.withColumn("_part", F.shiftright("_place", ROW_BITS))
    sizes = parts.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    row = F.col("_place").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    return (parts.join(F.broadcast(_sums_before(sizes, "_part", "_n")), "_part")
            .withColumn(column, F.col("_before") + row).drop("_part", "_before"))


def with_position(df: DataFrame, order: list[Column], column: str = "position") -> DataFrame:
    """The rows with their place in the whole order, counted from 0, as ``row_number() - 1``."""
    return positions(in_order(df, order), column).drop("_place")


def running_sums(placed: DataFrame, weight: Column, column: str) -> DataFrame:
    """Rows of ``in_order`` with the sum of ``weight`` over all rows before them.

    Sums are made inside blocks of 65,536 rows, over the blocks of a partition, and over the
    partitions, so no task holds more rows than a block, or small rows of one partition's blocks.
    """
    rows = placed.withColumns({"_block": F.shiftright("_place", BLOCK_BITS),
                               "_weight": weight.cast("long")})
    blocks = rows.groupBy("_block").agg(F.sum("_weight").alias("_sum")) \
        .withColumn("_part", F.shiftright("_block", ROW_BITS - BLOCK_BITS))
    parts = _sums_before(blocks.groupBy("_part").agg(F.sum("_sum").alias("_sum")), "_part", "_sum")
    in_part = Window.partitionBy("_part").orderBy("_block").rowsBetween(*_BEFORE)
    starts = (blocks.withColumn("_inner", F.coalesce(F.sum("_sum").over(in_part), F.lit(0)))
              .join(F.broadcast(parts), "_part")
              .select("_block", (F.col("_inner") + F.col("_before")).alias("_start")))
    in_block = Window.partitionBy("_block").orderBy("_place").rowsBetween(*_BEFORE)
    return (rows.withColumn("_inner", F.coalesce(F.sum("_weight").over(in_block), F.lit(0)))
            .join(starts, "_block")
            .withColumn(column, F.col("_start") + F.col("_inner"))
            .drop("_block", "_weight", "_inner", "_start"))
