import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from newsvault.operators.numbering import in_order, positions, running_sums, with_position


def test_positions_and_running_sums_equal_a_window(spark):
    rng = random.Random(4)
    rows = [(k, rng.choice([None, 1, 1, 1, 2, 7]), rng.choice(["a", "b", None])) for k in range(700)]
    df = spark.createDataFrame(rows, "id long, v int, s string")
    order = [F.desc("s"), F.asc("v"), F.asc("id")]
    want = df.withColumns({
        "position": F.row_number().over(Window.orderBy(*order)) - 1,
        "before": F.coalesce(F.sum(F.coalesce("v", F.lit(0))).over(
            Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))})
    got = running_sums(positions(in_order(df, order)), F.coalesce("v", F.lit(0)), "before").drop("_place")
    assert sorted(map(tuple, got.select(want.columns).collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    assert not with_position(df.limit(0), order).collect()


def test_no_window_over_all_rows(spark):
    df = spark.range(1000).withColumn("v", F.col("id") % 10)
    placed = in_order(df, [F.asc("v"), F.asc("id")])
    assert placed.rdd.getNumPartitions() >= 1
    plan = positions(placed)._jdf.queryExecution().optimizedPlan().toString()
    # the only window is over the counts of partitions
    assert plan.count("Window") == 1 and "Window [sum(_n" in plan
