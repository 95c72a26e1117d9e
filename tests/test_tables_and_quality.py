import shutil

from datetime import datetime

import pytest
from pyspark.sql.types import (
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

from newsvault.operators import merge, quality
from newsvault.plans import catalogue
from newsvault.sinks import export, tables
from tests.helpers import rows

KV = StructType([StructField("k", IntegerType()), StructField("v", StringType())])
WK = StructType([*KV.fields, StructField("w", TimestampNTZType())])


def kv(spark, *items):
    return spark.createDataFrame(list(items), KV)


def test_versioned_table_replaces_what_it_reads(spark, tmp_path):
    table = tables.VersionedTable(spark, f"{tmp_path}/t", KV)
    assert table.read().count() == 0
    table.replace(kv(spark, (1, "a")))
    for i in range(4):
        table.replace(table.read().unionByName(kv(spark, (i + 2, "b"))), keep=2)
    assert table.read().count() == 5
    assert len(table.versions()) == 2


def test_versioned_table_survives_a_broken_write(spark, tmp_path):
    table = tables.VersionedTable(spark, f"{tmp_path}/t", KV)
    table.replace(kv(spark, (1, "a")))
    (tmp_path / "t" / "v99999999999999999999").mkdir()
    assert rows(table.read()) == [(1, "a")]


def test_partition_upsert_rewrites_only_touched_partitions(spark, tmp_path):
    path = f"{tmp_path}/w"
    w1, w2 = datetime(2026, 1, 5), datetime(2026, 1, 12)
    make = lambda *items: spark.createDataFrame(list(items), WK)
    tables.upsert_partitions(spark, path, make((1, "a", w1), (2, "b", w1), (1, "c", w2)),
                             ["w", "k"], "w", WK)
    before = {p.name for p in (tmp_path / "w" / "w=2026-01-12 00%3A00%3A00").glob("*.parquet")}
    tables.upsert_partitions(spark, path, make((1, "new", w1), (3, "d", w1)), ["w", "k"],
                             "w", WK)
    after = {p.name for p in (tmp_path / "w" / "w=2026-01-12 00%3A00%3A00").glob("*.parquet")}
    assert before == after
    assert rows(tables.read_table(spark, path, WK).select("k", "v", "w")) == [
        (1, "c", w2), (1, "new", w1), (2, "b", w1), (3, "d", w1)]


def test_ensure_and_append(spark, tmp_path):
    path = f"{tmp_path}/t"
    assert tables.read_table(spark, path, KV) is None
    tables.ensure_table(spark, path, KV)
    tables.append_table(kv(spark, (1, "a")), path)
    tables.ensure_table(spark, path, KV)
    assert tables.read_or_empty(spark, path, KV).count() == 1


def test_export_is_ordered_and_counted(spark, tmp_path):
    df = kv(spark, *[(i, f'say "{i}", ok') for i in range(20)])
    assert export.export_csv(df, f"{tmp_path}/e", [("k", "desc")]) == 20
    files = sorted((tmp_path / "e").glob("*.csv"))
    lines = files[0].read_text().splitlines()
    assert lines[0] == "k,v" and lines[1] == '19,"say ""19"", ok"'
    assert export.export_csv(df, f"{tmp_path}/many", [("k", "asc")]) == 20
    back = spark.read.schema(KV).option("header", True).option("escape", '"').csv(
        f"{tmp_path}/many")
    assert rows(back) == rows(df)


def test_violations_are_reported(spark):
    parent = kv(spark, (1, "a"))
    child = kv(spark, (1, "a"), (1, None), (2, "z"), (None, "z"))
    got = quality.check_not_null(child, "t", ["k", "v"])
    assert rows(got.select("column_name", "failures", "status")) == [
        ("k", 1, "fail"), ("v", 1, "fail")]
    assert quality.check_unique(child, "t", "k").first().failures == 1
    assert quality.check_unique(parent, "t", "k").first().status == "pass"
    orphans = quality.check_reference(child, "t", "k", parent, "k")
    assert orphans.first().failures == 1
    with pytest.raises(AssertionError, match="t.k unique: 1"):
        quality.enforce(quality.check_unique(child, "t", "k"))
    assert quality.empty_results(spark).columns == quality.RESULT_COLUMNS


def test_declared_checks_hold_on_the_model(spark, sf_dir):
    results = catalogue.dq_model(spark, sf_dir)
    tests = [r.test for r in results.collect()]
    assert (tests.count("not_null"), tests.count("unique"), tests.count("relationships")) == (
        18, 4, 3)
    quality.enforce(results)


def test_row_counts(spark):
    got = export.row_counts({"a": kv(spark, (1, "x")), "b": kv(spark)})
    assert rows(got) == [("a", 1), ("b", 0)]


def test_csv_writes_keep_blanks(spark, tmp_path):
    df = kv(spark, (1, "  a b  "), (2, "back\\slash"), (3, 'quote"'))
    export.export_csv(df, f"{tmp_path}/e", [("k", "asc")])
    back = spark.read.schema(KV).option("header", True).option("escape", '"').csv(f"{tmp_path}/e")
    assert rows(back) == rows(df)


def test_stopped_upsert_is_finished_by_the_next_call(spark, tmp_path):
    """A stop after the merged rows were written, with one of two weeks moved already."""
    schema = "week string, k int, v string"
    frame = lambda *r: spark.createDataFrame(list(r), schema)
    path, struct = f"{tmp_path}/t", frame(("w", 1, "x")).schema
    tables.upsert_partitions(spark, path, frame(("w1", 1, "a"), ("w2", 1, "a")), ["week", "k"], "week", struct)
    frame(("w1", 1, "b"), ("w1", 2, "b"), ("w2", 1, "b")).write.parquet(f"{path}__pending")
    shutil.rmtree(f"{path}/week=w1")
    tables.upsert_partitions(spark, path, frame(("w2", 3, "c")), ["week", "k"], "week", struct)
    assert rows(tables.read_table(spark, path, struct).select("week", "k", "v")) == [
        ("w1", 1, "b"), ("w1", 2, "b"), ("w2", 1, "b"), ("w2", 3, "c")]


def test_doubled_updates_do_not_multiply_rows(spark):
    target, updates = kv(spark, (1, "a")), kv(spark, (1, "b"), (1, "c"), (2, "d"))
    assert rows(merge.upsert(target, updates, ["k"])) == [(1, "c"), (2, "d")]
    assert rows(merge.upsert(None, updates, ["k"])) == [(1, "c"), (2, "d")]
    assert rows(merge.partial_update(target, updates, ["k"])) == [(1, "c")]
