"""Stored layouts: days' lowest rows, changing columns, kept responses, rejects, file states."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from newsvault.operators import enrich, marts
from newsvault.operators.lowest import add_lowest, read_lowest, stored_top_negative
from newsvault.operators.moments import deviation, distinct_estimate, mean, merged_moments, moments
from newsvault.operators.pruning import dated
from newsvault.plans import catalogue
from newsvault.schemas import ARTICLE_FACT
from newsvault.sinks.tables import EvolvingTable, append_by_day, read_table
from newsvault.sources import feed_files
from tests.helpers import rows


def fact(spark, n, seed=1):
    return spark.range(n).select(
        F.md5(F.col("id").cast("string")).alias("news_hkey"),
        (F.timestamp_seconds(1767225600 + F.col("id") * 7919 * seed % 864000)).cast("timestamp_ntz").alias("event_datetime"),
        F.lit("s").alias("source_domain"), F.lit("u").alias("source_url"),
        F.when(F.col("id") % 11 > 0, (F.col("id") * 31 % 47 - 20).cast("double")).alias("tone_overall"),
        *[F.lit(0.0).alias(c) for c in ("tone_positive", "tone_negative", "tone_polarity")],
        F.lit("a").alias("ai_abstract"), F.lit(datetime(2026, 1, 20)).cast("timestamp_ntz").alias("generated_at"))


@pytest.mark.parametrize("k,since", [(5, None), (7, datetime(2026, 1, 4)), (7, datetime(2026, 1, 4, 13, 30)),
                                     (30, datetime(2026, 1, 9, 12)), (2, datetime(2026, 2, 1))])
def test_ranking_from_the_lowest_rows_of_days(spark, tmp_path, k, since):
    whole = fact(spark, 900)
    parts = [whole.where("crc32(news_hkey) % 3 = 0"), whole.where("crc32(news_hkey) % 3 > 0")]
    for part in (*parts, parts[1]):                                   # one part is added again
        add_lowest(spark, f"{tmp_path}/low", part, keep=20)
    for part in parts:
        append_by_day(part, f"{tmp_path}/fact")
    stored = read_table(spark, f"{tmp_path}/fact", dated(ARTICLE_FACT))
    got = stored_top_negative(read_lowest(spark, f"{tmp_path}/low"), stored, k, since, keep=20).select(ARTICLE_FACT.fieldNames())
    want = marts.top_negative(whole, k, None if since is None else F.lit(since).cast("timestamp_ntz"))
    assert rows(got) == rows(want)
    assert read_table(spark, f"{tmp_path}/low", dated(ARTICLE_FACT)).count() <= 200


def test_columns_that_change(spark, tmp_path):
    table = EvolvingTable(spark, f"{tmp_path}/t")
    with pytest.raises(ValueError, match="no table"):
        table.read()
    assert table.ensure(spark.createDataFrame([], "a int, b string").schema) == 1
    assert table.read().columns == ["a", "b"] and table.read().count() == 0
    table.append(spark.createDataFrame([(1, "x")], "a int, b string"))
    table.append(spark.createDataFrame([(2, "y")], "a int, b string"))
    table.append(spark.createDataFrame([(3, 0.5)], "a long, c double"))
    assert [v for v, _ in table.versions()] == [1, 2]
    assert table.read().dtypes == [("a", "bigint"), ("c", "double")]
    assert sorted(map(tuple, table.read().collect()), key=str) == [(1, None), (2, None), (3, 0.5)]


def test_a_stopped_scoring_run_goes_on(spark, tmp_path):
    articles = spark.createDataFrame(
        [(i, f"text number {i % 9} " * 20 if i != 4 else None, float(i % 9)) for i in range(24)],
        "id long, article_text string, tone_overall double")
    log = tmp_path / "asked"
    log.mkdir()

    def build(broken):
        folder = str(log)

        def scorer(prompts, texts):
            import os
            import uuid
            if broken and any("number 3" in t for t in texts):
                os._exit(1)                                           # the worker is lost
            for t in texts:
                open(os.path.join(folder, f"{t.split()[2]}-{uuid.uuid4().hex}"), "w").close()
            return ["about " + t[:13] for t in texts]
        return scorer

    with pytest.raises(Exception, match=".+"):
        enrich.score_resumable(articles, f"{tmp_path}/store", lambda: build(True), slices=9).collect()
    before = len(list(log.iterdir()))
    got = enrich.score_resumable(articles, f"{tmp_path}/store", lambda: build(False), slices=9).collect()
    asked = [p.name.split("-")[0] for p in log.iterdir()]
    assert 0 < before < 9 and len(asked) == len(set(asked)) == 9      # no question was asked twice
    assert len(got) == 24 and all((r.response or "").startswith("about") == (r.id != 4) for r in got)
    assert {r.outcome for r in got} == {enrich.SAVED, enrich.NO_TEXT}


def test_moments_merge_to_those_of_all_rows(spark):
    df = spark.range(600).selectExpr("id % 4 AS g", "CAST(id * 37 % 101 AS DOUBLE) / 8 AS v", "CAST(id % 50 AS STRING) AS s")
    whole = moments(df, ["g"], "v", "s")
    parts = [moments(df.where(f"hash(v) % 3 = {k} OR hash(v) % 3 = {k - 3}"), ["g"], "v", "s") for k in range(3)]
    merged = merged_moments(parts[0].unionByName(parts[1]).unionByName(parts[2]), ["g"])
    columns = ["g", "n", "total", "squares", "low", "high", mean().alias("m"), deviation().alias("d"),
               distinct_estimate().alias("e")]
    assert rows(merged.select(*columns)) == rows(whole.select(*columns))
    plain = {r.g: r for r in df.groupBy("g").agg(F.stddev("v").alias("d"), F.avg("v").alias("m")).collect()}
    for r in merged.select(*columns).collect():
        assert abs(float(r.m) - plain[r.g].m) < 0.006 and abs(float(r.d) - plain[r.g].d) < 0.006 and r.e == 25


def test_rejected_lines_keep_their_tail(spark):
    lines = spark.createDataFrame([("f", 1, "\t".join("x" * 27), None), ("f", 2, "\t".join("y" * 28), None),
                                   ("f", 3, "\t".join("z" * 26), None), ("f", 4, "", None), ("f", 5, None, "bad")],
                                  "source_file string, line_no long, line string, error string")
    assert [r.line_no for r in feed_files.accepted_lines(lines).where("line <> ''").collect()] == [1, 3]
    strict = feed_files.rejected_lines(lines, allow_short=False).collect()
    assert [(r.line_no, r.fields, r.line[-1]) for r in strict] == [(2, 28, "y"), (3, 26, "z")]
    assert [r.reason for r in feed_files.rejected_lines(lines).collect()] == ["expected 27 fields, found 28"]


def test_control_queries_read_their_tables_each_time(spark, sf_dir, tmp_path):
    for name in ("nation", "region", "orders"):
        spark.read.parquet(f"{sf_dir}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    events.write.parquet(f"{tmp_path}/events.parquet")
    before = catalogue.file_outcomes(spark, str(tmp_path)).count()
    events.orderBy("event_id").limit(10).write.mode("overwrite").parquet(f"{tmp_path}/events.parquet")
    assert catalogue.file_outcomes(spark, str(tmp_path)).count() < before
