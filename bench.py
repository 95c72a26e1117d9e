"""Benchmark: headline queries, warm, median of several runs; prints one JSON line.

BENCH_SF_DIR  folder of the tables (default /root/testdata/sf0.1)
BENCH_CPUS    local cores (default 8)
BENCH_RUNS    timed runs per query (default 3)
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from datetime import datetime

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from newsvault.functions import ts_lit  # noqa: E402
from newsvault.operators import marts  # noqa: E402
from newsvault.operators.lowest import add_lowest, read_lowest, stored_top_negative  # noqa: E402
from newsvault.plans import catalogue  # noqa: E402
from newsvault.session import local_session, scratch_path  # noqa: E402

HEADLINE = ["weekly_country_fact", "bronze_theme_filter", "stg_parse", "hub_news",
            "hub_increment", "link_news_country", "sat_news_tone", "sat_increment",
            "insert_if_absent", "weekly_increment", "top_negative_last7d",
            "articles_per_day", "file_outcomes", "run_summary", "dq_orphans",
            "article_score", "page_main_text", "daily_backfill", "export_csv",
            "zip_tsv_scan"]


def timed(run) -> float:
    start = time.perf_counter()
    run()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench")
    spark.sparkContext.setLogLevel("ERROR")

    def sink(df) -> None:
        df.write.format("noop").mode("overwrite").save()

    jobs = {n: (lambda q=catalogue.QUERIES[n]: sink(q(spark, sf_dir))) for n in HEADLINE}
    # The two queries with published times run on stored tables, as there.
    t = catalogue._model_tables(spark, sf_dir)
    b = catalogue._bucketed_tables(spark, t, scratch_path(spark, "bench"))
    jobs["stored_weekly_country"] = lambda: sink(marts.weekly_fact(
        b["fact"], b["link"], b["hub_country"], b["dim_country"],
        ts_lit("2026-02-01 06:00:00"), unique_articles=True, co_located=True))
    low = scratch_path(spark, "bench-lowest")
    add_lowest(spark, low, t["fact_ai_news_insights"])
    lows = read_lowest(spark, low)
    jobs["stored_top10_negative_7d"] = lambda: stored_top_negative(
        lows, t["fact_ai_news_insights"], 10, datetime(2024, 1, 24)).collect()

    seconds = {}
    for name, job in jobs.items():
        job()
        seconds[name] = round(statistics.median(timed(job) for _ in range(runs)), 4)
        print(f"{name}: {seconds[name]}", file=sys.stderr)
    print(json.dumps({"metric": "headline queries, total of warm medians",
                      "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": os.path.basename(sf_dir).removeprefix("sf")}))


if __name__ == "__main__":
    main()
