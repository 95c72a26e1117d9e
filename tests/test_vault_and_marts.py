from datetime import datetime
from decimal import Decimal

from pyspark.sql import functions as F

from newsvault.functions import ts_lit
from newsvault.operators import marts, merge, vault
from newsvault.schemas import ARTICLE_FACT, DIM_COUNTRY, HUB_NEWS, WEEKLY_FACT
from tests.helpers import DAY1, DAY2, DAY3, article, rows, staged

TWO = "1#a#US#r;1#b#CA#r"


def load(target, arriving, keys):
    return target.unionByName(merge.unseen(arriving, target, keys))


def test_hub_is_one_row_per_key_with_the_first_load(spark):
    src = staged(spark, article("a"), article("a"), article("b")).unionByName(
        staged(spark, article("a"), load=DAY2))
    hub = vault.hub_news(src).select(*HUB_NEWS.fieldNames())
    got = {r.gkg_record_id: r.load_datetime for r in hub.collect()}
    assert got == {"a": datetime(2026, 1, 2), "b": datetime(2026, 1, 2)}


def test_load_a_then_all_equals_load_all(spark):
    first = [article("a", locations=TWO), article("b")]
    everything = first + [article("c", locations="1#z#FR#"), article("d", locations=None)]
    a, ab = staged(spark, *first), staged(spark, *everything)
    for build, keys in ((vault.hub_news, ["news_hkey"]),
                        (vault.hub_country, ["country_hkey"]),
                        (vault.link_news_country, ["news_country_hkey"])):
        assert rows(load(build(a), build(ab), keys)) == rows(build(ab))
        again = merge.unseen(build(ab), build(ab), keys)
        assert again.count() == 0


def test_records_without_countries_give_no_links(spark):
    src = staged(spark, article("a", locations=None), article("b", locations=""))
    assert vault.link_news_country(src).count() == 0
    assert vault.hub_country(src).count() == 0


def _state(spark, tone, load_time, url="u"):
    return vault.sat_news_tone(staged(spark, article("a", tone=tone, url=url),
                                      load=load_time))


def test_return_to_an_old_state(spark):
    loads = [_state(spark, t, d) for t, d in
             (("1,2,3,4,5,6,7", DAY1), ("9,2,3,4,5,6,7", DAY2), ("1,2,3,4,5,6,7", DAY3))]
    for compare, expected in (("history", 2), ("latest", 3)):
        target = loads[0]
        for arriving in loads[1:]:
            target = target.unionByName(
                vault.unseen_states(arriving, target, "news_hkey", compare))
        assert target.count() == expected


def test_new_url_is_not_a_change(spark):
    target = _state(spark, "1,2,3,4,5,6,7", DAY1)
    arriving = _state(spark, "1,2,3,4,5,6,7", DAY2, url="other")
    assert vault.unseen_states(arriving, target, "news_hkey").count() == 0


def test_equal_states_in_one_batch(spark):
    src = staged(spark, article("a"), article("a"), article("a", url="z"))
    assert vault.sat_news_tone(src).count() == 1
    assert vault.sat_news_tone(src, keep_duplicates=True).count() == 3


def test_one_per_key_is_the_smallest_row(spark):
    df = spark.createDataFrame([(1, 5, "b"), (1, 5, "a"), (1, 7, None), (2, None, "x")],
                               "k int, o int, v string")
    assert rows(merge.one_per_key(df, ["k"], ["o"])) == [(1, 5, "a"), (2, None, "x")]


def test_insert_if_absent_and_upsert(spark):
    target = spark.createDataFrame([(1, "old")], "k int, v string")
    src = spark.createDataFrame([(1, "new"), (2, "b"), (2, "a")], "k int, v string")
    assert rows(target.unionByName(merge.insert_if_absent(src, target, ["k"]))) == [
        (1, "old"), (2, "a")]
    updates = spark.createDataFrame([(1, "new"), (2, "b")], "k int, v string")
    assert rows(merge.upsert(target, updates, ["k"])) == [(1, "new"), (2, "b")]
    assert rows(merge.upsert(None, updates, ["k"])) == [(1, "new"), (2, "b")]


def test_partial_update_keeps_what_is_not_given(spark):
    target = spark.createDataFrame([(1, "x", 5), (2, "y", 6)], "k int, a string, n int")
    updates = spark.createDataFrame([(1, None, 9), (3, "z", 1)], "k int, a string, n int")
    assert rows(merge.partial_update(target, updates, ["k"])) == [(1, "x", 9), (2, "y", 6)]


def test_schema_sync(spark):
    target = spark.createDataFrame([(1, "gone")], "k int, old string")
    incoming = spark.createDataFrame([(2, "new")], "k long, lang string")
    got = merge.append_synced(target, incoming)
    assert got.columns == ["k", "lang"]
    assert rows(got.na.fill("-")) == [(1, "-"), (2, "new")]


# Weekly fact --------------------------------------------------------------------------

def _dim(spark, *pairs):
    return spark.createDataFrame(
        [(code, name, None, None, None, "C", None) for code, name in pairs], DIM_COUNTRY)


def _fact(src):
    states = src.withColumn("news_hkey", vault.hash_key(F.col("gkg_record_id")))
    return marts.new_articles(
        marts.article_rows(states, F.lit("t"), ts_lit(DAY1)), None)


def _weekly(spark, src, dim, **options):
    options.setdefault("unique_articles", True)
    return marts.weekly_fact(_fact(src), vault.link_news_country(src),
                             vault.hub_country(src), dim, ts_lit(DAY1), **options)


def test_single_article_has_unknown_volatility(spark):
    row = _weekly(spark, staged(spark, article("a", tone="-2.345,1,2,3,4,5,6")),
                  _dim(spark, ("US", "United States"))).first()
    assert row.stddev_tone_overall is None and row.sentiment_volatility == "Unknown"
    assert row.avg_tone_overall == Decimal("-2.35")
    assert row.risk_intensity_score == Decimal("23.50")
    assert row.week_date == datetime(2026, 1, 5)
    assert row.sentiment_category == "Negative"


def test_country_with_two_codes_counts_once_and_weighs_twice(spark):
    src = staged(spark, article("a", tone="-6,1,1,1,1,0,1", locations="1#a#GB#;1#b#UK#"),
                 article("b", tone="3,1,1,1,1,0,1", locations="1#a#GB#"))
    dim = _dim(spark, ("GB", "United Kingdom"), ("UK", "United Kingdom"))
    for unique in (True, False):
        row = _weekly(spark, src, dim, unique_articles=unique).first()
        assert (row.article_count, row.avg_tone_overall) == (2, Decimal("-3.00"))
        row = _weekly(spark, src, dim, unique_articles=unique, dedupe_country=True).first()
        assert (row.article_count, row.avg_tone_overall) == (2, Decimal("-1.50"))


def test_code_of_two_countries_lands_in_both(spark):
    src = staged(spark, article("a", locations="1#a#NI#"))
    dim = _dim(spark, ("NI", "Nicaragua"), ("NI", "Nigeria"), ("NA", "Namibia"))
    got = _weekly(spark, src, dim).select("country_name", "article_count")
    assert rows(got) == [("Nicaragua", 1), ("Nigeria", 1)]


def test_counts_are_distinct_for_a_fact_with_repeated_keys(spark):
    src = staged(spark, article("a"), article("a", ts="20260106000000"))
    states = src.withColumn("news_hkey", vault.hash_key(F.col("gkg_record_id")))
    fact = marts.article_rows(states, F.lit("t"), ts_lit(DAY1))
    row = marts.weekly_fact(fact, vault.link_news_country(src), vault.hub_country(src),
                            _dim(spark, ("US", "United States")), ts_lit(DAY1)).first()
    assert row.article_count == 1


def test_weekly_schema(spark):
    got = _weekly(spark, staged(spark, article("a")), _dim(spark, ("US", "US"))).schema
    assert [(f.name, f.dataType) for f in got] == [(f.name, f.dataType) for f in WEEKLY_FACT]


def test_late_week_is_ignored_unless_looked_back(spark):
    dim = _dim(spark, ("US", "United States"))
    week1, week2 = article("a", ts="20260105120000"), article("b", ts="20260112120000")
    late = article("c", ts="20260106120000")
    stored = _weekly(spark, staged(spark, week1, week2), dim)
    everything = staged(spark, week1, week2, late)

    def after(lookback):
        since = marts.increment_start(stored, lookback)
        merged = marts.merged_weekly(stored, _weekly(spark, everything, dim, since=since))
        return {r.week_date.day: r.article_count for r in merged.collect()}
    assert after(0) == {5: 1, 12: 1}
    assert after(1) == {5: 2, 12: 1}
    full = {r.week_date.day: r.article_count
            for r in _weekly(spark, everything, dim).collect()}
    assert after(1) == full


def test_increment_start_of_an_empty_target(spark):
    empty = spark.createDataFrame([], WEEKLY_FACT)
    start = spark.range(1).select(marts.increment_start(empty).alias("s")).first()["s"]
    assert start == datetime(1900, 1, 1)
    assert marts.empty_article_fact(spark).schema == ARTICLE_FACT


def test_hot_record_id_is_kept_whole(spark):
    """A third of all rows share one id: still one hub row, all its countries linked."""
    hot = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string"))
        .alias("gkg_record_id"),
        F.array(F.concat(F.char(F.col("id") % 26 + 65), F.lit("A"))).alias("countries"),
        ts_lit(DAY1).alias("load_datetime"))
    assert vault.hub_news(hot).count() == 20001
    links = vault.link_news_country(hot)
    expected = hot.select("gkg_record_id", F.explode("countries").alias("c")).distinct().count()
    assert links.count() == expected


def test_top_and_daily_counts(spark):
    fact = _fact(staged(spark, article("a", tone="-5,1,1,1,1,1,1"),
                        article("b", tone="-9,1,1,1,1,1,1", ts="20260106000000"),
                        article("c", tone="2,1,1,1,1,1,1")))
    assert [r.tone_overall for r in marts.top_negative(fact, 2).collect()] == [-9.0, -5.0]
    since = ts_lit("2026-01-06 00:00:00")
    assert marts.top_negative(fact, 5, since).count() == 1
    assert [(str(r.date), r.articles) for r in marts.articles_per_day(fact).collect()] == [
        ("2026-01-06", 1), ("2026-01-05", 2)]
