from datetime import datetime
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from newsvault import functions as fn
from tests.helpers import values


def test_rounding_goes_through_three_places(spark):
    got = values(spark, [2.3447, 2.344, -2.3447, None], fn.round2, "c double")
    assert got == [Decimal("2.35"), Decimal("2.34"), Decimal("-2.35"), None]


def test_bands_at_their_limits(spark):
    tones = [Decimal(x) for x in ("-5.01", "-5", "-2.01", "-2", "1.99", "2", "4.99", "5")]
    assert values(spark, tones, fn.sentiment_band, "c decimal(18,2)") == [
        "Very Negative", "Negative", "Negative", "Neutral", "Neutral", "Positive",
        "Positive", "Very Positive"]
    spreads = [None, Decimal("3"), Decimal("3.01"), Decimal("1.5"), Decimal("1.51")]
    assert values(spark, spreads, fn.volatility_band, "c decimal(18,2)") == [
        "Unknown", "Moderate Volatility", "High Volatility", "Low Volatility",
        "Moderate Volatility"]


def test_risk_is_zero_or_ten_times_the_tone_and_not_capped(spark):
    tones = [Decimal("0"), Decimal("3.2"), Decimal("-2.35"), Decimal("-20")]
    assert values(spark, tones, fn.risk_score, "c decimal(18,2)") == [
        Decimal("0.00"), Decimal("0.00"), Decimal("23.50"), Decimal("200.00")]


def test_numbers_are_coerced_never_refused(spark):
    texts = ["1.5", " -2 ", "1e3", ".5", "x", "", None, "nan", "inf", "1.5d", "1_0"]
    assert values(spark, texts, fn.to_double) == [
        1.5, -2.0, 1000.0, 0.5, None, None, None, None, None, None, None]
    assert values(spark, ["12.7", "x", None, "-3.9"], fn.to_int_or_zero) == [12, 0, 0, -3]


def test_compact_times(spark):
    texts = ["20260101003000", "2026x", "20261301000000", "20260101240000", "2026", None,
             "20260101000060", " 20260101003000"]
    assert values(spark, texts, fn.parse_compact_ts) == [
        datetime(2026, 1, 1, 0, 30), None, None, None, None, None, None, None]
    assert values(spark, [20260101234500, 20260228234500], fn.next_tick, "c long") == [
        20260102000000, 20260301000000]


def test_weeks_start_on_monday(spark):
    times = [datetime(2026, 1, 1, 5), datetime(2026, 1, 4, 23, 59), datetime(2026, 1, 5)]
    assert values(spark, times, fn.week_start, "c timestamp_ntz") == [
        datetime(2025, 12, 29), datetime(2025, 12, 29), datetime(2026, 1, 5)]


def test_week_does_not_depend_on_the_session_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert values(spark, ["20260308023000"], lambda c: fn.week_start(
            fn.parse_compact_ts(c))) == [datetime(2026, 3, 2)]
        assert values(spark, ["20260308023000"], fn.parse_compact_ts) == [
            datetime(2026, 3, 8, 2, 30)]
        both = lambda c: fn.utc_day(fn.utc_instant(fn.parse_compact_ts(c))).cast("string")
        assert values(spark, ["20260308023000", "20260308235959"], both) == [
            "2026-03-08", "2026-03-08"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_country_codes(spark):
    texts = ["1#a#US#", "1#a#U1#", "1#a#USA#", "1#a# ca #", "1#a", "", None,
             "1#a#US#;2#b#CA#x;3#c#US#", "1#a#NA#r;bad;#;##", "1#é#ÉÈ#r", "##AB",
             "1#a#\tGB\u00a0#;x"]
    assert values(spark, texts, fn.country_codes) == [
        ["US"], [], [], ["ca"], [], [], [], ["CA", "US"], ["NA"], ["ÉÈ"], ["AB"], ["GB"]]


def _codes_by_hand(text):
    found = set()
    for location in text.split(";"):
        parts = location.split("#")
        if len(parts) > 2:
            code = parts[2].strip()
            if len(code) == 2 and code.isalpha():
                found.add(code)
    return sorted(found)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet="aB1#; é", max_size=14), min_size=60, max_size=60))
def test_country_codes_equal_a_split_by_hand(spark, texts):
    assert values(spark, texts, fn.country_codes) == [_codes_by_hand(t) for t in texts]


def test_array_text_round_trip(spark):
    df = spark.createDataFrame([(0, ["CA", "US"]), (1, []), (2, None), (3, ["A"])],
                               "i int, c array<string>")
    text = df.select("i", fn.to_pg_array(F.col("c")).alias("t"))
    got = text.select("t", fn.from_pg_array(F.col("t")).alias("a"),
                      fn.pg_array_size(F.col("t")).alias("n")).orderBy("i").collect()
    assert [tuple(r) for r in got] == [
        ("{CA,US}", ["CA", "US"], 2), (None, None, 0), (None, None, 0), ("{A}", ["A"], 1)]
    assert values(spark, ["{}", ""], fn.from_pg_array) == [None, None]


def test_themes(spark):
    texts = [None, "ECON_MONEYLAUNDERING_X", "TAX", "A;WB_2076_MONEY_LAUNDERING,4"]
    assert values(spark, texts, fn.theme_match) == [False, True, False, True]


def test_text_limits(spark):
    words = lambda n: " ".join(f"w{i}" for i in range(n))
    assert values(spark, [words(41), f"  {words(40)} ", "a  b", None],
                  lambda c: fn.first_words(c, 40)) == [
        words(40) + "...", words(40), "a  b", None]
    assert values(spark, ["abcd", "abc"], lambda c: fn.truncate_chars(c, 3)) == [
        "abc...", "abc"]
    assert values(spark, ["a" * 100, "a" * 101], lambda c: fn.keep_if_longer(c, 100)) == [
        None, "a" * 101]
    assert values(spark, [" a\n\t b\u00a0c "], fn.squish) == ["a b c"]
    assert values(spark, ["is not Relevant.", "fine"],
                  lambda c: fn.contains_ignoring_case(c, "NOT RELEVANT")) == [True, False]


def test_number_formats(spark):
    assert values(spark, [-3.1, 2.0], fn.two_decimals, "c double") == ["-3.10", "2.00"]
    assert values(spark, [0.0001, 12345678.0, -2.5, 100.0, 0.00123, 0.0], fn.number_text,
                  "c double") == ["0.0001", "12345678.0", "-2.5", "100.0", "0.00123", "0.0"]
    df = spark.createDataFrame([(1, 4), (1, 0)], "a int, b int")
    assert [r[0] for r in df.select(fn.percent(F.col("a"), F.col("b"))).collect()] == [
        25.0, None]


def test_hash_keys(spark):
    import hashlib
    md5 = lambda s: hashlib.md5(s.encode()).hexdigest()
    assert values(spark, ["US", None], fn.hash_key) == [md5("US"), None]
    df = spark.createDataFrame([(md5("a"), md5("b"))], "x string, y string")
    got = df.select(fn.composite_key(F.col("x"), F.col("y"))).first()[0]
    assert got == md5(md5("a") + "|" + md5("b"))


def test_feed_names(spark):
    assert values(spark, [20260101001500], fn.feed_file_name, "c long") == [
        "20260101001500.gkg.csv.zip"]
    assert values(spark, [20260101001500], lambda c: fn.feed_url(c, "http://h.example/v/"),
                  "c long") == ["http://h.example/v/20260101001500.gkg.csv.zip"]


@pytest.mark.parametrize("expr", ["weekday", "date_trunc"])
def test_week_start_equals_builtin(spark, expr):
    df = spark.sql("SELECT explode(sequence(TIMESTAMP_NTZ'2024-02-25 03:00:00', "
                   "TIMESTAMP_NTZ'2024-03-15 03:00:00', INTERVAL 7 HOURS)) AS t")
    other = (F.date_trunc("week", "t").cast("timestamp_ntz") if expr == "date_trunc" else
             (F.col("t").cast("date") - F.weekday("t")).cast("timestamp_ntz"))
    assert df.where(fn.week_start(F.col("t")) != other).count() == 0
