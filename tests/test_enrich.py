import pandas as pd
import pytest
from pyspark.sql import functions as F

from newsvault.functions import ts_lit
from newsvault.operators import enrich, vault
from newsvault.operators.page_text import main_text
from tests.helpers import DAY1, article, staged

LONG = "word " * 30


@pytest.mark.parametrize("html,expected", [
    (f"<p>out</p><article><h1>T</h1><p>{LONG}</p></article>", f"T {LONG}".strip()),
    (f"<div class='x article-body'>{LONG}<br>end</div><main>no</main>", f"{LONG}end"),
    (f"<main><nav>menu</nav>{LONG}<script>var a='</p>'</script>z</main>", f"{LONG}z"),
    (f"<p>{LONG}</p><div>no</div><p>a<b>b</b> c</p>", f"{LONG}abc"),
    (f"<header><article>no</article></header><p>{LONG}</p>", LONG.strip()),
    (f"<article>{LONG}&amp; x&eacute;<!-- hidden -->y</article>", f"{LONG}& xé y"),
    (f"<article><h1>x &amp</h1>{LONG}</article>", f"x & {LONG}".strip()),
    (f"<footer>f</footer><article><p><b>{LONG}<br><p>t</article><p>u</p>", f"{LONG}t"),
    ("<article>short</article>", None),
    ("", None), (None, None),
    ("<p>" + "a" * 100 + "</p>", None), ("<p>" + "a" * 101 + "</p>", "a" * 101),
])
def test_main_text(html, expected):
    assert main_text(html) == expected


def scored_frame(spark, *items):
    return spark.createDataFrame(
        [(i, *item) for i, item in enumerate(items)],
        "i int, article_text string, tone_overall double, response string")


def test_judging(spark):
    words = " ".join(["w"] * 41)
    df = scored_frame(spark, ("t", -3.1, words), ("t", 1.0, " short abstract "),
                      ("t", 1.0, "This is not relevant."), ("t", -3.1, None),
                      (None, 1.0, None))
    got = [(r.is_relevant, r.ai_abstract, r.outcome)
           for r in enrich.judge(df).orderBy("i").collect()]
    assert got == [
        (True, " ".join(["w"] * 40) + "...", "saved"), (True, "short abstract", "saved"),
        (False, None, "not_relevant"), (True, "Summary unavailable. Tone: -3.10", "saved"),
        (False, None, "fetch_failed")]


def test_prompt_is_cut_and_shows_the_tone(spark):
    df = spark.createDataFrame([("x" * 5000, -2.5)], "t string, tone double")
    text = df.select(enrich.prompt(F.col("t"), F.col("tone"))).first()[0]
    assert "-2.50" in text and "x" * 4000 + "..." in text and "x" * 4001 not in text


def test_plug_in_scorer_and_its_failure(spark):
    df = spark.createDataFrame([("a", 1.0), (None, 2.0)],
                               "article_text string, tone_overall double")

    def good():
        return lambda prompts, texts: pd.Series([f"about {t}" for t in texts],
                                                index=texts.index)

    def broken():
        def scorer(prompts, texts):
            raise RuntimeError("model is down")
        return scorer
    got = {r.article_text: r for r in enrich.score_articles(df, good).collect()}
    assert got["a"].ai_abstract == "about a" and got[None].outcome == "fetch_failed"
    got = {r.article_text: r for r in enrich.score_articles(df, broken).collect()}
    assert got["a"].ai_abstract == "Summary unavailable. Tone: 1.00"


def test_answers_are_taken_by_position_and_fail_one_by_one(spark):
    df = spark.createDataFrame([(None, 0.0), ("a", 1.0), (None, 2.0), ("bad", 3.0), ("c", 4.0)],
                               "article_text string, tone_overall double").coalesce(1)

    def fresh_index():
        def scorer(prompts, texts):
            if (texts == "bad").any():
                raise RuntimeError("cannot read this")
            return pd.Series([t.upper() for t in texts])
        return scorer

    def short():
        return lambda prompts, texts: ["one"] * (len(texts) - 1)
    got = {r.tone_overall: r for r in enrich.model_responses(df, fresh_index).collect()}
    assert [got[t].response for t in (0.0, 1.0, 2.0, 3.0, 4.0)] == [None, "A", None, None, "C"]
    assert "cannot read this" in got[3.0].response_error and got[1.0].response_error is None
    assert all("answers" in r.response_error for r in enrich.model_responses(df, short).collect()
               if r.article_text)


def test_scorers_get_runs_of_bounded_bytes(spark):
    long = enrich.RUN_BYTES + 9
    df = spark.range(300).select("id", F.lit(1.0).alias("tone_overall"), F.expr(
        f"if(id % 10 = 3, null, repeat('é', if(id = 150, {long}, 10000)))").alias("article_text")).coalesce(1)

    def sizes():
        return lambda prompts, texts: [f"{len(texts)} {sum(len(x.encode()) for x in [*prompts, *texts])}"] * len(texts)
    got = {r.id: r for r in enrich.model_responses(df, sizes).collect()}
    assert len(got) == 300 and all(r.response_error is None for r in got.values())
    assert [i for i, r in got.items() if r.response is None] == list(range(3, 300, 10))
    assert all(len(r.article_text) == (long if i == 150 else 10000) for i, r in got.items() if r.response)
    assert got[150].response.startswith("1 ")
    assert all(int(r.response.split()[1]) <= enrich.RUN_BYTES for i, r in got.items() if r.response and i != 150)


def test_subjects_are_found_in_the_whole_text(spark):
    text = "x " * 30000 + "FRAUD"
    df = spark.createDataFrame([(text, 1.0), ("y " * 80, 1.0)],
                               "article_text string, tone_overall double")
    assert sorted(r.is_relevant for r in enrich.score_articles(df).collect()) == [False, True]


def test_pages_join_by_url_even_when_one_url_is_hot(spark):
    src = staged(spark, *[article(f"r{i}", url="hot" if i % 3 == 0 else f"u{i}")
                          for i in range(90)])
    pages = spark.createDataFrame(
        [(2, "hot", f"<p>second {LONG}</p>"), (1, "hot", f"<p>first {LONG}</p>"),
         (3, "u1", f"<article>{LONG}</article>"), (4, "unused", "<p>x</p>")],
        "page_id long, url string, html string")
    states = enrich.day_slice(vault.sat_news_tone(src), "2026-01-05")
    got = enrich.with_page_text(states, pages)
    assert got.count() == 90
    hot = got.where("source_url = 'hot'").select("article_text").distinct().collect()
    assert [r[0] for r in hot] == [f"first {LONG}".strip()]
    counts = enrich.outcome_counts(enrich.score_articles(got, subjects=["first"])).first()
    assert (counts.scanned, counts.saved, counts.not_relevant, counts.fetch_failed) == (
        90, 30, 1, 59)


def test_day_slice(spark):
    src = staged(spark, article("a", ts="20260105235959"), article("b", ts="20260106000000"),
                 article("c", url=None), article("d", tone="x"))
    states = vault.sat_news_tone(src)
    assert enrich.day_slice(states, "2026-01-05").count() == 1
    assert enrich.day_slice(states, "2026-01-05", "2026-01-06").count() == 2
    order = [r.tone_overall for r in enrich.most_negative_first(states.where(
        "tone_overall IS NOT NULL")).collect()]
    assert order == sorted(order)


def test_insights_have_the_fact_columns(spark):
    df = vault.sat_news_tone(staged(spark, article("a"))).withColumn(
        "article_text", F.lit("fraud"))
    row = enrich.insights(enrich.score_articles(df), ts_lit(DAY1)).first()
    assert row.ai_abstract == "fraud" and row.source_domain == "d.example.com"
