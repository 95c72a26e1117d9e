"""Article scoring over fetched pages: text, prompt, relevance, abstract, routing."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from functools import reduce

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from newsvault.constants import (
    ABSTRACT_MAX_WORDS,
    FALLBACK_ABSTRACT,
    NOT_RELEVANT,
    PROMPT_MAX_CHARS,
)
from newsvault.functions import (
    contains_ignoring_case,
    date_lit,
    first_words,
    truncate_chars,
    two_decimals,
)
from newsvault.operators.marts import article_rows
from newsvault.operators.merge import one_per_key
from newsvault.operators.page_text import main_text
from newsvault.operators.pruning import in_time
from newsvault.sinks.tables import append_table, read_table

# Subjects that make the default scorer call an article relevant.
SUBJECTS = ["money launder", "laundering", "financial crime", "corruption", "bribe",
            "fraud", "embezzle", "illicit", "tax evasion", "sanction"]
SAVED, NOT_RELEVANT_OUTCOME, NO_TEXT = "saved", "not_relevant", "fetch_failed"

# Bytes of prompts and texts that a scorer is given at once, if no text is longer.
RUN_BYTES = 2 << 20

# A scorer turns (prompt, text) batches into raw responses; it is built once per task.
Scorer = Callable[[pd.Series, pd.Series], pd.Series]


@F.pandas_udf(StringType())
def _main_text(pages: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in pages:
        yield batch.map(main_text, na_action="ignore")


def page_texts(pages: DataFrame, html: str = "html") -> DataFrame:
    """Pages with ``article_text`` in place of the HTML."""
    return pages.withColumn("article_text", _main_text(F.col(html))).drop(html)


def prompt(text: Column, tone: Column, max_words: int = ABSTRACT_MAX_WORDS) -> Column:
    """The question put to a scoring model for one article."""
    return F.concat(
        F.lit("Is the article below mainly about money laundering or other financial "
              f"crime? If so, answer with an abstract of at most {max_words} words and "
              f'nothing else. If not, answer exactly "{NOT_RELEVANT}".\nTone score: '),
        two_decimals(tone), F.lit("\nArticle:\n"), truncate_chars(text, PROMPT_MAX_CHARS))


def mentions_any(text: Column, subjects: list[str]) -> Column:
    """Whether any subject occurs in the text, whatever the case.

    Plain searches in the lower-cased text; a case-blind pattern is several times slower.
    """
    lowered = F.lower(text)
    hits = [F.contains(lowered, F.lit(s.lower())) for s in subjects]
    return reduce(lambda a, b: a | b, hits)


def subject_response(text: Column, subjects: list[str] = SUBJECTS,
                     max_words: int = ABSTRACT_MAX_WORDS) -> Column:
    """Response of the default scorer: first words of an article on a subject.

    Deterministic and JVM-side. Subjects are looked up in the whole text.
    """
    hit = mentions_any(text, subjects)
    return F.when(hit, first_words(truncate_chars(text, PROMPT_MAX_CHARS), max_words)
                  ).otherwise(NOT_RELEVANT)


def _runs(batches: Iterator[pa.RecordBatch], names: list[str], limit: int = RUN_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with about ``limit`` bytes in the named text columns, one row at least.

    A batch of Spark's holds up to 10,000 rows or 64 MB, and its strings take several times that as
    Python objects. Series whose ``.str`` was used hold themselves, so their texts stay until
    garbage is collected; after each batch this is done, and free memory goes back to the system.
    """
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    for batch in batches:
        sizes = sum(pc.fill_null(pc.binary_length(batch.column(n)), 0).to_numpy(zero_copy_only=False).astype("int64")
                    for n in names)
        ends = sizes.cumsum()
        row = 0
        while row < batch.num_rows:
            end = int(ends.searchsorted((ends[row - 1] if row else 0) + limit, "right"))
            end = max(end, row + 1)
            yield batch.slice(row, end - row)
            row = end
        gc.collect()
        pa.default_memory_pool().release_unused()
        if trim:
            trim(0)


def model_responses(articles: DataFrame, build_scorer: Callable[[], Scorer]) -> DataFrame:
    """Adds ``response`` from a plug-in scorer, some ``RUN_BYTES`` of prompts and texts at a time.

    Answers are taken by position and must be as many as the questions. If a batch fails, its
    articles are asked one by one; only those that fail alone keep a NULL response, which
    post-processing treats as relevant. ``response_error`` holds the reason. Other columns
    stay in Arrow.
    """
    names = articles.columns
    asked = articles.withColumn("prompt", prompt(F.col("article_text"),
                                                 F.col("tone_overall")))

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = build_scorer()
        for run in _runs(batches, ["prompt", "article_text"]):
            batch = run.select(["prompt", "article_text"]).to_pandas()
            has_text = batch["article_text"].notna()
            responses: list = [None] * len(batch)
            errors: list = [None] * len(batch)

            def ask(rows: pd.Index) -> None:
                answers = list(scorer(batch.loc[rows, "prompt"], batch.loc[rows, "article_text"]))
                if len(answers) != len(rows):
                    raise ValueError(f"{len(answers)} answers to {len(rows)} articles")
                for row, one in zip(rows, answers):
                    responses[row] = one

            if has_text.any():
                try:
                    ask(batch.index[has_text])
                except Exception:
                    for row in batch.index[has_text]:
                        try:
                            ask(batch.index[row:row + 1])
                        except Exception as error:
                            errors[row] = f"{type(error).__name__}: {error}"
            text = run.column("article_text").type
            yield pa.RecordBatch.from_arrays(
                [*(run.column(n) for n in names),
                 *(pa.Array.from_pandas(pd.Series(x, dtype=object), type=text) for x in (responses, errors))],
                [*names, "response", "response_error"])

    schema = StructType([*articles.schema.fields, StructField("response", StringType()),
                         StructField("response_error", StringType())])
    return asked.mapInArrow(answer, schema)


def judge(scored: DataFrame, max_words: int = ABSTRACT_MAX_WORDS) -> DataFrame:
    """Adds ``is_relevant``, ``ai_abstract`` and ``outcome`` from text and response.

    No text: fetch failed. NULL response: kept with a fallback abstract.
    """
    response, has_text = F.col("response"), F.col("article_text").isNotNull()
    refused = F.coalesce(contains_ignoring_case(response, NOT_RELEVANT), F.lit(False))
    fallback = F.concat(F.lit(FALLBACK_ABSTRACT), two_decimals(F.col("tone_overall")))
    abstract = F.when(response.isNull(), fallback).otherwise(
        first_words(response, max_words))
    return scored.withColumns({
        "is_relevant": has_text & ~refused,
        "ai_abstract": F.when(has_text & ~refused, abstract),
        "outcome": F.when(~has_text, NO_TEXT).when(refused, NOT_RELEVANT_OUTCOME)
        .otherwise(SAVED)})


def scorable(states: DataFrame) -> DataFrame:
    """Satellite rows of any day that can be scored."""
    return states.where("event_datetime IS NOT NULL AND source_url IS NOT NULL "
                        "AND tone_overall IS NOT NULL")


def day_slice(states: DataFrame, first_day: str, last_day: str | None = None) -> DataFrame:
    """Satellite rows of a day or a span of days that can be scored.

    A range on the time and, where stored, on the day, so other days are not read.
    """
    start = date_lit(first_day).cast("timestamp_ntz")
    end = F.date_add(date_lit(last_day or first_day), 1).cast("timestamp_ntz")
    return in_time(states, start, end).where(
        "source_url IS NOT NULL AND tone_overall IS NOT NULL")


def most_negative_first(states: DataFrame) -> DataFrame:
    return states.orderBy("tone_overall")


def with_page_text(articles: DataFrame, pages: DataFrame) -> DataFrame:
    """Articles with the text of their page, NULL where there is none.

    Text is extracted once per wanted page, before the join, so HTML is not multiplied by
    articles. One page per url is kept. A url that many articles share is a skewed key of
    an outer join, which adaptive execution splits.
    """
    wanted = articles.select(F.col("source_url").alias("url")).distinct()
    texts = page_texts(pages.select("page_id", "url", "html")
                       .join(wanted, "url", "left_semi"))
    by_url = (one_per_key(texts, ["url"], ["page_id"])
              .select(F.col("url").alias("source_url"), "article_text"))
    return articles.join(by_url, "source_url", "left")


def score_articles(articles: DataFrame, build_scorer: Callable[[], Scorer] | None = None,
                   subjects: list[str] = SUBJECTS) -> DataFrame:
    """Articles with response, relevance, abstract and outcome."""
    answered = (articles.withColumn(
        "response", F.when(F.col("article_text").isNotNull(),
                           subject_response(F.col("article_text"), subjects)))
        if build_scorer is None else model_responses(articles, build_scorer))
    return judge(answered)


RESPONSES = StructType([StructField("asked", StringType()), StructField("response", StringType())])


def _asked() -> Column:
    """Names a question: the hash of its prompt and of the whole text."""
    return F.sha2(F.concat_ws("\n", prompt(F.col("article_text"), F.col("tone_overall")), "article_text"), 256)


def score_resumable(articles: DataFrame, store: str, build_scorer: Callable[[], Scorer], slices: int = 16
                    ) -> DataFrame:
    """``score_articles`` that keeps what the scorer has answered, so a stopped run goes on.

    Distinct questions without a stored response are asked in ``slices`` jobs by hash; each job
    adds its responses to the folder ``store`` when it ends. A rerun asks only what is missing, and
    equal articles are asked once. A question that fails is not stored and is asked again.
    """
    spark = articles.sparkSession
    with_key = articles.withColumn("asked", F.when(F.col("article_text").isNotNull(), _asked()))
    open_ = one_per_key(with_key.where("asked IS NOT NULL").select("asked", "article_text", "tone_overall"), ["asked"])
    for part in range(slices):
        todo = open_.where(F.conv(F.substring("asked", 1, 8), 16, 10).cast("long") % slices == part)
        stored = read_table(spark, store, RESPONSES)
        if stored is not None:
            todo = todo.join(stored.select("asked"), "asked", "left_anti")
        answered = model_responses(todo, build_scorer)
        append_table(answered.where("response_error IS NULL").select("asked", "response"), store)
    stored = one_per_key(read_table(spark, store, RESPONSES), ["asked"])
    return judge(with_key.join(stored, "asked", "left").drop("asked"))


def outcome_aggregates() -> list[Column]:
    """Counters of articles scanned, saved, not relevant, and without text."""
    outcome = F.col("outcome")
    return [F.count(F.lit(1)).alias("scanned"),
            F.count_if(outcome == SAVED).alias("saved"),
            F.count_if(outcome == NOT_RELEVANT_OUTCOME).alias("not_relevant"),
            F.count_if(outcome == NO_TEXT).alias("fetch_failed")]


def outcome_counts(scored: DataFrame) -> DataFrame:
    """The counters per day."""
    return scored.groupBy(F.col("event_datetime").cast("date").alias("day")).agg(
        *outcome_aggregates())


def insights(scored: DataFrame, generated_at: Column) -> DataFrame:
    """Relevant articles in the shape of the article fact."""
    return article_rows(scored.where("is_relevant"), F.col("ai_abstract"), generated_at)
