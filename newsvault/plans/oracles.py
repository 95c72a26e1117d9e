"""The catalogue's queries in DuckDB SQL, written independently of the Spark code.

Statements share named subqueries; each one carries those it uses.
"""

from __future__ import annotations

import re

_L1 = "TIMESTAMP '2026-02-01 06:00:00'"
_L2 = "TIMESTAMP '2026-02-02 06:00:00'"
_SPLIT = "TIMESTAMP '2024-01-16 00:00:00'"


def _parsed(source: str, load: str) -> str:
    return f"""
 SELECT c0 AS gkg_record_id, try_strptime(c1, '%Y%m%d%H%M%S') AS event_datetime,
  c3 AS source_domain, c4 AS source_url,
  TRY_CAST(p[1] AS DOUBLE) AS tone_overall, TRY_CAST(p[2] AS DOUBLE) AS tone_positive,
  TRY_CAST(p[3] AS DOUBLE) AS tone_negative, TRY_CAST(p[4] AS DOUBLE) AS tone_polarity,
  TRY_CAST(p[5] AS DOUBLE) AS tone_activity,
  CAST(trunc(coalesce(TRY_CAST(p[7] AS DOUBLE), 0)) AS INTEGER) AS word_count,
  coalesce(list_sort(list_distinct(list_filter(
    list_transform(str_split(c9, ';'), lambda l: trim(str_split(l, '#')[3])),
    lambda c: regexp_full_match(c, '[A-Za-z]{{2}}')))), []) AS countries,
  {load} AS load_datetime
 FROM (SELECT *, str_split(c15, ',') AS p FROM {source})"""


def _states(source: str) -> str:
    return f"""
 SELECT md5(gkg_record_id) AS news_hkey, load_datetime, event_datetime, source_domain,
  source_url, tone_overall, tone_positive, tone_negative, tone_polarity, tone_activity,
  word_count,
  md5(concat_ws('|', coalesce(CAST(event_datetime AS VARCHAR), ''),
   coalesce(source_domain, ''), coalesce(CAST(tone_overall AS VARCHAR), ''),
   coalesce(CAST(tone_positive AS VARCHAR), ''),
   coalesce(CAST(tone_negative AS VARCHAR), ''),
   coalesce(CAST(tone_polarity AS VARCHAR), ''),
   coalesce(CAST(tone_activity AS VARCHAR), ''),
   coalesce(CAST(word_count AS VARCHAR), ''))) AS hashdiff,
  'stg_gkg_news' AS record_source
 FROM {source}"""


def _hub_news(source: str) -> str:
    return f"""SELECT DISTINCT md5(gkg_record_id) AS news_hkey, gkg_record_id,
  load_datetime, 'stg_gkg_news' AS record_source FROM {source}"""


def _mention(source: str) -> str:
    return f"""SELECT gkg_record_id, unnest(countries) AS country_code, load_datetime
  FROM {source}"""


def _hub_country(source: str) -> str:
    return f"""SELECT DISTINCT md5(country_code) AS country_hkey, country_code,
  load_datetime, 'stg_gkg_news' AS record_source FROM {source}"""


def _link(source: str) -> str:
    return f"""SELECT DISTINCT
  md5(concat_ws('|', md5(gkg_record_id), md5(country_code))) AS news_country_hkey,
  md5(gkg_record_id) AS news_hkey, md5(country_code) AS country_hkey, load_datetime,
  'stg_gkg_news' AS record_source FROM {source}"""


def _fact(source: str, stamp: str) -> str:
    return f"""SELECT md5(gkg_record_id) AS news_hkey, event_datetime, source_domain,
  source_url, tone_overall, tone_positive, tone_negative, tone_polarity,
  'Summary unavailable. Tone: ' || printf('%.2f', tone_overall) AS ai_abstract,
  {stamp} AS generated_at
 FROM {source} WHERE source_url IS NOT NULL AND tone_overall IS NOT NULL
  AND event_datetime IS NOT NULL"""


def _curated(fact: str) -> str:
    return f"""SELECT f.news_hkey, f.event_datetime, f.tone_overall, f.tone_positive,
  f.tone_negative, f.tone_polarity, f.source_domain, d.country_name, d.continent,
  row_number() OVER (PARTITION BY f.news_hkey, d.country_name, d.continent
                     ORDER BY d.country_code) AS nth
 FROM {fact} f JOIN lnk l ON f.news_hkey = l.news_hkey
 JOIN hubc h ON l.country_hkey = h.country_hkey
 JOIN dim d ON h.country_code = d.country_code"""


def _weekly(curated: str) -> str:
    return f"""SELECT *,
  CAST(round(CASE WHEN avg_tone_overall >= 0 THEN 0 ELSE abs(avg_tone_overall) * 10 END, 2)
       AS DECIMAL(18,2)) AS risk_intensity_score,
  CASE WHEN avg_tone_overall < -5 THEN 'Very Negative'
       WHEN avg_tone_overall < -2 THEN 'Negative' WHEN avg_tone_overall < 2 THEN 'Neutral'
       WHEN avg_tone_overall < 5 THEN 'Positive' ELSE 'Very Positive'
  END AS sentiment_category,
  CASE WHEN stddev_tone_overall IS NULL THEN 'Unknown'
       WHEN stddev_tone_overall > 3 THEN 'High Volatility'
       WHEN stddev_tone_overall > 1.5 THEN 'Moderate Volatility'
       ELSE 'Low Volatility' END AS sentiment_volatility,
  {_L1} AS fact_created_at
 FROM (SELECT date_trunc('week', event_datetime) AS week_date, country_name, continent,
   count(DISTINCT news_hkey) AS article_count,
   count(DISTINCT source_domain) AS unique_sources,
   round(CAST(avg(tone_overall) AS DECIMAL(18,3)), 2) AS avg_tone_overall,
   round(CAST(avg(tone_positive) AS DECIMAL(18,3)), 2) AS avg_tone_positive,
   round(CAST(avg(tone_negative) AS DECIMAL(18,3)), 2) AS avg_tone_negative,
   round(CAST(avg(tone_polarity) AS DECIMAL(18,3)), 2) AS avg_tone_polarity,
   round(CAST(min(tone_overall) AS DECIMAL(18,3)), 2) AS min_tone_overall,
   round(CAST(max(tone_overall) AS DECIMAL(18,3)), 2) AS max_tone_overall,
   round(CAST(stddev_samp(tone_overall) AS DECIMAL(18,3)), 2) AS stddev_tone_overall
  FROM {curated} GROUP BY ALL)"""


def _source_weeks(fact: str) -> str:
    """Week x source measures from exact decimal sums, which no order of rows changes."""
    return f"""SELECT week_date, source_domain, n AS article_count, min_tone, max_tone,
  round(CAST(total::DOUBLE / n AS DECIMAL(18,3)), 2) AS avg_tone,
  CASE WHEN n > 1 THEN round(CAST(sqrt(greatest((squares::DOUBLE - total::DOUBLE ** 2 / n) / (n - 1), 0))
       AS DECIMAL(18,3)), 2) END AS stddev_tone
 FROM (SELECT date_trunc('week', event_datetime) AS week_date, source_domain, count(*) AS n,
   min(tone_overall) AS min_tone, max(tone_overall) AS max_tone,
   sum(CAST(tone_overall AS DECIMAL(18,6))) AS total,
   sum(CAST(tone_overall AS DECIMAL(18,6)) * CAST(tone_overall AS DECIMAL(18,6))) AS squares
  FROM {fact} GROUP BY 1, 2)"""


def _tick(ts: str) -> str:
    return f"time_bucket(INTERVAL 15 MINUTE, {ts}, TIMESTAMP '2000-01-01')"


_CTES = {
    "n": """SELECT n_nationkey AS k, n_name, r_name,
  chr(CAST(65 + n_nationkey AS INT)) || chr(CAST(65 + n_regionkey AS INT)) AS code
 FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "dim": """SELECT code AS country_code, n_name AS country_name, r_name AS continent FROM n
 UNION ALL SELECT 'Z' || chr(CAST(65 + k AS INT)), n_name, r_name FROM n WHERE k < 5""",
    "feed": """SELECT event_id, ts, event_type,
  strftime(ts, '%Y%m%d%H%M%S') || '-' || event_id AS c0,
  CASE WHEN event_id % 97 = 0 THEN 'bad' ELSE strftime(ts, '%Y%m%d%H%M%S') END AS c1,
  'site' || (user_id % 20) || '.example.com' AS c3,
  CASE WHEN event_id % 89 <> 0 THEN 'http://news.example.com/' || event_id END AS c4,
  CASE event_type WHEN 'error' THEN 'ECON_MONEYLAUNDERING,12;TAX,3'
   WHEN 'purchase' THEN 'WB_2076_MONEY_LAUNDERING,5' WHEN 'click' THEN NULL
   ELSE 'EDUCATION,9' END AS c8,
  CASE WHEN event_id % 13 <> 0 THEN
   '1#p#' || a.code || '#r#0#0#f;4#q#' || b.code || '#r#0#0#f;1#p#' ||
   CASE WHEN event_id % 25 < 5 THEN 'Z' || chr(CAST(65 + event_id % 25 AS INT))
        ELSE 'x1' END || '#r#0#0#f' END AS c9,
  (event_id % 25 - 12) || '.' || lpad(CAST(event_id % 100 AS VARCHAR), 2, '0') || ',' ||
   (event_id % 10) || ',' ||
   CASE WHEN event_id % 31 = 0 THEN 'x' ELSE CAST(event_id % 7 AS VARCHAR) END ||
   ',1.5,2,0,' || (event_id % 900) AS c15
 FROM events JOIN n a ON a.k = event_id % 25 JOIN n b ON b.k = (event_id * 7) % 25""",
    "bronze": """SELECT * FROM feed
 WHERE c8 LIKE '%ECON_MONEYLAUNDERING%' OR c8 LIKE '%WB_2076_MONEY_LAUNDERING%'""",
    "stg": _parsed("bronze", _L1),
    "stg1": _parsed(f"(SELECT * FROM bronze WHERE ts < {_SPLIT})", _L1),
    "stg2": _parsed("bronze", _L2),
    "stgx": """SELECT * REPLACE (CASE WHEN source_domain LIKE '%0.example.com'
  THEN word_count + 1 ELSE word_count END AS word_count) FROM stg2""",
    "hubn": _hub_news("stg"),
    "ment": _mention("stg"),
    "hubc": _hub_country("ment"),
    "lnk": _link("ment"),
    "sat": _states("stg"),
    "fact": _fact("stg", _L1),
    "cur": _curated("fact"),
    "wk": _weekly("cur"),
    "ticks": f"""SELECT event_type AS dataset, {_tick('ts')} AS tick_at,
  CAST(strftime({_tick('ts')}, '%Y%m%d%H%M%S') AS BIGINT) AS file_ts,
  count(*) AS n_rows,
  count(*) FILTER (c8 LIKE '%ECON_MONEYLAUNDERING%' OR c8 LIKE '%WB_2076_MONEY_LAUNDERING%')
   AS matched_rows,
  count(*) FILTER (event_id % 101 = 0) > 0 AS broken
 FROM feed GROUP BY ALL""",
    "bounds": """SELECT dataset, min(tick_at) AS start_at, max(tick_at) AS end_at
 FROM ticks GROUP BY ALL""",
    "cal": """SELECT dataset, unnest(generate_series(start_at, end_at + INTERVAL 30 MINUTE,
  INTERVAL 15 MINUTE)) AS tick_at FROM bounds""",
    "outc": """SELECT * FROM (SELECT *, min(CASE WHEN future THEN file_ts END)
   OVER (PARTITION BY dataset) AS stop
  FROM (SELECT c.dataset, CAST(strftime(c.tick_at, '%Y%m%d%H%M%S') AS BIGINT) AS file_ts,
    t.n_rows * 100 AS bytes, t.matched_rows,
    t.dataset IS NULL AND c.tick_at > b.end_at AS future,
    CASE WHEN t.dataset IS NULL THEN 'skipped' WHEN t.broken THEN 'failed'
     WHEN t.matched_rows > 0 THEN 'downloaded' ELSE 'skipped' END AS status,
    CASE WHEN t.dataset IS NULL AND c.tick_at > b.end_at THEN '404 - Future date'
     WHEN t.dataset IS NULL THEN '404 Not Found' WHEN t.broken THEN 'unreadable'
     WHEN t.matched_rows > 0 THEN NULL ELSE 'No AML themes found' END AS error_message
   FROM cal c JOIN (SELECT max(end_at) AS end_at FROM bounds) b ON true
   LEFT JOIN ticks t ON t.dataset = c.dataset AND t.tick_at = c.tick_at))
 WHERE stop IS NULL OR file_ts <= stop""",
    "files": f"""SELECT dataset, file_ts,
  'http://feed.example.com/v2/' || file_ts || '.gkg.csv.zip' AS url,
  file_ts || '.gkg.csv.zip' AS filename, 'run_' || dataset AS run_id, status, bytes,
  error_message, {_L1} AS inserted_at, {_L1} AS updated_at,
  CASE WHEN status IN ('downloaded', 'failed') THEN {_L1} END AS download_ended_at
 FROM outc""",
    "moved": """SELECT dataset, max(file_ts) AS mark FROM outc
 WHERE status <> 'failed' AND error_message IS DISTINCT FROM '404 - Future date'
 GROUP BY dataset""",
}

def _used(text: str, names: list[str]) -> set[str]:
    return {n for n in names if re.search(rf"\b{n}\b", text)}


def sql(body: str, **extra: str) -> str:
    """The statement with the subqueries it needs, each computed once."""
    known = {**_CTES, **extra}
    needed, todo = set(), _used(body, list(known))
    while todo:
        needed |= todo
        todo = set().union(*(_used(known[n], list(known)) for n in todo)) - needed
    parts = ",\n".join(f"{n} AS MATERIALIZED ({t})" for n, t in known.items() if n in needed)
    return f"WITH {parts}\n{body}"


_FACT_COLS = ("news_hkey, event_datetime, source_domain, source_url, tone_overall, "
              "tone_positive, tone_negative, tone_polarity, ai_abstract, generated_at")
_SAT_COLS = ("news_hkey, load_datetime, event_datetime, source_domain, source_url, "
             "tone_overall, tone_positive, tone_negative, tone_polarity, tone_activity, "
             "word_count, hashdiff, record_source")
_LINES = "SELECT c0 AS record_id, c1 AS event_text, c3 AS source_domain, c4 AS source_url, " \
         "c8 AS themes, c9 AS locations_raw, c15 AS tone_raw FROM "

_MODEL = {"hub_news": "hubn", "hub_country": "hubc", "link_news_country": "lnk",
          "sat_news_tone": "sat", "dim_country": "dim", "fact_ai_news_insights": "fact",
          "fact_countries": "wk"}
_CHECKS = """not_null hub_news news_hkey
not_null hub_country country_hkey
not_null sat_news_tone news_hkey load_datetime
not_null link_news_country news_country_hkey news_hkey country_hkey
not_null dim_country country_code country_name
not_null fact_ai_news_insights news_hkey event_datetime source_domain source_url tone_overall ai_abstract generated_at
not_null fact_countries week_date country_name
unique hub_news news_hkey
unique hub_country country_hkey
unique link_news_country news_country_hkey
unique fact_ai_news_insights news_hkey"""
_LINKED = [("link_news_country", "news_hkey", "hubn", "news_hkey"),
           ("link_news_country", "country_hkey", "hubc", "country_hkey"),
           ("hub_country", "country_code", "dim", "country_code")]


def _model_checks() -> str:
    counts = []
    for line in _CHECKS.splitlines():
        test, table, *columns = line.split()
        for column in columns:
            source = (f"{_MODEL[table]} WHERE {column} IS NULL" if test == "not_null" else
                      f"(SELECT {column} FROM {_MODEL[table]} GROUP BY 1 HAVING count(*) > 1)")
            counts.append((table, column, test, f"SELECT count(*) FROM {source}"))
    for table, column, parent, key in _LINKED:
        counts.append((table, column, "relationships",
                       f"SELECT count(DISTINCT {column}) FROM {_MODEL[table]} "
                       f"WHERE {column} NOT IN (SELECT {key} FROM {parent})"))
    rows = " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, '{k}' AS test, ({q}) AS failures"
        for t, c, k, q in counts)
    return (f"SELECT *, CASE WHEN failures > 0 THEN 'fail' ELSE 'pass' END AS status "
            f"FROM ({rows})")


# The late delivery: purchases before the split arrive only with the second load.
_EARLY = f"bronze WHERE ts < {_SPLIT} AND event_type <> 'purchase'"
_DOC_SUBJECTS = "secret|password|license|contact"
_DOC_CTES = {
    "doc": """SELECT doc_id, source, CAST(doc_id % 21 AS DOUBLE) - 10 AS tone_overall,
  CASE WHEN length(squished) > 100 THEN squished END AS article_text
 FROM (SELECT *, trim(regexp_replace(text, '[\\s\\x{85}\\p{Z}]+', ' ', 'g')) AS squished
       FROM documents)""",
    "cut": """SELECT *, CASE WHEN length(article_text) > 4000
  THEN substr(article_text, 1, 4000) || '...' ELSE article_text END AS short
 FROM doc""",
    "words": """SELECT *, str_split(short, ' ') AS w,
  regexp_matches(article_text, '(?i)""" + _DOC_SUBJECTS + """') AS hit FROM cut""",
    "scored": """SELECT *, CASE WHEN NOT hit THEN 'NOT RELEVANT' WHEN len(w) > 40
   THEN array_to_string(w[1:40], ' ') || '...' ELSE short END AS response FROM words""",
    "judged": """SELECT *, article_text IS NOT NULL
   AND NOT contains(upper(response), 'NOT RELEVANT') AS is_relevant FROM scored""",
    "routed": """SELECT *, CASE WHEN article_text IS NULL THEN 'fetch_failed'
   WHEN is_relevant THEN 'saved' ELSE 'not_relevant' END AS outcome FROM judged""",
}


def statements() -> dict[str, str]:
    first_fact = _fact("stg1", _L1)
    out = {
        "weekly_country_fact": sql("SELECT * FROM wk"),
        "bronze_theme_filter": sql(_LINES + "bronze"),
        "stg_parse": sql("SELECT * EXCLUDE (countries) FROM stg"),
        "stg_countries": sql("""SELECT gkg_record_id, CASE WHEN len(countries) > 0
  THEN '{' || array_to_string(countries, ',') || '}' END AS countries,
  len(countries) AS n_countries FROM stg"""),
        "stg_load_stats": sql("""SELECT count(*) AS n_rows, min(event_datetime) AS first_event,
  max(event_datetime) AS last_event, CAST(sum(len(countries)) AS BIGINT) AS country_mentions
  FROM stg"""),
        "pg_array_explode": sql("SELECT * FROM ment"),
        "hub_news": sql("SELECT * FROM hubn"),
        "hub_country": sql("SELECT * FROM hubc"),
        "link_news_country": sql("SELECT * FROM lnk"),
        "sat_news_tone": sql("SELECT * FROM sat"),
        "hub_increment": sql(
            "SELECT * FROM h1 UNION ALL SELECT * FROM h2 "
            "WHERE news_hkey NOT IN (SELECT news_hkey FROM h1)",
            h1=_hub_news("stg1"), h2=_hub_news("stg2")),
        "hub_country_increment": sql(
            "SELECT * FROM h1 UNION ALL SELECT * FROM h2 "
            "WHERE country_hkey NOT IN (SELECT country_hkey FROM h1)",
            m1=_mention("stg1"), m2=_mention("stg2"), h1=_hub_country("m1"),
            h2=_hub_country("m2")),
        "link_increment": sql(
            "SELECT * FROM h1 UNION ALL SELECT * FROM h2 "
            "WHERE news_country_hkey NOT IN (SELECT news_country_hkey FROM h1)",
            m1=_mention("stg1"), m2=_mention("stg2"), h1=_link("m1"), h2=_link("m2")),
        "sat_increment": sql(
            "SELECT * FROM s1 UNION ALL SELECT * FROM s2 "
            "WHERE (news_hkey, hashdiff) NOT IN (SELECT news_hkey, hashdiff FROM s1)",
            s1=_states("stg1"), s2=_states("stgx")),
        "article_fact": sql("SELECT * FROM fact"),
        "insert_if_absent": sql(
            "SELECT * FROM f1 UNION ALL SELECT * FROM f2 "
            "WHERE news_hkey NOT IN (SELECT news_hkey FROM f1)",
            f1=first_fact, f2=_fact("stg2", _L2)),
        "curated_articles": sql("SELECT * EXCLUDE (nth), nth = 1 AS first_mention FROM cur"),
        "weekly_increment": sql(
            "SELECT * FROM w1 WHERE week_date < (SELECT max(week_date) FROM w1) "
            "UNION ALL SELECT * FROM wk WHERE week_date >= (SELECT max(week_date) FROM w1)",
            early=_parsed(f"(SELECT * FROM {_EARLY})", _L1), f1=_fact("early", _L1),
            c1=_curated("f1"), w1=_weekly("c1")),
        "weekly_lookback": sql(
            "SELECT * FROM w1 WHERE week_date < (SELECT max(week_date) - INTERVAL 7 DAY "
            "FROM w1) UNION ALL SELECT * FROM wk WHERE week_date >= "
            "(SELECT max(week_date) - INTERVAL 7 DAY FROM w1)",
            early=_parsed(f"(SELECT * FROM {_EARLY})", _L1), f1=_fact("early", _L1),
            c1=_curated("f1"), w1=_weekly("c1")),
        "weekly_dedup_country": sql("SELECT * FROM w1",
                                    c1="SELECT * FROM cur WHERE nth = 1",
                                    w1=_weekly("c1")),
        "sentiment_bands": sql("""SELECT sentiment_category, count(*) AS n,
  min(avg_tone_overall) AS low, max(avg_tone_overall) AS high FROM wk GROUP BY ALL"""),
        "volatility_bands": sql("""SELECT sentiment_volatility, count(*) AS n,
  min(stddev_tone_overall) AS low, max(stddev_tone_overall) AS high FROM wk GROUP BY ALL"""),
        "risk_ranking": sql("""SELECT country_name, max(risk_intensity_score) AS peak_risk,
  CAST(sum(article_count) AS BIGINT) AS articles FROM wk GROUP BY ALL"""),
        "day_slice_negative_first": sql(f"""SELECT {_SAT_COLS} FROM sat
  WHERE CAST(event_datetime AS DATE) = DATE '2024-01-15' AND source_url IS NOT NULL
  AND tone_overall IS NOT NULL ORDER BY tone_overall"""),
        "top_negative_k": sql(f"SELECT {_FACT_COLS} FROM fact "
                              "ORDER BY tone_overall, news_hkey LIMIT 5"),
        "top_negative_last7d": sql(
            f"SELECT {_FACT_COLS} FROM fact WHERE event_datetime >= "
            "TIMESTAMP '2024-01-24 00:00:00' ORDER BY tone_overall, news_hkey LIMIT 10"),
        "top_negative_stored": sql(
            f"SELECT {_FACT_COLS} FROM fact WHERE event_datetime >= "
            "TIMESTAMP '2024-01-24 00:00:00' ORDER BY tone_overall, news_hkey LIMIT 10"),
        "weekly_co_located": sql("SELECT * FROM wk"),
        "articles_per_day": sql("""SELECT CAST(event_datetime AS DATE) AS date,
  count(*) AS articles FROM fact GROUP BY ALL"""),
        "days_behind": sql(f"""SELECT dataset AS process_name,
  CAST(end_at AS DATE) AS last_processed_date, {_L1} AS updated_at,
  CAST(DATE '2024-02-05' - CAST(end_at AS DATE) AS INTEGER) AS days_behind FROM bounds"""),
        "feed_calendar": sql("""SELECT CAST(strftime(t, '%Y%m%d%H%M%S') AS BIGINT) AS file_ts,
  t AS tick_at, strftime(t, '%Y%m%d%H%M%S') || '.gkg.csv.zip' AS filename,
  'http://feed.example.com/v2/' || strftime(t, '%Y%m%d%H%M%S') || '.gkg.csv.zip' AS url
 FROM (SELECT unnest(generate_series((SELECT min(start_at) FROM bounds),
   (SELECT max(end_at) FROM bounds), INTERVAL 15 MINUTE)) AS t)"""),
        "next_ticks": sql("""SELECT dataset, file_ts,
  CAST(strftime(tick_at + INTERVAL 15 MINUTE, '%Y%m%d%H%M%S') AS BIGINT) AS next_ts
 FROM ticks"""),
        "feed_gaps": sql("""SELECT o.dataset, o.file_ts FROM outc o
  JOIN moved m ON m.dataset = o.dataset
  WHERE o.file_ts <= m.mark
   AND (o.status NOT IN ('downloaded', 'skipped') OR (o.file_ts // 100) % 7 = 3)"""),
        "read_watermarks": sql("""SELECT d.dataset, coalesce(m.mark, 0) AS watermark
 FROM (SELECT DISTINCT dataset FROM ticks UNION ALL SELECT DISTINCT o_orderpriority
       FROM orders) d LEFT JOIN moved m ON m.dataset = d.dataset"""),
        "resolve_start": sql("""SELECT dataset, mark AS watermark, explicit_start,
  coalesce(explicit_start, CASE WHEN mark < 20240120000000 THEN 20240120000000
   ELSE CAST(strftime(strptime(CAST(mark AS VARCHAR), '%Y%m%d%H%M%S')
        + INTERVAL 15 MINUTE, '%Y%m%d%H%M%S') AS BIGINT) END) AS start_ts
 FROM (SELECT dataset, file_ts AS mark, CASE WHEN n_rows > 2 THEN 20240101000000 END
        AS explicit_start FROM ticks)"""),
        "next_day": sql("""SELECT dataset AS process_name,
  CAST(end_at + INTERVAL 1 DAY AS DATE) AS next_day,
  CAST(end_at + INTERVAL 1 DAY AS DATE) <= DATE '2024-01-31' AS due FROM bounds
 UNION ALL SELECT DISTINCT o_orderpriority, DATE '2026-01-01', false FROM orders"""),
        "close_day": sql(f"""SELECT dataset AS process_name,
  CAST(end_at AS DATE) AS last_processed_date, {_L2} AS updated_at FROM bounds"""),
        "file_outcomes": sql("""SELECT dataset, file_ts, status, bytes, matched_rows,
  error_message FROM outc"""),
        "run_summary": sql("""SELECT run_id, files_processed, files_with_data, files_failed,
  rows_saved, files_with_data * 100.0::DOUBLE / files_processed AS pct_with_data,
  files_processed / 96.0::DOUBLE AS days_covered,
  CASE WHEN files_failed > 0 THEN 'partial' ELSE 'success' END AS final_status
 FROM (SELECT 'run_' || dataset AS run_id, count(*) AS files_processed,
   count(*) FILTER (status = 'downloaded') AS files_with_data,
   count(*) FILTER (status = 'failed') AS files_failed,
   CAST(coalesce(sum(matched_rows) FILTER (status = 'downloaded'), 0) AS BIGINT)
    AS rows_saved FROM outc GROUP BY dataset)"""),
        "files_by_status": sql("""SELECT dataset, file_ts, url, filename, status, bytes,
  CAST(NULL AS VARCHAR) AS checksum, error_message FROM files
  WHERE run_id = 'run_error' AND status = 'downloaded'"""),
        "batch_cap": sql("""SELECT DISTINCT file_ts FROM ticks ORDER BY file_ts LIMIT 96"""),
        "register_files": sql("""SELECT dataset, file_ts, url, filename,
  'rerun' AS run_id, 'queued' AS status, bytes, CAST(NULL AS VARCHAR) AS checksum,
  CAST(NULL AS TIMESTAMP) AS download_started_at, download_ended_at, error_message,
  inserted_at, """ + _L2 + """ AS updated_at FROM files"""),
        "update_files": sql("""SELECT dataset, file_ts, url, filename, run_id,
  CASE WHEN status = 'failed' THEN 'downloading' ELSE status END AS status, bytes,
  CASE WHEN status = 'failed' THEN md5(filename) END AS checksum,
  CASE WHEN status = 'failed' THEN """ + _L2 + """ END AS download_started_at,
  download_ended_at, error_message, inserted_at,
  CASE WHEN status = 'failed' THEN """ + _L2 + """ ELSE updated_at END AS updated_at
 FROM files"""),
        "advance_watermarks": sql(f"""SELECT dataset, mark AS last_successful_file_ts,
  {_L2} AS updated_at, 'run_' || dataset AS last_run_id FROM moved"""),
        "reset_watermarks": sql(f"""SELECT dataset,
  CASE WHEN dataset < 'm' THEN 0 ELSE mark END AS last_successful_file_ts,
  CASE WHEN dataset < 'm' THEN {_L2} ELSE {_L1} END AS updated_at,
  'run_' || dataset AS last_run_id FROM moved"""),
        "run_lifecycle": sql(f"""SELECT 'run_' || dataset AS run_id, dataset,
  {_L1} AS started_at, {_L2} AS ended_at,
  CASE WHEN count(*) FILTER (status = 'failed') > 0 THEN 'partial' ELSE 'success' END
   AS status, 17280 AS max_files_per_run, {_L1} AS catalog_snapshot_at,
  CAST(count(*) AS INTEGER) AS files_detected,
  CAST(count(*) FILTER (status = 'downloaded') AS INTEGER) AS files_selected,
  CAST(count(*) FILTER (status = 'downloaded') AS INTEGER) AS files_downloaded,
  CAST(count(*) FILTER (status = 'failed') AS INTEGER) AS files_failed,
  CAST(NULL AS VARCHAR) AS error_message
 FROM outc GROUP BY dataset"""),
        "seed_dim_scan": sql("SELECT country_code, country_name, continent FROM dim"),
        "table_roundtrip": sql("""SELECT 'staging' AS table_name, count(*) AS n_rows FROM stg
 UNION ALL SELECT 'hub_news', count(*) FROM hubn
 UNION ALL SELECT 'fact_ai_news_insights', count(*) FROM fact"""),
        "weekly_partition_upsert": sql("SELECT * FROM wk"),
        "dq_not_null": sql("""SELECT 'stg' AS table_name, c AS column_name,
  'not_null' AS test, f AS failures, CASE WHEN f > 0 THEN 'fail' ELSE 'pass' END AS status
 FROM (SELECT unnest(['gkg_record_id', 'event_datetime', 'source_url', 'tone_negative'])
   AS c, unnest([count(*) FILTER (gkg_record_id IS NULL),
   count(*) FILTER (event_datetime IS NULL), count(*) FILTER (source_url IS NULL),
   count(*) FILTER (tone_negative IS NULL)]) AS f FROM stg)"""),
        "dq_unique": sql("""SELECT t AS table_name, c AS column_name, 'unique' AS test,
  f AS failures, CASE WHEN f > 0 THEN 'fail' ELSE 'pass' END AS status FROM (
  SELECT 'hub_news' AS t, 'news_hkey' AS c, (SELECT count(*) FROM (SELECT news_hkey
   FROM hubn GROUP BY 1 HAVING count(*) > 1)) AS f
  UNION ALL SELECT 'link_news_country', 'news_hkey', (SELECT count(*) FROM (
   SELECT news_hkey FROM lnk GROUP BY 1 HAVING count(*) > 1)))"""),
        "dq_orphans": sql("""SELECT t AS table_name, c AS column_name,
  'relationships' AS test, f AS failures,
  CASE WHEN f > 0 THEN 'fail' ELSE 'pass' END AS status FROM (
  SELECT 'link_news_country' AS t, 'news_hkey' AS c, (SELECT count(DISTINCT news_hkey)
   FROM lnk WHERE news_hkey NOT IN (SELECT news_hkey FROM fact)) AS f
  UNION ALL SELECT 'hub_country', 'country_code', (SELECT count(DISTINCT country_code)
   FROM hubc WHERE country_code NOT IN (SELECT country_code FROM dim)))"""),
        "dq_model": sql(_model_checks()),
        "export_order": sql("""SELECT week_date, country_name, continent, article_count,
  risk_intensity_score, sentiment_category FROM wk ORDER BY week_date DESC, country_name"""),
        "export_csv": sql("""SELECT news_hkey, event_datetime, source_url, tone_overall,
  ai_abstract FROM fact ORDER BY event_datetime DESC"""),
        "schema_sync": sql("""SELECT news_hkey, event_datetime, tone_overall,
  CAST(NULL AS VARCHAR) AS language FROM f1 UNION ALL
  SELECT news_hkey, event_datetime, tone_overall, 'en' FROM f2
  WHERE news_hkey NOT IN (SELECT news_hkey FROM f1)""", f1=first_fact,
                           f2=_fact("stg2", _L2)),
        "schema_versions": sql("""SELECT news_hkey, event_datetime, tone_overall,
  CAST(NULL AS VARCHAR) AS language FROM f1 UNION ALL
  SELECT news_hkey, event_datetime, tone_overall, 'en' FROM f2
  WHERE news_hkey NOT IN (SELECT news_hkey FROM f1)""", f1=first_fact,
                           f2=_fact("stg2", _L2)),
        "zip_tsv_scan": sql(_LINES + "bronze"),
        "tsv_scan": sql(_LINES + "feed"),
        "tsv_width_check": sql("""SELECT 27 AS fields, true AS width_ok, count(*) AS n
  FROM feed"""),
        "rejected_lines": sql("""SELECT CASE WHEN fields = 27 THEN 'accepted' ELSE 'rejected' END AS route,
  c0 AS record_id, fields, CASE WHEN fields <> 27 THEN 'expected 27 fields, found ' || fields END AS reason,
  true AS placed
 FROM (SELECT c0, CASE event_id % 50 WHEN 1 THEN 26 WHEN 2 THEN 28 ELSE 27 END AS fields FROM feed)"""),
        "damaged_archives": sql("""SELECT '' AS kind, CAST(NULL AS VARCHAR) AS error, count(*) AS n_lines FROM feed
 UNION ALL SELECT 'none', 'not a readable zip archive', 0
 UNION ALL SELECT 'cut', 'damaged archive', 0
 UNION ALL SELECT 'empty', 'empty file', 0"""),
        "skipped_files": sql("""SELECT 'good' AS kind, strftime(ts, '%Y%m%d') AS day, 'complete' AS state,
  count(*) AS n_lines FROM feed GROUP BY ALL
 UNION ALL SELECT 'cut', '', 'cut', count(*) FROM feed WHERE event_id < 3
 UNION ALL SELECT 'empty', '', 'empty', 0"""),
        "file_provenance": sql("""SELECT 'bronze' AS kind, count(*) AS n_rows,
  count(*) AS with_source, count(DISTINCT ts::DATE) AS n_folders FROM bronze"""),
        "stream_vault": sql("""SELECT 'hub_news' AS table_name, news_hkey AS key FROM hubn
 UNION ALL SELECT 'hub_country', country_hkey FROM hubc
 UNION ALL SELECT 'link_news_country', news_country_hkey FROM lnk
 UNION ALL SELECT 'sat_news_tone', hashdiff FROM sat"""),
        "stream_weekly": sql("SELECT * FROM wk"),
        "stream_weekly_window": sql(f"SELECT week_date, source_domain, article_count, avg_tone, stddev_tone FROM ({_source_weeks('fact')})"),
        "stream_repeats": sql(f"SELECT week_date, source_domain, article_count, avg_tone, stddev_tone FROM ({_source_weeks('fact')})"),
        "stream_late_rows": sql(f"""SELECT week_date, source_domain, count(*) AS n, min(tone_overall) AS low,
  CASE WHEN first OR week_date >= (SELECT max(date_trunc('week', event_datetime)) FROM f1) THEN 'on time'
       ELSE 'late' END AS route
 FROM (SELECT fact.*, date_trunc('week', event_datetime) AS week_date,
         news_hkey IN (SELECT news_hkey FROM f1) AS first FROM fact) GROUP BY ALL""",
                                early=_parsed(f"(SELECT * FROM {_EARLY})", _L1), f1=_fact("early", _L1)),
        "weekly_moments": sql(f"""SELECT week_date, source_domain, article_count, avg_tone, stddev_tone,
  min_tone, max_tone, true AS sketch_close FROM ({_source_weeks('fact')})"""),
        "weekly_ordered": sql("""SELECT row_number() OVER (ORDER BY week_date DESC, article_count DESC, country_name) AS place,
  week_date, country_name, article_count, risk_intensity_score FROM wk"""),
        "vault_customer_hub": f"""SELECT md5(CAST(c_custkey AS VARCHAR)) AS customer_hkey,
  c_custkey, {_L1} AS load_datetime, 'crm' AS record_source FROM customer""",
        "vault_orders_link": f"""SELECT DISTINCT
  md5(concat_ws('|', md5(CAST(o_orderkey AS VARCHAR)), md5(CAST(o_custkey AS VARCHAR))))
   AS order_customer_hkey, md5(CAST(o_orderkey AS VARCHAR)) AS order_hkey,
  md5(CAST(o_custkey AS VARCHAR)) AS customer_hkey, {_L1} AS load_datetime,
  'shop' AS record_source FROM orders""",
        "vault_orders_sat": f"""SELECT md5(CAST(o_orderkey AS VARCHAR)) AS order_hkey,
  {_L1} AS load_datetime, o_orderstatus, o_totalprice, o_orderpriority,
  md5(concat_ws('|', coalesce(o_orderstatus, ''),
   coalesce(CAST(o_totalprice AS VARCHAR), ''))) AS hashdiff, 'shop' AS record_source
 FROM orders""",
        "article_prompt": sql(
            "SELECT doc_id, length(short) AS n_prompt_chars, "
            "printf('%.2f', tone_overall) AS tone_text FROM cut", **_DOC_CTES),
        "article_score": sql(
            "SELECT doc_id, is_relevant, CASE WHEN is_relevant THEN response END "
            "AS ai_abstract, outcome FROM routed", **_DOC_CTES),
        "article_score_plugin": sql(
            "SELECT doc_id, CASE WHEN length(article_text) % 7 <> 0 THEN "
            "length(article_text) || ' characters' END AS response, "
            "coalesce(length(article_text) % 7 = 0, false) AS failed FROM doc", **_DOC_CTES),
        "score_counters": sql(
            "SELECT source, count(*) AS scanned, "
            "count(*) FILTER (outcome = 'saved') AS saved, "
            "count(*) FILTER (outcome = 'not_relevant') AS not_relevant, "
            "count(*) FILTER (outcome = 'fetch_failed') AS fetch_failed "
            "FROM routed GROUP BY ALL", **_DOC_CTES),
    }
    out.update(_page_statements())
    return out


def _unescaped(text: str) -> str:
    """The text with its entities resolved; HTML lets these end without a semicolon."""
    for entity, char in (("nbsp;?", "chr(160)"), ("lt;?", "'<'"), ("gt;?", "'>'"),
                         ("quot;?", "'\"'"), ("#39;?", "chr(39)"), ("mdash;", "chr(8212)"),
                         ("amp;?", "'&'")):
        text = f"regexp_replace({text}, '&{entity}', {char}, 'g')"
    return text


# Page text: the pages hold one article each, so its text is everything between the
# article tags with tags turned into blanks and entities resolved.
_PAGE_CTES = {
    "pg0": """SELECT page_id, url, regexp_replace(regexp_replace(html,
   '(?s)<!--.*?-->', ' ', 'g'),
   '(?s)<script\\b.*?</script>|<style\\b.*?</style>|<nav\\b.*?</nav>|<footer\\b.*?</footer>|<header\\b.*?</header>', ' ', 'g') AS h FROM pages""",
    "pg1": """SELECT page_id, url,
  regexp_extract(h, '(?s)<article[^>]*>(.*?)</article>', 1) AS h FROM pg0""",
    "pg2": "SELECT page_id, url, trim(regexp_replace(" + _unescaped(
        "regexp_replace(h, '<[^>]*>', ' ', 'g')") +
    """, '[\\s\\x{85}\\p{Z}]+', ' ', 'g')) AS t FROM pg1""",
    "pg": """SELECT page_id, url, CASE WHEN length(t) > 100 THEN t END AS article_text FROM pg2""",
}


def _page_statements() -> dict[str, str]:
    scored = """SELECT s.*, p.article_text,
  regexp_matches(p.article_text, '(?i)money|bank|the') AS hit
 FROM art s LEFT JOIN pg p ON p.url = s.page_url"""
    art = """SELECT f.*, q.url AS page_url FROM (SELECT fact.*, feed.event_id FROM fact
  JOIN feed ON md5(feed.c0) = fact.news_hkey) f
 JOIN pages q ON q.page_id = f.event_id % (SELECT count(*) FROM pages)"""
    return {
        "page_main_text": sql("SELECT page_id, article_text FROM pg", **_PAGE_CTES),
        "daily_backfill": sql(
            "SELECT CAST(event_datetime AS DATE) AS day, count(*) AS scanned, "
            "count(*) FILTER (article_text IS NOT NULL AND hit) AS saved, "
            "count(*) FILTER (article_text IS NOT NULL AND NOT hit) AS not_relevant, "
            "count(*) FILTER (article_text IS NULL) AS fetch_failed FROM sc GROUP BY ALL",
            **_PAGE_CTES, art=art, sc=scored),
    }
