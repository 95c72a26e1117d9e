"""Quality rules as a ledger of failure bits, in column expressions only.

Every rule is evaluated once per document: the ledger row has the measurements and one bit for
each rule that failed. A policy is a versioned mask of rules, so applying one, comparing two
and dropping a rule from one are bitwise work on the ledger; texts are not read again.

Defined results: a null or empty text has no word and fails ``few_words``; null doc_ids and
repeated rows each get a row; an empty table gives no rows; extra columns are ignored; texts of
any length are measured whole.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .frames import table

WHITE = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 8

# Bits never change their meaning; a new rule takes a new bit.
RULES = {"few_words": 0, "repeated_words": 1, "symbol_heavy": 2, "short_words": 3,
         "long_words": 4, "repeated_lines": 5}
BASE = ("few_words", "repeated_words")


@dataclass(frozen=True)
class Policy:
    """A named version of the set of rules that reject a document."""

    name: str
    version: int
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(1 << RULES[r] for r in self.rules)


POLICIES = (
    Policy("base", 1, BASE),
    Policy("prose", 1, BASE + ("symbol_heavy", "short_words", "long_words")),
    Policy("prose", 2, tuple(RULES)),
)
PRODUCTION = POLICIES[-1]


def _repeated_words(starts: Column) -> Column:
    """Words under windows that begin at the sorted starts: each covers up to the next one."""
    reach = F.transform(starts, lambda s, k: F.least(
        F.lit(WINDOW), F.coalesce(F.get(starts, k + 1) - s, F.lit(WINDOW))))
    return F.aggregate(reach, F.lit(0).cast("long"), lambda total, x: total + x)


def measurements(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words.

    Words become 64-bit hashes once, and windows hashes of those. Only a text with fewer distinct
    windows than windows sorts them; equal neighbours then mark the repeated window starts.
    """
    base = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    row = base.select(
        "doc_id", "text", F.trim("text", F.lit(WHITE)).alias("trimmed"),
        F.translate("text", WHITE, "").alias("solid")).select(
        "doc_id",
        F.when(F.col("trimmed") == "", F.array().cast("array<string>"))
        .otherwise(F.split("trimmed", r"[\x20\x09-\x0D]+")).alias("words"),
        F.filter(F.split("text", "\n"), lambda x: F.trim(x, F.lit(WHITE)) != "").alias("lines"),
        F.length("solid").cast("long").alias("word_chars"),
        (F.length("solid") - F.length(F.translate("solid", SYMBOLS, ""))).cast("long")
        .alias("n_symbols"))
    row = row.select(
        "doc_id", "word_chars", "n_symbols", F.size("words").cast("long").alias("n_words"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("coded"))
    row = row.withColumn("windows", F.when(
        F.col("n_words") >= WINDOW,
        F.transform(F.sequence(F.lit(0), F.size("coded") - WINDOW), lambda i: F.xxhash64(
            *(F.get("coded", i + k) for k in range(WINDOW))))))
    row = row.withColumn("ordered", F.when(
        F.size("windows") > F.size(F.array_distinct("windows")),
        F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    near = (lambda k: F.get("ordered", k)["h"])
    row = row.withColumn("starts", F.sort_array(F.filter(F.transform(
        "ordered", lambda p, k: F.when((near(k - 1) == p["h"]) | (near(k + 1) == p["h"]), p["i"])),
        lambda i: i.isNotNull())))
    return row.select("doc_id", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines",
                      F.coalesce(_repeated_words(F.col("starts")), F.lit(0).cast("long"))
                      .alias("n_repeat_words"))


def ledger(docs: DataFrame) -> DataFrame:
    """Measurements and failure_bits, where bit RULES[name] is set if that rule failed."""
    row = measurements(docs)
    c = {x: F.col(x) for x in row.columns}
    failed = {
        "few_words": c["n_words"] < 20,
        "repeated_words": 100 * c["n_repeat_words"] > 30 * c["n_words"],
        "symbol_heavy": 10 * c["n_symbols"] > c["word_chars"],
        "short_words": c["word_chars"] < 2 * c["n_words"],
        "long_words": c["word_chars"] > 20 * c["n_words"],
        "repeated_lines": 2 * c["n_dup_lines"] > c["n_lines"],
    }
    bits = F.lit(0).cast("long")
    for name, bit in RULES.items():
        bits = bits.bitwiseOR(F.when(failed[name], F.lit(1 << bit)).otherwise(F.lit(0)).cast("long"))
    return row.withColumn("failure_bits", bits)


def passes(bits: Column, policy: Policy) -> Column:
    return bits.bitwiseAND(F.lit(policy.mask).cast("long")) == 0


def ablation(rows: DataFrame, policies=POLICIES) -> DataFrame:
    """For each policy and each of its rules: documents kept, kept without the rule, and rejected
    by this rule alone. Ledger rows are first counted by their bits, of which there are few.
    """
    counted = rows.groupBy("failure_bits").count()
    table_of = F.array(*(F.struct(F.lit(p.name).alias("policy"), F.lit(p.version).alias("version"),
                                  F.lit(r).alias("rule"), F.lit(p.mask).cast("long").alias("mask"),
                                  F.lit(1 << RULES[r]).cast("long").alias("bit"))
                         for p in policies for r in p.rules))
    each = counted.select("failure_bits", "count", F.explode(table_of).alias("p")) \
        .select("failure_bits", "count", "p.*")
    hit = F.col("failure_bits").bitwiseAND(F.col("mask"))
    total = (lambda when: F.sum(F.when(when, F.col("count")).otherwise(0)))
    return each.groupBy("policy", "version", "rule").agg(
        total(hit == 0).alias("kept"), total(hit.bitwiseAND(F.bitwise_not("bit")) == 0).alias("kept_without"),
        total(hit == F.col("bit")).alias("rejected_alone"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledger of every document with the base verdict and that of the production policy."""
    rows = ledger(table(spark, sf_dir, "documents"))
    base = POLICIES[0]
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                       (~passes(F.col("failure_bits"), base)).alias("base_failed"),
                       (passes(F.col("failure_bits"), base)
                        & passes(F.col("failure_bits"), PRODUCTION)).alias("kept"), "failure_bits")


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT rid, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
      FROM d),
win AS (SELECT rid, i, ws[i:i + 7] AS win
        FROM (SELECT rid, ws, unnest(range(1, len(ws) - 6)) AS i FROM w WHERE len(ws) >= 8)),
rep AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, win) AS c FROM win)
        WHERE c > 1),
cov AS (SELECT rid, sum(x) AS n FROM (
          SELECT rid, least(8, coalesce(lead(i) OVER (PARTITION BY rid ORDER BY i) - i, 8)) AS x FROM rep)
        GROUP BY rid),
m AS (SELECT w.doc_id, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
        length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
        len(ls)::BIGINT AS n_lines, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
        coalesce(cov.n, 0)::BIGINT AS n_repeat_words
      FROM w LEFT JOIN cov USING (rid)),
f AS (SELECT *, (CASE WHEN n_words < 20 THEN 1 ELSE 0 END)
        + (CASE WHEN 100 * n_repeat_words > 30 * n_words THEN 2 ELSE 0 END)
        + (CASE WHEN 10 * n_symbols > word_chars THEN 4 ELSE 0 END)
        + (CASE WHEN word_chars < 2 * n_words THEN 8 ELSE 0 END)
        + (CASE WHEN word_chars > 20 * n_words THEN 16 ELSE 0 END)
        + (CASE WHEN 2 * n_dup_lines > n_lines THEN 32 ELSE 0 END) AS bits FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (bits & 3) <> 0 AS base_failed, bits = 0 AS kept, bits::BIGINT AS failure_bits FROM f
"""
