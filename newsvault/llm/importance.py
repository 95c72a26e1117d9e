"""Importance resampling of documents towards the benchmark's distribution of word runs.

A 256-byte table lower-cases A-Z and blanks what separates words, right in the UTF-8 bytes;
``bytes.split`` then gives the words. The checksum of a word is the seed of the checksum of the run
that it begins, so runs of one to three words are hashed without being joined. Counters of
hashed runs, of a fixed number of buckets, are summed over the corpus and over the target; each
bucket gets an integer gain, a document weighs the sum of its runs' gains, and Gumbel noise from its
doc_id turns the highest scores into a draw without replacement.

Only the buckets' counts, of which there are ``BUCKETS`` at most, come to the driver. Ranks are
positions in range partitions. Very long texts are worked on in stretches that hand on their last
checksums, so a task holds the words of one stretch.

Defined results: null and empty texts have no word, weigh 0 and are never drawn; a null doc_id has the
noise of the empty string and comes last among equal scores; repeated rows are documents of their own, with
ranks of their own; without target texts, or without documents, the counts are 0 and the gains
follow from the same formula; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsvault.operators.numbering import with_position

from . import blocks
from .frames import table, written

BUCKETS = 10_000
RUN = 3
SEED, PERCENT, LEAST_WORDS = 42, 5, 20
STRETCH = 1 << 20

_TABLE = bytes(c + 32 if 0x41 <= c <= 0x5A
               else c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A
               else 0x20 for c in range(256))


def stretches(text: bytes, size: int = STRETCH) -> Iterator[list[bytes]]:
    """Words of a text, some at a time; stretches end at blanks."""
    text = text.translate(_TABLE)
    at = 0
    while at < len(text):
        end = len(text) if len(text) - at <= size else text.find(b" ", at + size)
        end = len(text) if end < 0 else end
        yield text[at:end].split()
        at = end


def run_checksums(text: bytes, size: int = STRETCH) -> Iterator[tuple[int, list[int]]]:
    """(number of words, checksums of all runs that end in them) for each stretch of a text."""
    ends: list[list[int]] = [[] for _ in range(RUN - 1)]     # the last checksum of each length, if any
    for words in stretches(text, size):
        if not words:
            continue
        sums = list(map(crc32, words))
        every, spaced = list(sums), [b" " + w for w in words]
        for k in range(RUN - 1):
            seeds = ends[k] + sums               # each run of k + 1 words that the next word extends
            ends[k] = seeds[-1:]
            # the first runs of a text are short of words: runs and their next words end together
            skip = len(words) + 1 - len(seeds)
            sums = list(map(crc32, spaced[skip:], seeds)) if skip <= len(words) else []
            every += sums
        yield len(words), every


def _texts(run: pa.RecordBatch) -> Iterator[bytes]:
    data, offsets = blocks.flat(run.column("text"))
    view = memoryview(data)
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        yield bytes(view[a:b])


def _buckets(sums: list[int], buckets: int) -> np.ndarray:
    return np.array(sums, np.int64) % buckets


def _count(buckets: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[int] = Counter()
        for run in blocks.runs(batches):
            for text in _texts(run):
                for _, sums in run_checksums(text):
                    seen.update(_buckets(sums, buckets).tolist())
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(list(seen.keys()), pa.int64()),
                                          "n": pa.array(list(seen.values()), pa.int64())})
    return count


def bucket_counts(docs: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n) over all runs of all texts; tasks count first."""
    return docs.select("text").mapInArrow(_count(buckets), "bucket long, n long") \
        .groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, gain) of every bucket, from two frames of bucket counts."""
    both = corpus.withColumns({"s": F.col("n"), "t": F.lit(0)}).unionByName(
        target.withColumns({"s": F.lit(0), "t": F.col("n")}))
    both = corpus.sparkSession.range(buckets).select(
        F.col("id").alias("bucket"), F.lit(0).alias("s"), F.lit(0).alias("t")).unionByName(both.drop("n"))
    both = written(both.groupBy("bucket").agg(F.sum("s").alias("s"), F.sum("t").alias("t")), "counts")
    total = both.agg(F.sum("s").alias("s"), F.sum("t").alias("t")).first()
    s, t = F.col("s").cast("double"), F.col("t").cast("double")
    ratio = ((t + 1) * float(total.s + buckets)) / ((s + 1) * float(total.t + buckets))
    return both.select("bucket", F.floor(1000 * F.log(ratio)).alias("gain"))


def _weigh(gain: np.ndarray):
    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in blocks.runs(batches):
            words, features, weights = [], [], []
            for text in _texts(run):
                n = m = w = 0
                for k, sums in run_checksums(text):
                    n, m = n + k, m + len(sums)
                    w += int(gain[_buckets(sums, len(gain))].sum())
                words.append(n)
                features.append(m)
                weights.append(w)
            yield pa.RecordBatch.from_pydict({
                "doc_id": run.column("doc_id"), "n_words": pa.array(words, pa.int64()),
                "n_features": pa.array(features, pa.int64()), "weight": pa.array(weights, pa.int64())})
    return weigh


def weights(docs: DataFrame, gain: DataFrame) -> DataFrame:
    """doc_id, n_words, n_features and weight of each document, from a gain for every bucket."""
    rows = gain.collect()                                       # one for each bucket
    of = np.zeros(len(rows), np.int64)
    for r in rows:
        of[r.bucket] = r.gain
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _weigh(of), "doc_id long, n_words long, n_features long, weight long")


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """Gumbel noise in thousandths, from the hash of seed and doc_id."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296)))


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS,
             seed: int = SEED, buckets: int = BUCKETS) -> DataFrame:
    """Every document with its weight and score, and its rank if it is drawn."""
    gain = gains(bucket_counts(docs, buckets), bucket_counts(target, buckets), buckets)
    rows = weights(docs, gain).withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))
    rows = written(rows, "weighed")
    usable = rows.where(F.col("n_words") >= least_words)
    drawn = usable.count() * percent // 100
    # which of the equal rows is drawn first makes no difference, but they must be told apart
    placed = with_position(usable.withColumn("_row", F.monotonically_increasing_id()),
                           [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("_row")], "rank")
    ranked = placed.withColumn("rank", F.when(F.col("rank") < drawn, F.col("rank") + 1)).drop("_row")
    short = rows.where(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("long"))
    return ranked.unionByName(short)


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents scored against all benchmark texts; a twentieth of them drawn."""
    rows = resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return rows.select("doc_id", "n_features", "weight", "score", "rank", "n_words")


ORACLE = r"""
WITH crc_table AS (SELECT list(c ORDER BY i) AS tab FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)::UINTEGER[]::BIGINT[]),
        lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
    FROM range(256) r(i))),
texts AS (SELECT 's' AS side, row_number() OVER () AS rid, doc_id,
            translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
          UNION ALL SELECT 't', -row_number() OVER (), NULL,
            translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') FROM benchmark),
words AS (SELECT side, rid, doc_id,
            coalesce(regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM texts),
runs AS (SELECT side, rid, unnest(w) AS f FROM words
         UNION ALL SELECT side, rid, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM words
         UNION ALL SELECT side, rid, unnest(list_transform(range(1, len(w) - 1),
                            lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) FROM words),
counted AS (SELECT f, side, rid, count(*) AS n FROM runs GROUP BY ALL),
hashed AS (SELECT f, xor(list_reduce(list_prepend(4294967295, list_transform(regexp_extract_all(hex(encode(f)), '..'),
             lambda v: ('0x' || v)::BIGINT)),
             lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS bucket
           FROM (SELECT DISTINCT f FROM counted), crc_table),
sides AS (SELECT bucket, coalesce(sum(n) FILTER (side = 's'), 0) AS s, coalesce(sum(n) FILTER (side = 't'), 0) AS t
          FROM counted JOIN hashed USING (f) GROUP BY bucket),
total AS (SELECT sum(s)::DOUBLE AS s_all, sum(t)::DOUBLE AS t_all FROM sides),
gain AS (SELECT bucket, floor(1000 * ln(((t + 1)::DOUBLE * (s_all + 10000)) / ((s + 1)::DOUBLE * (t_all + 10000))))::BIGINT AS g
         FROM sides, total),
weighed AS (SELECT rid, sum(n)::BIGINT AS m, sum(n * g)::BIGINT AS weight
            FROM counted JOIN hashed USING (f) JOIN gain USING (bucket) WHERE side = 's' GROUP BY rid),
scored AS (SELECT rid, doc_id, len(w)::BIGINT AS n_words, coalesce(m, 0) AS n_features, coalesce(weight, 0) AS weight,
             coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('42:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT
                 + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
           FROM words LEFT JOIN weighed USING (rid) WHERE side = 's'),
ranked AS (SELECT rid, row_number() OVER (ORDER BY score DESC, doc_id ASC NULLS LAST) AS r, count(*) OVER () AS n
           FROM scored WHERE n_words >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN r <= 5 * n // 100 THEN r END AS rank, n_words
FROM scored LEFT JOIN ranked USING (rid)
"""
