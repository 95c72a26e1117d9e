"""Near-duplicate documents by ProbMinHash, banding and exact verification.

A text is a weighted set: its shingles of five words, each weighing as often as it occurs
(fewer words make one shingle). Similarity is the probability Jaccard, which for texts without
repeated shingles is the plain Jaccard. Each shingle is a Poisson process whose rate is its
weight; its arrivals hit random registers, a register keeps the shingle that came first, and
a shingle ends when its next arrival is later than every register of its document.

1. One pass in tasks gives each document a digest of its words and hashes of its bands.
2. Documents with equal words form a class; its smallest doc_id stands for all of them.
3. In each band bucket every class is verified against one leader, the member with most
   company in all its buckets. Buckets never emit all pairs.
4. Where members of a bucket are still in different components, those outside of its largest
   component are verified against the rest, so no link between candidates is lost. Only pairs
   that cannot reach the threshold are left out: shingles that only documents of one component
   have bound what two documents of different components share, and one minus the similarity is
   a metric, so two documents are at least as far apart as their distances to the leader differ.

Texts are shuffled once, for candidates. With 26 bands of 5 rows a pair at similarity 0.8 is
missed with probability 4e-5.

Defined results: null texts, and texts without words, link with nothing; a row with null doc_id
links with nothing, has a null class and is kept; repeated rows come back as often as given,
all in one class; rows of one doc_id with different texts have the links and the class of their own
text each, and are told apart by row_key; equal texts take their smallest doc_id; extra columns
are ignored; an empty table gives no rows; texts of any length are taken whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsvault.operators.numbering import with_position

from . import blocks
from .frames import components, drop_scratch, gathered, table, written

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 26, 5
KEYS_A_TASK = 500_000      # rows of a few numbers
TEXTS_A_TASK = 5_000
MASKS = 8                  # 64-bit words that mark a document's shared shingles
_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


def shingles(words: np.ndarray, rows: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the word shingles of each row, and where each row's begin."""
    n = np.diff(rows)
    count = np.where(n >= size, n - size + 1, np.minimum(n, 1))
    begin = np.r_[0, np.cumsum(count)]
    at = np.repeat(rows[:-1] - begin[:-1], count) + np.arange(begin[-1])
    width = np.repeat(np.minimum(n, size), count)
    out = width.astype(np.uint64) * _C
    padded = np.r_[words, np.zeros(size, np.uint64)]
    for k in range(size):
        step = blocks.mix(out * _A + padded[at + k])
        out = step if (width > k).all() else np.where(width > k, step, out)
    return out, begin


def weigh(items: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct items of each row with their number of times, and their row."""
    row = np.repeat(np.arange(len(begin) - 1), np.diff(begin))
    codes, _, first = blocks.factorize(blocks.mix(items + row.astype(np.uint64) * _B))
    return items[first], np.bincount(codes, minlength=len(first)).astype(float), row[first]


def signatures(items: np.ndarray, weights: np.ndarray, row: np.ndarray, n_rows: int,
               registers: int) -> np.ndarray:
    """(rows, registers) of the shingles that arrive first; rows without items hold zeros."""
    times = np.full(n_rows * registers, np.inf)
    winner = np.zeros(n_rows * registers, np.uint64)
    last = np.full(n_rows, np.inf)
    arrival = np.zeros(len(items))
    step = np.zeros(1, np.uint64)
    while len(items):
        step += _A
        draw = blocks.mix(items + step)
        arrival = arrival - np.log(((draw >> np.uint64(11)) + np.uint64(1)) * 2.0 ** -53) / weights
        alive = arrival <= last[row]
        items, weights, row, arrival = items[alive], weights[alive], row[alive], arrival[alive]
        hit = (blocks.mix(draw[alive] ^ _B) % np.uint64(registers)).astype(np.int64)
        place = row * registers + hit
        np.minimum.at(times, place, arrival)
        first = arrival == times[place]
        winner[place[first]] = items[first]
        live = np.unique(row) if len(row) < n_rows * 4 else np.arange(n_rows)
        last[live] = times.reshape(n_rows, registers)[live].max(1)
    return winner.reshape(n_rows, registers)


def _sign(size: int, bands: int, rows_a_band: int):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for run in blocks.runs(batches, limit=2 * blocks.BLOCK):
                *_, words, rows = blocks.hashed_words(run)
                items, begin = shingles(words, rows, size)
                distinct, weights, row = weigh(items, begin)
                sig = signatures(distinct, weights, row, run.num_rows, bands * rows_a_band)
                keys = np.zeros((run.num_rows, bands), np.uint64)
                keys += np.arange(1, bands + 1, dtype=np.uint64) * _C
                for k in range(rows_a_band):
                    keys = blocks.mix(keys * _A + sig.reshape(-1, bands, rows_a_band)[:, :, k])
                sums = [blocks.sequence_sums(words, rows, salt) for salt in (_A, _B)]    # of the word sequence
                none = np.diff(rows) == 0
                yield pa.RecordBatch.from_arrays(
                    [run.column("doc_id").cast(pa.int64()), run.column("row_key"),
                     *(pa.array(x.view(np.int64), mask=none) for x in sums),
                     pa.ListArray.from_arrays(
                         pa.array(np.r_[0, np.cumsum(np.where(none, 0, bands))].astype(np.int32)),
                         pa.array(keys[~none].ravel().view(np.int64)))],
                    ["doc_id", "row_key", "d1", "d2", "bands"])
    return sign


def probability_jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Exact probability Jaccard of two multisets given as arrays of item hashes."""
    (x, n), (y, m) = (np.unique(v, return_counts=True) for v in (a, b))
    both, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    union = len(x) + len(y) - len(both)
    if not union:
        return 0.0
    if len(both) == 0 or (len(x) == len(a) and len(y) == len(b)):
        return len(both) / union
    p, q = n[i].astype(float), m[j].astype(float)
    ratio = p / q
    order = np.argsort(ratio, kind="stable")
    up, down = (np.r_[0.0, np.cumsum(v[order])] for v in (p, q))
    lighter = np.searchsorted(ratio[order], ratio, "left")
    # an item's share is one over the sum, over all items, of the larger weight in its terms
    more = n.sum() - up[lighter]
    less = down[lighter] + (m.sum() - q.sum())
    return float((1.0 / (more / p + less / q)).sum())


def _verify(size: int):
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for run in blocks.runs(batches, "text_a"):
                sides = []
                for name in ("text_a", "text_b"):
                    column = run.column(name)
                    # a leader's text comes once for each of its members; hash it once
                    coded = column.dictionary_encode()
                    texts = pa.RecordBatch.from_arrays([coded.dictionary], ["t"])
                    *_, words, rows = blocks.hashed_words(texts, "t")
                    sides.append((*shingles(words, rows, size), coded.indices.to_numpy()))
                (x, bx, ix), (y, by, iy) = sides
                same = [probability_jaccard(x[bx[i]:bx[i + 1]], y[by[j]:by[j + 1]]) for i, j in zip(ix, iy)]
                yield pa.RecordBatch.from_arrays([run.column("a"), run.column("b"), pa.array(same, pa.float64())],
                                                 ["a", "b", "same"])
    return verify


def _verified(pairs: DataFrame, texts: DataFrame, size: int) -> DataFrame:
    """(a, b, same) with the exact similarity; a is the side with fewer distinct values."""
    first, second = (texts.select(F.col("doc_id").alias(c), F.col("text").alias(f"text_{c}"))
                     for c in "ab")
    both = pairs.join(second, "b").join(first, "a").select("a", "b", "text_a", "text_b")
    return written(gathered(both, pairs.count(), TEXTS_A_TASK // 2)
                   .mapInArrow(_verify(size), "a long, b long, same double"), "verified")


def _room(texts: DataFrame, comps: DataFrame, size: int, n: int) -> DataFrame:
    """doc_id, total shingles, whether none repeats (flat), and how many only documents of its own
    component have (alone). comps: doc_id, comp of the open documents, n of them at most."""
    def items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in blocks.runs(batches):
            *_, words, rows = blocks.hashed_words(run)
            distinct, times, row = weigh(*shingles(words, rows, size))
            yield pa.RecordBatch.from_arrays(
                [run.column("doc_id").take(pa.array(row)), run.column("comp").take(pa.array(row)),
                 pa.array(distinct.view(np.int64)), pa.array(times.astype(np.int64))],
                ["doc_id", "comp", "item", "times"])

    rows = written(gathered(texts.join(comps, "doc_id").select("doc_id", "comp", "text"), n, TEXTS_A_TASK).mapInArrow(
        items, "doc_id long, comp long, item long, times long"), "items")
    own = rows.groupBy("item").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo = hi") \
        .select("item", F.lit(True).alias("own"))
    rows = rows.join(own, "item", "left").withColumn("bit", F.pmod("item", F.lit(64 * MASKS)))
    shared = F.col("own").isNull()
    masks = [F.bit_or(F.when(shared & (F.floor(F.col("bit") / 64) == w),
                             F.expr("shiftleft(1L, cast(bit % 64 as int))"))).alias(f"m{w}") for w in range(MASKS)]
    return rows.groupBy("doc_id").agg(
        F.sum("times").alias("total"), (F.max("times") == 1).alias("flat"),
        F.sum(F.when(shared, 0).otherwise(F.col("times"))).alias("alone"), *masks) \
        .fillna(0, [f"m{w}" for w in range(MASKS)])


def _bound():
    """Most that the similarity of x and y can be, given the shingles that the other cannot have.

    For sets it is the common part over the union. The common part is at most the number of bits
    that both masks of shared shingles have, and of the shingles beyond one for each bit, the fewer.
    With weights P and Q are the shares that may be common: the terms are concave and homogeneous,
    so they sum to PQ / (P + (1 - P) Q) at most.
    """
    nx, ny, ux, uy = (F.col(c) for c in ("nx", "ny", "ux", "uy"))
    masks = [(F.col(f"m{w}x"), F.col(f"m{w}y")) for w in range(MASKS)]
    bits = (lambda of: sum((F.bit_count(of(x, y)) for x, y in masks), F.lit(0)))
    both, of_x, of_y = bits(lambda x, y: x.bitwiseAND(y)), bits(lambda x, y: x), bits(lambda x, y: y)
    common = F.least(nx - ux, ny - uy, both + F.least(nx - ux - of_x, ny - uy - of_y))
    p, q = 1 - ux / nx, 1 - uy / ny
    weighted = F.least(p * q / (p + (1 - p) * q), p * q / (q + (1 - q) * p))
    return F.when(F.col("fx") & F.col("fy"), common / (nx + ny - common)).otherwise(weighted)


def _open(member: DataFrame, found: DataFrame, n: int) -> DataFrame:
    """Rows (key, doc_id, ...) of buckets with several components, with comp and the bucket's largest
    component (most); of n rows."""
    member = member.join(found.withColumnRenamed("node", "doc_id"), "doc_id", "left") \
        .withColumn("comp", F.coalesce("root", "doc_id")).drop("root")
    sizes = member.groupBy("key", "comp").count()
    most = sizes.groupBy("key").agg(F.count("*").alias("n"), F.max(F.struct("count", "comp")).alias("m")) \
        .where("n > 1").select("key", F.col("m.comp").alias("most"))
    return written(member.join(most, "key"), "open", n, KEYS_A_TASK)


def _unseen(pairs: DataFrame, seen: DataFrame) -> DataFrame:
    """Pairs of neither order among those seen."""
    order = (lambda df: df.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")))
    return order(pairs).distinct().join(order(seen).distinct(), ["a", "b"], "left_anti")


def classes(docs: DataFrame, size: int = SHINGLE, least: float = SIMILARITY, bands: int = BANDS,
            rows_a_band: int = ROWS) -> DataFrame:
    """doc_id, row_key (hash of doc_id and text), class_id (smallest doc_id of its group of near
    copies), kept.

    Below, doc_id is the node of a content: the place of its word sequence in the order of its
    smallest doc_id. So rows of one doc_id with different texts each have their links, and the
    smallest node of a component is the one with its smallest doc_id.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.col("doc_id").cast("long"), "text").alias("row_key"), "text")
    signed = written(docs.mapInArrow(
        _sign(size, bands, rows_a_band), "doc_id long, row_key long, d1 long, d2 long, bands array<long>"), "signed")
    n = signed.count()
    linkable = signed.where("doc_id is not null and d1 is not null")
    same = written(linkable.groupBy("d1", "d2").agg(F.min("doc_id").alias("rep"),
                                                    F.min_by("row_key", "doc_id").alias("row_key")), "same", n)
    same = written(with_position(same, [F.asc("rep"), F.asc("d1"), F.asc("d2")], "node"), "nodes")
    leads = same.select("node", F.col("rep").alias("doc_id"), "row_key", "d1", "d2")
    coded = written(linkable.join(leads, ["doc_id", "row_key", "d1", "d2"])
                    .select(F.col("node").alias("doc_id"), "bands").dropDuplicates(["doc_id"]), "coded", n)
    keyed = coded.select("doc_id", F.explode("bands").alias("key"))
    buckets = (keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"))
    held = written(keyed.join(buckets, "key"), "buckets", n * bands, KEYS_A_TASK)
    n_held = held.count()
    company = held.groupBy("doc_id").agg(F.sum("n").alias("company"))
    placed = held.join(company, "doc_id")
    leaders = written(placed.groupBy("key").agg(
        F.max(F.struct("company", (-F.col("doc_id")).alias("minus"))).alias("m"))
        .select("key", (-F.col("m.minus")).alias("a")), "leaders", n_held, KEYS_A_TASK)
    stars = written(held.join(leaders, "key").where("doc_id <> a")
                    .select("a", F.col("doc_id").alias("b")).distinct(), "stars", n_held, KEYS_A_TASK)
    asked = stars.select(F.col("b").alias("doc_id")).union(stars.select("a")).distinct()
    # the bucket members are all that a later round can ask for
    asked = asked.join(leads.select(F.col("node").alias("doc_id"), F.col("doc_id").alias("rep"), "row_key"), "doc_id")
    texts = written(docs.select(F.col("doc_id").alias("rep"), "row_key", "text")
                    .join(asked.hint("merge"), ["rep", "row_key"]).select("doc_id", "text")
                    .dropDuplicates(["doc_id"]), "texts", n, TEXTS_A_TASK)
    first = _verified(stars, texts, size)
    links = first.where(F.col("same") >= least).select("a", "b")
    found = components(links)

    # buckets whose members are not yet in one component
    member = _open(held.select("key", "doc_id"), found, n_held)
    room = written(_room(texts, member.select("doc_id", "comp").distinct(), size, n), "room", n)
    far = leaders.join(first, "a").select("key", F.col("b").alias("doc_id"), (1 - F.col("same")).alias("far"))
    member = written(member.join(far, ["key", "doc_id"], "left").fillna(0.0, ["far"])   # the leader is no way from itself
                     .join(room.where(1 - F.col("alone") / F.col("total") >= least), "doc_id")
                     .join(coded, "doc_id"), "member", n_held)
    left, right = (member.select("key", F.col("doc_id").alias(d), F.col("comp").alias(f"c{d}"), "most",
                                 F.col("total").alias(f"n{d}"), F.col("alone").alias(f"u{d}"),
                                 F.col("flat").alias(f"f{d}"), F.col("far").alias(f"d{d}"), F.col("bands").alias(f"b{d}"),
                                 *(F.col(f"m{w}").alias(f"m{w}{d}") for w in range(MASKS))) for d in "xy")
    left, right = left.where("cx <> most").drop("most"), right
    pairs = (left.join(right, "key").where("cx <> cy and (cy = most or x < y)").where(_bound() >= least)
             .where(F.abs(F.col("dx") - F.col("dy")) <= 1 - least + 1e-9)
             .where(F.col("key") == F.get("bx", F.array_position(F.zip_with("bx", "by", lambda p, q: p == q), True)
                                          .cast("int") - 1))      # the first bucket that both are in
             .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
    pairs = written(_unseen(pairs, stars), "pairs", n_held, KEYS_A_TASK)
    more = _verified(pairs, texts, size).where(F.col("same") >= least).select("a", "b")
    merged = found.select(F.col("node").alias("a"), F.col("root").alias("b")).union(more)
    found = components(merged)
    for frame in (texts, held, leaders, member, pairs, coded):
        drop_scratch(frame)
    root = same.select(F.col("node").alias("root"), F.col("rep").alias("class_id"))
    of_node = found.join(root, "root").select("node", "class_id")
    rooted = signed.select("doc_id", F.col("row_key").alias("key"), "d1", "d2").join(same.drop("row_key"), ["d1", "d2"], "left") \
        .join(of_node, "node", "left")
    return rooted.select("doc_id", F.col("key").alias("row_key"), F.when(F.col("doc_id").isNotNull(), F.coalesce("class_id", "rep", "doc_id"))
                         .alias("class_id")) \
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("class_id"), F.lit(True)))


def op4_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate class of every document."""
    return classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "kept")
