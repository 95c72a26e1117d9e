"""Document scores by masked pseudo-likelihood.

A window network predicts every word from the ``SIDE`` words before and after it, never from
itself: embeddings, one hidden layer, then the word's group, its place in the group, and its share of
that place. The sum of these conditional log-probabilities scores the document.

Words are counted over the whole corpus, by hash. The most frequent ones have a symbol each; the
others share symbols, and a word's share is its count over its symbol's, so every word of the
corpus, however rare, has a probability of its own and the vocabulary grows with the corpus. Tasks
hold the shares of the ``LISTED`` most frequent words; those of rarer ones are joined in Spark.

The network is trained in numpy where the text lies: in each of ``ROUNDS`` rounds a task takes
another ``ROUNDS``-th of the words of its documents, chosen by hash, in small steps, and returns its
parameters, which are averaged in a tree, weighted by the words taken. So every word of the
corpus is a target once.

Defined results: null and empty texts have no words and score 0 (per word null); null doc_ids and
repeated rows each give a row; an empty table gives no rows; extra columns are ignored; texts of
any length are scored whole, in stretches that see their neighbours' words; a word that the
corpus does not have counts as one that it has once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import blocks
from .frames import table, written

GROUPS = 32                      # groups of 32 symbols
SYMBOLS = GROUPS * GROUPS
SHARED = 64                      # symbols that the rarer words share; one more is the edge of a text
KNOWN = SYMBOLS - SHARED - 1
EDGE = SYMBOLS - 1
LISTED = 1 << 18                 # words whose shares every task holds, in 12 bytes each
SIDE, WIDTH, HIDDEN = 2, 16, 32
ROUNDS, STEP, FAN = 2, 4096, 32
SHAPES = {"e": (SYMBOLS, WIDTH), "w": (2 * SIDE * WIDTH, HIDDEN), "b": (HIDDEN,), "g": (HIDDEN, GROUPS),
          "gb": (GROUPS,), "s": (GROUPS, HIDDEN, GROUPS), "sb": (GROUPS, GROUPS)}


def fresh() -> dict[str, np.ndarray]:
    rng = np.random.default_rng(7)
    scale = {"e": 0.3, "w": 0.15, "g": 0.1, "s": 0.1}
    return {k: (rng.normal(0, scale.get(k, 0), s)).astype(np.float32) for k, s in SHAPES.items()}


def flatten(p: dict) -> np.ndarray:
    return np.concatenate([p[k].ravel() for k in SHAPES]).astype(np.float32)


def unflatten(v: np.ndarray) -> dict:
    out, at = {}, 0
    for k, s in SHAPES.items():
        n = int(np.prod(s))
        out[k], at = v[at:at + n].reshape(s).astype(np.float32), at + n
    return out


def _found(keys: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Place of each hash in sorted keys, -1 where it is not there."""
    order, at = np.argsort(hashes), np.empty(len(hashes), np.int64)
    at[order] = np.searchsorted(keys, hashes[order])    # in order, so that neighbours are searched together
    hit = np.flatnonzero(at < len(keys))
    hit = hit[keys[at[hit]] == hashes[hit]]
    out = np.full(len(hashes), -1, np.int64)
    out[hit] = at[hit]
    return out


def symbols(hashes: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Symbol of each word; known: sorted hashes of the frequent words."""
    at = _found(known, hashes)
    return np.where(at >= 0, at, KNOWN + (hashes % np.uint64(SHARED)).astype(np.int64))


def contexts(ids: np.ndarray, rows: np.ndarray, pick: np.ndarray) -> np.ndarray:
    """The SIDE symbols before and after each picked word; EDGE beyond its text."""
    row = np.searchsorted(rows, pick, "right") - 1
    low, high = rows[row], rows[row + 1]
    out = np.empty((len(pick), 2 * SIDE), np.int64)
    for k, d in enumerate([*range(-SIDE, 0), *range(1, SIDE + 1)]):
        there = pick + d
        inside = (there >= low) & (there < high)
        out[:, k] = np.where(inside, ids[np.clip(there, 0, max(len(ids) - 1, 0))], EDGE)
    return out


ONES = np.ones(GROUPS, np.float32)
BOUND = 60.0                     # exponentials up to this are finite in single precision, and so are their sums


def _by_symbol(t: np.ndarray) -> tuple[np.ndarray, list]:
    """Order in which words of a group stand together, and (group, first, end) of the groups that occur."""
    order = np.argsort(t.astype(np.uint16), kind="stable")      # a radix sort, for short numbers
    cut = np.searchsorted(t[order], np.arange(GROUPS + 1) * GROUPS).tolist()
    return order, [(k, cut[k], cut[k + 1]) for k in range(GROUPS) if cut[k] < cut[k + 1]]


def _tanh(x: np.ndarray) -> None:
    """In place, by one exponential, which numpy has faster than tanh: 1 - 2 / (1 + exp(2 x))."""
    np.multiply(x, 2, out=x)
    np.minimum(x, BOUND, out=x)
    np.exp(x, out=x)
    x += 1
    np.divide(2, x, out=x)
    np.subtract(1, x, out=x)


def _scores(p: dict, h: np.ndarray, groups: list, z: np.ndarray) -> None:
    """Scores of the groups, and of the places in each word's group, into z (2 x words x GROUPS).

    Hidden values lie within 1, so the weights bound the scores. Only where they could be large is
    the largest of a row taken off, on which no softmax depends.
    """
    np.matmul(h, p["g"], out=z[0])
    z[0] += p["gb"]
    for k, a, b in groups:
        np.matmul(h[a:b], p["s"][k], out=z[1, a:b])
        z[1, a:b] += p["sb"][k]
    if not max((np.abs(p[w]).sum(-2) + np.abs(p[c])).max() for w, c in (("g", "gb"), ("s", "sb"))) < BOUND:
        z -= z.max(-1, keepdims=True)


def log_probs(p: dict, ids: np.ndarray, around: np.ndarray, part: int = 8192) -> np.ndarray:
    """Log-probability of each symbol given the symbols around it."""
    out = np.empty(len(ids), np.float64)
    tables = [p["e"] @ w for w in p["w"].reshape(2 * SIDE, WIDTH, HIDDEN)]      # what a symbol adds at each side
    tables[0] = tables[0] + p["b"]
    part = max(min(part, len(ids)), 1)
    hidden, more = np.empty((2, part, HIDDEN), tables[0].dtype)
    room = np.empty((2, part, GROUPS), hidden.dtype)
    for a in range(0, len(ids), part):
        n = min(part, len(ids) - a)
        order, groups = _by_symbol(ids[a:a + n])
        t, c = ids[a:a + n][order], around[a:a + n].T[:, order]
        h, m, z = hidden[:n], more[:n], room[:, :n]
        np.take(tables[0], c[0], 0, out=h, mode="clip")
        for x, k in zip(tables[1:], c[1:]):
            h += np.take(x, k, 0, out=m, mode="clip")
        _tanh(h)
        _scores(p, h, groups, z)
        at = np.arange(n)
        lp = z[0, at, t // GROUPS] + z[1, at, t % GROUPS]
        np.exp(z, out=z)
        sums = z @ ONES
        out[a + order] = lp - np.log(sums[0]) - np.log(sums[1])
    return out


class Trainer:
    """Adagrad in small steps on one task's words."""

    def __init__(self, p: dict, rate: float = 0.3):
        self.p = {k: v.copy() for k, v in p.items()}
        self.sums = {k: np.full(v.shape, 1e-2, np.float32) for k, v in p.items()}
        self.rate, self.n, self.most = rate, 0, 0

    def _move(self, k, g):
        self.sums[k] += g * g
        self.p[k] -= self.rate * g / np.sqrt(self.sums[k])

    def _room(self, n: int) -> tuple[np.ndarray, ...]:
        """Work arrays of n words, kept from step to step."""
        if n > self.most:
            self.most = n
            self.x = np.empty((n, 2 * SIDE, WIDTH), np.float32)
            self.h = np.empty((3, n, HIDDEN), np.float32)
            self.z = np.empty((2, n, GROUPS), np.float32)
        return self.x[:n], *self.h[:, :n], self.z[:, :n]

    def step(self, t: np.ndarray, c: np.ndarray) -> None:
        p, n = self.p, len(t)
        order, groups = _by_symbol(t)
        t, c = t[order], c[order]
        x, h, dh, back, z = self._room(n)
        x = np.take(p["e"], c, 0, out=x, mode="clip").reshape(n, -1)
        np.matmul(x, p["w"], out=h)
        h += p["b"]
        _tanh(h)
        _scores(p, h, groups, z)
        # gradient of the mean loss by the scores: the softmax, less one for what was chosen
        np.exp(z, out=z)
        z *= (np.float32(1 / n) / (z @ ONES))[..., None]
        at = np.arange(n)
        z[0, at, t // GROUPS] -= np.float32(1 / n)
        z[1, at, t % GROUPS] -= np.float32(1 / n)
        dg, ds = z
        one = np.ones(n, np.float32)        # sums of columns are products with it
        grads = {"g": h.T @ dg, "gb": one @ dg, **{k: np.zeros(SHAPES[k], np.float32) for k in ("s", "sb")}}
        for k, a, b in groups:
            np.matmul(h[a:b].T, ds[a:b], out=grads["s"][k])
            np.matmul(one[a:b], ds[a:b], out=grads["sb"][k])
            np.matmul(ds[a:b], p["s"][k].T, out=back[a:b])
        np.matmul(dg, p["g"].T, out=dh)
        dh += back
        h *= h
        np.subtract(1, h, out=h)
        dh *= h
        grads.update(w=x.T @ dh, b=one @ dh)
        # of each embedded number, summed by symbol over both sides
        dx = (p["w"] @ dh.T).reshape(2 * SIDE, WIDTH, n)
        flat = c.T.ravel()
        grads["e"] = np.stack([np.bincount(flat, dx[:, k].ravel(), SYMBOLS) for k in range(WIDTH)], 1).astype(np.float32)
        for k, g in grads.items():
            self._move(k, g)
        self.n += n


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of a task's words, sent whenever many distinct ones are held."""
    held, size = [], 0

    def send():
        h, n = (np.concatenate([x[k] for x in held]) for k in (0, 1))
        codes, distinct, _ = blocks.factorize(h)
        return pa.RecordBatch.from_arrays([pa.array(distinct.view(np.int64)),
                                           pa.array(np.bincount(codes, n).astype(np.int64))], ["h", "n"])

    for run in blocks.runs(batches, limit=4 * blocks.BLOCK):
        *_, hashes, _ = blocks.hashed_words(run)
        if len(hashes):
            codes, distinct, _ = blocks.factorize(hashes)
            held.append((distinct, np.bincount(codes)))
            size += len(distinct)
        if size > 2_000_000:
            yield send()
            held, size = [], 0
    if held:
        yield send()


@dataclass
class Vocabulary:
    """Sorted hashes of the words with a symbol of their own, and of the listed others with the
    logarithms of their shares; the corpus counts of all words; the counts of the shared symbols."""

    known: np.ndarray
    listed: np.ndarray
    shares: np.ndarray
    counts: DataFrame
    totals: np.ndarray


def vocabulary(docs: DataFrame, listed: int = LISTED) -> Vocabulary:
    """All words of all documents, counted. The driver gets the most frequent ones, of a fixed number."""
    counts = written(docs.select("text").mapInArrow(_count, "h long, n long").groupBy("h")
                     .agg(F.sum("n").alias("n")), "counts")
    top = counts.orderBy(F.desc("n"), "h").limit(KNOWN + listed).toArrow()
    hashes = top.column("h").to_numpy().view(np.uint64)
    times = top.column("n").to_numpy()
    known, rest = np.sort(hashes[:KNOWN]), hashes[KNOWN:]
    totals = np.zeros(SHARED, np.int64)
    place = F.col("h").bitwiseAND(SHARED - 1).cast("int")
    for r in counts.groupBy(place.alias("place")).agg(F.sum("n").alias("n")).collect():
        totals[r.place] = r.n
    np.subtract.at(totals, (hashes[:KNOWN] % np.uint64(SHARED)).astype(np.int64), times[:KNOWN])
    of = (rest % np.uint64(SHARED)).astype(np.int64)
    shares = np.log(times[KNOWN:] / np.maximum(totals[of], 1))
    order = np.argsort(rest)
    return Vocabulary(known, rest[order], shares[order].astype(np.float32), counts, totals)


def targets(hashes: np.ndarray, rows: np.ndarray, turn: int, rounds: int) -> np.ndarray:
    """The words that are targets in round ``turn``: each word in one of the rounds."""
    place = np.arange(len(hashes)) - np.repeat(rows[:-1], np.diff(rows))
    return np.flatnonzero(blocks.mix(hashes + place.astype(np.uint64)) % np.uint64(rounds) == turn)


def _learn(known: np.ndarray, start: np.ndarray, turn: int, rounds: int):
    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trainer, kept = Trainer(unflatten(start)), []

        def steps(least):
            while kept and sum(len(t) for t, _ in kept) >= least:
                t, c = (np.concatenate([x[k] for x in kept]) for k in (0, 1))
                kept.clear()
                full = len(t) // STEP * STEP if least > 1 else len(t)
                for a in range(0, full, STEP):
                    trainer.step(t[a:a + STEP], c[a:a + STEP])
                if full < len(t):
                    kept.append((t[full:], c[full:]))

        for run in blocks.runs(batches):
            *_, hashes, rows = blocks.hashed_words(run)
            codes, distinct, _ = blocks.factorize(hashes)
            ids = symbols(distinct, known)[codes]
            pick = targets(hashes, rows, turn, rounds)
            if len(pick):
                kept.append((ids[pick], contexts(ids, rows, pick)))
            steps(STEP)
        steps(1)
        if trainer.n:
            yield pa.RecordBatch.from_arrays(
                [pa.array([TaskContext.get().partitionId()]), pa.array([trainer.n]),
                 pa.array([flatten(trainer.p).tobytes()], pa.binary())], ["part", "n", "p"])
    return learn


def _mean(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("part")
    total, n = 0.0, int(rows.n.sum())
    for m, raw in zip(rows.n, rows.p):
        total = total + np.frombuffer(raw, np.float32).astype(float) * (m / n)
    return pd.DataFrame({"part": [int(rows.part.iloc[0]) // FAN], "n": [n],
                         "p": [np.asarray(total, np.float32).tobytes()]})


def train(docs: DataFrame, rounds: int = ROUNDS) -> tuple[Vocabulary, np.ndarray]:
    """The words of the corpus, and the parameters after averaging rounds."""
    words, params = vocabulary(docs), flatten(fresh())
    for turn in range(rounds):
        models = written(docs.select("text").mapInArrow(_learn(words.known, params, turn, rounds),
                                                        "part long, n long, p binary"), "models")
        last = models.agg(F.max("part")).first()[0]
        while last:
            models = models.groupBy(F.expr(f"part div {FAN}").alias("g")).applyInPandas(
                _mean, "part long, n long, p binary")
            last //= FAN
        for r in models.collect():          # one row
            params = np.frombuffer(r.p, np.float32)
    return words, params


def _score(known: np.ndarray, listed: np.ndarray, shares: np.ndarray, params: np.ndarray):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = unflatten(params)
        for run in blocks.runs(batches):
            *_, hashes, rows = blocks.hashed_words(run)
            codes, distinct, _ = blocks.factorize(hashes)
            own, at = symbols(distinct, known), _found(listed, distinct)
            share = np.where((own < KNOWN) | (at < 0), 0.0, shares[at] if len(listed) else 0.0)
            rare = (own >= KNOWN) & (at < 0)                # their shares are not at hand
            ids, n = own[codes], np.diff(rows)
            row = np.repeat(np.arange(run.num_rows), n)
            sums = np.bincount(row, share[codes], run.num_rows).astype(float)    # whole numbers without words
            for a in range(0, len(ids), 1 << 19):
                pick = np.arange(a, min(a + (1 << 19), len(ids)))
                sums += np.bincount(row[pick], log_probs(p, ids[pick], contexts(ids, rows, pick)), run.num_rows)
            left = np.flatnonzero(rare[codes])
            pairs, times = np.unique(row[left] * len(distinct) + codes[left], return_counts=True)
            bounds = np.searchsorted(pairs, np.arange(run.num_rows + 1) * len(distinct)).astype(np.int32)
            tail = pa.ListArray.from_arrays(pa.array(bounds), pa.StructArray.from_arrays(
                [pa.array(distinct[pairs % max(len(distinct), 1)].view(np.int64)), pa.array(times.astype(np.int64))], ["h", "n"]))
            yield pa.RecordBatch.from_arrays([run.column("doc_id"), pa.array(n), pa.array(sums), tail],
                                             ["doc_id", "n_words", "log_prob", "tail"])
    return score


def scores(docs: DataFrame, words: Vocabulary, params: np.ndarray) -> DataFrame:
    """doc_id, n_words, log_prob (sum over words) and log_prob_word (mean, null without words)."""
    scored = written(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _score(words.known, words.listed, words.shares, params),
        "doc_id long, n_words long, log_prob double, tail array<struct<h: long, n: long>>")
        .withColumn("row", F.monotonically_increasing_id()), "scored")
    totals = F.lit([int(max(t, 1)) for t in words.totals])
    rare = scored.select("row", F.explode("tail").alias("t")).select("row", "t.h", F.col("t.n").alias("times"))
    share = F.log(F.coalesce("n", F.lit(1)) / F.get(totals, F.col("h").bitwiseAND(SHARED - 1).cast("int")))
    more = rare.join(words.counts, "h", "left").groupBy("row").agg(F.sum(F.col("times") * share).alias("more"))
    whole = F.col("log_prob") + F.coalesce("more", F.lit(0.0))
    return scored.join(more, "row", "left").select(
        "doc_id", "n_words", whole.alias("log_prob"),
        F.when(F.col("n_words") > 0, whole / F.col("n_words")).alias("log_prob_word"))


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pseudo-likelihood of every document under a network trained on all of them."""
    docs = table(spark, sf_dir, "documents")
    return scores(docs, *train(docs))
