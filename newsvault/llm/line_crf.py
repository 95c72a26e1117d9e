"""Document quality from a linear-chain conditional random field over lines.

Every line gets measurements of its own characters and words; its emission also sees those of
the lines before and after. The field labels each line good or bad; marginals from
forward-backward, weighted by line length, give the document's raw quality, and a logistic
step fitted on the sample turns that into the probability of label 1.

The field is fitted on the driver on at most ``SAMPLE`` labelled documents, the first by a hash
of their id, of which only line measurements are collected. Scoring is one pass in tasks.

Defined results: null and empty texts have no line with a word and score the share of label 1 in
the sample; null doc_ids are scored (held_out false); repeated rows are scored each; null labels
and labels of absent documents are not learned from; without labels of both kinds every score is
the share of label 1, or 0.5 without labels; extra columns are ignored; texts of any length are
scored whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import blocks
from .frames import table

SAMPLE = 4_000
KEEP = 0.7
MEASURES = 12
_CLASSES = [np.isin(np.arange(256), [*range(65, 91)]), np.isin(np.arange(256), [*range(97, 123)]),
            np.isin(np.arange(256), [*range(48, 58)]), np.isin(np.arange(256), list(b"#*$%&<>@^~")),
            np.isin(np.arange(256), list(b"!?")), np.isin(np.arange(256), list(b"|/\\_=+{}[]")),
            np.arange(256) >= 128, np.isin(np.arange(256), [32, *range(9, 14)])]


def lines(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    r"""Offsets of the \n-divided lines, and the line index at which each row begins."""
    cuts = np.flatnonzero(data == 10) + 1
    bounds = np.concatenate([cuts, offsets])
    order = np.argsort(bounds, kind="stable")     # a cut at a row's end makes an empty last line
    starts = bounds[order]
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    return starts, place[len(cuts):]


def measure(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Measurements of the lines that hold a word, their lengths, and the rows' first lines."""
    bounds, rows = lines(data, offsets)
    begin, end = bounds[:-1], bounds[1:]
    starts, ends, _ = blocks.word_spans(data, bounds)
    word_line = np.searchsorted(bounds, starts, "right") - 1
    # several bounds may coincide; the last of them opens the line
    n_words = np.bincount(word_line, minlength=len(begin))[:len(begin)]
    full = np.flatnonzero(n_words > 0)
    row_first = np.searchsorted(full, rows)
    size = (end - begin)[full].astype(float)
    edges = np.c_[begin[full], end[full]].ravel()      # sums over lines, and between them
    if len(full) and edges[-1] >= len(data):
        edges = edges[:-1]
    counts = [np.add.reduceat(c[data].view(np.uint8), edges, dtype=np.int64)[::2]
              if len(full) else np.zeros(0) for c in _CLASSES]
    upper, lower, digit, symbol, loud, bar, wide, space = counts
    hashes = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        j = max(int(np.searchsorted(ends, starts[i] + 2 * blocks.BLOCK, "right")), i + 1)
        a = starts[i]
        hashes[i:j] = blocks.hash_spans(data[a:ends[j - 1]], starts[i:j] - a, ends[i:j] - a)
        i = j
    number = np.cumsum(n_words > 0) - 1
    word_line = number[word_line]
    same = np.zeros(len(hashes))
    same[1:] = (hashes[1:] == hashes[:-1]) & (word_line[1:] == word_line[:-1])
    _, _, first = blocks.factorize(blocks.mix(hashes + word_line.astype(np.uint64) * blocks._MULT))
    words = n_words[full].astype(float)
    distinct = np.bincount(word_line[first], minlength=len(full))
    # a line that its document has had before
    sums = np.add.reduceat(hashes, np.searchsorted(word_line, np.arange(len(full)))) if len(full) \
        else np.zeros(0, np.uint64)
    row = np.searchsorted(row_first, np.arange(len(full)), "right") - 1
    _, _, seen = blocks.factorize(blocks.mix(sums ^ blocks.mix(row.astype(np.uint64))))
    again = np.ones(len(full))
    again[seen] = 0
    solid = np.maximum(size - space, 1)
    letters = np.maximum(upper + lower, 1)
    x = np.stack([np.log1p(size) / 5, upper / letters, digit / solid, np.sqrt(symbol / solid),
                  np.sqrt(loud / solid), np.sqrt(bar / solid), wide / solid, solid / words / 10,
                  np.bincount(word_line, same, len(full)) / words, distinct / words, again,
                  (upper > lower).astype(float)], 1) if len(full) else np.zeros((0, MEASURES))
    return x, size, row_first


def inputs(x: np.ndarray, row_first: np.ndarray) -> np.ndarray:
    """Own measurements and their squares, those of both neighbours, and whether these exist."""
    before, after = np.zeros_like(x), np.zeros_like(x)
    has = np.zeros((len(x), 2))
    if len(x):
        before[1:], after[:-1], has[1:, 0], has[:-1, 1] = x[:-1], x[1:], 1, 1
        first = row_first[:-1][np.diff(row_first) > 0]
        last = row_first[1:][np.diff(row_first) > 0] - 1
        before[first], has[first, 0], after[last], has[last, 1] = 0, 0, 0, 0
    return np.concatenate([x, x * x, before, after, has, np.ones((len(x), 1))], 1)


def _sweep(first: np.ndarray, count: np.ndarray, step: int):
    """Indices of the lines at each position of their documents, forwards or backwards."""
    order = np.argsort(-count, kind="stable")
    first, count = first[order], count[order]
    live = np.searchsorted(-count, -np.arange(1, (count[0] if len(count) else 0) + 1), "right")
    for t, k in enumerate(live):
        yield first[:k] + t if step > 0 else first[:k] + count[:k] - 1 - t


def marginals(emit: np.ndarray, row_first: np.ndarray, weights: np.ndarray):
    """Log odds of good for each line, and both messages. weights: pair weights W[good, bad ->
    good, bad], as a 2x2 array of log potentials."""
    first, count = row_first[:-1], np.diff(row_first)
    keep = count > 0
    first, count = first[keep], count[keep]
    before, after = np.zeros(len(emit)), np.zeros(len(emit))
    w = weights

    def message(odds, w):
        return (np.logaddexp(odds + w[0, 0], w[1, 0]) - np.logaddexp(odds + w[0, 1], w[1, 1]))

    last = None
    for at in _sweep(first, count, 1):
        if last is not None:
            before[at] = message(emit[at - 1] + before[at - 1], w)
        last = at
    last = None
    for at in _sweep(first, count, -1):
        if last is not None:
            after[at] = message(emit[at + 1] + after[at + 1], w.T)
        last = at
    return emit + before + after, before, after


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def raw_quality(odds: np.ndarray, size: np.ndarray, row_first: np.ndarray) -> np.ndarray:
    """Length-weighted mean of the lines' probabilities of being good; nan without lines."""
    row = np.repeat(np.arange(len(row_first) - 1), np.diff(row_first))
    n = len(row_first) - 1
    weight = np.bincount(row, size, n)
    with np.errstate(invalid="ignore"):
        return np.where(weight > 0, np.bincount(row, size * _sigmoid(odds), n) / weight, np.nan)


def fit(x: np.ndarray, size: np.ndarray, row_first: np.ndarray, label: np.ndarray,
        rounds: int = 250, decay: float = 1e-3) -> dict:
    """Field and logistic step by Adam on the likelihood; every line carries its document's label."""
    base = float(label.mean()) if len(label) else 0.5
    lengths = np.diff(row_first)
    if len(label) == 0 or label.min() == label.max() or not lengths.sum():
        return {"base": base, "theta": None}
    z = inputs(x, row_first)
    mean, dev = z.mean(0), z.std(0) + 1e-3
    mean[-1], dev[-1] = 0, 1
    z = (z - mean) / dev
    row = np.repeat(np.arange(len(lengths)), lengths)
    y = label[row].astype(float)
    share = 1 / np.maximum(lengths, 1)[row]           # a document counts once, however long
    first = np.zeros(len(row), bool)
    first[row_first[:-1][lengths > 0]] = True
    pair = np.flatnonzero(~first)
    theta, w = np.zeros(z.shape[1]), np.zeros((2, 2))
    moments = [np.zeros(len(theta) + 4) for _ in range(2)]
    for t in range(1, rounds + 1):
        emit = z @ theta
        odds, before, after = marginals(emit, row_first, w)
        p = _sigmoid(odds)
        grad = -(z.T @ ((y - p) * share)) / len(lengths) + decay * theta
        left = emit[pair - 1] + before[pair - 1]
        right = emit[pair] + after[pair]
        joint = np.stack([left + right + w[0, 0], left + w[0, 1], right + w[1, 0],
                          np.full(len(pair), w[1, 1])], 1)
        joint = np.exp(joint - joint.max(1, keepdims=True))
        joint /= joint.sum(1, keepdims=True)
        seen = np.stack([y[pair] * y[pair - 1], y[pair - 1] * (1 - y[pair]),
                         (1 - y[pair - 1]) * y[pair], (1 - y[pair - 1]) * (1 - y[pair])], 1)
        pull = -((seen - joint) * share[pair, None]).sum(0) / len(lengths) + decay * w.ravel()
        g = np.concatenate([grad, pull])
        moments[0] = 0.9 * moments[0] + 0.1 * g
        moments[1] = 0.99 * moments[1] + 0.01 * g * g
        move = 0.1 * (moments[0] / (1 - 0.9 ** t)) / (np.sqrt(moments[1] / (1 - 0.99 ** t)) + 1e-8)
        theta, w = theta - move[:-4], w - move[-4:].reshape(2, 2)
    raw = raw_quality(marginals(z @ theta, row_first, w)[0], size, row_first)
    have = ~np.isnan(raw)
    r = np.log(np.clip(raw[have], 1e-4, 1 - 1e-4) / (1 - np.clip(raw[have], 1e-4, 1 - 1e-4)))
    a, b, target = 1.0, 0.0, label[have].astype(float)
    for _ in range(50):                                # Newton steps of the logistic fit
        q = _sigmoid(a * r + b)
        s = q * (1 - q)
        h = np.array([[(s * r * r).sum(), (s * r).sum()], [(s * r).sum(), s.sum()]]) + np.eye(2) * 0.1
        a, b = np.array([a, b]) + np.linalg.solve(h, [((target - q) * r).sum() - 0.1 * (a - 1),
                                                      (target - q).sum() - 0.1 * b])
    return {"base": base, "theta": theta, "w": w, "mean": mean, "dev": dev, "a": a, "b": b}


def score(model: dict, x: np.ndarray, size: np.ndarray, row_first: np.ndarray) -> np.ndarray:
    n = len(row_first) - 1
    if model["theta"] is None:
        return np.full(n, model["base"])
    z = (inputs(x, row_first) - model["mean"]) / model["dev"]
    raw = raw_quality(marginals(z @ model["theta"], row_first, model["w"])[0], size, row_first)
    r = np.clip(raw, 1e-4, 1 - 1e-4)
    return np.where(np.isnan(raw), model["base"], _sigmoid(model["a"] * np.log(r / (1 - r)) + model["b"]))


def _collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for run in blocks.runs(batches):
        x, size, first = measure(*blocks.flat(run.column("text")))
        x, size = x.astype(np.float32), size.astype(np.float32)
        cells = [[a[i:j].tobytes() for i, j in zip(first[:-1], first[1:])] for a in (x, size)]
        yield pa.RecordBatch.from_arrays(
            [run.column("doc_id"), pa.array(cells[0], pa.binary()), pa.array(cells[1], pa.binary())],
            ["doc_id", "x", "size"])


def held_out(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> dict:
    """Field fitted on at most ``sample`` labelled documents outside of the held-out ones."""
    chosen = (labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()
                           & ~held_out(F.col("doc_id")))
              .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
              .agg(F.min("quality").alias("quality"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text") \
        .join(F.broadcast(chosen.select("doc_id")), "doc_id", "left_semi")   # bounded by sample
    found = texts.mapInArrow(_collect, "doc_id long, x binary, size binary") \
        .dropDuplicates(["doc_id"]).join(F.broadcast(chosen), "doc_id").orderBy("doc_id").collect()
    xs = [np.frombuffer(r.x, np.float32).reshape(-1, MEASURES) for r in found]
    first = np.r_[0, np.cumsum([len(x) for x in xs])].astype(np.int64)
    x = np.concatenate([np.zeros((0, MEASURES)), *xs]).astype(float)
    size = np.concatenate([np.zeros(0), *(np.frombuffer(r.size, np.float32) for r in found)])
    return fit(x, size.astype(float), first, np.array([r.quality for r in found], int))


def quality(docs: DataFrame, model: dict, name: str = "score") -> DataFrame:
    """The frame's columns and a score; texts are scored whole."""
    def run_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in blocks.runs(batches, limit=2 * blocks.BLOCK):
            s = score(model, *measure(*blocks.flat(run.column("text"))))
            yield pa.RecordBatch.from_arrays([*run.columns, pa.array(s)], [*run.schema.names, name])

    return docs.mapInArrow(run_all, docs.select("*", F.lit(0.0).alias(name)).schema)


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    docs = table(spark, sf_dir, "documents")
    scored = quality(docs.select("doc_id", "text"), train(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= KEEP).cast("int").alias("predicted"))
