"""Near-duplicate vectors by the epsilon grid order join.

Unit vectors with cosine >= c lie within eps = sqrt(2 - 2c). Vectors are projected on their
leading principal directions, which never lengthens a distance, and cut into grid cells of width
eps. Sorted by label and cells they form one long sequence, stored as blocks of ``BLOCK``
neighbours with a bounding box. Only blocks whose boxes are within eps meet; inside such a
pair the two sequences are halved again and again, parts that are provably distant are
skipped, and small parts are compared in double precision.

Equal vectors of a label are one class with a count, so copies are never compared. A pair of
blocks returns one row per vector at most: the number of its links and the smallest member of
its component there. Pairs of vectors are never emitted.

Defined results: vectors that are null, empty, zero or hold null or non-finite components link
with nothing, and so do rows with null label or vec_id (whose component is null); vectors of
different length never link; repeated rows are one vector; an empty table gives no rows; extra
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .frames import components, table, written

COSINE = 0.93
BLOCK = 512
LEAF = 96
LEADING = 6
GRID = 3            # leading cells that bring blocks together


def unit(vectors: np.ndarray) -> np.ndarray:
    vectors = vectors / np.abs(vectors).max(1, keepdims=True)
    return vectors / np.sqrt((vectors * vectors).sum(1, keepdims=True))


def _rows(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, unit vectors) for each vector length of a list column."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    offsets = column.offsets.to_numpy()
    values = column.values.to_numpy(zero_copy_only=False).astype(float)
    length = np.diff(offsets)
    out = []
    for n in np.unique(length):
        rows = np.flatnonzero(length == n)
        out.append((rows, unit(values[offsets[rows][:, None] + np.arange(n)])))
    return out


def basis(vectors: DataFrame, width: int, leading: int) -> np.ndarray:
    """(width, leading): main directions of all vectors, shorter ones padded with zeros.

    Tasks sum the products of components; what reaches the driver is one row per component pair.
    """
    i, j = np.triu_indices(width)

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            if batch.num_rows:
                for _, x in _rows(batch.column("embedding")):
                    total[:x.shape[1], :x.shape[1]] += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(i), dtype=np.int32)), pa.array(total[i, j])],
                                         ["place", "s"])

    found = vectors.select("embedding").mapInArrow(products, "place int, s double") \
        .groupBy("place").agg(F.sum("s").alias("s")).collect()
    square = np.zeros((width, width))
    for r in found:
        square[i[r.place], j[r.place]] = square[j[r.place], i[r.place]] = r.s
    return np.linalg.eigh(square)[1][:, ::-1][:, :leading].copy()


def _place(axes: np.ndarray, eps: float):
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            n = batch.num_rows
            cells = np.zeros((n, axes.shape[1]), np.int32)
            length, raw = np.zeros(n, np.int32), [b""] * n
            for rows, x in _rows(batch.column("embedding")):
                cells[rows] = np.floor(x @ axes[:x.shape[1]] / eps)
                length[rows] = x.shape[1]
                for r, v in zip(rows.tolist(), x):
                    raw[r] = v.tobytes()
            yield pa.RecordBatch.from_arrays(
                [batch.column("label").cast(pa.int64()), batch.column("rep"), batch.column("n"),
                 pa.array(length), pa.array(raw, pa.binary()),
                 *(pa.array(cells[:, k]) for k in range(cells.shape[1]))],
                ["label", "rep", "n", "length", "v", *(f"c{k}" for k in range(cells.shape[1]))])
    return place


def _blocks(axes: np.ndarray, size: int):
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made, held = TaskContext.get().partitionId(), 0, []

        def close():
            nonlocal made
            x = np.frombuffer(b"".join(h[4] for h in held)).reshape(len(held), -1)
            p = x @ axes[:x.shape[1]]
            made += 1
            return pa.RecordBatch.from_pylist([{
                "block": (task << 32) + made, "label": held[0][0], "length": held[0][3],
                "lo": p.min(0).tolist(), "hi": p.max(0).tolist(),
                "ids": np.array([h[1] for h in held], np.int64).tobytes(),
                "ns": np.array([h[2] for h in held], np.int64).tobytes(), "vs": x.tobytes()}],
                schema=schema)

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("label", "rep", "n", "length", "v"))):
                if held and (len(held) == size or (held[0][0], held[0][3]) != (row[0], row[3])):
                    yield close()
                    held.clear()
                held.append(row)
        if held:
            yield close()

    schema = pa.schema([("block", pa.int64()), ("label", pa.int64()), ("length", pa.int32()),
                        ("lo", pa.list_(pa.float64())), ("hi", pa.list_(pa.float64())),
                        ("ids", pa.binary()), ("ns", pa.binary()), ("vs", pa.binary())])
    return build


def join_sequences(x: np.ndarray, y: np.ndarray, axes: np.ndarray, cosine: float, own: bool,
                   leaf: int = LEAF) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs with cosine >= ``cosine`` between two sequences in grid order; with ``own`` the
    two are one sequence and pairs come once."""
    eps = np.sqrt(max(2 - 2 * cosine, 0)) + 1e-9
    p, q = x @ axes[:x.shape[1]], y @ axes[:y.shape[1]]
    found: list[tuple[np.ndarray, np.ndarray]] = []
    todo = [(0, len(x), 0, len(y))]
    while todo:
        a, b, c, d = todo.pop()
        if a >= b or c >= d or (own and c >= b and a > c) or (own and a >= d):
            continue
        gap = np.maximum(np.maximum(p[a:b].min(0) - q[c:d].max(0), q[c:d].min(0) - p[a:b].max(0)), 0)
        if np.sqrt((gap * gap).sum()) > eps:
            continue
        if b - a <= leaf and d - c <= leaf:
            i, j = np.nonzero(x[a:b] @ y[c:d].T >= cosine)
            i, j = i + a, j + c
            if own:
                keep = i < j
                i, j = i[keep], j[keep]
            found.append((i, j))
        elif b - a >= d - c:
            m = (a + b) // 2
            todo += [(a, m, c, d), (m, b, c, d)]
        else:
            m = (c + d) // 2
            todo += [(a, b, c, m), (a, b, m, d)]
    if not found:
        return np.zeros(0, int), np.zeros(0, int)
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _least(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest position linked, over any number of steps, with each position."""
    label = np.arange(n)
    while True:
        before = label.copy()
        np.minimum.at(label, i, label[j])
        np.minimum.at(label, j, label[i])
        label = label[label]
        if (label == before).all():
            return label


def _compare(axes: np.ndarray, cosine: float):
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                r = {c: batch.column(c)[k].as_py() for c in batch.schema.names}
                own = r["a"] == r["b"]
                ids, ns, vs = ([np.frombuffer(r[c + s], t) for s in ("_a", "_b")]
                               for c, t in (("ids", np.int64), ("ns", np.int64), ("vs", float)))
                x, y = (v.reshape(len(w), -1) for v, w in zip(vs, ids))
                i, j = join_sequences(x, y, axes, cosine, own)
                if not len(i):
                    continue
                shift = 0 if own else len(x)
                name = ids[0] if own else np.concatenate(ids)
                weight = ns[0] if own else np.concatenate(ns)
                j = j + shift
                order = np.argsort(name, kind="stable")     # the smallest id leads its component
                place = np.empty_like(order)
                place[order] = np.arange(len(order))
                root = name[order][_least(len(name), place[i], place[j])][place]
                links = np.bincount(i, weight[j], len(name)) + np.bincount(j, weight[i], len(name))
                hit = links > 0
                yield pa.RecordBatch.from_arrays(
                    [pa.array(name[hit]), pa.array(links[hit].astype(np.int64)), pa.array(root[hit])],
                    ["rep", "links", "root"])
    return compare


def near_vectors(vectors: DataFrame, cosine: float = COSINE, block: int = BLOCK,
                 leading: int = LEADING) -> DataFrame:
    """vec_id, n_links, component_id and kept for every vector."""
    eps = float(np.sqrt(2 - 2 * cosine) + 1e-9)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
                          "embedding")
    fine = F.coalesce(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.forall(
        "embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("embedding", lambda x: x != 0), F.lit(False))
    rows = written(rows.withColumn("fine", fine)
                   .withColumns({"k1": F.xxhash64("embedding"), "k2": F.xxhash64("embedding", F.lit(7))})
                   .distinct(), "vectors")
    good = rows.where("fine")
    same = written(good.groupBy("label", "k1", "k2").agg(F.min("vec_id").alias("rep"), F.count("*").alias("n")),
                   "same")
    reps = good.join(same.withColumn("vec_id", F.col("rep")), ["vec_id", "label", "k1", "k2"]) \
        .select("label", "rep", "n", "embedding")
    width = reps.agg(F.max(F.size("embedding"))).first()[0]
    linked = None
    if width:
        axes = basis(reps, width, min(leading, width))
        cells = [f"c{k}" for k in range(axes.shape[1])]
        order = ["label", "length", *cells, "rep"]
        placed = reps.mapInArrow(_place(axes, eps), "label long, rep long, n long, length int, v binary, "
                                 + ", ".join(f"{c} int" for c in cells))
        parts = written(placed.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
            _blocks(axes, block), "block long, label long, length int, lo array<double>, hi array<double>, "
            "ids binary, ns binary, vs binary"), "blocks")

        def spread(side: str, room: float) -> DataFrame:
            box = parts.select(F.col("block").alias(side), "label", "length", F.col("lo").alias(f"lo_{side}"),
                               F.col("hi").alias(f"hi_{side}"))
            for k in range(min(GRID, axes.shape[1])):
                box = box.withColumn(f"g{k}", F.explode(F.sequence(
                    F.floor((F.get(f"lo_{side}", F.lit(k)) - room) / eps),
                    F.floor((F.get(f"hi_{side}", F.lit(k)) + room) / eps))))
            return box

        gaps = [F.greatest(F.get("lo_a", F.lit(k)) - F.get("hi_b", F.lit(k)),
                           F.get("lo_b", F.lit(k)) - F.get("hi_a", F.lit(k)), F.lit(0.0))
                for k in range(axes.shape[1])]
        grid = ["label", "length", *(f"g{k}" for k in range(min(GRID, axes.shape[1])))]
        pairs = (spread("a", 0.0).join(spread("b", eps), grid)
                 .where((F.col("a") <= F.col("b")) & (sum(g * g for g in gaps) <= eps * eps))
                 .select("a", "b").distinct())
        sides = [parts.select(F.col("block").alias(s), *(F.col(c).alias(f"{c}_{s}") for c in ("ids", "ns", "vs")))
                 for s in "ab"]
        linked = written(pairs.join(sides[0], "a").join(sides[1], "b").mapInArrow(
            _compare(axes, cosine), "rep long, links long, root long"), "links")
        links = linked.groupBy("rep").agg(F.sum("links").alias("links"))
        found = components(linked.select(F.col("rep").alias("a"), F.col("root").alias("b")))
        of = same.join(links, "rep", "left").join(found.withColumnRenamed("node", "rep"), "rep", "left") \
            .select("label", "k1", "k2", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("links"),
                    F.coalesce("root", "rep").alias("root"), F.lit(True).alias("fine"))
    else:
        of = same.select("label", "k1", "k2", F.col("n").alias("links"), F.col("rep").alias("root"),
                         F.lit(True).alias("fine"))
    return rows.join(of, ["label", "k1", "k2", "fine"], "left").select(
        "vec_id", F.coalesce("links", F.lit(0).cast("long")).alias("n_links"),
        F.coalesce("root", "vec_id").alias("component_id")) \
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all vectors of equal label."""
    return near_vectors(table(spark, sf_dir, "embeddings"))


ORACLE = """
WITH v AS (SELECT DISTINCT vec_id, label, embedding FROM embeddings),
ok AS (SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM v
       WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
         AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
         AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
u AS (SELECT *, sqrt(list_sum(list_transform(e, lambda x: x * x))) AS norm FROM ok),
link AS (SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b
         ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
         WHERE list_inner_product(a.e, b.e) / (a.norm * b.norm) >= 0.93),
reach AS (WITH RECURSIVE r(a, b) AS (SELECT a, b FROM link UNION
          SELECT r.a, link.b FROM r JOIN link ON r.b = link.a) SELECT a, min(b) AS low FROM r GROUP BY a),
n AS (SELECT a, count(*) AS n FROM link GROUP BY a)
SELECT v.vec_id, coalesce(n.n, 0)::BIGINT AS n_links, least(v.vec_id, coalesce(low, v.vec_id)) AS component_id,
       coalesce(v.vec_id = least(v.vec_id, coalesce(low, v.vec_id)), true) AS kept
FROM v LEFT JOIN n ON n.a = v.vec_id LEFT JOIN reach ON reach.a = v.vec_id
"""
