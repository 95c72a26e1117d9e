"""Shards along a Hilbert curve, in column expressions only.

Metadata dimensions (language, source, size) are quantised to ``2**BITS`` cells by their
distribution over all documents: the cell of a value is the share of documents with a smaller one, so
every dimension uses its whole range. The cells' place on a Hilbert curve orders the documents, and
cutting that order into runs gives shards, and files inside a shard, that each cover a small box of
all dimensions at once, which file statistics then prune.

The curve is a table of states made from the rule of its Gray code, walked from the highest bit
down. Cells come from sorted bounds, of which there are at most ``2**BITS`` per dimension, by
binary search. Only small rows move: order and running sums are made in range partitions.

Laws: ``bytes`` cuts at equal sums of sizes, so a shard differs from the mean by less than one
document; ``rows`` cuts at equal counts, at most one apart.

Defined results: a null text has no bytes (size 1), an empty one too; null dimensions are the
smallest value; repeated rows, and repeated or null doc_ids, are placed as often as they come; an
empty table gives no rows; extra columns are ignored, whatever their names; texts are measured whole. Equal
texts of equal dimensions are neighbours on the curve. Documents may be fewer than shards.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsvault.operators.numbering import in_order, positions, running_sums

from .frames import table, written

SHARDS = 8
BITS = 10
DIMENSIONS = ("lang", "source")
CRC_POLYNOMIAL = 0xEDB88320
KEY_CHARS = 64          # strings are quantised by so many characters, which bounds the bounds


# ---------------------------------------------------------------- the curve

def curve_states(dims: int) -> tuple[list[int], list[int]]:
    """Next state and place for each state and corner, as two lists with 2**dims entries a state.

    A state is the corner at which the curve enters a cube and the axis along which it leaves;
    corners are visited in Gray code order, and each sub-cube has a state of its own.
    """
    corners = 1 << dims

    def gray(i):
        return i ^ (i >> 1)

    def turn(x, by):
        by %= dims
        return ((x << by) | (x >> (dims - by))) & (corners - 1)

    def trailing_ones(i):
        return (~i & (i + 1)).bit_length() - 1

    def enters(i):
        return gray((i - 1) // 2 * 2) if i else 0

    def axis(i):
        return (trailing_ones(i if i % 2 else i - 1) if i else 0) % dims

    place_of = {gray(i): i for i in range(corners)}
    states, following, places = [(0, 0)], [], []
    for entry, direction in states:                       # grows while it is walked
        for corner in range(corners):
            at = place_of[turn(corner ^ entry, -(direction + 1))]
            then = (entry ^ turn(enters(at), direction + 1), (direction + axis(at) + 1) % dims)
            if then not in states:
                states.append(then)
            following.append(states.index(then))
            places.append(at)
    return following, places


def curve_index(cells: list[Column], bits: int = BITS) -> Column:
    """Place of the point with these cells (0 to 2**bits - 1) on the curve through all of them."""
    dims = len(cells)
    following, places = curve_states(dims)
    steps = F.lit([s * (1 << dims) + p for s, p in zip(following, places)])
    points = F.array(*[c.cast("long") for c in cells])

    def step(walk, bit):
        corner = F.aggregate(
            F.transform(points, lambda c, j: F.call_function(
                "shiftleft", F.call_function("shiftright", c, bit).bitwiseAND(F.lit(1)), j)),
            F.lit(0).cast("long"), lambda a, b: a + b)
        got = F.get(steps, (walk["state"] * (1 << dims) + corner).cast("int")).cast("long")
        return F.struct(F.shiftright(got, dims).alias("state"),
                        (walk["index"] * (1 << dims) + got.bitwiseAND(F.lit((1 << dims) - 1))).alias("index"))

    zero = F.lit(0).cast("long")
    return F.aggregate(F.sequence(F.lit(bits - 1), F.lit(0), F.lit(-1)),
                       F.struct(zero.alias("state"), zero.alias("index")), step, lambda w: w["index"])


# ---------------------------------------------------------------- cells

def sortable(column: Column, kind: str) -> Column:
    """Text whose order is that of the column; null is the smallest."""
    if kind == "string":
        return F.concat(F.when(column.isNull(), "0").otherwise("1"),
                        F.coalesce(F.substring(column, 1, KEY_CHARS), F.lit("")))
    if kind in ("boolean", "tinyint", "smallint", "int", "bigint", "date", "timestamp"):
        number = F.unix_micros(column) if kind == "timestamp" else \
            F.unix_date(column) if kind == "date" else column
        number = number.cast("decimal(20,0)") + F.lit(str(1 << 63)).cast("decimal(20,0)")
        return F.coalesce(F.concat(F.lit("1"), F.lpad(number.cast("decimal(20,0)").cast("string"), 20, "0")),
                          F.lit("0"))
    raise TypeError(f"no dimension of type {kind}")


def cell_bounds(rows: DataFrame, dims: int, bits: int = BITS) -> list[tuple[list[str], list[int]]]:
    """For each of the columns d0, d1, ...: the smallest value of every cell in use, and the cell.

    Values are counted before they are ordered, so a value with most rows is one row here.
    """
    each = rows.select(F.explode(F.array(*[
        F.struct(F.lit(k).alias("dim"), F.col(f"d{k}").alias("value")) for k in range(dims)])).alias("x"))
    counted = each.groupBy("x.dim", "x.value").agg(F.count(F.lit(1)).alias("n"))
    total = rows.count()
    # the dimensions follow each other in the order, each with the rows of the whole table
    before = running_sums(in_order(counted, [F.asc("dim"), F.asc("value")]), F.col("n"), "before")
    cell = F.expr(f"((before - dim * {total}L) * {1 << bits}L) div {max(total, 1)}L")
    got = before.groupBy("dim", cell.alias("cell")).agg(F.min("value").alias("value")).collect()
    out: list[tuple[list[str], list[int]]] = []
    for k in range(dims):
        mine = sorted((r.cell, r.value) for r in got if r.dim == k)
        out.append(([v for _, v in mine], [c for c, _ in mine]))
    return out


def cell_of(value: Column, bounds: list[str], cells: list[int]) -> Column:
    """Cell of a value: that of the last bound which is not above it, by binary search."""
    if not bounds:
        return F.lit(0)
    steps, top = F.lit(bounds), len(bounds).bit_length()
    found = F.aggregate(
        F.lit([1 << k for k in range(top - 1, -1, -1)]), F.lit(0),
        lambda at, jump: F.when(F.get(steps, at + jump - 1) <= value, at + jump).otherwise(at))
    return F.get(F.lit(cells), F.greatest(found - 1, F.lit(0)))


# ---------------------------------------------------------------- shards

def measured(docs: DataFrame, dimensions=DIMENSIONS) -> DataFrame:
    """doc_id, size, text_crc32, the sortable dimensions d0, d1, ..., the last being the size."""
    kinds = dict(docs.dtypes)
    text = F.coalesce(F.encode("text", "UTF-8"), F.lit(b""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       (F.octet_length(text) + 1).cast("long").alias("size"),
                       F.crc32(text).alias("text_crc32"),
                       *[sortable(F.col(c), kinds[c]).alias(f"d{k}") for k, c in enumerate(dimensions)])
    return rows.withColumn(f"d{len(dimensions)}", sortable(F.col("size"), "bigint"))


def along_curve(rows: DataFrame, dims: int, bits: int = BITS) -> DataFrame:
    """Measured rows with ``curve``, in the curve's order (see ``in_order``)."""
    bounds = cell_bounds(rows, dims, bits)
    cells = [cell_of(F.col(f"d{k}"), *bounds[k]) for k in range(dims)]
    rows = rows.withColumn("curve", curve_index(cells, bits)).drop(*[f"d{k}" for k in range(dims)])
    return in_order(rows, [F.asc("curve"), F.asc("doc_id"), F.asc("size"), F.asc("text_crc32"), F.asc("row")])


def cut(placed: DataFrame, shards: int = SHARDS, law: str = "bytes") -> DataFrame:
    """Rows in curve order with their shard and their slot in it."""
    if law not in ("bytes", "rows"):
        raise ValueError(f"unknown law: {law}")
    rows = positions(placed)
    if law == "rows":
        n = placed.count()
        return rows.withColumn("shard", F.expr(f"position * {shards} div {max(n, 1)}").cast("int")) \
            .withColumn("slot", F.col("position") - F.expr(f"(shard * {n}L + {shards - 1}) div {shards}"))
    total = placed.agg(F.sum("size")).first()[0] or 1
    # a document lies in the shard that holds its middle byte
    middle = F.expr(f"(2 * before + size) * {shards} div {2 * total}L")
    rows = running_sums(rows, F.col("size"), "before") \
        .withColumn("shard", F.least(middle, F.lit(shards - 1)).cast("int"))
    first = rows.groupBy("shard").agg(F.min("position").alias("first"))          # a row per shard
    return rows.join(F.broadcast(first), "shard").withColumn("slot", F.col("position") - F.col("first"))


def assign(docs: DataFrame, shards: int = SHARDS, law: str = "bytes", dimensions=DIMENSIONS,
           bits: int = BITS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard, curve and row of each document.

    ``row`` numbers the rows as the frame delivers them.
    """
    rows = written(measured(docs, dimensions).withColumn("row", F.monotonically_increasing_id()), "measured")
    cut_ = cut(along_curve(rows, len(dimensions) + 1, bits), shards, law)
    return cut_.select("doc_id", "size", "text_crc32", F.lit(law).alias("law"), "shard", "slot",
                       F.lit(None).cast("int").alias("grown_shard"), "curve", "row")


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, law: str = "bytes", dimensions=DIMENSIONS,
                 bits: int = BITS, rows_per_file: int = 100_000) -> None:
    """The documents as files below shard=N, each a run of the curve, with all their columns."""
    whole = written(docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("doc")), "unsharded")
    places = assign(whole.select("doc.*"), shards, law, dimensions, bits).select("row", "shard", "slot")
    # the same files read again deliver the same rows in the same order
    numbered = whole.withColumn("row", F.monotonically_increasing_id())
    files = numbered.join(places, "row").withColumn("run", F.expr(f"slot div {rows_per_file}"))
    (files.repartitionByRange("shard", "run").sortWithinPartitions("shard", "slot")
     .select("doc.*", "shard").write.mode("overwrite").option("maxRecordsPerFile", rows_per_file)
     .partitionBy("shard").parquet(path))


def manifest(spark: SparkSession, path: str, dimensions=DIMENSIONS) -> DataFrame:
    """One row per shard file: rows, and the least and largest value of each dimension."""
    return spark.read.parquet(path).groupBy("shard", F.col("_metadata.file_path").alias("file")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[f(c).alias(f"{name}_{c}") for c in dimensions for name, f in (("min", F.min), ("max", F.max))])


def op12_hilbert_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in eight shards of near equal bytes, in runs of the curve."""
    return assign(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard", "curve")


def statement(shards: int = SHARDS, bits: int = BITS) -> str:
    """The same in DuckDB SQL: ranks as cells, the table of states walked level by level."""
    following, places = curve_states(3)
    levels = "".join(f"""
l{bits - 1 - b} AS (SELECT * EXCLUDE (st, ix), {following}[corner + 1] AS st, ix * 8 + {places}[corner + 1] AS ix
  FROM (SELECT *, st * 8 + ((c0 >> {b}) & 1) + 2 * ((c1 >> {b}) & 1) + 4 * ((c2 >> {b}) & 1) AS corner
        FROM {'cells' if b == bits - 1 else f'(SELECT * EXCLUDE corner FROM l{bits - 2 - b})'}) AS s{b}),"""
                     for b in range(bits - 1, -1, -1))
    # the checksum's table is linear: each set bit of the index adds the entry of that bit alone
    crc_step = "0"
    for bit in range(8):
        entry = 1 << bit
        for _ in range(8):
            entry = entry >> 1 ^ (CRC_POLYNOMIAL if entry & 1 else 0)
        crc_step = f"xor({crc_step}, ((xor(c, b) >> {bit}) & 1) * {entry})"
    return f"""
WITH texts AS (SELECT row_number() OVER () AS rid, doc_id, lang, source, coalesce(text, '') AS t FROM documents),
bytes AS (SELECT rid, hex(encode(t)) AS x FROM texts),
sums AS (SELECT rid, xor(list_reduce(list_prepend(4294967295, list_transform(regexp_extract_all(x, '..'),
           lambda v: ('0x' || v)::BIGINT)),
           lambda c, b: xor(c >> 8, {crc_step})), 4294967295) AS crc FROM bytes),
docs AS (SELECT rid, doc_id, strlen(t) + 1 AS size, crc, lang, source FROM texts JOIN sums USING (rid)),
cells AS (SELECT *, (rank() OVER (ORDER BY substr(lang, 1, {KEY_CHARS}) NULLS FIRST) - 1) * {1 << bits} // count(*) OVER () AS c0,
            (rank() OVER (ORDER BY substr(source, 1, {KEY_CHARS}) NULLS FIRST) - 1) * {1 << bits} // count(*) OVER () AS c1,
            (rank() OVER (ORDER BY size) - 1) * {1 << bits} // count(*) OVER () AS c2, 0 AS st, 0 AS ix FROM docs),{levels}
placed AS (SELECT *, row_number() OVER w - 1 AS pos,
             coalesce(sum(size) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before,
             sum(size) OVER ()::BIGINT AS total
           FROM l{bits - 1} WINDOW w AS (ORDER BY ix, doc_id NULLS FIRST, size, crc)),
sharded AS (SELECT *, least((2 * before + size) * {shards} // (2 * total), {shards - 1})::INTEGER AS shard FROM placed)
SELECT doc_id, size::BIGINT AS size, crc::BIGINT AS text_crc32, 'bytes' AS law, shard,
       (pos - min(pos) OVER (PARTITION BY shard))::BIGINT AS slot, NULL::INTEGER AS grown_shard, ix::BIGINT AS curve
FROM sharded
"""


ORACLE = statement()
