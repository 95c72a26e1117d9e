"""Best-fit packing of token sequences by hierarchical residual packing.

Each task packs its own pieces best-fit decreasing. Bins that are nearly full are done; an
underfull bin becomes one item for the next level, where the bins of several tasks meet and
are packed again, up a tree with fan-in ``FAN``. Only (bin, fill, members) rows move, never
ids. Where a level of the tree would make groups of more than ``MOST`` bins, the bins are dealt by
hash to as many groups as keep that size, so that each holds bins of every fill, and such
rounds go on until one merges less than a bin in a thousand, or all that is left fits in one group. Every underfull bin is
handed on in every round: groups stay bounded and no bin is closed early.

Defined results: a null or empty text is the closing id alone; repeated rows, and repeated or
null doc_ids, are packed as often as they come; an empty table gives no rows; extra columns
are ignored; a text of any length is cut into pieces of ``capacity``.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import blocks
from .frames import table, written

CAPACITY = 4096
NEARLY_FULL = 0.995
FAN = 8
MOST = 50_000
END_ID = 1
PIECES = ("doc_id long, piece int, start long, length long, ids_crc32 long, "
          "bin long, at long, grp int")
BINS = "bin long, fill long, grp int, open boolean, members array<struct<bin:long,shift:long>>"


def best_fit(sizes: list[int], capacity: int) -> tuple[list[int], list[int], list[int]]:
    """Bin and place of each item, and the fill of each bin; best-fit decreasing.

    Bins wait by their free room; a bit mask finds the smallest room that is large enough.
    """
    rooms: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask, fills = 0, []
    bin_of, at = [0] * len(sizes), [0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        size = sizes[i]
        fit = mask >> size
        if fit:
            room = size + (fit & -fit).bit_length() - 1
            b = rooms[room].pop()
            if not rooms[room]:
                mask ^= 1 << room
        else:
            b, room = len(fills), capacity
            fills.append(0)
        bin_of[i], at[i] = b, fills[b]
        fills[b] += size
        rooms[room - size].append(b)
        mask |= 1 << (room - size)
    return bin_of, at, fills


# Byte classes: 0 white space, 1 letter (of ASCII, or part of a Latin-1 letter), 2 digit or
# punctuation, 3 anything that makes its word go to the tokenizer as it is.
_CLASS = np.full(256, 3, np.uint8)
_CLASS[[0x20, 9, 10, 11, 12, 13]] = 0
_CLASS[np.arange(0x21, 0x7F)] = 2
for _first, _last in ((0x41, 0x5A), (0x61, 0x7A), (0x80, 0xBF)):
    _CLASS[_first:_last + 1] = 1
_CLASS[0xC3] = 1
_CLASS[[ord(c) for c in "'<|>"]] = 3
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def chunks(data: np.ndarray, offsets: np.ndarray):
    """Starts, ends and lower-cased bytes of the stretches that the tokenizer never joins.

    White space always divides. Inside a word of ASCII and Latin-1 characters, letters and
    others divide too; words with an apostrophe, a part of a special token, or any further
    character stay whole, since normalization and the tokenizer's pattern may join there.
    """
    kind = _CLASS[data]
    lead = data == 0xC3
    follows = np.zeros(len(data), bool)
    follows[1:] = lead[:-1]
    odd = (kind == 3) | (lead & np.r_[~((data[1:] >= 0x80) & (data[1:] != 0x97) & (data[1:] != 0xB7)), True]) \
        | ((data >= 0x80) & (data < 0xC0) & ~follows)
    if odd.any():
        starts, ends, _ = blocks.word_spans(data, offsets)
        total = np.r_[0, np.cumsum(odd)]
        whole = np.flatnonzero(total[ends] > total[starts])
        n = ends[whole] - starts[whole]
        kind[np.repeat(starts[whole] - np.cumsum(n) + n, n) + np.arange(n.sum())] = 3
    lower = _LOWER[data]
    lower[follows & (data >= 0x80) & (data <= 0x9E) & (kind == 1)] += 0x20
    cut = np.ones(len(data) + 1, bool)
    cut[1:-1] = kind[1:] != kind[:-1]
    cut[offsets] = True
    at = np.flatnonzero(cut)
    starts, ends = at[:-1], at[1:]
    keep = kind[starts] > 0 if len(data) else np.zeros(0, bool)
    return starts[keep], ends[keep], lower


def byte_symbols() -> list[str]:
    """Symbol of each byte in byte-level vocabularies: printable bytes stand for themselves,
    the others follow from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


def tokenizer_ids(path: str):
    """Function from distinct stretches of text to their id lists.

    Plain stretches go to the tokenizer's model at once: what its normalizer and its pattern
    would make of them is the stretch itself, digits one by one. Others take the whole way.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    model = tok.model.tokenize
    symbols = dict(enumerate(byte_symbols()))
    pieces = re.compile("[0-9]|[^0-9]+").findall
    plain = re.compile("[a-zà-öø-þß]+|[!-&(-;=?@\\[-`{}~]+").fullmatch

    def encode(words: list[str]) -> list[list[int]]:
        out: list = [None] * len(words)
        rest = []
        for i, w in enumerate(words):
            if not plain(w):
                rest.append(i)
            elif w.isascii():
                if w.isalpha():
                    out[i] = [t.id for t in model(w)]
                else:
                    out[i] = [t.id for p in pieces(w) for t in model(p)]
            else:
                out[i] = [t.id for t in model(w.encode().decode("latin-1").translate(symbols))]
        if rest:
            got = tok.encode_batch([words[i] for i in rest], add_special_tokens=False)
            for i, e in zip(rest, got):
                out[i] = e.ids
        return out
    return encode


def _pieces(batches, table_of: blocks.WordTable, capacity: int):
    """Columns of the pieces of each run of rows: document, piece, start, length, checksum."""
    for run in blocks.runs(batches):
        data, offsets = blocks.flat(run.column("text"))
        n = run.num_rows
        starts, ends, data = chunks(data, offsets)
        rows = np.searchsorted(starts, offsets)
        counts, ids = [np.zeros(0, np.int64)], [np.zeros(0, np.uint32)]
        i = 0
        while i < len(starts):  # a very long row goes through the table in stretches
            j = max(int(np.searchsorted(ends, starts[i] + 4 * blocks.BLOCK, "right")), i + 1)
            s, e = starts[i:j] - starts[i], ends[i:j] - starts[i]
            part = data[starts[i]:ends[j - 1]]
            c, x = table_of.ids(part, s, e, blocks.hash_spans(part, s, e))
            counts.append(c)
            ids.append(x)
            i = j
        counts, ids = np.concatenate(counts), np.concatenate(ids)
        ends_of = np.r_[0, np.cumsum(counts)][rows]
        lengths = np.diff(ends_of) + 1
        begin = np.r_[0, np.cumsum(lengths)]
        out = np.full(begin[-1], END_ID, "<u4")
        closing = np.zeros(begin[-1], bool)
        closing[begin[1:] - 1] = True
        out[~closing] = ids
        del ids, closing
        cuts = -(-lengths // capacity)
        doc = np.repeat(np.arange(n), cuts)
        piece = np.arange(cuts.sum()) - np.repeat(np.cumsum(cuts) - cuts, cuts)
        start = piece * capacity
        length = np.minimum(lengths[doc] - start, capacity)
        first = begin[doc] + start
        sums = [zlib.crc32(out[a:a + k]) for a, k in zip(first.tolist(), length.tolist())]
        yield pa.array(run.column("doc_id")).take(pa.array(doc)), piece, start, length, sums


def _local(tokenizer_path: str, capacity: int, nearly_full: float):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = blocks.WordTable(tokenizer_ids(tokenizer_path))
        parts = list(_pieces(batches, words, capacity))
        if not parts:
            return
        task = TaskContext.get().partitionId()
        docs = pa.chunked_array([p[0] for p in parts]).combine_chunks()
        piece, start, length = (np.concatenate([p[k] for p in parts]) for k in (1, 2, 3))
        sums = np.asarray([x for p in parts for x in p[4]], np.int64)
        bins, at, fills = best_fit(length.tolist(), capacity)
        bins, fills = np.asarray(bins), np.asarray(fills)
        underfull = fills[bins] < nearly_full * capacity
        arrays = [docs.cast(pa.int64()), pa.array(piece.astype(np.int32)), pa.array(start),
                  pa.array(length), pa.array(sums), pa.array(bins + (task << 32)),
                  pa.array(np.asarray(at, np.int64)),
                  pa.array(np.where(underfull, task, -1).astype(np.int32))]
        whole = pa.RecordBatch.from_arrays(
            arrays, ["doc_id", "piece", "start", "length", "ids_crc32", "bin", "at", "grp"])
        for i in range(0, whole.num_rows, 50_000):
            yield whole.slice(i, 50_000)
    return pack


def _level(capacity: int, nearly_full: float):
    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("bin")
        fills_in, members = rows.fill.tolist(), list(rows.members)
        ids, grp = rows.bin.tolist(), int(rows.grp.iloc[0])
        bins, at, fills = best_fit(fills_in, capacity)
        merged: list[list[dict]] = [[] for _ in fills]
        name: list[int | None] = [None] * len(fills)
        for i, b in enumerate(bins):
            name[b] = ids[i] if name[b] is None else min(name[b], ids[i])
            merged[b] += [{"bin": m["bin"], "shift": m["shift"] + at[i]} for m in members[i]]
        return pd.DataFrame({"bin": name, "fill": fills, "grp": grp,
                             "open": [f < nearly_full * capacity for f in fills], "members": merged})
    return pack


def merge_underfull(level: DataFrame, capacity: int, nearly_full: float, fan: int, most: int) -> DataFrame:
    """Bins after all rounds, from the tasks' underfull bins (grp: the task)."""
    done, groups = level.limit(0), (level.agg(F.max("grp")).first()[0] or 0) + 1
    left, turn = level.count(), 0
    while left:
        turn += 1
        tree, need = -(-groups // fan), -(-left // most)
        dealt = tree < need
        key = F.expr(f"pmod(xxhash64(bin, {turn}), {need})") if dealt else F.expr(f"grp div {fan}")
        groups = need if dealt else tree
        after = written(level.withColumn("grp", key.cast("int")).groupBy("grp").applyInPandas(
            _level(capacity, nearly_full), BINS), "bins")
        if groups == 1:
            return done.unionAll(after)
        n = after.count()
        if dealt and left - n <= left // 1000:       # groups of all fills, and next to no merge
            return done.unionAll(after)
        done, level = done.unionAll(after.where("not open")), after.where("open")
        left = level.count()
    return done


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY,
                   nearly_full: float = NEARLY_FULL, fan: int = FAN, most: int = MOST) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    pieces = written(docs.select("doc_id", "text")
                     .mapInArrow(_local(tokenizer_path, capacity, nearly_full), PIECES), "pieces")
    level = (pieces.where("grp >= 0").groupBy("bin", "grp").agg(F.sum("length").alias("fill"))
             .select("bin", "fill", "grp", F.lit(True).alias("open"),
                     F.array(F.struct("bin", F.lit(0).cast("long").alias("shift"))).alias("members")))
    done = merge_underfull(written(level, "bins"), capacity, nearly_full, fan, most)
    moved = done.select(F.col("bin").alias("sequence_id"), F.explode("members").alias("m")) \
        .select("sequence_id", F.col("m.bin").alias("bin"), F.col("m.shift").alias("shift"))
    result = (pieces.where("grp >= 0").join(moved, "bin")
              .unionByName(pieces.where("grp < 0").withColumns(
                  {"sequence_id": F.col("bin"), "shift": F.lit(0).cast("long")})))
    return result.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id",
                         (F.col("at") + F.col("shift")).alias("offset"))


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, packed into sequences of 4096 ids."""
    return pack_documents(table(spark, sf_dir, "documents"),
                          public_tokenizers.path("word_bpe_49k.json"))
