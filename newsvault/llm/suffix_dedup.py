"""Removal of passages that an earlier document already has, by suffix arrays.

A byte goes when a string of ``LENGTH`` bytes that covers it also starts in a document with a
smaller doc_id. Every such string holds an anchor: the smallest hash of its 16-byte pieces.
Neighbouring strings with one anchor form a stretch, so equal strings lie in stretches of equal
anchors, and shards made by anchor see all of them.

1. Blocks of text tell the shards which anchors they hold (five bytes each, once a block); a
   shard answers with a bit for those held by several documents. Only stretches of these go on.
2. Equal stretches of a block are sent once, with the smallest doc_id. A shard settles equal
   stretches by a grouped minimum. Where one anchor has different stretches, suffix arrays
   (Larsson-Sadakane refinement) and common prefixes (Kasai) over bounded sub-shards group
   equal strings; sub-shards that share an anchor are merged by binary search.
3. The answer is a bit for each string of a stretch; blocks turn those into byte ranges.

An anchor of more than ``HOT`` stretches is split: its strings go out singly, keyed by their own
hash, so no shard gathers a common phrase. Texts are shuffled twice, to meet the two answers.

Defined results: null and empty texts have no bytes; rows with null doc_id neither lose bytes
nor take any from others; rows with the same doc_id are one document and take nothing from
each other; repeated rows come back as often as given; extra columns are ignored; an empty table
gives no rows; long texts are worked on in overlapping pieces with the same result.
"""

from __future__ import annotations

import gc
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import blocks
from .frames import drop_scratch, table, written

LENGTH = 50
ANCHOR = 16
MOST = 128                 # strings in a stretch
HOT = 50_000               # stretches with one anchor before it is split
SHARD_BYTES = 4 << 20      # text for each shard of anchors
SUB_SHARD = 1 << 20        # bytes under one suffix array
KEY = 5                    # bytes of an anchor, beside those its shard tells; a clash only adds a check
_A = np.uint64(0x9E3779B97F4A7C15)


# ---------------------------------------------------------------- suffix arrays

def suffix_array(text: np.ndarray) -> np.ndarray:
    """All suffixes in order: groups by their first eight bytes, refined by doubling.

    As in Larsson-Sadakane, a suffix's rank is the place of its group, and each round sorts
    only inside groups of several, by the rank of the suffix that lies ``h`` further on.
    """
    n = len(text)
    padded = np.r_[text, np.zeros(8, np.uint8)]
    head = np.lib.stride_tricks.sliding_window_view(padded, 8)[:n].copy().view(">u8").ravel().astype(np.uint64)
    sa = np.argsort(head, kind="stable")
    new = np.r_[True, head[sa][1:] != head[sa][:-1]] if n else np.zeros(0, bool)
    rank = np.empty(n + 1, np.int64)
    rank[n] = -1
    rank[sa] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    h = 8
    while True:
        open_ = ~(new & np.r_[new[1:], True])
        at = np.flatnonzero(open_)
        if not len(at):
            break
        suffix = sa[at]
        key = (rank[suffix].astype(np.uint64) << np.uint64(32)) \
            | (rank[np.minimum(suffix + h, n)] + 1).astype(np.uint64)
        order = np.argsort(key, kind="stable")
        sa[at], key = suffix[order], key[order]
        first = np.r_[True, key[1:] != key[:-1]]
        new[at] |= first
        rank[sa[at]] = np.maximum.accumulate(np.where(first, at, 0))
        h *= 2
    return sa


def common_prefixes(text: np.ndarray, sa: np.ndarray, most: int) -> np.ndarray:
    """Bytes, ``most`` at most, that each suffix shares with the one before it in the array.

    Kasai's scan in text order, in many lanes at once: the next suffix shares one byte less at
    least, so each lane moves on either by a byte of prefix or by a suffix.
    """
    n = len(sa)
    before = np.full(n, -1, np.int64)
    before[sa[1:]] = sa[:-1]
    shared = np.zeros(n, np.int64)
    if not n:
        return shared
    width = max(64, int(np.sqrt(n) / 4))
    at = np.arange(0, n, width)
    stop = np.minimum(at + width, n)
    length = np.zeros(len(at), np.int64)
    padded = np.r_[text, np.zeros(most + 1, np.uint8)]
    while len(at):
        other = before[at]
        far = np.maximum(at, other) + length
        grow = (other >= 0) & (length < most) & (far < n)
        grow &= padded[at + length] == padded[np.maximum(other, 0) + length]
        length[grow] += 1
        done = ~grow
        shared[at[done]] = length[done]
        at[done] += 1
        length[done] = np.maximum(length[done] - 1, 0)
        live = at < stop
        if not live.all():
            at, stop, length = at[live], stop[live], length[live]
    return shared[sa]


def _strings(content: np.ndarray, begin: np.ndarray, count: np.ndarray, doc: np.ndarray, length: int):
    """For one sub-shard: groups of equal strings. Returns per string (stretch by stretch) its
    group, and per group its smallest document and one place, in order of the strings."""
    size = count + length - 1
    text = np.full(int(size.sum()) + len(count), 0xFF, np.uint8)     # 0xFF is in no UTF-8 text
    own = np.repeat(np.cumsum(size + 1) - size - 1, size) + np.arange(size.sum()) \
        - np.repeat(np.cumsum(size) - size, size)
    source = np.repeat(begin, size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    text[own] = content[source]
    del own, source
    sa = suffix_array(text)
    shared = common_prefixes(text, sa, length)
    place = np.full(len(text), -1, np.int64)
    first = np.cumsum(size + 1) - size - 1
    n = int(count.sum())
    starts = np.repeat(first, count) + np.arange(n) - np.repeat(np.cumsum(count) - count, count)
    place[starts] = np.arange(n)
    group = np.cumsum(shared < length) - 1
    mine = place[sa]
    keep = mine >= 0
    mine, group = mine[keep], group[keep]
    _, group = np.unique(group, return_inverse=True)
    of = np.empty(n, np.int64)
    of[mine] = group
    least = np.full(group[-1] + 1 if n else 0, np.iinfo(np.int64).max)
    np.minimum.at(least, group, np.repeat(doc, count)[mine])
    lead = np.full(len(least), -1, np.int64)
    lead[group[::-1]] = starts[mine[::-1]]
    return of, least, text, lead


def _keys(text: np.ndarray, lead: np.ndarray, length: int) -> np.ndarray:
    raw = np.ones((len(lead), length + 1), np.uint8)                 # a last byte that is not zero
    raw[:, :length] = np.lib.stride_tricks.sliding_window_view(text, length)[lead]
    return raw.view(f"S{length + 1}").ravel()


def repeated_strings(anchor: np.ndarray, content: np.ndarray, begin: np.ndarray, count: np.ndarray,
                     doc: np.ndarray, length: int = LENGTH, limit: int = SUB_SHARD) -> np.ndarray:
    """Whether each string of the stretches (sorted by anchor) has an equal one of a smaller
    document. Sub-shards hold ``limit`` bytes of stretches; each gets a suffix array, and those
    that share an anchor are merged: their ordered strings meet by binary search."""
    size = np.cumsum(count + length - 1)
    cut, i = [0], 0
    while i < len(count):
        i = max(int(np.searchsorted(size, (size[i - 1] if i else 0) + limit, "right")), i + 1)
        cut.append(i)
    parts = [(a, b, *_strings(content, begin[a:b], count[a:b], doc[a:b], length))
             for a, b in zip(cut[:-1], cut[1:])]
    for shared in {anchor[y[0]] for x, y in zip(parts[:-1], parts[1:]) if anchor[x[1] - 1] == anchor[y[0]]}:
        held = []                          # the ordered strings of this anchor in each part that has it
        for a, b, of, least, text, lead in parts:
            if anchor[a] <= shared <= anchor[b - 1]:
                owner = np.empty(len(least), anchor.dtype)
                owner[of] = np.repeat(anchor[a:b], count[a:b])
                mine = np.flatnonzero(owner == shared)
                held.append((_keys(text, lead[mine], length), least, mine))
        merged, low = held[0][0], held[0][1][held[0][2]]
        for keys, least, mine in held[1:]:
            at = np.searchsorted(merged, keys)
            hit = at < len(merged)
            hit[hit] = merged[at[hit]] == keys[hit]
            np.minimum.at(low, at[hit], least[mine][hit])
            merged, low = np.insert(merged, at[~hit], keys[~hit]), np.insert(low, at[~hit], least[mine][~hit])
        for keys, least, mine in held:
            least[mine] = low[np.searchsorted(merged, keys)]
    if not parts:
        return np.zeros(0, bool)
    return np.concatenate([least[of] < np.repeat(doc[a:b], count[a:b])
                           for a, b, of, least, _, _ in parts])


# ---------------------------------------------------------------- blocks of text

def _small(values: np.ndarray) -> bytes:
    """Compressed bytes of an array, with their number in front."""
    raw = np.ascontiguousarray(values).tobytes()
    return len(raw).to_bytes(8, "little") + (pa.compress(raw, codec="zstd", asbytes=True) if raw else b"")


def _large(raw: bytes, kind) -> np.ndarray:
    size = int.from_bytes(raw[:8], "little")
    return np.frombuffer(pa.decompress(raw[8:], size, codec="zstd", asbytes=True) if size else b"", kind)


def stretches(data: np.ndarray, offsets: np.ndarray, length: int, piece: int):
    """Runs of neighbouring strings with one anchor: row, start, number of strings, anchor."""
    n = len(data) - length + 1
    none = np.zeros(0, np.int64)
    if n <= 0:
        return none, none, none, np.zeros(0, np.uint64)
    padded = np.r_[data, np.zeros(8, np.uint8)]
    word = np.lib.stride_tricks.sliding_window_view(padded, 8)[:len(data)].copy().view(np.uint64).ravel()
    m = len(data) - piece + 1
    low = blocks.mix(word[:m] * _A + word[piece - 8:piece - 8 + m])
    span, width = 1, length - piece + 1
    while span < width:
        step = min(span, width - span)
        low = np.minimum(low[:-step], low[step:])
        span += step
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[:n]
    inside = np.arange(n) + length <= offsets[1:][row]
    new = np.r_[True, (low[1:] != low[:-1]) | (row[1:] != row[:-1])] & inside
    begin = np.flatnonzero(new)
    # a run ends at the next one or at its row's last string; long runs are divided
    end = np.minimum(np.r_[begin[1:], n], offsets[1:][row[begin]] - length + 1)
    count = end - begin
    parts = -(-count // MOST)
    sub = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
    begin = np.repeat(begin, parts) + sub * MOST
    count = np.minimum(np.repeat(count, parts) - sub * MOST, MOST)
    # smallest hashes lie near zero: mixing once more spreads them over the shards
    return row[begin], begin, count, blocks.mix(low[begin] ^ _A)


def _blocks(batches, limit: int, length: int) -> Iterator[dict]:
    """Blocks of pieces of documents. Long texts give pieces that overlap by length - 1."""
    task, made = TaskContext.get().partitionId(), 0
    for run in blocks.runs(batches, limit=limit):
        data, offsets = blocks.flat(run.column("text"))
        doc = run.column("doc_id").to_numpy()
        row_key = run.column("row_key").to_numpy()
        if len(data) <= 2 * limit:
            cuts = [(np.arange(run.num_rows), offsets, np.zeros(run.num_rows, np.int64))]
        else:
            cuts = [(np.array([r]), np.array([a, min(a + limit + length - 1, offsets[r + 1])]),
                     np.array([a - offsets[r]]))
                    for r in range(run.num_rows) for a in range(offsets[r], max(offsets[r + 1], 1), limit)]
        for rows, bounds, base in cuts:
            made += 1
            yield {"block": (task << 32) + made, "doc": doc[rows], "row_key": row_key[rows], "base": base,
                   "data": data[bounds[0]:bounds[-1]], "offsets": bounds - bounds[0]}


def _tell(bits: int, limit: int, length: int, piece: int):
    """A block's distinct anchors for each shard, and whether several of its documents hold them."""
    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _blocks(batches, limit, length):
            row, _, _, anchor = stretches(b["data"], b["offsets"], length, piece)
            distinct, inverse = np.unique(anchor, return_inverse=True)
            if not len(distinct):
                continue
            doc = b["doc"][row]
            low, high = (np.full(len(distinct), v) for v in (np.iinfo(np.int64).max, np.iinfo(np.int64).min))
            np.minimum.at(low, inverse, doc)
            np.maximum.at(high, inverse, doc)
            several = low < high
            times = np.minimum(np.bincount(inverse, minlength=len(distinct)), 65_535).astype(np.uint16)
            raw = (distinct << np.uint64(bits)).astype(">u8").view(np.uint8).reshape(-1, 8)[:, :KEY]
            cut = np.searchsorted(distinct, np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits)
                                  if bits else np.zeros(1, np.uint64))
            cut = np.r_[cut, len(distinct)]
            have = np.flatnonzero(np.diff(cut))
            yield pa.RecordBatch.from_arrays(
                [pa.array(have.astype(np.int32)), pa.array(np.full(len(have), b["block"])),
                 pa.array([raw[cut[s]:cut[s + 1]].tobytes() for s in have], pa.binary()),
                 pa.array([np.packbits(several[cut[s]:cut[s + 1]]).tobytes() for s in have], pa.binary()),
                 pa.array([_small(times[cut[s]:cut[s + 1]]) for s in have], pa.binary())],
                ["shard", "block", "anchors", "several", "times"])
    return tell


def _unpack(raw: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(raw, np.uint8), count=n).astype(bool)


def _answer_anchors(hot: int):
    def answer(rows: pd.DataFrame) -> pd.DataFrame:
        sizes = rows.anchors.map(len).to_numpy() // KEY
        raw = np.zeros((sizes.sum(), 8), np.uint8)
        raw[:, :KEY] = np.frombuffer(b"".join(rows.anchors), np.uint8).reshape(-1, KEY)
        key = raw.view(">u8").ravel().astype(np.uint64)
        several = np.concatenate([_unpack(s, n) for s, n in zip(rows.several, sizes)])
        order = np.argsort(key, kind="stable")
        first = np.r_[True, key[order][1:] != key[order][:-1]]
        group = np.empty(len(key), np.int64)
        group[order] = np.cumsum(first) - 1
        held = np.bincount(group)
        times = np.bincount(group, np.concatenate([_large(x, np.uint16) for x in rows.times]))
        wanted = (held > 1) | (np.bincount(group, several) > 0)
        shared, many = wanted[group], (times > hot)[group]
        cut = np.r_[0, np.cumsum(sizes)]
        return pd.DataFrame({
            "block": rows.block.to_numpy(), "shard": rows.shard.to_numpy(), "n": sizes,
            "shared": [np.packbits(shared[a:b]).tobytes() for a, b in zip(cut[:-1], cut[1:])],
            "hot": [np.packbits(many[a:b]).tobytes() for a, b in zip(cut[:-1], cut[1:])]})
    return answer


def _pack_blocks(limit: int, length: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _blocks(batches, limit, length):
            yield pa.RecordBatch.from_arrays(
                [pa.array([b["block"]]), *(pa.array([_small(b[c].astype(t))], pa.binary()) for c, t in
                                           (("doc", "i8"), ("row_key", "i8"), ("base", "i8"), ("offsets", "i8"),
                                            ("data", "u1")))],
                ["block", "doc", "row_key", "base", "offsets", "data"])
    return pack


_SENT = ("shard int, block long, anchor binary, doc binary, n binary, content binary, "
         "entry binary, row binary, start binary, row_doc binary, row_key binary")


def _send(bits: int, length: int, piece: int):
    """Stretches of shared anchors: one row for each shard with the distinct ones, and one row
    (shard -1) with all their occurrences in the block."""
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in _SENT.split(", ")]
        for batch in batches:
            for k in range(batch.num_rows):
                r = {c: batch.column(c)[k].as_py() for c in batch.schema.names}
                data = _large(r["data"], np.uint8)
                doc, base, offsets = (_large(r[c], np.int64) for c in ("doc", "base", "offsets"))
                row, begin, count, anchor = stretches(data, offsets, length, piece)
                distinct, inverse = np.unique(anchor, return_inverse=True)
                told = sorted(r["told"], key=lambda x: x["shard"])
                if sum(x["n"] for x in told) != len(distinct):
                    raise RuntimeError("the documents came in another order than before")
                shared, hot = (np.concatenate([_unpack(x[c], x["n"]) for x in told])[inverse]
                               for c in ("shared", "hot"))
                # strings of hot anchors go singly
                keep = np.flatnonzero(shared)
                row, begin, count, anchor, hot = (v[keep] for v in (row, begin, count, anchor, hot))
                times = np.where(hot, count, 1)
                sub = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
                row, anchor, hot = (np.repeat(v, times) for v in (row, anchor, hot))
                begin, count = np.repeat(begin, times) + sub, np.where(hot, 1, np.repeat(count, times))
                if not len(row):
                    continue
                code = blocks.hash_spans(data, begin, begin + count + length - 1)
                anchor = np.where(hot, blocks.mix(code ^ _A), anchor)
                order = np.lexsort((doc[row], code, anchor))
                row, begin, count, anchor, code = (v[order] for v in (row, begin, count, anchor, code))
                first = np.r_[True, (anchor[1:] != anchor[:-1]) | (code[1:] != code[:-1])]
                entry = np.cumsum(first) - 1
                lead = np.flatnonzero(first)
                size = (count + length - 1)[lead]
                at = np.repeat(begin[lead] - np.cumsum(size) + size, size) + np.arange(size.sum())
                content, ends = data[at], np.r_[0, np.cumsum(size)]
                shard = (anchor[lead] >> np.uint64(64 - bits)).astype(np.int64) if bits else \
                    np.zeros(len(lead), np.int64)
                have, cut = np.unique(shard, return_index=True)
                cut = np.r_[cut, len(lead)]
                a, d, n = anchor[lead], doc[row[lead]], count[lead].astype(np.uint8)
                out = [dict(zip(names, (int(s), r["block"], a[i:j].tobytes(), _small(d[i:j]), _small(n[i:j]),
                                        _small(content[ends[i]:ends[j]]))))
                       for s, i, j in zip(have, cut[:-1], cut[1:])]
                out.append({"shard": -1, "block": r["block"], "n": _small(n), "doc": _small(d),
                            "entry": _small(entry.astype(np.uint32)), "row": _small(row.astype(np.uint32)),
                            "start": _small((begin - offsets[row] + base[row]).astype(np.int64)),
                            "row_doc": r["doc"], "row_key": r["row_key"]})
                yield pa.RecordBatch.from_pylist(out, schema=schema)

    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    schema = pa.schema([(x.split()[0], kinds[x.split()[1]]) for x in _SENT.split(", ")])
    return send


_ANSWER = ("shard int, block long, bits binary, n long, entry binary, row binary, start binary, doc binary, "
           "counts binary, row_doc binary, row_key binary")


def _answer_stretches(length: int, limit: int):
    """A bit for each string of the stretches that blocks sent to one shard. The rows with a
    block's occurrences come through as they are."""
    names = [x.split()[0] for x in _ANSWER.split(", ")]

    def answer(rows: pd.DataFrame) -> pd.DataFrame:
        if rows.shard.iloc[0] < 0:
            return rows.assign(counts=rows.n, n=0, bits=None)[names]
        counts = [_large(x, np.uint8) for x in rows.n]
        sizes = [len(x) for x in counts]
        anchor = np.frombuffer(b"".join(rows.anchor), np.uint64)
        doc = np.concatenate([_large(x, np.int64) for x in rows.doc])
        count = np.concatenate(counts).astype(np.int64)
        content = np.concatenate([_large(x, np.uint8) for x in rows.content])
        end = np.cumsum(count + length - 1)
        begin = end - (count + length - 1)
        code = blocks.hash_spans(content, begin, end)
        order = np.lexsort((doc, code, anchor))
        new = np.r_[True, (anchor[order][1:] != anchor[order][:-1]) | (code[order][1:] != code[order][:-1])]
        kind = np.empty(len(order), np.int64)
        kind[order] = np.cumsum(new) - 1
        lead = order[new]                              # each distinct stretch, from its first document
        least = doc[lead]
        a = anchor[lead]
        alone = np.r_[True, a[1:] != a[:-1]] & np.r_[a[1:] != a[:-1], True]
        ask = np.flatnonzero(~alone)
        found = repeated_strings(a[ask], content, begin[lead[ask]], count[lead[ask]], least[ask], length, limit)
        bit_of = np.full(len(lead), -1, np.int64)      # where a distinct stretch's bits begin in found
        bit_of[ask] = np.cumsum(count[lead[ask]]) - count[lead[ask]]
        later = doc > least[kind]
        matched = np.repeat(later, count)
        asked = np.repeat(~later & (bit_of[kind] >= 0), count)
        step = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        matched[asked] = found[(np.repeat(bit_of[kind], count) + step)[asked]]
        cut = np.r_[0, np.cumsum(count)][np.r_[0, np.cumsum(sizes)]]
        return pd.DataFrame({"block": rows.block.to_numpy(), "shard": rows.shard.to_numpy(),
                             "bits": [np.packbits(matched[i:j]).tobytes() for i, j in zip(cut[:-1], cut[1:])],
                             "n": np.diff(cut)}).reindex(columns=names).astype({c: object for c in names[4:]}) \
            .where(lambda x: x.notna(), None)
    return answer


def _ranges(length: int):
    """Removed byte ranges of the pieces of a block."""
    def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                r = {c: batch.column(c)[k].as_py() for c in batch.schema.names}
                bits = np.concatenate([_unpack(x["bits"], x["n"]) for x in sorted(r["told"], key=lambda x: x["shard"])])
                count = _large(r["counts"], np.uint8).astype(np.int64)
                entry, row = (_large(r[c], np.uint32).astype(np.int64) for c in ("entry", "row"))
                start, least, row_doc, row_key = (_large(r[c], np.int64)
                                                  for c in ("start", "doc", "row_doc", "row_key"))
                n = count[entry]
                step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                hit = bits[np.repeat((np.cumsum(count) - count)[entry], n) + step] \
                    | np.repeat(row_doc[row] > least[entry], n)
                at, of = (np.repeat(start, n) + step)[hit], np.repeat(row, n)[hit]
                if not len(at):
                    continue
                order = np.lexsort((at, of))
                at, of = at[order], of[order]
                new = np.r_[True, (of[1:] != of[:-1]) | (at[1:] > at[:-1] + length)]
                last = np.r_[np.flatnonzero(new)[1:] - 1, len(at) - 1]
                a, b, of = at[new], at[last] + length, of[new]
                rows, cut = np.unique(of, return_index=True)
                cut = np.r_[cut, len(of)]
                spans = np.stack([a, b], 1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row_doc[rows]), pa.array(row_key[rows]),
                     pa.array([spans[i:j].tobytes() for i, j in zip(cut[:-1], cut[1:])], pa.binary())],
                    ["doc_id", "row_key", "spans"])
    return ranges


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for run in blocks.runs(batches):
        data, offsets = blocks.flat(run.column("text"))
        out = []
        for k, parts in enumerate(run.column("spans").to_pylist()):
            text = data[offsets[k]:offsets[k + 1]]
            n, spans, kept = len(text), [], text.tobytes()
            if parts:
                pairs = np.concatenate([np.frombuffer(p, np.int64).reshape(-1, 2) for p in parts])
                for a, b in pairs[np.argsort(pairs[:, 0], kind="stable")].tolist():
                    if spans and a <= spans[-1][1]:
                        spans[-1][1] = max(spans[-1][1], b)
                    else:
                        spans.append([a, b])
                edges = [0, *(x for s in spans for x in s), n]
                kept = b"".join(kept[a:b] for a, b in zip(edges[::2], edges[1::2]))
            out.append({"n_bytes": n, "n_removed": n - len(kept), "n_spans": len(spans),
                        "kept_sha256": hashlib.sha256(kept).hexdigest(), "kept": kept,
                        "kept_text": kept.decode("utf-8", "ignore")})
        added = pa.RecordBatch.from_pylist(out)
        passed = [c for c in run.schema.names if c != "spans"]
        yield pa.RecordBatch.from_arrays([*(run.column(c) for c in passed), *added.columns],
                                         [*passed, *added.schema.names])


def _release(spark: SparkSession) -> None:
    """Lets Spark remove the shuffle files of frames that are no longer held."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def removed_ranges(docs: DataFrame, length: int = LENGTH, block: int = blocks.BLOCK, hot: int = HOT,
                   shard_bytes: int = SHARD_BYTES, sub_shard: int = SUB_SHARD) -> DataFrame:
    """doc_id, row_key, list of removed byte ranges; docs: doc_id, text, row_key, from a stored
    table, as it is read twice in the same order."""
    spark = docs.sparkSession
    source = docs.where("doc_id is not null").where(F.octet_length("text") >= length)
    total = source.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    bits = max(0, int(total // shard_bytes).bit_length())
    told = source.mapInArrow(_tell(bits, block, length, ANCHOR),
                             "shard int, block long, anchors binary, several binary, times binary")
    told = written(told.groupBy("shard").applyInPandas(
        _answer_anchors(hot), "block long, shard int, n int, shared binary, hot binary"), "anchors")
    told = told.groupBy("block").agg(F.collect_list(F.struct("shard", "n", "shared", "hot")).alias("told"))
    packed = source.mapInArrow(_pack_blocks(block, length), "block long, doc binary, row_key binary, "
                               "base binary, offsets binary, data binary")
    sent = packed.join(told, "block").mapInArrow(_send(bits, length, ANCHOR), _SENT)
    answers = written(sent.groupBy("shard", F.when(F.col("shard") < 0, F.col("block")).alias("own"))
                      .applyInPandas(_answer_stretches(length, sub_shard), _ANSWER), "answers")
    del sent, packed
    _release(spark)
    bits_of = answers.where("shard >= 0").groupBy("block").agg(
        F.collect_list(F.struct("shard", "n", "bits")).alias("told"))
    found = written(answers.where("shard = -1").drop("shard", "bits", "n").join(bits_of, "block")
                    .mapInArrow(_ranges(length), "doc_id long, row_key long, spans binary"), "ranges")
    drop_scratch(answers)
    return found.groupBy("doc_id", "row_key").agg(F.array_distinct(F.collect_list("spans")).alias("spans"))


def remove_repeats(docs: DataFrame, length: int = LENGTH, rest: tuple[str, ...] = (), **options) -> DataFrame:
    """doc_id, the columns named in ``rest``, n_bytes, n_removed, n_spans, kept_sha256, kept and kept_text.

    ``kept`` has the bytes that stay. A cut may fall inside a character; ``kept_text`` is without it.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text",
                       F.xxhash64("doc_id", "text").alias("row_key"), *rest)
    spans = removed_ranges(rows.select("doc_id", "text", "row_key"), length, **options)
    joined = rows.join(spans, ["doc_id", "row_key"], "left").select(*rows.columns, "spans")
    return joined.mapInArrow(_apply, rows.select(
        "*", *(F.lit(0).cast("long").alias(c) for c in ("n_bytes", "n_removed", "n_spans")),
        F.lit("").alias("kept_sha256"), F.lit(b"").alias("kept"), F.lit("").alias("kept_text")).schema)


def op6_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without passages of earlier ones."""
    return remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
