"""Helpers for work inside tasks: Arrow batches as flat byte arrays, and hashed words.

Texts stay in the buffers in which Arrow delivers them. A batch is cut into runs of rows of
about ``BLOCK`` bytes, so a task holds a few arrays of that length, whatever the batch size.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc

BLOCK = 2 << 20
LANES = 1 << 18
_MULT = np.uint64(0x9E3779B97F4A7C15)
_SALT = np.uint64(0xD6E8FEB86659FD93)
_MASKS = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Bit finalizer of the splitmix generator on uint64."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string or binary column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    kind = pa.large_binary() if pa.types.is_large_string(column.type) or \
        pa.types.is_large_binary(column.type) else pa.binary()
    if column.null_count:
        column = pc.fill_null(column, "" if not (pa.types.is_binary(column.type) or
                                                 pa.types.is_large_binary(column.type)) else b"")
    column = column.cast(kind)
    width = np.int64 if kind == pa.large_binary() else np.int32
    _, offs, data = column.buffers()
    offsets = np.frombuffer(offs, width)[column.offset:column.offset + len(column) + 1]
    offsets = offsets.astype(np.int64)
    if data is None:
        return np.zeros(0, np.uint8), offsets * 0
    whole = np.frombuffer(data, np.uint8)
    return whole[offsets[0]:offsets[-1]], offsets - offsets[0]


def give_back() -> None:
    """Returns memory that earlier work of this process no longer uses to the system.

    Python workers live on between stages, and would keep what the largest of them once took.
    """
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def runs(batches: Iterator[pa.RecordBatch], text: str = "text",
         limit: int = BLOCK) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with about ``limit`` bytes of text, one row at least."""
    give_back()
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = flat(batch.column(text))
        row = 0
        while row < batch.num_rows:
            end = int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1
            end = min(max(end, row + 1), batch.num_rows)
            yield batch.slice(row, end - row)
            row = end
    give_back()


def _lanes(padded: np.ndarray, at: np.ndarray, rest: np.ndarray) -> np.ndarray:
    """Eight bytes from each place as a number, without those beyond ``rest``."""
    every = np.ndarray((len(padded) - 7,), "<u8", buffer=padded, strides=(1,))
    return every[at] & _MASKS[np.minimum(rest, 8)]


def _further(starts: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """For spans of more than eight bytes, in parts of about ``LANES``: the spans, the number of their
    lanes after the first, and for each such lane its number, its place and the bytes left."""
    long = np.flatnonzero(sizes > 8)
    counts = (sizes[long] + 7 >> 3) - 1
    ends = np.cumsum(counts)
    i = 0
    while i < len(long):
        j = max(int(np.searchsorted(ends, (ends[i - 1] if i else 0) + LANES, "right")), i + 1)
        n = counts[i:j]
        k = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + 1
        yield long[i:j], n, k, np.repeat(starts[long[i:j]], n) + 8 * k, np.repeat(sizes[long[i:j]], n) - 8 * k
        i = j


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans: a sum over lanes of eight bytes, each mixed with its number.

    Every lane at every place counts with a value of its own, so no arrangement of few letters gives
    equal sums by its structure, as it would in a polynomial modulo a power of two.
    """
    padded, sizes = np.r_[data, np.zeros(8, np.uint8)], ends - starts
    out = mix(_lanes(padded, starts, sizes) ^ _SALT)
    for span, n, k, at, rest in _further(starts, sizes):
        salt = mix(k.astype(np.uint64) * _MULT) ^ _SALT
        out[span] += np.add.reduceat(mix(_lanes(padded, at, rest) ^ salt), np.cumsum(n) - n)
    return mix(out + sizes.astype(np.uint64) * _MULT)


def equal_spans(a: np.ndarray, a_starts: np.ndarray, a_ends: np.ndarray, b: np.ndarray,
                b_starts: np.ndarray, b_ends: np.ndarray) -> np.ndarray:
    """Whether the spans of two arrays hold the same bytes, pair by pair."""
    a, b = (np.r_[x, np.zeros(8, np.uint8)] for x in (a, b))
    sizes = a_ends - a_starts
    same = sizes == b_ends - b_starts
    same &= _lanes(a, a_starts, sizes) == _lanes(b, b_starts, b_ends - b_starts)
    for span, n, k, at, rest in _further(a_starts, np.where(same, sizes, 0)):
        there = np.repeat(b_starts[span], n) + 8 * k
        same[span] &= np.logical_and.reduceat(_lanes(a, at, rest) == _lanes(b, there, rest), np.cumsum(n) - n)
    return same


def sequence_sums(values: np.ndarray, rows: np.ndarray, salt: np.uint64) -> np.ndarray:
    """A hash of the sequence of values of each row: each value counts mixed with its place."""
    place = np.arange(len(values)) - np.repeat(rows[:-1], np.diff(rows))
    mixed = mix((values ^ salt) + mix(place.astype(np.uint64) * _MULT + salt))
    total = np.r_[np.uint64(0), np.cumsum(mixed)]
    return mix(total[rows[1:]] - total[rows[:-1]] + np.diff(rows).astype(np.uint64))


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of each row, and where each row's words begin.

    A word is a run of bytes other than space and 0x09 to 0x0D; it never crosses rows.
    """
    inside = np.zeros(len(data) + 1, bool)
    inside[:-1] = ~_SPACE[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = np.zeros(len(data) + 1, bool)
    last[1:] = inside[:-1] & ~inside[1:]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    first[edges] = inside[edges]
    last[edges] |= inside[edges - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last)
    return starts, ends, np.searchsorted(starts, offsets)


def hashed_words(batch: pa.RecordBatch, text: str = "text"):
    """Bytes, word starts, ends and hashes, and the word index at which each row begins.

    Hashes are made over stretches of ``BLOCK`` bytes that end between words, so a very long
    row costs eight bytes a word and not several arrays of its length.
    """
    data, offsets = flat(batch.column(text))
    starts, ends, rows = word_spans(data, offsets)
    hashes = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        j = max(int(np.searchsorted(ends, starts[i] + 2 * BLOCK, "right")), i + 1)
        a, b = starts[i], ends[j - 1]
        hashes[i:j] = hash_spans(data[a:b], starts[i:j] - a, ends[i:j] - a)
        i = j
    return data, starts, ends, hashes, rows


def factorize(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code of each hash, distinct hashes, and the first place of each."""
    codes, distinct = pd.factorize(hashes)
    first = np.empty(len(distinct), np.int64)
    first[codes[::-1]] = np.arange(len(codes) - 1, -1, -1)
    return codes, distinct, first


class WordTable:
    """Ids of distinct words, kept over the blocks of a task.

    ``encode`` gets a list of new words and returns their id lists. Words are looked up by hash, in
    sorted arrays, and their bytes are compared, so two words with one hash keep their own ids.
    Beyond ``most`` bytes the table starts anew, which bounds memory and changes no result.
    """

    def __init__(self, encode, most: int = 48 << 20):
        self.encode, self.most = encode, most
        self._clear()

    def _clear(self) -> None:
        self.keys, self.slots = np.zeros(0, np.uint64), np.zeros(0, np.int64)    # sorted by hash
        self.n, self.used = 0, {"id": 0, "byte": 0}
        self.flat = {"id": np.zeros(1 << 16, np.uint32), "byte": np.zeros(1 << 16, np.uint8)}
        # of each slot: where its ids and its bytes begin, and end
        self.begin = {k: np.zeros(1 << 12, np.int64) for k in self.flat}
        self.end = {k: np.zeros(1 << 12, np.int64) for k in self.flat}

    def held(self) -> int:
        return 16 * self.n + sum(x.nbytes for d in (self.flat, self.begin, self.end) for x in d.values())

    def ids(self, data, starts, ends, hashes) -> tuple[np.ndarray, np.ndarray]:
        """Number of ids of each word, and all ids in order."""
        if self.held() > self.most:
            self._clear()
        codes, distinct, first = factorize(hashes)
        slots = self._slots(data, starts[first], ends[first], distinct)[codes]
        clash = np.flatnonzero(~equal_spans(data, starts, ends, data, starts[first][codes], ends[first][codes]))
        if len(clash):
            slots[clash] = self._apart(data, starts[clash], ends[clash])
        counts = self.end["id"][slots] - self.begin["id"][slots]
        out = np.cumsum(counts) - counts
        index = np.repeat(self.begin["id"][slots] - out, counts) + np.arange(counts.sum())
        return counts, self.flat["id"][index]

    def _slots(self, data, starts, ends, hashes) -> np.ndarray:
        """Slots of words of different hashes; new words are added."""
        at = np.searchsorted(self.keys, hashes)
        known = np.flatnonzero(at < len(self.keys))
        known = known[self.keys[at[known]] == hashes[known]]
        slots = np.full(len(hashes), -1, np.int64)
        slots[known] = self.slots[at[known]]
        new = np.flatnonzero(slots < 0)
        if len(known):
            old = slots[known]
            bytes_ = self.flat["byte"][:self.used["byte"]]
            clash = known[~equal_spans(data, starts[known], ends[known], bytes_, self.begin["byte"][old],
                                       self.end["byte"][old])]
            if len(clash):
                slots[clash] = self._apart(data, starts[clash], ends[clash])
        if len(new):
            slots[new] = self._add(data, starts[new], ends[new])
            keys, all_ = np.r_[self.keys, hashes[new]], np.r_[self.slots, slots[new]]
            order = np.argsort(keys, kind="stable")
            self.keys, self.slots = keys[order], all_[order]
        return slots

    def _apart(self, data, starts, ends) -> np.ndarray:
        """Slots of words whose hash is another word's: by their bytes, for this block only."""
        of: dict[bytes, int] = {}
        out = np.empty(len(starts), np.int64)
        for i, (s, e) in enumerate(zip(starts.tolist(), ends.tolist())):
            word = data[s:e].tobytes()
            if word not in of:
                of[word] = int(self._add(data, starts[i:i + 1], ends[i:i + 1])[0])
            out[i] = of[word]
        return out

    def _add(self, data, starts, ends) -> np.ndarray:
        raw = data.tobytes() if len(starts) > 1 else None
        words = [raw[s:e] if raw else data[s:e].tobytes() for s, e in zip(starts.tolist(), ends.tolist())]
        got = self.encode([w.decode("utf-8", "replace") for w in words])
        ids = np.fromiter(chain.from_iterable(got), np.uint32)
        slots = self._put("id", ids, np.fromiter(map(len, got), np.int64, len(got)))
        self._put("byte", np.frombuffer(b"".join(words), np.uint8), ends - starts)
        self.n += len(words)
        return slots

    def _put(self, kind: str, values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        n, used = self.n, self.used[kind]
        while n + len(sizes) > len(self.begin[kind]):
            for of in (self.begin, self.end):
                of[kind] = np.r_[of[kind], np.zeros_like(of[kind])]
        if used + len(values) > len(self.flat[kind]):
            grown = np.zeros(max(2 * len(self.flat[kind]), used + len(values)), self.flat[kind].dtype)
            grown[:used] = self.flat[kind][:used]
            self.flat[kind] = grown
        self.flat[kind][used:used + len(values)] = values
        last = used + np.cumsum(sizes)
        self.begin[kind][n:n + len(sizes)], self.end[kind][n:n + len(sizes)] = last - sizes, last
        self.used[kind] = used + len(values)
        return np.arange(n, n + len(sizes))
