"""Fill-in-the-middle documents through memoized content-defined chunks.

A rolling hash over the bytes cuts texts into chunks, so a passage that many documents hold gives the
same chunks in each. A chunk is worked on once: a cache from its very bytes (so equality is
checked, not presumed) keeps its summary, which is where its lines end, how many code points it has and
whether it holds a marker. Summing the counts of a document's chunks gives its lines, and finds the
chunk, and in it the place, of each cut without reading the rest again.

The choice of form and cuts depends on seed and doc_id alone. The output of a form can be turned
back into the exact text (``restored``).

Defined results: a null or empty text is plain with no lines; a text that holds a marker stays
plain; a null doc_id chooses like the empty string; repeated rows each give a row; an empty table
gives no rows; extra columns are ignored; texts of any length are cut whole, with the rolling
hash over stretches. The cache starts anew beyond ``CACHE_BYTES``, which changes no result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import blocks
from .frames import table

SEED, RATE, SPM_SHARE = 7, 100, 50
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MARKERS = tuple(m.encode() for m in (PREFIX, SUFFIX, MIDDLE))
WINDOW_DOUBLINGS = 5                 # the hash sees 2**5 bytes
CUT_BITS, LONGEST = 11, 1 << 15      # chunks of 2 KB on average
CACHE_BYTES = 32 << 20
STRETCH = 4 << 20

_GEAR = np.random.default_rng(2024).integers(0, 1 << 32, 256, np.uint32)


def chunk_ends(data: np.ndarray, offsets: np.ndarray, bits: int = CUT_BITS, longest: int = LONGEST) -> np.ndarray:
    """Sorted ends of the chunks of all rows; rows end chunks too.

    A chunk ends where the hash of the last 32 bytes has ``bits`` zeros on top, or after ``longest``
    bytes. The hash of a window is put together from those of its halves.
    """
    found = [offsets[1:]]
    reach = (1 << WINDOW_DOUBLINGS) - 1
    for a in range(0, len(data), STRETCH):
        low = max(a - reach, 0)
        h = _GEAR[data[low:a + STRETCH]]
        for k in range(WINDOW_DOUBLINGS):
            half = 1 << k
            joined = h.copy()
            joined[half:] += h[:-half] << np.uint32(half)
            h = joined
        found.append(np.flatnonzero((h >> np.uint32(32 - bits))[a - low:] == 0) + a + 1)
    ends = np.unique(np.concatenate(found))
    ends = ends[ends > 0]
    starts = np.r_[0, ends[:-1]].astype(np.int64)
    extra = (ends - starts - 1) // longest
    more = np.repeat(starts, extra) + longest * (
        np.arange(extra.sum()) - np.repeat(np.cumsum(extra) - extra, extra) + 1)
    return np.sort(np.r_[ends, more])


class Summaries:
    """Line ends, code points and markers of chunks, by their content."""

    def __init__(self, most: int = CACHE_BYTES):
        self.most, self.held, self.of = most, 0, {}
        self.hits = self.misses = 0

    def get(self, chunk: bytes) -> tuple[np.ndarray, int, bool]:
        """(offsets after each newline, code points that begin here, whether a marker lies inside)."""
        known = self.of.get(chunk)
        if known is not None:
            self.hits += 1
            return known
        self.misses += 1
        raw = np.frombuffer(chunk, np.uint8)
        known = ((np.flatnonzero(raw == 10) + 1).astype(np.int32),
                 len(chunk) if chunk.isascii() else int(np.count_nonzero((raw & 0xC0) != 0x80)),
                 any(m in chunk for m in MARKERS))
        self.held += len(chunk) + known[0].nbytes + 400
        if self.held > self.most:
            self.of.clear()
            self.held = len(chunk) + known[0].nbytes + 400
        self.of[chunk] = known
        return known


def _across(raw: bytes, begin: int, end: int, at: int) -> bool:
    """Whether a marker of the row from begin to end lies across the chunk border ``at``."""
    piece = raw[max(begin, at - 2):min(end, at + 2)]
    return b"<" in piece and any(m in piece for m in MARKERS)


def choices(seed: int, doc_id) -> list[int]:
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[k:k + 8], 16) for k in range(0, 32, 8)]


def cut_documents(raw: bytes, offsets: np.ndarray, ids: list, cache: Summaries, seed: int = SEED,
                  rate: int = RATE, spm_share: int = SPM_SHARE, bits: int = CUT_BITS) -> Iterator[tuple]:
    """(lines, form, prefix code points, middle code points, output) of each row of one block."""
    ends = chunk_ends(np.frombuffer(raw, np.uint8), offsets, bits)
    starts = np.r_[0, ends[:-1]].astype(np.int64)
    got = [cache.get(raw[a:b]) for a, b in zip(starts.tolist(), ends.tolist())]
    lines = np.r_[0, np.cumsum([len(g[0]) for g in got], dtype=np.int64)]
    chars = np.r_[0, np.cumsum([g[1] for g in got], dtype=np.int64)]
    first_chunk = np.searchsorted(starts, offsets).tolist()     # a row's chunks begin where it does
    for row, doc_id in enumerate(ids):
        begin, end = int(offsets[row]), int(offsets[row + 1])
        a, b = (first_chunk[row], first_chunk[row + 1]) if begin < end else (0, 0)
        newlines = int(lines[b] - lines[a])
        n = newlines + (begin < end and raw[end - 1] != 10)
        h1, h2, h3, h4 = choices(seed, doc_id)
        if begin == end or h3 % 100 >= rate or any(g[2] for g in got[a:b]) \
                or any(_across(raw, begin, end, x) for x in ends[a:b - 1].tolist()):
            yield n, "plain", None, None, raw[begin:end]
            continue

        def cut(unit):
            """Byte and code point after so many lines."""
            if unit == 0:
                return begin, 0
            if unit > newlines:
                return end, int(chars[b] - chars[a])
            k = int(np.searchsorted(lines, lines[a] + unit)) - 1          # the chunk with that newline
            at = int(starts[k]) + int(got[k][0][lines[a] + unit - lines[k] - 1])
            head = raw[starts[k]:at]
            inside = len(head) if head.isascii() else sum((x & 0xC0) != 0x80 for x in head)
            return at, int(chars[k] - chars[a]) + inside

        (x, x_chars), (y, y_chars) = map(cut, sorted((h1 % (n + 1), h2 % (n + 1))))
        prefix, middle, suffix = raw[begin:x], raw[x:y], raw[y:end]
        p, s, m = MARKERS
        if h4 % 100 < spm_share:
            form, output = "spm", s + suffix + p + prefix + m + middle
        else:
            form, output = "psm", p + prefix + s + suffix + m + middle
        yield n, form, x_chars, y_chars - x_chars, output


def _transform(seed: int, rate: int, spm_share: int):
    def transform(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = Summaries()
        for run in blocks.runs(batches, limit=2 * blocks.BLOCK):
            data, offsets = blocks.flat(run.column("text"))
            rows = list(cut_documents(data.tobytes(), offsets, run.column("doc_id").to_pylist(), cache,
                                      seed, rate, spm_share))
            n, form, prefix, middle, output = zip(*rows)
            yield pa.RecordBatch.from_arrays(
                [run.column("doc_id"), pa.array(n, pa.int64()), pa.array(form), pa.array(prefix, pa.int64()),
                 pa.array(middle, pa.int64()), pa.array(output, pa.binary()).cast(pa.string())],
                ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])
    return transform


def fill_middle(docs: DataFrame, seed: int = SEED, rate: int = RATE, spm_share: int = SPM_SHARE) -> DataFrame:
    """doc_id, n (lines), form, prefix_chars, middle_chars and output of each document.

    ``rate`` is the percentage of documents that are transformed, ``spm_share`` that of them in
    suffix-prefix-middle form.
    """
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _transform(seed, rate, spm_share),
        "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(output: Column, form: Column) -> Column:
    """The text of an output. Each marker occurs once in it, since marked texts stay plain."""
    body = F.substr(output, F.lit(len(PREFIX) + 1))

    def parts(one, two):
        rest = F.substring_index(body, one, -1)
        return (F.substring_index(body, one, 1), F.substring_index(rest, two, 1),
                F.substring_index(rest, two, -1))

    prefix, suffix, middle = parts(SUFFIX, MIDDLE)
    psm = F.concat(prefix, middle, suffix)
    suffix, prefix, middle = parts(PREFIX, MIDDLE)
    return F.when(form == "psm", psm).when(form == "spm", F.concat(prefix, middle, suffix)).otherwise(output)


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents transformed, with hashes of the output and of the text rebuilt from it."""
    rows = fill_middle(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                       F.sha2("output", 256).alias("output_sha256"),
                       F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


ORACLE = r"""
WITH units AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u,
                 sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS x FROM documents),
numbers AS (SELECT doc_id, t, u, len(u) AS n, ('0x' || substr(x, 1, 8))::BIGINT AS h1, ('0x' || substr(x, 9, 8))::BIGINT AS h2,
              ('0x' || substr(x, 17, 8))::BIGINT AS h3, ('0x' || substr(x, 25, 8))::BIGINT AS h4 FROM units),
forms AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
            CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 100 THEN 'plain'
                 WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM numbers),
parts AS (SELECT *, array_to_string(u[1:a], '') AS p, array_to_string(u[a + 1:b], '') AS m, array_to_string(u[b + 1:], '') AS s
          FROM forms)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(p)::BIGINT END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m)::BIGINT END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
              ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM parts
"""
