"""SentencePiece encoding and decoding by a forward pass over a trie of words.

Text is cut into marked words: a run of spaces, each as the mark, with what follows up to the
next space. The distinct marked words of a block are sorted, which lays them out as a trie in
depth-first order: a word keeps the forward states of the prefix that it shares with the one
before, and only its new characters are worked on. The state of a prefix is its best last piece.

For unigram models this is Viterbi: the best sum of scores. For merge (BPE) models the best score
is not the sum, but an encoding is right exactly if each two neighbouring pieces stay apart when
merged on their own; so the last piece of a prefix is the one that fits the state where it
begins, and the same pass gives the library's result. Characters without a piece become bytes.

Defined results: null and empty texts have no ids and decode to empty text; null doc_ids and
repeated rows each give a row; an empty table gives no rows; extra columns are ignored; texts of
any length are encoded whole. A mark in the text decodes as a space.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import blocks
from .frames import table

MARK = "▁"
TABLE_BYTES = 128 << 20        # of each task's table of words
MOST_PAIRS = 1_000_000         # neighbours that are remembered, at about 100 bytes


class Pieces:
    """A vocabulary with scores, and the forward pass over sorted words."""

    def __init__(self, scores: dict[str, tuple[int, float]], byte_ids: list[int], merges: bool,
                 most_pairs: int = MOST_PAIRS):
        self.scores, self.byte_ids, self.merges, self.most_pairs = scores, byte_ids, merges, most_pairs
        self.longest = max(map(len, scores), default=1)
        self.fits: dict[int, bool] = {}              # by the ids of both pieces

    @classmethod
    def load(cls, path: str, merges: bool = True) -> Pieces:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        plain = [i for i in range(sp.get_piece_size())
                 if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        return cls({sp.id_to_piece(i): (i, sp.get_score(i)) for i in plain},
                   [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)], merges)

    def _apart(self, left: str, right: str, key: int) -> bool:
        """Whether merging left + right alone ends with just these two pieces; kept for later."""
        if len(self.fits) >= self.most_pairs:
            self.fits.clear()
        known = self.fits[key] = self.merge(left + right) == [left, right]
        return known

    def merge(self, text: str) -> list[str]:
        """Merges of the best-scored neighbours, leftmost first among equals, to the end."""
        parts, scores = list(text), self.scores
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                got = scores.get(parts[i] + parts[i + 1])
                if got and (best is None or got[1] > best):
                    best, at = got[1], i
            if at < 0:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def encode_sorted(self, words: list[str]) -> list[list[int]]:
        """Ids of the words; words in order share the work on common prefixes."""
        scores, fits, apart, longest = self.scores, self.fits, self._apart, self.longest
        begins, pieces = [0], [""]                       # per prefix: where its last piece begins, the piece
        total: list[float] = [0.0]
        before, out = "", []
        for word in words:
            n = min(len(word), len(before))
            same = 0
            while same < n and word[same] == before[same]:
                same += 1
            del begins[same + 1:], pieces[same + 1:], total[same + 1:]
            for end in range(same + 1, len(word) + 1):
                found, best = -1, None
                for begin in range(end - longest if end > longest else 0, end):
                    piece = word[begin:end]
                    if piece not in scores:
                        continue
                    if self.merges:
                        prior = pieces[begin]
                        if prior:
                            key = scores[prior][0] << 32 | scores[piece][0]
                            known = fits.get(key)
                            if not (apart(prior, piece, key) if known is None else known):
                                continue
                        found = begin
                        break
                    value = total[begin] + scores[piece][1]
                    if best is None or value > best:
                        found, best = begin, value
                if found < 0:                              # no piece: bytes, which nothing merges with
                    begins.append(end - 1)
                    pieces.append("")
                    total.append(total[end - 1] - 1e6)
                else:
                    begins.append(found)
                    pieces.append(word[found:end])
                    total.append(best or 0.0)
            before = word
            ids, end = [], len(word)
            while end:
                begin, piece = begins[end], pieces[end]
                if piece:
                    ids.append(scores[piece][0])
                else:
                    ids += [self.byte_ids[b] for b in word[begin:end].encode()[::-1]]
                end = begin
            out.append(ids[::-1])
        return out

    def encode(self, words: list[str]) -> list[list[int]]:
        order = sorted(range(len(words)), key=words.__getitem__)
        out: list = [None] * len(words)
        for i, ids in zip(order, self.encode_sorted([words[i] for i in order])):
            out[i] = ids
        return out


def marked(data: np.ndarray, offsets: np.ndarray):
    """Bytes with a space put before each row that has text, word starts and ends, row bounds."""
    full = np.flatnonzero(np.diff(offsets) > 0)
    bytes_ = np.insert(data, offsets[:-1][full], 32)
    added = np.zeros(len(offsets), np.int64)
    added[full + 1] = 1
    offsets = offsets + np.cumsum(added)
    space = bytes_ == 32
    first = space.copy()
    first[1:] &= ~space[:-1]
    first[offsets[:-1][full]] = True
    starts = np.flatnonzero(first)
    return bytes_, starts, np.r_[starts[1:], len(bytes_)].astype(np.int64), offsets


def _encode(path: str, merges: bool):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Pieces.load(path, merges)
        words = blocks.WordTable(lambda raw: model.encode([w.replace(" ", MARK) for w in raw]), most=TABLE_BYTES)
        for run in blocks.runs(batches, limit=2 * blocks.BLOCK):
            spaced = pc.replace_substring(run.column("text"), MARK, " ")   # a mark is a space
            data, starts, ends, offsets = marked(*blocks.flat(spaced))
            rows = np.searchsorted(starts, offsets)
            counts, ids = [np.zeros(0, np.int64)], [np.zeros(0, np.uint32)]
            i = 0
            while i < len(starts):
                j = max(int(np.searchsorted(ends, starts[i] + 4 * blocks.BLOCK, "right")), i + 1)
                s, e = starts[i:j] - starts[i], ends[i:j] - starts[i]
                part = data[starts[i]:ends[j - 1]]
                c, x = words.ids(part, s, e, blocks.hash_spans(part, s, e))
                counts.append(c)
                ids.append(x)
                i = j
            bounds = np.r_[0, np.cumsum(np.concatenate(counts))][rows]
            column = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)),
                                              pa.array(np.concatenate(ids).astype(np.int32)))
            yield pa.RecordBatch.from_arrays([run.column("doc_id"), run.column("text"), column],
                                             ["doc_id", "text", "ids"])
    return encode


def _decode(path: str):
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        raw = []
        for i in range(sp.get_piece_size()):
            piece = sp.id_to_piece(i)
            raw.append(bytes([int(piece[3:5], 16)]) if sp.is_byte(i) else b"" if sp.is_control(i)
                       else b" \xe2\x81\x87 " if sp.is_unknown(i) else piece.replace(MARK, " ").encode())
        size = np.array([len(r) for r in raw])
        begin, all_ = np.cumsum(size) - size, np.frombuffer(b"".join(raw), np.uint8)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                lists = part.column("ids")
                bounds = lists.offsets.to_numpy().astype(np.int64)
                ids = lists.values.to_numpy()[bounds[0]:bounds[-1]]
                n = size[ids]
                text = all_[np.repeat(begin[ids] - np.cumsum(n) + n, n) + np.arange(n.sum())].tobytes()
                edge = np.r_[0, np.cumsum(n)][bounds - bounds[0]].tolist()
                texts = [text[a + (text[a:a + 1] == b" "):b].decode("utf-8", "replace")
                         for a, b in zip(edge[:-1], edge[1:])]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())],
                                                 [*part.schema.names, "decoded"])
    return decode


def encode(docs: DataFrame, path: str, merges: bool = True) -> DataFrame:
    """doc_id, text and ids (array of int)."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _encode(path, merges), "doc_id long, text string, ids array<int>")


def decode(coded: DataFrame, path: str) -> DataFrame:
    """The frame's columns and ``decoded``, the text of its ``ids``."""
    return coded.mapInArrow(_decode(path), coded.select("*", F.lit("").alias("decoded")).schema)


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all documents by their number and hash, and whether they decode to the text."""
    path = public_tokenizers.path("piece_bpe_32k.model")
    coded = encode(table(spark, sf_dir, "documents"), path)
    # a digest in place of the text: the second Python step needs the ids alone
    digest = (lambda c: F.sha2(F.coalesce(c, F.lit("")), 256))
    rows = decode(coded.select("doc_id", digest("text").alias("digest"), "ids"), path)
    return rows.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.xxhash64("ids").alias("ids_hash"),
                       (digest("decoded") == F.col("digest")).alias("round_trip"))
