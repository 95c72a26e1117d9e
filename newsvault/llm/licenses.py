"""License texts in documents: winnowed fingerprints, then banded alignment.

Texts are runs of letters and digits, lower-cased. Templates leave the smallest hash of each
``WINDOW`` neighbouring shingles of ``SHINGLE`` words in an inverted index, in which every shingle
of a document is looked up, so that no fingerprint depends on the words around a notice; what
both have proposes places. Word-for-word occurrences are taken as they are; around each other
diagonal with hits, in the gaps between the spans taken, the longest common subsequence inside a
band of ``BAND`` words gives coverage, the share of the template's words that are there, and the
span, until no hit is left. So each of many notices in a row has its match.

The index holds the templates only, at most ``MOST_WORDS`` words, so it goes along with the tasks.
One pass, no shuffle.

Defined results: null and empty texts have no match; null doc_ids are scanned too; repeated rows
each give their matches; of overlapping matches the one with more words in a tighter span is
reported; a notice of another version or license of a family is reported as the family; an
empty table gives no rows; extra columns are ignored; texts of any length are scanned whole.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import blocks
from .frames import table

SHINGLE, WINDOW, BAND = 3, 2, 12
COVERAGE = 0.8
MOST_WORDS = 200_000

# Wording of public licenses and of the notices that name them.
TEMPLATES = {
    "apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "mit-notice": "Released under the MIT License.",
    "gpl-3-notice": "This work is licensed under the GNU General Public License, version 3.",
    "cc-by-nc-4-notice": "Licensed under CC BY-NC 4.0.",
    "cc-by-4-notice": "Licensed under CC BY 4.0.",
    "cc-by-sa-4-notice": "Licensed under CC BY-SA 4.0.",
    "cc-by-nd-4-notice": "Licensed under CC BY-ND 4.0.",
    "cc-by-nc-sa-4-notice": "Licensed under CC BY-NC-SA 4.0.",
    "cc-by-nc-nd-4-notice": "Licensed under CC BY-NC-ND 4.0.",
    "all-rights-reserved": "All rights reserved.",
    "bsd-notice": "Released under the BSD License.",
    "mpl-2.0-notice": "Licensed under the Mozilla Public License, Version 2.0.",
    "gpl-2-notice": "This work is licensed under the GNU General Public License, version 2.",
    "lgpl-3-notice": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "spdx-mit": "SPDX-License-Identifier: MIT",
    "spdx-apache-2.0": "SPDX-License-Identifier: Apache-2.0",
    "spdx-gpl-2.0": "SPDX-License-Identifier: GPL-2.0",
    "spdx-gpl-3.0": "SPDX-License-Identifier: GPL-3.0",
    "spdx-lgpl-3.0": "SPDX-License-Identifier: LGPL-3.0",
    "spdx-bsd-2-clause": "SPDX-License-Identifier: BSD-2-Clause",
    "spdx-bsd-3-clause": "SPDX-License-Identifier: BSD-3-Clause",
    "spdx-mpl-2.0": "SPDX-License-Identifier: MPL-2.0",
    "spdx-cc0-1.0": "SPDX-License-Identifier: CC0-1.0",
    "apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
        "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License."),
    "mit": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions: The above copyright notice and this permission notice shall be included in all "
        "copies or substantial portions of the Software."),
    "mit-disclaimer": (
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT "
        "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO "
        "EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN "
        "AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE "
        "OR OTHER DEALINGS IN THE SOFTWARE."),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    "bsd-2-clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met: 1. Redistributions of source code must retain the above copyright "
        "notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must "
        "reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution."),
    "bsd-3-clause-endorsement": (
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
        "products derived from this software without specific prior written permission."),
    "bsd-disclaimer": (
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED "
        "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
        "PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY "
        "DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, "
        "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER "
        "CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE "
        "OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH "
        "DAMAGE."),
    "mpl-2.0-header": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    "unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, "
        "publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, "
        "for any purpose, commercial or non-commercial, and by any means."),
    "gpl-2-header": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation; either version 2 of the License, or "
        "(at your option) any later version. This program is distributed in the hope that it will be useful, but "
        "WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR "
        "PURPOSE. See the GNU General Public License for more details."),
    "lgpl-3-header": (
        "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or "
        "(at your option) any later version. This library is distributed in the hope that it will be useful, but "
        "WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR "
        "PURPOSE. See the GNU Lesser General Public License for more details."),
    "gpl-3-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or "
        "(at your option) any later version. This program is distributed in the hope that it will be useful, but "
        "WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR "
        "PURPOSE. See the GNU General Public License for more details."),
}
NOTICE_WORDS = 14                # a template of at most so many words only names a license
# Words of notices that tell no license from another.
GENERIC = {"licensed", "released", "under", "the", "this", "work", "is", "license", "public", "general", "version"}
# The words of longer texts without which another version or license is meant.
DECISIVE = {"apache-2.0-header": {"apache", "2", "0"}, "gpl-2-header": {"2"}, "gpl-3-header": {"3"},
            "lgpl-3-header": {"lesser", "3"}, "mpl-2.0-header": {"mozilla", "2", "0"}}


def decisive_words(name: str, words: list[str]) -> set[str]:
    """Words of a template that a match must hold to be this license and not one of its family."""
    return DECISIVE.get(name, set()) if len(words) > NOTICE_WORDS else {w for w in words if w not in GENERIC}


def family(name: str) -> str:
    """The license without version and form: ``gpl`` of ``gpl-3-notice``."""
    return re.sub(r"-notice$|-header$|-[0-9].*", "", name)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.zeros(256, bool)
for _a, _b in ((48, 57), (65, 90), (97, 122), (128, 255)):
    _WORD[_a:_b + 1] = True


def words(data: np.ndarray, offsets: np.ndarray):
    """Starts, ends and hashes of the words of each row, and where each row's begin."""
    low = np.where(_WORD[data], _LOWER[data], np.uint8(32))
    starts, ends, rows = blocks.word_spans(low, offsets)
    hashes, i = np.empty(len(starts), np.uint64), 0
    while i < len(starts):
        j = max(int(np.searchsorted(ends, starts[i] + 2 * blocks.BLOCK, "right")), i + 1)
        a = starts[i]
        hashes[i:j] = blocks.hash_spans(low[a:ends[j - 1]], starts[i:j] - a, ends[i:j] - a)
        i = j
    return starts, ends, hashes, rows


def _values(hashes: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Value and row of the shingle at each place, and whether it lies inside one row."""
    n = max(len(hashes) - SHINGLE + 1, 0)
    value = np.zeros(n, np.uint64)
    for k in range(SHINGLE):
        value = blocks.mix(value * np.uint64(31) + hashes[k:n + k])
    row = np.repeat(np.arange(len(rows) - 1), np.diff(rows))
    return value, row[:n], row[:n] == row[len(row) - n:]


def shingles(hashes: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and values of all shingles inside rows."""
    value, _, whole = _values(hashes, rows)
    at = np.flatnonzero(whole)
    return at, value[at]


def winnow(hashes: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and values of the chosen shingles: the smallest of each window, inside rows."""
    value, row, whole = _values(hashes, rows)
    n = len(value)
    chosen = np.zeros(n, bool)
    for d in range(WINDOW):      # chosen if smallest in any window that holds it; also in short rows
        best = whole.copy()
        for e in range(WINDOW):
            shift = e - d
            if shift:
                there = np.zeros(n, bool)
                a, b = (slice(shift, None), slice(None, n - shift)) if shift > 0 else \
                    (slice(None, n + shift), slice(-shift, None))
                there[b] = whole[a] & (row[a] == row[b])
                less = np.zeros(n, bool)
                less[b] = value[a] < value[b]
                best &= ~(there & less)
        chosen |= best
    at = np.flatnonzero(chosen)
    return at, value[at]


def align(template: np.ndarray, text: np.ndarray, shift: int, band: int) -> list[tuple[int, int]]:
    """Matched (template, text) places of a longest common subsequence near the diagonal
    ``text = template + shift``."""
    n, width = len(template), 2 * band + 1
    score = np.zeros((n + 1, width), np.int32)      # column c of row i stands for text place i - 1 + shift + c - band
    at = np.arange(width) + shift - band
    for i in range(1, n + 1):
        place = at + i - 1
        inside = (place >= 0) & (place < len(text))
        same = inside & (text[np.clip(place, 0, len(text) - 1)] == template[i - 1])
        up = np.r_[score[i - 1, 1:], score[i - 1, -1]]          # same text place, one word less of the template
        score[i] = np.maximum.accumulate(np.maximum(up, np.where(same, score[i - 1] + 1, 0)))
    found, i, c = [], n, int(score[n].argmax())
    while i and score[i, c]:                         # the latest way there, which keeps the span tight
        place = i - 1 + shift + c - band
        if 0 <= place < len(text) and text[place] == template[i - 1] and score[i, c] == score[i - 1, c] + 1:
            found.append((i - 1, place))
            i -= 1
        elif c + 1 < width and score[i - 1, c + 1] == score[i, c]:
            i, c = i - 1, c + 1
        else:
            c -= 1
    return found[::-1]


class Index:
    """Winnowed fingerprints of templates: value, template, place."""

    def __init__(self, templates: dict[str, str]):
        self.names = list(templates)
        texts = [t.encode() for t in templates.values()]
        data = np.frombuffer(b"".join(texts), np.uint8)
        offsets = np.r_[0, np.cumsum([len(t) for t in texts])]
        _, _, hashes, rows = words(data, offsets)
        if len(hashes) > MOST_WORDS:
            raise ValueError(f"templates have more than {MOST_WORDS} words")
        at, value = winnow(hashes, rows)
        which = np.searchsorted(rows, at, "right") - 1
        order = np.argsort(value, kind="stable")
        self.value, self.which, self.place = value[order], which[order], (at - rows[which])[order]
        self.templates = [hashes[a:b] for a, b in zip(rows[:-1], rows[1:])]
        self.families = [family(n) for n in self.names]
        self.decisive = []                       # places of the words that must be there
        for name, text in templates.items():
            own = re.findall("[a-z0-9]+", text.lower())
            needed = decisive_words(name, own)
            self.decisive.append({k for k, w in enumerate(own) if w in needed})

    def hits(self, at: np.ndarray, value: np.ndarray):
        """(document place, template, template place) of all common fingerprints."""
        low, high = np.searchsorted(self.value, value, "left"), np.searchsorted(self.value, value, "right")
        n = high - low
        k = np.repeat(low - np.cumsum(n) + n, n) + np.arange(n.sum())
        return np.repeat(at, n), self.which[k], self.place[k]


def occurrences(template: np.ndarray, text: np.ndarray, places: np.ndarray, inside: np.ndarray,
                least: float, band: int) -> list[list[tuple[int, int]]]:
    """Matched (template, text) places of every occurrence, without overlaps.

    Word-for-word ones are taken first. What hits they leave is aligned, in the gaps between the
    spans taken, around each of its diagonals until a hit is inside a span or found wanting. Groups
    of diagonals within ``band`` only set the order: the diagonal with most hits comes first.
    """
    n, found, starts, ends = len(template), [], [], []
    diagonal = places - inside
    order = np.lexsort((places, diagonal))
    diagonal, places = diagonal[order], places[order]
    whole = np.unique(diagonal[(diagonal >= 0) & (diagonal + n <= len(text))])
    for k in range(n):
        whole = whole[text[whole + k] == template[k]]
    for d in whole.tolist():
        if not ends or d > ends[-1]:
            starts.append(d)
            ends.append(d + n - 1)
            found.append([(k, d + k) for k in range(n)])
    cuts = np.array(ends, np.int64)
    at = np.searchsorted(cuts, places)          # a hit of which a word is taken is settled
    free = np.r_[np.array(starts, np.int64), len(text) + SHINGLE][at] >= places + SHINGLE
    diagonal, places = diagonal[free].tolist(), places[free].tolist()
    i = 0
    while i < len(diagonal):
        j = bisect_right(diagonal, diagonal[i] + band, i)
        group = list(zip(diagonal[i:j], places[i:j]))
        i = j
        while group:
            hits: dict = {}                     # hits of each diagonal in each gap
            for d, place in group:
                k = bisect_left(ends, place)
                if k == len(ends) or starts[k] >= place + SHINGLE:
                    hits.setdefault((d, k), []).append(place)
            if not hits:
                break
            d, k = max(hits, key=lambda h: (len(hits[h]), -h[0], -h[1]))
            low = max(ends[k - 1] + 1 if k else 0, d - band)
            high = min(starts[k] if k < len(starts) else len(text), d + n + band)
            part = text[low:high]
            common = int(np.isin(template, part).sum())      # no subsequence has more words
            pairs = align(template, part, d - low, band) if common >= least * n else []
            if len(pairs) >= least * n:
                pairs = [(a, b + low) for a, b in pairs]
                found.append(pairs)
                starts.insert(k, pairs[0][1])
                ends.insert(k, pairs[-1][1])
            else:
                del hits[d, k]
            group = [(e, p) for (e, _), ps in hits.items() for p in ps]
    return found


def matches(index: Index, hashes: np.ndarray, places: np.ndarray, which: np.ndarray, inside: np.ndarray,
            least: float, band: int) -> list[tuple[int, float, int, int, int, str]]:
    """(template, coverage, matched words, first word, last word, license) in one document.

    Without the words that decide between licenses of a family, the family is what is found.
    """
    found = []
    for t in np.unique(which):
        mine, template = which == t, index.templates[t]
        for pairs in occurrences(template, hashes, places[mine], inside[mine], least, band):
            first, last = pairs[0][1], pairs[-1][1]
            tight = len(pairs) / max(len(template), last - first + 1)
            exact = index.decisive[t] <= {k for k, _ in pairs}
            found.append((len(pairs) * tight * (1 if exact else 0.5), int(t), len(pairs) / len(template), len(pairs),
                          first, last, index.names[t] if exact else index.families[t]))
    taken, ends = [], []                    # by start, without overlaps
    for f in sorted(found, key=lambda f: (-f[0], f[4], f[1])):
        k = bisect_left(ends, f[4])
        if k == len(ends) or f[5] < taken[k][0]:
            taken.insert(k, (f[4], f))
            ends.insert(k, f[5])
    return [f[1:] for _, f in taken]


SCHEMA = "doc_id long, license string, coverage double, n_matched int, start long, end long"


def _scan(templates: dict[str, str], least: float, band: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(templates)
        for run in blocks.runs(batches, limit=2 * blocks.BLOCK):
            data, offsets = blocks.flat(run.column("text"))
            starts, ends, hashes, rows = words(data, offsets)
            places, which, inside = index.hits(*shingles(hashes, rows))
            doc = np.searchsorted(rows, places, "right") - 1
            out = []
            order = np.argsort(doc, kind="stable")
            docs, cut = np.unique(doc[order], return_index=True)
            for d, at in zip(docs, np.split(order, cut[1:])):
                own = slice(rows[d], rows[d + 1])
                at_byte, at_char = offsets[d], 0                         # matches come by start
                for _, cover, n, a, b, name in matches(index, hashes[own], places[at] - rows[d], which[at], inside[at],
                                                 least, band):
                    first, last = starts[own][a], ends[own][b]
                    start = at_char + int(((data[at_byte:first] & 0xC0) != 0x80).sum())     # characters, not bytes
                    end = start + int(((data[first:last] & 0xC0) != 0x80).sum())
                    at_byte, at_char = last, end
                    out.append((int(d), name, cover, n, start, end))
            if out:
                d, *rest = map(list, zip(*out))
                yield pa.RecordBatch.from_arrays(
                    [run.column("doc_id").take(pa.array(d)), pa.array(rest[0]), pa.array(rest[1], pa.float64()),
                     pa.array(rest[2], pa.int32()), pa.array(rest[3], pa.int64()), pa.array(rest[4], pa.int64())],
                    ["doc_id", "license", "coverage", "n_matched", "start", "end"])
    return scan


def scan(docs: DataFrame, templates: dict[str, str] | None = None, least: float = COVERAGE,
         band: int = BAND) -> DataFrame:
    """One row per match: doc_id, license, coverage, n_matched, start and end (code points)."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _scan(templates or TEMPLATES, least, band), SCHEMA)


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License matches in all documents."""
    return scan(table(spark, sf_dir, "documents"))
