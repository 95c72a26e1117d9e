"""Small documents with the awkward cases, and plain versions of what operators compute."""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from itertools import combinations

from pyspark.sql import SparkSession

WORD = re.compile("[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, score double, spans string, key long, kept boolean, row_key string"
_BASE = " ".join(f"word{i} and part{i * 7 % 50}" for i in range(60))


def texts() -> list[tuple[int | None, str | None]]:
    near = _BASE.replace("word7 ", "other ")
    far = " ".join(f"else{i} but thing{i}" for i in range(60))
    passage = "this passage of more than fifty bytes is in several documents, word for word. "
    return [
        (0, None), (1, ""), (2, " \t\n "), (3, _BASE), (4, _BASE), (5, near), (6, far), (7, passage + far[:300]),
        (8, "intro é ü " + passage), (9, "one two"), (10, "one  two"), (11, "a b c d e f g h " * 30), (11, "a b c d e f g h " * 30),
        (12, "mail a.b@c-d.org and 10.0.0.256 or 10.0.0.1, card 4111 1111 1111 1111 call +1 (555) 123-4567 é"),
        (13, "Licensed under the Apache License, Version 2.0. Released under the MIT License."),
        (None, _BASE), (None, None), (14, "x" * 5000), (15, (_BASE + "\n") * 40), (16, "LOUD!! $$$ ### \n" * 20),
        (17, "nul \x00 and ▁ mark ﬁ 日本  two  spaces " + passage), (18, "don't <|endoftext|> İΣ ≠ 5½ é"),
    ]


def frame(spark: SparkSession, rows=None):
    rows = texts() if rows is None else rows
    return spark.createDataFrame([(i, t, "en", 0.5, "x", 1, False, "k") for i, t in rows], SCHEMA)


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def shingles(text: str | None, n: int = 5) -> Counter:
    w = words(text)
    return Counter(tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))) if w else Counter()


def probability_jaccard(a: Counter, b: Counter) -> float:
    every = set(a) | set(b)
    return sum(1 / sum(max(a[j] / a[i], b[j] / b[i]) for j in every) for i in set(a) & set(b))


def roots(nodes, links) -> dict:
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def near_classes(rows, least: float = 0.8) -> dict[int, int]:
    sets: dict[int, Counter] = {i: shingles(t) for i, t in rows if i is not None}
    links = [(i, j) for i, j in combinations(sets, 2)
             if sets[i] and sets[j] and probability_jaccard(sets[i], sets[j]) >= least]
    return roots(sets, links)


def without_repeats(rows, length: int = 50) -> list[tuple]:
    """(doc_id, n_bytes, n_removed, n_spans, sha256) by comparing all strings of all documents."""
    first: dict[bytes, int] = {}
    for i, t in rows:
        b = (t or "").encode()
        for p in range(len(b) - length + 1) if i is not None else ():
            w = b[p:p + length]
            first[w] = min(first.get(w, i), i)
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1) if i is not None else ():
            if first[b[p:p + length]] < i:
                gone[p:p + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((i, len(b), len(b) - len(kept), len([s for s in bytes(gone).split(b"\0") if s]),
                    hashlib.sha256(kept).hexdigest()))
    return out


PII = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
       "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def personal(text: str | None) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base spans."""
    def luhn(s):
        d = [int(x) * (1 + k % 2) for k, x in enumerate(s[::-1])]
        return sum(x - 9 if x > 9 else x for x in d) % 10 == 0

    def fine(kind, m):
        digits = re.sub("[^0-9]", "", m)
        return {"email": True, "ip": kind != "ip" or all(int(x) <= 255 for x in m.split(".")),
                "card": 14 <= len(digits) <= 19 and luhn(digits), "phone": 10 <= len(digits) <= 15}[kind]

    return sorted((m.start(), k, m.end()) for k, (kind, p) in enumerate(PII.items())
                  for m in re.finditer(p, text or "") if fine(kind, m[0]))
