"""Personal data by candidate generators, boosted trees and calibrated thresholds.

Generators are patterns. Those of the base kinds are strict: a match that passes its check is
redacted. Those of the added kinds are wide and overlap: anything that looks like a number of a
person, a disguised address or a secret. Each of their spans gets format and context features,
and boosted trees, fitted on the driver on at most ``SAMPLE`` spans of about ``SAMPLE_DOCS`` documents, score it. A span is added if
its score reaches the threshold of its kind and no base span or better candidate overlaps it.

Without labelled spans the trees learn from what is known: a candidate that a passed base span
covers, or that is assigned to a word such as ``token``, is personal; candidates of the same
look without that are not. The checks themselves are no features, so the trees generalize from
format and context. On a quarter of the sample the thresholds are set to the lowest score that
keeps precision at ``PRECISION``; a kind that cannot reach it adds nothing.

All work on texts is column expressions. Positions come from the lengths of the parts between
matches; running sums are made in chunks, so a text with very many matches stays linear.

Defined results: null texts count as empty; rows with null doc_id and repeated rows each give a
row; an empty table gives no rows; extra columns are ignored; with too few candidates for a fit
only base spans are returned; texts of any length are scanned whole.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .frames import table

SAMPLE = 20_000                 # candidates for the fit,
SAMPLE_DOCS = 50_000            # from about so many documents, chosen by hash
PRECISION = 0.9
ROUNDS, DEPTH = 24, 3
CONTEXT = 24
CHUNK = 256

# Possessive forms of the patterns of the contract: they match the same spans without
# backtracking or recursion. A match never begins inside a run that could not match from its start.
BASE = {
    "email": (r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@"),
    "ip": (r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]"),
    "card": (r"[0-9]++(?:[\x20-][0-9]++)*+", r"[0-9](?:[\x20-]?+[0-9]){13}"),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9]"),
}
ADDED = {
    "secret": (r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*+[0-9])[A-Za-z0-9+/_-]{16,}+", "[0-9]"),
    "contact": (r"[A-Za-z0-9._%+-]{1,64}+ ?(?:@|\(at\)|\[at\]) ?[A-Za-z0-9-]{1,63}+"
                r" ?(?:\.|\(dot\)|\[dot\]) ?[A-Za-z]{2,24}+", r"@|[\(\[]at[\)\]]"),
    "number": (r"(?<![0-9])[0-9](?:[\x20().-]?+[0-9]){6,}+", r"[0-9](?:[\x20().-]?+[0-9]){6}"),
}
KINDS = [*BASE, *ADDED]
NAMED = r"(?i)(?:token|secret|passw(?:or)?d|api[_-]?key|auth)[\x20\"']*[:=][\x20\"']*$"
FEATURES = ["length", "digits", "lowers", "uppers", "marks", "blanks", "hex_only", "plus", "brackets", "at",
            "named", "quoted", "word_before", "digit_near", "symbol_near"]


def _running(columns: dict[str, Column]) -> list[dict[str, Column]]:
    """Stages that turn integer arrays into their running sums: within chunks, then across."""
    def add(acc, x):
        return F.concat(acc, F.array(F.coalesce(F.get(acc, F.size(acc) - 1), F.lit(0)) + x))

    empty = F.array().cast("array<int>")

    def within(c):
        first = F.sequence(F.lit(0), F.greatest(F.size(c) - 1, F.lit(0)), F.lit(CHUNK))
        return F.transform(first, lambda i: F.aggregate(F.slice(c, i + 1, F.lit(CHUNK)), empty, add))

    parts = {k: within(c) for k, c in columns.items()}
    offsets = {f"{k}_o": F.aggregate(F.transform(k, lambda a: F.coalesce(F.get(a, F.size(a) - 1), F.lit(0))),
                                     F.array(F.lit(0)), add) for k in columns}
    sums = {k: F.flatten(F.zip_with(k, F.slice(f"{k}_o", F.lit(1), F.size(k)),
                                    lambda a, o: F.transform(a, lambda x: x + o))) for k in columns}
    return [parts, offsets, sums]


def spans(docs: DataFrame, kinds: dict[str, tuple[str, str]]) -> DataFrame:
    """One array<struct<start, end, match>> column ``s_<kind>`` for each kind; null if none."""
    text = F.col("text")
    found = docs.withColumns({f"m_{k}": F.when(text.rlike(hint), F.regexp_extract_all(text, F.lit(p), F.lit(0)))
                              for k, (p, hint) in kinds.items()})
    some = {k: F.size(f"m_{k}") > 0 for k in kinds}
    found = found.withColumns({f"l_{k}": F.when(some[k], F.zip_with(
        F.slice(F.split(text, p, -1), F.lit(1), F.size(f"m_{k}")), f"m_{k}",
        lambda gap, m: F.length(gap) + F.length(m))) for k, (p, _) in kinds.items()})
    for stage in _running({f"l_{k}": F.col(f"l_{k}") for k in kinds}):
        found = found.withColumns(stage)
    found = found.withColumns({f"s_{k}": F.zip_with(
        f"l_{k}", f"m_{k}", lambda end, m: F.struct((end - F.length(m)).alias("start"), end.alias("end"),
                                                    m.alias("match"))) for k in kinds})
    return found.drop(*(f"{a}_{k}{b}" for k in kinds for a, b in (("m", ""), ("l", ""), ("l", "_o"))))


def _luhn(digits: Column) -> Column:
    def term(i):
        d = F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int")
        return F.when(i % 2 == 0, d).otherwise(2 * d - F.when(d > 4, 9).otherwise(0))
    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), lambda s, i: s + term(i)) % 10 == 0


def _checked(kind: str) -> Column:
    """The kind's matches that pass its check."""
    def passes(s):
        m = s["match"]
        if kind == "ip":
            def small(part):
                short = F.ltrim(part, F.lit("0"))
                return F.when(F.length(short) > 3, False).otherwise(
                    F.when(short == "", 0).otherwise(short.cast("int")) <= 255)
            return F.forall(F.split(m, r"\."), small)
        if kind == "card":
            digits = F.translate(m, " -", "")
            return F.when(F.length(digits).between(14, 19), _luhn(digits)).otherwise(False)
        if kind == "phone":
            return F.length(F.translate(m, "+ ().-", "")).between(10, 15)
        return F.lit(True)
    return F.transform(F.filter(f"s_{kind}", passes), lambda s: F.struct(
        s["start"], F.lit(KINDS.index(kind)).alias("kind"), s["end"]))


def base_spans(docs: DataFrame) -> DataFrame:
    """doc_id, text and base: array<struct<start, kind, end>> by start, then kind."""
    found = spans(docs, BASE)
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    every = F.concat(*(F.coalesce(_checked(k), none) for k in BASE))
    return found.withColumn("base", F.sort_array(every)).drop(*(f"s_{k}" for k in BASE))


def candidates(docs: DataFrame) -> DataFrame:
    """Adds cands: array of spans of the wide generators with their features; docs: text, base."""
    found = spans(docs, ADDED)
    text = F.col("text")

    def described(kind):
        def one(s):
            m, n = s["match"], F.length(s["match"])
            before = F.substring(text, F.greatest(s["start"] - CONTEXT, F.lit(0)) + 1,
                                 F.least(F.lit(CONTEXT), s["start"]))
            after = F.substring(text, s["end"] + 1, F.lit(2))
            count = (lambda pattern: n - F.length(F.regexp_replace(m, pattern, "")))
            flag = (lambda c: F.when(c, 1).otherwise(0))
            values = dict(
                length=n, digits=count("[0-9]"), lowers=count("[a-z]"), uppers=count("[A-Z]"),
                marks=count("[-+/_.]"), blanks=count(" "), hex_only=flag(m.rlike("^[0-9a-f]+$")),
                plus=flag(F.endswith(before, F.lit("+"))), brackets=flag(m.rlike(r"[()\[\]]")), at=flag(m.contains("@")),
                named=flag(before.rlike(NAMED)), quoted=flag(before.rlike("[\"']$")),
                word_before=flag(before.rlike(r"(?i)(?:tel|phone|call|fax|card|visa|iban|ssn|mail|id)\W*$")),
                digit_near=flag(before.rlike("[0-9][^A-Za-z]?$") | after.rlike("^[^A-Za-z]?[0-9]")),
                symbol_near=flag(after.rlike("^[#*$%&]")))
            return F.struct(s["start"], F.lit(KINDS.index(kind)).alias("kind"), s["end"],
                            *(values[f].cast("double").alias(f) for f in FEATURES))
        return F.transform(f"s_{kind}", one)

    kind_of = "array<struct<start:int,kind:int,end:int," + ",".join(f"{f}:double" for f in FEATURES) + ">>"
    every = F.concat(*(F.coalesce(described(k), F.array().cast(kind_of)) for k in ADDED))
    return found.withColumn("cands", every).drop(*(f"s_{k}" for k in ADDED))


def _overlaps(x: Column, y: Column) -> Column:
    return (x["start"] < y["end"]) & (y["start"] < x["end"])


# ---------------------------------------------------------------- boosted trees, on the driver

def _grow(x, grad, hess, rows, bounds, depth):
    total = grad[rows].sum(), hess[rows].sum()
    leaf = float(-total[0] / (total[1] + 1.0)) * 0.3
    if depth == 0 or len(rows) < 40:
        return leaf
    best = (1e-6, None, None)
    for f, cuts in enumerate(bounds):
        for c in cuts:
            left = x[rows, f] <= c
            if not 15 <= left.sum() <= len(rows) - 15:
                continue
            g, h = grad[rows][left].sum(), hess[rows][left].sum()
            gain = g * g / (h + 1) + (total[0] - g) ** 2 / (total[1] - h + 1) - total[0] ** 2 / (total[1] + 1)
            if gain > best[0]:
                best = (gain, f, c)
    if best[1] is None:
        return leaf
    left = x[rows, best[1]] <= best[2]
    return (best[1], float(best[2]), _grow(x, grad, hess, rows[left], bounds, depth - 1),
            _grow(x, grad, hess, rows[~left], bounds, depth - 1))


def _value(tree, x):
    if not isinstance(tree, tuple):
        return np.full(len(x), tree)
    f, c, left, right = tree
    return np.where(x[:, f] <= c, _value(left, x), _value(right, x))


def boost(x: np.ndarray, y: np.ndarray, rounds: int = ROUNDS, depth: int = DEPTH) -> list:
    """Trees of logistic gradient boosting; a tree is (feature, cut, left, right) or a leaf."""
    bounds = [np.unique(np.quantile(x[:, f], np.linspace(0.05, 0.95, 12))) for f in range(x.shape[1])]
    score, trees = np.zeros(len(x)), []
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-score))
        tree = _grow(x, p - y, p * (1 - p), np.arange(len(x)), bounds, depth)
        trees.append(tree)
        score += _value(tree, x)
    return trees


def train(docs: DataFrame, sample: int = SAMPLE) -> dict | None:
    """Trees, calibration and thresholds from at most ``sample`` candidates, first by a hash."""
    docs = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(max(docs.count(), 1))) < SAMPLE_DOCS).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = candidates(base_spans(docs)).select("doc_id", "base", F.explode("cands").alias("c"))
    known = F.exists("base", lambda b: _overlaps(b, F.col("c"))) | (F.col("c.named") == 1)
    picked = rows.select("c.kind", *(f"c.{f}" for f in FEATURES), known.cast("int").alias("y"),
                         F.xxhash64("doc_id", "c.start", "c.kind").alias("h")) \
        .orderBy("h").limit(sample).collect()
    if len(picked) < 200:
        return None
    # a secret's name is what makes it known, so only other features may tell it apart
    x = np.array([[r[f] for f in FEATURES] for r in picked])
    y, kind = np.array([r.y for r in picked], float), np.array([r.kind for r in picked])
    if y.min() == y.max():
        return None
    x = np.c_[x, kind]
    test = np.arange(len(x)) % 4 == 3
    trees = boost(x[~test], y[~test])
    raw = sum(_value(t, x) for t in trees)
    a, b = 1.0, 0.0
    for _ in range(30):
        q = 1 / (1 + np.exp(-(a * raw[test] + b)))
        s = q * (1 - q)
        h = np.array([[(s * raw[test] ** 2).sum(), (s * raw[test]).sum()], [(s * raw[test]).sum(), s.sum()]])
        a, b = np.array([a, b]) + np.linalg.solve(h + np.eye(2) * 0.1, [((y[test] - q) * raw[test]).sum(),
                                                                       (y[test] - q).sum()])
    p = 1 / (1 + np.exp(-(a * raw + b)))
    limits = {}
    for k in np.unique(kind):
        at = test & (kind == k)
        order = np.argsort(-p[at], kind="stable")
        right = np.cumsum(y[at][order]) / np.arange(1, at.sum() + 1)
        good = np.flatnonzero(right >= PRECISION)
        if len(good) and at.sum() >= 20:
            limits[int(k)] = float(p[at][order][good[-1]])
    return {"trees": trees, "a": float(a), "b": float(b), "limits": limits}


def _expression(tree, c: Column) -> Column:
    if not isinstance(tree, tuple):
        return F.lit(float(tree))
    f, cut, left, right = tree
    value = c[FEATURES[f]] if f < len(FEATURES) else c["kind"].cast("double")
    return F.when(value <= cut, _expression(left, c)).otherwise(_expression(right, c))


def find(docs: DataFrame, model: dict | None = None, rest: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, text, columns named in ``rest``, base and spans (base and added ones), each by start,
    then kind."""
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), *rest)
    rows = base_spans(docs)
    if not model or not model["limits"]:
        return rows.withColumn("spans", F.col("base"))
    rows = candidates(rows)

    def scored(c):
        raw = reduce(lambda p, q: p + q, (_expression(t, c) for t in model["trees"]))
        return F.struct(c["start"], c["kind"], c["end"],
                        (1 / (1 + F.exp(-(raw * model["a"] + model["b"])))).alias("p"))

    limit = (lambda c: reduce(lambda e, kv: F.when(c["kind"] == kv[0], F.lit(kv[1])).otherwise(e),
                              model["limits"].items(), F.lit(2.0)))
    free = F.filter("cands", lambda c: ~F.exists("base", lambda b: _overlaps(b, c)))
    rows = rows.withColumn("cands", F.transform(free, scored))
    rows = rows.withColumn("cands", F.filter("cands", lambda c: c["p"] >= limit(c)))
    best = F.filter("cands", lambda c: ~F.exists("cands", lambda d: _overlaps(c, d) & (
        (d["p"] > c["p"]) | ((d["p"] == c["p"]) & ((d["start"] < c["start"]) | (
            (d["start"] == c["start"]) & (d["kind"] < c["kind"])))))))
    added = F.transform(best, lambda c: F.struct(c["start"], c["kind"], c["end"]))
    return rows.withColumn("spans", F.sort_array(F.concat("base", added))).drop("cands")


def listing(column: str) -> Column:
    """kind:start:end of the spans, comma-joined."""
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(column, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(found: DataFrame) -> DataFrame:
    """Adds ``redacted``: the text with each span, overlapping ones together, as its kind in
    brackets. Texts without spans are passed on as they are."""
    names = F.array(*(F.lit(f"[{k}]") for k in KINDS))
    reach = F.aggregate("spans", F.struct(F.lit(0).alias("end"), F.array().cast("array<string>").alias("parts")),
                        lambda acc, s: F.when(s["start"] < acc["end"], F.struct(
                            F.greatest(acc["end"], s["end"]).alias("end"), acc["parts"].alias("parts")))
                        .otherwise(F.struct(s["end"].alias("end"), F.concat(acc["parts"], F.array(
                            F.substring("text", acc["end"] + 1, s["start"] - acc["end"]),
                            F.get(names, s["kind"]))).alias("parts"))))
    found = found.withColumn("cut", F.when(F.size("spans") > 0, reach))
    return found.withColumn("redacted", F.when(F.col("cut").isNull(), F.col("text")).otherwise(F.concat(
        F.array_join("cut.parts", ""), F.expr("substring(text, cut.end + 1)")))).drop("cut")


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    docs = table(spark, sf_dir, "documents")
    found = find(docs, train(docs))
    count = (lambda k: F.size(F.filter("base", lambda s: s["kind"] == KINDS.index(k))).cast("long"))
    return found.select("doc_id", *(count(k).alias(f"n_{k}") for k in BASE),
                        F.sha2(listing("base"), 256).alias("base_sha256"), listing("spans").alias("spans"))
