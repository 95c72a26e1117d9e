"""Importance resampling, Hilbert shards and fill-in-the-middle against plain versions."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter
from itertools import product

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from newsvault.llm import fill_middle, frames, hilbert, importance

from . import cases

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(0x41, 0x5B)})
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def _tables(spark, path, rows, target=("word1 and part7 else1 but thing1", None, "")):
    cases.frame(spark, rows).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(k, t, 1.0) for k, t in enumerate(target)], "item_id long, text string, weight double") \
        .write.parquet(f"{path}/benchmark.parquet")


def _sql(path, statement, names=("documents",)):
    con = duckdb.connect()
    for n in names:
        con.execute(f"CREATE VIEW {n} AS SELECT * FROM '{path}/{n}.parquet/*.parquet'")
    return Counter(con.execute(statement).fetchall())


# ---------------------------------------------------------------- op11

def _grams(text):
    w = WORD.findall((text or "").translate(LOWER))
    return len(w), [" ".join(w[i:i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1)]


def _resampled(rows, target):
    def counts(texts):
        return Counter(zlib.crc32(f.encode()) % 10000 for t in texts for f in _grams(t)[1])

    s, t = counts(x for _, x in rows), counts(target)
    n_s, n_t = sum(s.values()), sum(t.values())
    out = []
    for i, text in rows:
        n, runs = _grams(text)
        b = [zlib.crc32(f.encode()) % 10000 for f in runs]
        weight = sum(math.floor(1000 * math.log((t[x] + 1) * (n_s + 10000) / ((s[x] + 1) * (n_t + 10000)))) for x in b)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(runs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n])
    usable = sorted((r for r in out if r[5] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for k, r in enumerate(usable[:5 * len(usable) // 100]):
        r[4] = k + 1
    return Counter(map(tuple, out))


def test_resampling_equals_plain_version_and_sql(spark, sf_dir, tmp_path):
    rng = random.Random(5)
    words = ["Alpha", "beta", "GAMMA", "délta", "e1", "É", "42", "z"]
    rows = cases.texts() + [(100 + k, "".join(rng.choice(words) + rng.choice([" ", "-", "\n", ", "]) for _ in range(rng.randint(0, 60))))
                            for k in range(120)]
    rows += [(500, rows[-1][1])] * 3 + [(600, "x" * 300_000 + " tail"), (None, rows[-1][1])]
    target = ["word1 and part7 alpha beta", None, "", "e1 42 É z"]
    _tables(spark, tmp_path, rows, target)
    got = importance.op11_importance_resampling(spark, str(tmp_path)).collect()
    assert Counter(map(tuple, got)) == _resampled(rows, target)
    plain = [(i, t) for i, t in rows if "\0" not in (t or "")]
    _tables(spark, tmp_path / "sql", plain, target)
    got = importance.op11_importance_resampling(spark, f"{tmp_path}/sql").collect()
    assert Counter(map(tuple, got)) == _sql(f"{tmp_path}/sql", importance.ORACLE, ("documents", "benchmark"))


def test_resampling_of_nothing(spark, tmp_path):
    _tables(spark, tmp_path, [])
    assert not importance.op11_importance_resampling(spark, str(tmp_path)).collect()
    _tables(spark, tmp_path / "no-target", [(1, "one two"), (2, None)], [])
    got = importance.op11_importance_resampling(spark, f"{tmp_path}/no-target").collect()
    assert Counter(map(tuple, got)) == _resampled([(1, "one two"), (2, None)], [])


@pytest.mark.parametrize("size", [1, 2, 7, 50])
def test_stretches_change_nothing(size):
    text = ("a bb  ccc " * 20 + "long" * 30 + " é ü").encode()
    n = sums = 0
    for k, s in importance.run_checksums(text, size):
        n, sums = n + k, sums + sum(s)
    words, runs = _grams(text.decode())
    assert (n, sums) == (words, sum(zlib.crc32(r.encode()) for r in runs))


# ---------------------------------------------------------------- op12

@pytest.mark.parametrize("dims,bits", [(2, 4), (3, 3), (4, 2)])
def test_the_curve_visits_every_cell_and_steps_to_a_neighbour(spark, dims, bits):
    cells = [f"c{k}" for k in range(dims)]
    points = spark.createDataFrame(list(product(range(1 << bits), repeat=dims)), ", ".join(f"{c} int" for c in cells))
    got = sorted((r[-1], r[:-1]) for r in points.select(
        *cells, hilbert.curve_index([F.col(c) for c in cells], bits)).collect())
    assert [i for i, _ in got] == list(range(1 << bits * dims))
    for (_, a), (_, b) in zip(got, got[1:]):
        assert sum(abs(x - y) for x, y in zip(a, b)) == 1


def _check_shards(got, rows, shards, law):
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter(
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    members = {s: sorted((r for r in got if r.shard == s), key=lambda r: r.slot) for s in range(shards)}
    assert sum(map(len, members.values())) == len(got)
    order = []
    for s in range(shards):
        assert [r.slot for r in members[s]] == list(range(len(members[s])))
        order += [r.curve for r in members[s]]
    assert order == sorted(order)
    if law == "rows":
        sizes = [len(m) for m in members.values()]
        assert max(sizes) - min(sizes) <= 1
    else:
        largest = max((r.size for r in got), default=0)
        mean = sum(r.size for r in got) / shards
        assert all(abs(sum(r.size for r in m) - mean) <= largest for m in members.values())
    assert all(r.law == law and r.grown_shard is None for r in got)


@pytest.mark.parametrize("law", ["bytes", "rows"])
def test_shards_keep_their_law(spark, law):
    rows = cases.texts() + [(200 + k, "row " * (k % 23)) for k in range(150)] + [(900, "same")] * 60
    docs = cases.frame(spark, rows).withColumn("source", F.when(F.col("doc_id") % 3 > 0, F.concat(F.lit("s"), F.col("doc_id") % 7)))
    _check_shards(hilbert.assign(docs, 8, law).collect(), rows, 8, law)
    _check_shards(hilbert.assign(docs.limit(3), 8, law).collect(), rows[:3], 8, law)
    assert not hilbert.assign(docs.limit(0), 8, law).collect()
    with pytest.raises(ValueError, match="law"):
        hilbert.cut(docs, 8, "hash")


def test_shards_equal_sql(spark, tmp_path):
    rows = [r for r in cases.texts() if "\0" not in (r[1] or "")] + [(200 + k, "row " * (k % 23)) for k in range(150)]
    docs = cases.frame(spark, rows).withColumn("source", F.when(F.col("doc_id") % 3 > 0, F.concat(F.lit("s"), F.col("doc_id") % 7)))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = hilbert.op12_hilbert_sharding(spark, str(tmp_path)).collect()
    assert Counter(map(tuple, got)) == _sql(tmp_path, hilbert.ORACLE)


def test_other_dimensions_are_ordered_as_their_values(spark):
    values = [-5, 3, None, 0, 2 ** 62, -2 ** 62]
    frame = spark.createDataFrame([(v,) for v in values], "v long").withColumns({
        "t": F.timestamp_micros(F.col("v") % 10 ** 15), "d": F.date_from_unix_date((F.col("v") % 1000).cast("int"))})
    for name, kind in frame.dtypes:
        rows = frame.select(name, hilbert.sortable(F.col(name), kind).alias("k")).collect()
        key = (lambda r: (r[0] is not None, r[0] if r[0] is not None else 0)) if name == "v" else \
            (lambda r: (r[0] is not None, str(r[0])))
        assert sorted(rows, key=lambda r: r.k) == sorted(rows, key=key)
    with pytest.raises(TypeError, match="double"):
        hilbert.sortable(F.col("v"), "double")


def test_written_shards_hold_all_columns_and_prune(spark, sf_dir, tmp_path):
    docs = frames.table(spark, sf_dir, "documents").withColumns({"row": F.lit("x"), "curve": F.lit(1.5), "doc": F.lit(2)})
    path = f"{tmp_path}/shards"
    hilbert.write_shards(docs, path, 4, rows_per_file=10)
    stored = spark.read.parquet(path)
    assert Counter(map(tuple, stored.select(docs.columns).collect())) == Counter(map(tuple, docs.collect()))
    files = hilbert.manifest(spark, path).collect()
    assert {r.shard for r in files} == {0, 1, 2, 3} and max(r.n_rows for r in files) <= 10
    # a file covers a small box of language and source: most cannot hold a given pair of them
    hit = [r for r in files if r.min_lang <= "fr" <= r.max_lang and r.min_source <= "src3" <= r.max_source]
    assert len(hit) < 0.5 * len(files)


# ---------------------------------------------------------------- op13

def _filled(rows):
    out = []
    for i, t in rows:
        t = t or ""
        x = hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()
        h1, h2, h3, h4 = (int(x[k:k + 8], 16) for k in (0, 8, 16, 24))
        u = re.findall(r"[^\n]*\n|[^\n]+", t)
        a, b = sorted((h1 % (len(u) + 1), h2 % (len(u) + 1)))
        p, m, s = "".join(u[:a]), "".join(u[a:b]), "".join(u[b:])
        if not t or any(k in t for k in ("<P>", "<S>", "<M>")):
            row = ("plain", None, None, t)
        elif h4 % 100 < 50:
            row = ("spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}")
        else:
            row = ("psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}")
        out.append((i, len(u), *row[:3], hashlib.sha256(row[3].encode()).hexdigest(), hashlib.sha256(t.encode()).hexdigest()))
    return Counter(out)


def _marked_rows():
    rng = random.Random(2)
    parts = ["line\n", "<", "S", ">", "é日\n", "\n", "<P", ">M", "word ", "<<\n", "x" * 50]
    rows = [(1000 + k, "".join(rng.choice(parts) for _ in range(rng.randint(0, 60)))) for k in range(150)]
    shared = "".join(f"shared line {k} é\n" for k in range(900))
    rows += [(2000 + k, "own start %d\n" % k + shared + "own end") for k in range(6)]
    return rows + [(3000, "\n" * 5000), (3001, "z" * 200_000), (3002, "z" * 70_000 + "<M>" + "z" * 70_000), (3003, "é" * 40_000 + "\nx")]


def test_fill_in_middle_equals_plain_version_and_sql(spark, sf_dir, tmp_path):
    rows = cases.texts() + _marked_rows()
    _tables(spark, tmp_path, rows)
    got = fill_middle.op13_fill_in_middle(spark, str(tmp_path)).collect()
    assert Counter(map(tuple, got)) == _filled(rows)
    assert {r.form for r in got} == {"plain", "psm", "spm"}
    plain = [(i, t) for i, t in rows if "\0" not in (t or "")]
    _tables(spark, tmp_path / "sql", plain)
    got = fill_middle.op13_fill_in_middle(spark, f"{tmp_path}/sql").collect()
    assert Counter(map(tuple, got)) == _sql(f"{tmp_path}/sql", fill_middle.ORACLE)
    assert not fill_middle.fill_middle(cases.frame(spark, [])).collect()


@pytest.mark.parametrize("bits,most", [(1, 100), (3, 2000), (5, 1 << 20)])
def test_any_chunks_and_any_cache_give_the_same(bits, most):
    rows = cases.texts() + _marked_rows()
    texts = [(t or "").encode() for _, t in rows]
    offsets = np.r_[0, np.cumsum([len(t) for t in texts])].astype(np.int64)
    cache = fill_middle.Summaries(most)
    got = list(fill_middle.cut_documents(b"".join(texts), offsets, [i for i, _ in rows], cache, bits=bits))
    assert Counter((i, int(g[0]), *g[1:4], hashlib.sha256(g[4]).hexdigest()) for (i, _), g in zip(rows, got)) \
        == Counter(r[:6] for r in _filled(rows).elements())


def test_chunks_follow_content_and_are_shared():
    rng = np.random.default_rng(1)
    body = rng.integers(97, 123, 60_000).astype(np.uint8)
    one = np.r_[rng.integers(97, 123, 777).astype(np.uint8), body]
    both = np.r_[one, body]
    offsets = np.array([0, len(one), len(both)])
    ends = fill_middle.chunk_ends(both, offsets)
    assert ends[-1] == len(both) and len(one) in ends and np.all(np.diff(np.r_[0, ends]) <= fill_middle.LONGEST)
    raw, cache = both.tobytes(), fill_middle.Summaries()
    for a, b in zip([0, *ends[:-1].tolist()], ends.tolist()):
        cache.get(raw[a:b])
    assert cache.hits > 0.8 * len(ends) / 2
