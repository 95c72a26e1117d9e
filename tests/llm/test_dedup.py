"""Vectors, near copies and repeated passages against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from newsvault.llm import blocks, frames, grid_join, minhash, suffix_dedup
from newsvault.llm.frames import components

from . import cases


def test_components_of_long_chains_and_stars(spark):
    rng = np.random.default_rng(1)
    chain = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(30)]
    loose = [(int(a), int(b)) for a, b in rng.integers(200, 260, (40, 2))]
    links = chain + loose
    got = components(spark.createDataFrame(links, "a long, b long")).collect()
    want = cases.roots({x for e in links for x in e}, links)
    assert {r.node: r.root for r in got} == {n: r for n, r in want.items() if n != r}
    assert not components(spark.createDataFrame([], "a long, b long")).collect()


def _vectors():
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(6, 16))
    rows = [(i, [float(x) for x in centres[i % 6] + rng.normal(size=16) * 0.25], i % 3) for i in range(120)]
    rows += [(200 + i, rows[i][1], rows[i][2]) for i in range(5)]          # copies
    rows += [(210, [x * 2 for x in rows[0][1]], 0), (211, None, 0), (212, [], 0), (213, [0.0] * 16, 0),
             (214, [1.0, None] + [0.0] * 14, 0), (215, [float("nan")] * 16, 0), (216, [float("inf")] + [0.0] * 15, 0),
             (217, rows[0][1], None), (None, rows[0][1], 0), (218, rows[0][1][:8], 0), (3, rows[3][1], rows[3][2])]
    return rows


def _linked(rows, cosine):
    links = set()
    for a, u, la in rows:
        for b, v, lb in rows:
            if a is None or b is None or a >= b or la is None or la != lb or not u or not v or len(u) != len(v):
                continue
            if None in u or None in v or not np.isfinite(u).all() or not np.isfinite(v).all():
                continue
            x, y = np.array(u), np.array(v)
            if x.any() and y.any() and x @ y / np.sqrt((x @ x) * (y @ y)) >= cosine:
                links.add((a, b))
    return links


@pytest.mark.parametrize("block", [7, 512])
def test_grid_join_equals_all_pairs(spark, block):
    rows = _vectors()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("rep", F.lit(1))
    got = grid_join.near_vectors(df, block=block).collect()
    links = _linked(rows, 0.93)
    ids = {r[0] for r in rows if r[0] is not None}
    root = cases.roots(ids, links)
    n = {i: sum(i in e for e in links) for i in ids}
    assert len(got) == len(ids) + 1
    for r in got:
        if r.vec_id is None:
            assert (r.n_links, r.component_id, r.kept) == (0, None, True)
        else:
            assert (r.n_links, r.component_id, r.kept) == (n[r.vec_id], root[r.vec_id], root[r.vec_id] == r.vec_id)


def test_grid_join_without_vectors(spark):
    assert not grid_join.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).collect()
    only = spark.createDataFrame([(1, None, 1)], "vec_id long, embedding array<float>, label int")
    assert [tuple(r) for r in grid_join.near_vectors(only).collect()] == [(1, 0, 1, True)]


def test_sequences_skip_no_pair():
    rng = np.random.default_rng(2)
    x = grid_join.unit(rng.normal(size=(300, 8)))
    axes = np.linalg.qr(rng.normal(size=(8, 3)))[0]
    i, j = grid_join.join_sequences(x, x, axes, 0.8, True, leaf=5)
    want = {(a, b) for a in range(300) for b in range(a + 1, 300) if x[a] @ x[b] >= 0.8}
    assert set(zip(i.tolist(), j.tolist())) == want and len(i) == len(want)


def test_probability_jaccard_and_its_estimate():
    rng = np.random.default_rng(3)
    same = total = 0
    for _ in range(60):
        a, b = (rng.integers(0, 40, rng.integers(1, 60)).astype(np.uint64) for _ in range(2))
        b = np.r_[a, b[:8]] if rng.random() < 0.5 else b
        want = cases.probability_jaccard(cases.Counter(a.tolist()), cases.Counter(b.tolist()))
        assert abs(minhash.probability_jaccard(a, b) - want) < 1e-9
        items, begin = np.r_[a, b], np.array([0, len(a), len(a) + len(b)])
        s = minhash.signatures(*minhash.weigh(blocks_mix(items), begin), 2, 512)
        same, total = same + (s[0] == s[1]).mean(), total + want
    assert abs(same - total) / 60 < 0.02


def blocks_mix(x):
    from newsvault.llm.blocks import mix
    return mix(x + np.uint64(9))


def test_near_copies_equal_brute_force(spark, sf_dir):
    docs = frames.table(spark, sf_dir, "documents")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = cases.near_classes(rows)
    assert {r.doc_id: r.class_id for r in minhash.classes(docs).collect()} == want


def test_near_copies_of_awkward_texts(spark):
    got = minhash.classes(cases.frame(spark)).collect()
    want = cases.near_classes(cases.texts())
    assert len(got) == len(cases.texts())
    for r in got:
        assert r.class_id == (None if r.doc_id is None else want[r.doc_id])
        assert r.kept == (r.doc_id is None or r.doc_id == r.class_id)
    assert not minhash.classes(cases.frame(spark, [])).collect()


def test_texts_of_one_doc_id_each_keep_their_links(spark):
    base = [f"w{i}" for i in range(100)]
    one, two = " ".join(base), " ".join(f"v{i}" for i in range(100))
    rows = [(1, one), (1, two), (5, two + " more"), (9, one + " more"), (7, one), (7, "a text of its own and of no other one")]
    got = sorted((r.doc_id, r.class_id, r.kept) for r in minhash.classes(cases.frame(spark, rows)).collect())
    assert got == [(1, 1, True), (1, 1, True), (5, 1, False), (7, 1, False), (7, 7, True), (9, 1, False)]


def test_small_tables_take_few_files_whatever_the_shuffle_partitions(spark, monkeypatch):
    """Every file and task has a cost of its own, so a session of many partitions must not make as many of each."""
    files = {}

    def counted(df, name, *rest):
        out = frames.written(df, name, *rest)
        files[name] = max(files.get(name, 0), len(out.inputFiles()))
        return out

    monkeypatch.setattr(minhash, "written", counted)
    rows = [(100 * i + k, " ".join(f"t{i}w{j}" for j in range(60 - k))) for i in range(60) for k in range(3)]
    many = {"spark.sql.shuffle.partitions": "61", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in many}
    try:
        for k, v in many.items():
            spark.conf.set(k, v)
        got = {r.doc_id: r.class_id for r in minhash.classes(cases.frame(spark, rows)).collect()}
        links = components(spark.createDataFrame([(3 * i, 3 * i + k) for i in range(200) for k in (1, 2)], "a long, b long"))
        files["components"] = len(links.inputFiles())
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == {i: i - i % 100 for i, _ in rows} and links.count() == 400
    few = max(8, spark.sparkContext.defaultParallelism)
    assert {n: k for n, k in files.items() if k > few and n != "nodes"} == {}


def test_word_sequences_of_one_polynomial_are_not_copies():
    word = "a"
    while len(word) < 1024:
        word += word.translate({97: "b", 98: "a"})
    ids = np.array([[7, 99][c == "b"] for c in word + word.translate({97: "b", 98: "a"})], np.uint64)
    sums = {tuple(blocks.sequence_sums(ids, np.array([0, 1024, 2048]), s)) for s in (minhash._A, minhash._B)}
    assert all(a != b for a, b in sums)


def test_recall_against_brute_force(spark):
    """All links of 1,000 documents, with shingles that repeat, found by their shared shingles."""
    docs = frames.table(spark, "/root/testdata/sf0.01", "documents")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    sets = {i: cases.shingles(t) for i, t in rows}
    at = {}
    for i, s in sets.items():
        for x in s:
            at.setdefault(x, []).append(i)
    shared = cases.Counter((a, b) for ids in at.values() if len(ids) < 100 for a in ids for b in ids if a < b)
    links = [(a, b) for (a, b), n in shared.items() if n >= 0.4 * max(len(sets[a]), len(sets[b]))
             and cases.probability_jaccard(sets[a], sets[b]) >= 0.8]
    got = {r.doc_id: r.class_id for r in minhash.classes(docs).collect()}
    assert len(links) > 50 and sum(got[a] == got[b] for a, b in links) >= 0.99 * len(links)


def test_group_of_mutated_copies_is_linked_without_all_pairs(spark):
    rng = np.random.default_rng(4)
    base = [f"w{i}" for i in range(150)]
    rows = []
    for i in range(60):
        text = list(base)
        for p in rng.choice(150, rng.integers(0, 9), replace=False):
            text[p] = f"m{i}x{p}"
        rows.append((i, " ".join(text)))
    got = {r.doc_id: r.class_id for r in minhash.classes(cases.frame(spark, rows)).collect()}
    assert got == cases.near_classes(rows)


def test_suffix_array_and_prefixes():
    rng = np.random.default_rng(6)
    for n in (0, 1, 7, 400, 3000):
        text = rng.integers(97, 99, n).astype(np.uint8)
        sa = suffix_dedup.suffix_array(text)
        raw = text.tobytes()
        assert sa.tolist() == sorted(range(n), key=lambda i: raw[i:])
        got = suffix_dedup.common_prefixes(text, sa, 50)
        for k in range(1, n, 7):
            a, b = raw[sa[k - 1]:], raw[sa[k]:]
            same = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
            assert got[k] == min(same, 50)


@pytest.mark.parametrize("options", [{}, {"block": 2000, "hot": 1, "shard_bytes": 4000, "sub_shard": 900}])
def test_repeats_equal_brute_force(spark, sf_dir, options):
    docs = frames.table(spark, sf_dir, "documents").where("doc_id < 120")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = suffix_dedup.remove_repeats(docs, **options).collect()
    assert sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == \
        sorted(cases.without_repeats(rows))


@pytest.mark.parametrize("options", [{}, {"block": 300, "hot": 1, "shard_bytes": 500, "sub_shard": 200}])
def test_repeats_of_awkward_texts(spark, options):
    got = suffix_dedup.remove_repeats(cases.frame(spark), **options).collect()
    order = lambda rows: sorted(rows, key=str)
    assert order((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == \
        order(cases.without_repeats(cases.texts()))


def test_repeats_of_nothing(spark):
    assert not suffix_dedup.remove_repeats(cases.frame(spark, [])).collect()
