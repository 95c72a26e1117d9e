"""Tokens, rules, quality, personal data, licenses, scores and packing."""

import hashlib
import random
import tracemalloc
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from newsvault.llm import blocks, frames, licenses, line_crf, packing, pieces, pii, pseudo_lm, rules

from . import cases

PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")


# ---------------------------------------------------------------- op2

def test_pieces_equal_the_library(spark, sf_dir):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    rng = random.Random(3)
    alphabet = "abcdeé  ▁\t\n  12 日本ﬁ\x00 '<s>.,"
    rows = cases.texts() + [(100 + k, "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40)))) for k in range(200)]
    rows += [(400 + k, " " * k + "x" + " " * (k % 17)) for k in range(40)]
    got = pieces.decode(pieces.encode(cases.frame(spark, rows), PIECES), PIECES).collect()
    assert sorted((str(r.doc_id), r.ids) for r in got) == sorted((str(i), sp.encode(t or "")) for i, t in rows)
    assert all(r.decoded == (r.text or "").replace("▁", " ") for r in got)
    docs = frames.table(spark, sf_dir, "documents").where("doc_id < 60")
    for r in pieces.encode(docs, PIECES).collect():
        assert r.ids == sp.encode(r.text)
    assert not pieces.encode(cases.frame(spark, []), PIECES).collect()


def test_unigram_pieces_are_the_best_of_all_segmentations():
    rng = random.Random(1)
    vocab = {"".join(rng.choice("ab") for _ in range(rng.randint(1, 4))) for _ in range(14)} | {"a", "b"}
    scores = {p: (k, -rng.random() * 5) for k, p in enumerate(sorted(vocab))}
    model = pieces.Pieces(scores, list(range(1000, 1256)), merges=False)

    def best(word):
        if not word:
            return 0.0, []
        ways = [(scores[word[:k]][1] + v, [scores[word[:k]][0], *ids]) for k in range(1, len(word) + 1)
                if word[:k] in scores for v, ids in [best(word[k:])]]
        return max(ways)

    value = {k: s for k, s in scores.values()}
    words = ["".join(rng.choice("ab") for _ in range(rng.randint(1, 9))) for _ in range(60)]
    for word, ids in zip(words, model.encode(words)):
        assert sum(value[i] for i in ids) == pytest.approx(best(word)[0])
    assert model.encode(["ac"]) == [[scores["a"][0], 1000 + ord("c")]]


def _twins():
    """Two words of one length whose sums in any polynomial modulo 2**64 are equal."""
    word = "a"
    while len(word) < 1024:
        word += word.translate({97: "b", 98: "a"})
    return word, word.translate({97: "b", 98: "a"})


def test_words_of_one_polynomial_keep_their_own_ids(spark):
    import sentencepiece

    one, two = _twins()
    rows = [(1, one), (2, two), (3, f"{one} {two} {one}")]
    raw = np.frombuffer((one + two).encode(), np.uint8)
    assert len(set(blocks.hash_spans(raw, np.array([0, 1024]), np.array([1024, 2048])).tolist())) == 2
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    got = pieces.decode(pieces.encode(cases.frame(spark, rows).coalesce(1), PIECES), PIECES).collect()
    assert all(r.ids == sp.encode(r.text) and r.decoded == r.text for r in got)
    packed = packing.pack_documents(cases.frame(spark, rows).coalesce(1), WORDS).collect()
    assert {(r.doc_id, r.ids_crc32) for r in packed} == {
        (i, zlib.crc32(np.array(_encoded(t), "<u4").tobytes())) for i, t in rows}


def test_word_table_compares_bytes(monkeypatch):
    """With one hash for all words each still has its own ids; so it has after a new start."""
    monkeypatch.setattr(blocks, "hash_spans", lambda data, starts, ends: np.full(len(starts), 7, np.uint64))
    words = blocks.WordTable(lambda ws: [[len(w), *w.encode()] for w in ws], most=1 << 20)
    for text in ("aa bb aa cc", "bb", "cc aa " + "long" * 50, "aa", "x" * 300_000 + " aa", "bb aa", "é bb"):
        data = np.frombuffer(text.encode(), np.uint8)
        starts, ends, _ = blocks.word_spans(data, np.array([0, len(data)]))
        counts, ids = words.ids(data, starts, ends, blocks.hash_spans(data, starts, ends))
        want = [[len(w), *w.encode()] for w in text.split()]
        assert counts.tolist() == [len(w) for w in want] and ids.tolist() == sum(want, [])


# ---------------------------------------------------------------- op3

def _rules(rows):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    if rows:
        con.executemany("INSERT INTO documents VALUES (?, ?)", [(i, t) for i, t in rows if "\0" not in (t or "")])
    return Counter(con.execute(rules.ORACLE).fetchall())


def test_rules_equal_sql_and_plain_counts(spark, tmp_path):
    rows = [r for r in cases.texts() if "\0" not in (r[1] or "")]
    cases.frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = rules.op3_quality_rules(spark, str(tmp_path)).collect()
    assert Counter(map(tuple, got)) == _rules(rows)
    for r in got:
        if r.doc_id == 11:
            assert (r.n_words, r.n_repeat_words, r.base_failed) == (240, 240, True)
    assert not rules.ledger(cases.frame(spark, [])).collect()


def test_policies_and_ablation(spark):
    rows = rules.ledger(cases.frame(spark))
    bits = [r.failure_bits for r in rows.collect()]
    for r in rules.ablation(rows).collect():
        policy = next(p for p in rules.POLICIES if (p.name, p.version) == (r.policy, r.version))
        bit = 1 << rules.RULES[r.rule]
        assert r.kept == sum(b & policy.mask == 0 for b in bits)
        assert r.kept_without == sum(b & policy.mask & ~bit == 0 for b in bits)
        assert r.rejected_alone == sum(b & policy.mask == bit for b in bits)


# ---------------------------------------------------------------- op5

def test_marginals_equal_enumeration():
    rng = np.random.default_rng(2)
    emit, w, first = rng.normal(size=9), rng.normal(size=(2, 2)), np.array([0, 4, 4, 5, 9])
    got, _, _ = line_crf.marginals(emit, first, w)
    for a, b in zip(first[:-1], first[1:]):
        weight = {}
        for code in range(2 ** (b - a)):
            y = [code >> k & 1 for k in range(b - a)]
            # state 0 of the pair weights is good
            s = sum(emit[a + k] * y[k] for k in range(b - a)) + sum(w[1 - y[k], 1 - y[k + 1]] for k in range(b - a - 1))
            weight[code] = np.exp(s)
        for k in range(b - a):
            good = sum(v for c, v in weight.items() if c >> k & 1)
            assert got[a + k] == pytest.approx(np.log(good / (sum(weight.values()) - good)))


def test_quality_tells_held_out_documents_apart(spark):
    sf = "/root/testdata/sf0.01"
    got = line_crf.op5_quality_classifier(spark, sf)
    rows = got.join(frames.table(spark, sf, "labels"), "doc_id").collect()
    assert got.count() == 1000
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    good, bad = ([r.score for r in held if r.quality == q] for q in (1, 0))
    assert sum(g > b for g in good for b in bad) / (len(good) * len(bad)) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)


def test_quality_of_awkward_texts(spark):
    model = line_crf.train(cases.frame(spark), spark.createDataFrame([(3, None), (None, 1)], "doc_id long, quality int"))
    assert model["theta"] is None
    labels = spark.createDataFrame([(i, int(i != 16 and i != 11)) for i in range(25)], "doc_id long, quality int")
    model = line_crf.train(cases.frame(spark), labels)
    got = line_crf.quality(cases.frame(spark), model, "q").collect()
    assert len(got) == len(cases.texts()) and all(0 <= r.q <= 1 for r in got)
    assert {r.q for r in got if not (r.text or "").split()} == {model["base"]}
    assert not line_crf.quality(cases.frame(spark, []), model, "q").collect()
    x, size, first = line_crf.measure(*blocks.flat(blocks.pa.array(["a\n\nb c\n", None, "", "\n", "d"])))
    assert size.tolist() == [2, 4, 1] and first.tolist() == [0, 2, 2, 2, 2, 3]


# ---------------------------------------------------------------- op7

def test_license_matches(spark):
    mit = licenses.TEMPLATES["mit"]
    damaged = " ".join(w for k, w in enumerate(mit.split()) if k % 11)
    rows = cases.texts() + [(50, "é intro " + mit.upper() + " tail"), (51, damaged), (52, mit[:120]),
                            (53, "Licensed under CC BY-NC 4.0. x y z " + "Licensed under the Apache License, Version 2.0.")]
    got = {}
    for r in licenses.scan(cases.frame(spark, rows)).collect():
        got.setdefault(r.doc_id, []).append((r.license, round(r.coverage, 2), r.start, r.end))
    assert got[13] == [("apache-2.0-notice", 1.0, 0, 46), ("mit-notice", 1.0, 48, 78)]
    assert got[50] == [("mit", 1.0, 8, 8 + len(mit) - 1)]
    assert [m[0] for m in got[51]] == ["mit"] and got[51][0][1] < 1
    assert [m[0] for m in got[53]] == ["cc-by-nc-4-notice", "apache-2.0-notice"]
    assert set(got) == {13, 50, 51, 53}
    assert not licenses.scan(cases.frame(spark, [])).collect()


def test_short_notices_inside_any_sentence(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    rows = [(k, f"{word()} {word()} 2020 {word()}. All rights reserved. {word()} {word()} {word()}") for k in range(200)]
    got = licenses.scan(cases.frame(spark, rows)).collect()
    assert sorted((r.doc_id, r.license) for r in got) == [(k, "all-rights-reserved") for k in range(200)]
    text = dict(rows)
    assert {text[r.doc_id][r.start:r.end] for r in got} == {"All rights reserved"}


@pytest.mark.parametrize("notice", ["Released under the MIT License.", "Licensed under CC BY 4.0.", "All rights reserved.",
                                    "Licensed under the nice CC BY 4.0."])
def test_every_notice_of_a_row_of_them(spark, notice):
    counts = (1, 2, 10, 1000)
    rows = [(n, (notice + " ") * n) for n in counts] + [(7, (notice + " by some one. ") * 7)]
    got = {}
    for r in licenses.scan(cases.frame(spark, rows)).collect():
        got.setdefault(r.doc_id, []).append((r.start, r.end))
    for n, text in rows:
        step = len(text) // n
        assert sorted(got[n]) == [(k * step, k * step + len(notice) - 1) for k in range(n)]


def test_alignment_is_the_longest_common_subsequence():
    rng = np.random.default_rng(8)
    for _ in range(50):
        a, b = (rng.integers(0, 4, rng.integers(1, 12)).astype(np.uint64) for _ in range(2))
        best = np.zeros((len(a) + 1, len(b) + 1), int)
        for i in range(len(a)):
            for j in range(len(b)):
                best[i + 1, j + 1] = max(best[i, j + 1], best[i + 1, j], best[i, j] + (a[i] == b[j]))
        got = licenses.align(a, b, 0, 30)
        assert len(got) == best[-1, -1] and all(a[i] == b[j] for i, j in got)
        assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(got, got[1:]))


# ---------------------------------------------------------------- op8

HARD = ["a@b.c.x@d.e f@g..h i_j@k.l@m.n", "1.2.3.4.5.6.7.8 999.1.1.1 01.002.0003.255", "4111-1111 1111  1111 4111111111111111",
        "+1 (555) 123-4567 +123456789012345678 +5", "é日 a@b.cc 4111111111111111 +49 170 1234567 10.1.1.1", "5 5 5 5 " * 400]


def test_base_spans_equal_plain_patterns(spark):
    rows = cases.texts() + [(60 + k, t) for k, t in enumerate(HARD)] + [(90, " ".join(f"u{k}@h{k}.org 10.0.0.{k}" for k in range(700)))]
    got = pii.find(cases.frame(spark, rows)).select("doc_id", "text", "base", pii.listing("base").alias("s")).collect()
    assert len(got) == len(rows)
    for r in got:
        want = cases.personal(r.text)
        assert [tuple(s) for s in r.base] == want
        assert r.s == ",".join(f"{list(cases.PII)[k]}:{a}:{b}" for a, k, b in want)
    assert not pii.find(cases.frame(spark, [])).collect()


def test_added_spans_and_redaction(spark):
    rng = random.Random(2)
    rows = []
    for k in range(400):
        secret, plain = hashlib.sha1(str(k).encode()).hexdigest(), f"{rng.randint(10 ** 6, 10 ** 7)}"
        rows.append((k, f'see token = "{secret}" or {plain} mail u{k}@h.org' if k % 2 else f"section {plain} of b{k}@h.org"))
    rows.append((400, None))
    docs = cases.frame(spark, rows)
    model = pii.train(docs)
    assert model["limits"]
    for r in pii.redact(pii.find(docs, model)).collect():
        base = {tuple(s) for s in r.base}
        assert base <= {tuple(s) for s in r.spans}
        if r.doc_id % 2 and r.doc_id < 400:
            assert "[secret]" in r.redacted and "[email]" in r.redacted and "token" in r.redacted
        for a, _, b in base:
            assert r.text[a:b] not in r.redacted
    assert pii.train(cases.frame(spark)) is None


def _plain_matches(text):
    """Templates that are in the text word for word: (license, first word, last word); the longest ones first."""
    own = licenses.re.findall("[a-z0-9]+", text.lower())
    found = []
    for name, template in licenses.TEMPLATES.items():
        t = licenses.re.findall("[a-z0-9]+", template.lower())
        found += [(-len(t), k, k + len(t), name) for k in range(len(own) - len(t) + 1) if own[k:k + len(t)] == t]
    taken = []
    for n, a, b, name in sorted(found):
        if all(b <= x or a >= y for _, x, y in taken):
            taken.append((name, a, b))
    return sorted(n for n, _, _ in taken)


def test_every_template_is_found_at_every_place(spark):
    rng = random.Random(8)
    rows, want = [], {}
    for k, (name, template) in enumerate(licenses.TEMPLATES.items()):
        for place in (0, 1, 7, 40):
            around = [f"q{rng.randint(0, 400)}" for _ in range(60)]
            i = 100 * k + place
            rows.append((i, " ".join(around[:place]) + f" {template} " + " ".join(around[place:])))
            want[i] = _plain_matches(rows[-1][1])
            assert name in want[i] or len(want[i]) >= 1
    got = {}
    for r in licenses.scan(cases.frame(spark, rows)).collect():
        got.setdefault(r.doc_id, []).append(r.license)
    assert {i: sorted(n) for i, n in got.items()} == want


@pytest.mark.parametrize("text,license", [
    ("Licensed under CC BY 3.0.", "cc-by"), ("Licensed under CC BY-ND 4.0.", "cc-by-nd-4-notice"),
    ("Licensed under CC BY-NC-SA 4.0.", "cc-by-nc-sa-4-notice"), ("Licensed under the Apache License, Version 1.1.", None),
    ("Licensed under the Apache License, Version 1.0.", "apache"), ("Released under the Foo License.", None),
    ("SPDX-License-Identifier: Apache-2.0", "spdx-apache-2.0"), ("SPDX-License-Identifier: CC0-1.0", "spdx-cc0-1.0"),
    (licenses.TEMPLATES["gpl-3-header"].replace("version 3", "version 4"), "gpl"),
    (licenses.TEMPLATES["gpl-2-header"], "gpl-2-header"), (licenses.TEMPLATES["lgpl-3-header"], "lgpl-3-header")])
def test_version_words_decide(text, license):
    index = licenses.Index(licenses.TEMPLATES)
    data = np.frombuffer(text.encode(), np.uint8)
    _, _, hashes, rows = licenses.words(data, np.array([0, len(data)]))
    places, which, inside = index.hits(*licenses.shingles(hashes, rows))
    got = [m[-1] for m in licenses.matches(index, hashes, places, which, inside, licenses.COVERAGE, licenses.BAND)]
    assert got == ([license] if license else []) or (license is None and all("-" not in g for g in got))


# ---------------------------------------------------------------- op9

def test_log_probs_equal_a_plain_softmax():
    rng = np.random.default_rng(1)
    p = {k: rng.normal(0, 0.3, s).astype(np.float32) for k, s in pseudo_lm.SHAPES.items()}
    ids, rows = rng.integers(0, pseudo_lm.EDGE, 40), np.array([0, 13, 13, 14, 40])
    around = pseudo_lm.contexts(ids, rows, np.arange(40))
    got = pseudo_lm.log_probs(p, ids, around, part=7)
    for k in range(40):
        row = np.searchsorted(rows, k, "right") - 1
        near = [ids[k + d] if rows[row] <= k + d < rows[row + 1] else pseudo_lm.EDGE for d in (-2, -1, 1, 2)]
        h = np.tanh(np.concatenate([p["e"][c] for c in near]) @ p["w"] + p["b"])
        g, s = divmod(int(ids[k]), pseudo_lm.GROUPS)
        soft = lambda z: np.exp(z - z.max()) / np.exp(z - z.max()).sum()
        want = np.log(soft(h @ p["g"] + p["gb"])[g]) + np.log(soft(h @ p["s"][g] + p["sb"][g])[s])
        assert got[k] == pytest.approx(want, abs=1e-4)


def test_every_word_is_a_training_target_once(monkeypatch):
    texts = ["by the staff of the daily news " * 9, "", "a b c"] * 3
    batch = blocks.pa.RecordBatch.from_arrays([blocks.pa.array(texts)], ["text"])
    seen = Counter()
    monkeypatch.setattr(pseudo_lm.Trainer, "step", lambda self, t, c: seen.update(t.tolist()))
    for turn in range(pseudo_lm.ROUNDS):
        assert not list(pseudo_lm._learn(np.zeros(0, np.uint64), pseudo_lm.flatten(pseudo_lm.fresh()), turn,
                                         pseudo_lm.ROUNDS)(iter([batch])))
    *_, hashes, _ = blocks.hashed_words(batch)
    assert seen == Counter(pseudo_lm.symbols(hashes, np.zeros(0, np.uint64)).tolist())


def test_steps_follow_the_gradient():
    rng = np.random.default_rng(4)
    trainer = pseudo_lm.Trainer(pseudo_lm.fresh())
    t, c = rng.integers(0, 1000, 50), rng.integers(0, 1000, (50, 4))
    start, grads = {k: v.astype(float) for k, v in trainer.p.items()}, {}
    trainer._move = lambda k, g: grads.update({k: g})
    trainer.step(t, c)
    for k in start:
        way = rng.normal(size=start[k].shape)
        up, down = ({**start, k: start[k] + s * 1e-4 * way} for s in (1, -1))
        slope = -(pseudo_lm.log_probs(up, t, c).mean() - pseudo_lm.log_probs(down, t, c).mean()) / 2e-4
        assert (grads[k] * way).sum() == pytest.approx(slope, rel=1e-2, abs=1e-4)


def _network_and_words(n, scale):
    rng = np.random.default_rng(3)
    p = {k: rng.normal(0, scale, s).astype(np.float32) for k, s in pseudo_lm.SHAPES.items()}
    return p, rng.integers(0, pseudo_lm.EDGE, n), rng.integers(0, pseudo_lm.SYMBOLS, (n, 4))


@pytest.mark.parametrize("scale", [0.3, 40.0])
def test_scores_and_steps_hold_for_large_weights(scale):
    """Weights beyond the bound on scores: finite, without warnings, and equal to double precision."""
    p, t, c = _network_and_words(300, scale)
    wide = {k: v.astype(float) for k, v in p.items()}
    h = np.tanh(wide["e"][c].reshape(len(t), -1) @ wide["w"] + wide["b"])
    log_soft = lambda z: z - z.max(1, keepdims=True) - np.log(np.exp(z - z.max(1, keepdims=True)).sum(1, keepdims=True))
    at, (g, s) = np.arange(len(t)), divmod(t, pseudo_lm.GROUPS)
    want = log_soft(h @ wide["g"] + wide["gb"])[at, g] + log_soft(np.einsum("nh,nhk->nk", h, wide["s"][g]) + wide["sb"][g])[at, s]
    trainer = pseudo_lm.Trainer(p)
    with np.errstate(all="raise", under="ignore"):
        got = pseudo_lm.log_probs(p, t, c, part=128)
        trainer.step(t, c)
    assert got == pytest.approx(want, rel=1e-4, abs=1e-4)
    assert all(np.isfinite(v).all() for v in trainer.p.values())


def test_steps_reuse_their_work_arrays():
    p, t, c = _network_and_words(pseudo_lm.STEP, 0.3)
    trainer = pseudo_lm.Trainer(p)
    trainer.step(t, c)
    tracemalloc.start()
    trainer.step(t, c)
    taken = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert taken / len(t) < 750         # bytes a word that a step takes anew; 1121 when each had arrays of its own


def test_trained_network_prefers_real_word_order(spark, sf_dir):
    docs = frames.table(spark, sf_dir, "documents").where("lang = 'en'").select("doc_id", "text")
    text = "the cat sat on the mat and the dog lay on the rug . " * 30
    rows = [(k, text) for k in range(40)] + [(None, None), (200, ""), (201, "  ")]
    words, params = pseudo_lm.train(docs.union(spark.createDataFrame(rows, "doc_id long, text string")))
    mixed = text.split()
    random.Random(1).shuffle(mixed)
    asked = spark.createDataFrame([(1, text), (2, " ".join(mixed)), (3, None), (4, "x" * 9000)], "doc_id long, text string") \
        .withColumn("h", F.lit(1))
    got = {r.doc_id: r for r in pseudo_lm.scores(asked, words, params).collect()}
    assert got[1].log_prob > got[2].log_prob + 50 and got[1].n_words == got[2].n_words
    assert (got[3].n_words, got[3].log_prob, got[3].log_prob_word) == (0, 0.0, None)
    assert got[4].n_words == 1
    empty = cases.frame(spark, [])
    assert not pseudo_lm.scores(empty, *pseudo_lm.train(empty)).collect()


def _plain_scores(texts, corpus, words, params):
    """Word by word: softmax of the group, of the place, and the word's share of its symbol."""
    p = pseudo_lm.unflatten(params)
    code = lambda w: int(blocks.hash_spans(np.frombuffer(w, np.uint8), np.array([0]), np.array([len(w)]))[0])
    split = lambda t: [w.encode() for w in cases.words(t)]
    known = {int(h): k for k, h in enumerate(words.known)}
    symbol = lambda w: known.get(code(w), pseudo_lm.KNOWN + code(w) % pseudo_lm.SHARED)
    soft = lambda z: np.exp(z - z.max()) / np.exp(z - z.max()).sum()
    counts = Counter(w for t in corpus for w in split(t))
    mass = Counter()
    for w, n in counts.items():
        mass[symbol(w)] += n
    out = []
    for t in texts:
        ws, total = split(t), 0.0
        ids = [symbol(w) for w in ws]
        for k, w in enumerate(ws):
            near = [ids[k + d] if 0 <= k + d < len(ids) else pseudo_lm.EDGE for d in (-2, -1, 1, 2)]
            h = np.tanh(p["e"][near].ravel() @ p["w"] + p["b"])
            g, s = divmod(ids[k], pseudo_lm.GROUPS)
            total += np.log(soft(h @ p["g"] + p["gb"])[g]) + np.log(soft(h @ p["s"][g] + p["sb"][g])[s])
            total += np.log(max(counts[w], 1) / max(mass[ids[k]], 1))
        out.append(total)
    return out


def test_every_word_is_scored_for_itself(spark, monkeypatch):
    """Few symbols and few listed words: most words are joined, and equal the plain version."""
    monkeypatch.setattr(pseudo_lm, "LISTED", 40)
    rng = random.Random(6)
    corpus = [" ".join(f"w{int(rng.paretovariate(0.4)) % 5000}" for _ in range(300)) for _ in range(40)]
    corpus += [corpus[0], None, "", "twice twice", "twice é"]
    docs = cases.frame(spark, list(enumerate(corpus)))
    words = pseudo_lm.vocabulary(docs, 40)
    assert len(words.known) == pseudo_lm.KNOWN and len(words.listed) == 40
    assert words.counts.count() == len({w for t in corpus for w in cases.words(t)}) > pseudo_lm.KNOWN + 40
    _, params = pseudo_lm.train(docs)
    asked = [corpus[0], corpus[7], "twice é", "never seen", None, ""]
    got = {r.doc_id: r for r in pseudo_lm.scores(cases.frame(spark, list(enumerate(asked))), words, params).collect()}
    for k, want in enumerate(_plain_scores(asked, corpus, words, params)):
        assert got[k].log_prob == pytest.approx(want, rel=1e-4, abs=1e-3)
        n = len(cases.words(asked[k]))
        assert got[k].log_prob_word == (pytest.approx(want / n, rel=1e-4) if n else None)


# ---------------------------------------------------------------- op10

def _encoded(text):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(WORDS).encode(text or "", add_special_tokens=False).ids + [1]


@pytest.mark.parametrize("capacity,fan,most", [(64, 2, 50_000), (4096, 8, 50_000), (64, 2, 12), (64, 2, 1)])
def test_packing(spark, capacity, fan, most):
    rows = cases.texts() + [(70 + k, "Ünï İstanbul x’s don't 5½ ≠ <|endoftext|>, […] ́e " * (k % 7) + "w " * k) for k in range(60)]
    docs = cases.frame(spark, rows).repartition(5)
    got = packing.pack_documents(docs, WORDS, capacity=capacity, fan=fan, most=most).collect()
    want = Counter()
    for i, t in rows:
        ids = _encoded(t)
        for a in range(0, len(ids), capacity):
            part = np.array(ids[a:a + capacity], "<u4")
            want[i, a // capacity, a, len(part), zlib.crc32(part.tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    bins = {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for items in bins.values():
        place = 0
        for offset, length in sorted(items):
            assert offset == place
            place += length
        assert place <= capacity
    total = sum(r.length for r in got)
    if most > 1:                      # groups of one bin cannot merge any
        assert len(bins) <= -(-total // capacity) * 1.25 + 1


def test_packing_of_nothing(spark):
    assert not packing.pack_documents(cases.frame(spark, []), WORDS).collect()


def test_best_fit_keeps_capacity_and_places():
    rng = random.Random(4)
    sizes = [rng.randint(1, 100) for _ in range(500)]
    bins, at, fills = packing.best_fit(sizes, 100)
    for b in range(len(fills)):
        items = sorted((at[i], sizes[i]) for i in range(500) if bins[i] == b)
        assert [a for a, _ in items] == [sum(s for _, s in items[:k]) for k in range(len(items))]
        assert sum(s for _, s in items) == fills[b] <= 100
    assert len(fills) <= -(-sum(sizes) // 100) * 1.1
