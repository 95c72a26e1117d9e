"""The stages of the corpus pipeline, each held against a plain version on its own input."""

import zlib

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F

import corpus_pipeline
from newsvault.llm import line_crf
from newsvault.llm.frames import table, written

from . import cases


def test_stages_in_order(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    extra = spark.createDataFrame([(10_000, None, "en", "s", None), (10_001, "", "en", "s", 0)], docs.schema)
    docs = written(docs.union(extra), "docs")
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_classifier", "minhash_near_dedup", "suffix_array_dedup", "pii", "best_fit_packing"]
    names = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        out = written(stage(spark, docs, sf_dir), "stage")
        before = {r.doc_id: r for r in docs.collect()}
        rows = [(r.doc_id, r.text) for r in before.values()]
        if name == "best_fit_packing":
            break
        after = {r.doc_id: r for r in out.collect()}
        assert out.columns == names
        if name == "quality_classifier":
            model = line_crf.train(docs, table(spark, sf_dir, "labels"))
            kept = line_crf.quality(docs, model, "q").where(F.col("q") >= 0.7)
            assert set(after) == {r.doc_id for r in kept.collect()}
            assert 0.7 * len(before) < len(after) < len(before)
        elif name == "minhash_near_dedup":
            assert set(after) == set(cases.near_classes(rows).values())
        elif name == "suffix_array_dedup":
            want = {r[0]: r for r in cases.without_repeats(rows)}
            for i, r in after.items():
                assert r.n_chars == (len(r.text) if r.text is not None else None)
                if not want[i][2]:
                    assert r.text == (before[i].text or "")
                else:
                    assert len(r.text.encode()) <= want[i][1] - want[i][2]
        else:
            for i, r in after.items():
                text = before[i].text or ""
                for a, _, b in cases.personal(text):
                    assert text[a:b] not in r.text
                if not cases.personal(text) and "token" not in text:
                    assert r.text == text or "[" in r.text
        docs = out
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = set()
    for i, t in rows:
        ids = tok.encode(t or "", add_special_tokens=False).ids + [1]
        for a in range(0, len(ids), 4096):
            part = np.array(ids[a:a + 4096], "<u4")
            want.add((i, a // 4096, len(part), zlib.crc32(part.tobytes())))
    assert {(r.doc_id, r.piece, r.length, r.ids_crc32) for r in out.collect()} == want


CLASHING = ["quality_score", "score", "spans", "kept", "row_key", "n_bytes", "kept_text", "base", "s_email", "cut",
            "redacted", "rest", "class_id", "a.b"]


def test_extra_columns_come_through_whatever_their_names(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").limit(150).withColumns(
        {c: F.concat(F.lit(f"{c}-"), F.col("doc_id")) for c in CLASHING})
    docs = written(docs, "docs")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes
        rows = out.collect()
        assert rows and all(r[c] == f"{c}-{r.doc_id}" for r in rows for c in CLASHING)


def test_rows_of_one_doc_id_go_singly(spark, sf_dir):
    words = [f"w{i}" for i in range(100)]
    rows = [(1, " ".join(words)), (7, " ".join(words) + " more"), (7, "a text of its own and of no other document here")]
    docs = spark.createDataFrame(rows, "doc_id int, text string")
    left = corpus_pipeline.minhash_stage(spark, docs, sf_dir).collect()
    assert sorted((r.doc_id, r.text) for r in left) == [rows[0], rows[2]]


def test_pipeline_of_nothing(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert not corpus_pipeline.run(spark, str(tmp_path)).collect()
