"""The corpus pipeline: stages that each read what their predecessor kept.

Each stage takes (spark, docs, sf_dir) and returns a frame, which ``run`` writes as Parquet and
reads again for the next one.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsvault.llm import line_crf, minhash, packing, pii, suffix_dedup
from newsvault.llm.frames import table, written


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line classifier does not reject."""
    rows = _packed(docs)
    scored = line_crf.quality(rows, line_crf.train(rows, table(spark, sf_dir, "labels")), "score")
    return _unpacked(docs, scored.where(F.col("score") >= line_crf.KEEP))


def minhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies, that with the smallest doc_id."""
    rows = _packed(docs).withColumn("row_key", F.xxhash64(F.col("doc_id").cast("long"), "text"))
    gone = minhash.classes(rows).where("not kept").select("doc_id", "row_key").distinct()
    return _unpacked(docs, rows.join(gone.hint("merge"), ["doc_id", "row_key"], "left_anti"))


def suffix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of earlier ones. Bytes of a character that is cut go with it."""
    return _unpacked(docs, suffix_dedup.remove_repeats(_packed(docs), rest=("rest",)), F.col("kept_text"))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by the name of its kind."""
    rows = _packed(docs)
    return _unpacked(docs, pii.redact(pii.find(rows, pii.train(rows), ("rest",))), F.col("redacted"))


def pack_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents, packed into sequences."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality_classifier", quality_stage),
    ("minhash_near_dedup", minhash_stage),
    ("suffix_array_dedup", suffix_stage),
    ("pii", pii_stage),
    ("best_fit_packing", pack_stage),
]

# Trained models, a tokenizer and suffix arrays are beyond SQL; tests hold the stages against
# brute-force versions.
ORACLE_SQL = None


def _packed(docs: DataFrame) -> DataFrame:
    """doc_id, text, and all other columns in ``rest``, where no name of theirs can clash."""
    others = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
    return docs.select("doc_id", "text", (F.struct(*others) if others else F.lit(0)).alias("rest"))


def _unpacked(docs: DataFrame, rows: DataFrame, text: Column | None = None) -> DataFrame:
    """The columns of ``docs`` from packed rows, with a new text, if given, and its number of characters."""
    out = []
    for name in docs.columns:
        value = F.col("doc_id").cast(docs.schema[name].dataType) if name == "doc_id" else \
            (F.col("text") if text is None else text) if name == "text" else F.col("rest")[name]
        if name == "n_chars" and text is not None:
            value = F.length(text).cast(docs.schema[name].dataType)
        out.append(value.alias(name))
    return rows.select(out)


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table of documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
