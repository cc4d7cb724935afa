"""Corpus cleaning: quality, repeated lines, near duplicates, benchmark passages, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as
Parquet and read back as the next stage's ``docs``.  All but the last return the
columns of ``documents``, further columns of any name included; ``run`` gives the packed pieces.

A null text counts as empty.  Rows are judged each by its text, also where they share a
doc_id or have none; the line stage passes rows without a doc_id on unchanged but for lines
repeated within the text, and takes rows of one doc_id as one document when it looks for
earlier copies.  Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerlight.llm import decontaminate, line_dedup, minhash_dedup, packing, quality
from ledgerlight.llm.stage import put_back, read, set_apart, stage

ORACLE_SQL = None  # the classifier's decisions can't be told in SQL; tests use a brute-force version


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score, by a network fitted on labelled rows that are not held out, is at least 0.5."""
    model = quality.fit_quality(docs.select("doc_id", "text"), read(spark, sf_dir, "labels"))
    scored = quality.score_documents(set_apart(docs, "doc_id", "text"), model, "score").filter("score >= 0.5")
    return scored.select(*put_back(scored, docs.columns, "doc_id", "text"))


def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without content-defined chunks of lines that came before, nor shorter runs of them; documents that had only those are dropped, as copies."""
    # pushed down, the filter would compute the lines of a document once more; it stays above a column that is not deterministic
    out = line_dedup.dedup_chunks_and_runs(set_apart(docs, "doc_id", "text")).withColumn("_row", F.monotonically_increasing_id())
    out = out.filter("_row >= 0 AND (n_removed = 0 OR n_left > 0)")
    out = out.select(*put_back(out, docs.columns, "doc_id", "text"))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def near_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One text of each near-duplicate group: five-word shingles, similarity 0.8.

    Rows go, not ids: of a doc_id with several texts only those that are like another one.  Rows with
    a null doc_id or without words stay, rows equal in doc_id and text stay or go together.
    """
    gone = minhash_dedup.copies(docs, k=5, percent=80)
    rows = set_apart(docs, "doc_id", "text").withColumn("th", F.xxhash64(F.col("text").cast("string")))
    kept = rows.join(gone, (rows.doc_id == gone.doc_id) & (rows.th == gone.th), "left_anti")
    return kept.select(*put_back(kept, docs.columns, "doc_id", "text"))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    clean = decontaminate.clean(set_apart(docs, "doc_id", "text"), read(spark, sf_dir, "benchmark"))
    return clean.select(*put_back(clean, docs.columns, "doc_id", "text"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents, packed into sequences of 1024 tokens."""
    return packing.pack(docs, capacity=1024, end_id=2)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_deduplication),
    ("minhash_near_dedup", near_deduplication),
    ("benchmark_decontamination", benchmark_decontamination),
    ("best_fit_packing", best_fit_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder before the next begins."""
    docs = read(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
