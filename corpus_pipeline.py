"""The corpus pipeline: quality rules, near-duplicate removal, benchmark decontamination, personal data,
packing.

Each stage is a function ``(spark, docs, sf_dir)``; its result is written as Parquet and read again as
the next one's documents. All but the last return the columns of ``documents`` that they were given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.base import labels_of, settings, stored, table
from tidemark.llm.decontaminate import leaks
from tidemark.llm.near_dedup import near_duplicates
from tidemark.llm.packing import pack_documents
from tidemark.llm.pii import redacted, spans_column
from tidemark.llm.quality import judge_quality


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the base rule or the learned decision list rejects."""
    settings(spark)
    judged = judge_quality(docs, labels_of(table(spark, sf_dir, "labels"), "quality"))
    return judged.where("quality.kept").select(*(judged[f"`{name}`"] for name in docs.columns))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near duplicates (five words, similarity 0.8): the one of the
    least id. Rows that repeat an id and a text are one document."""
    settings(spark)
    judged = near_duplicates(docs, size=5, percent=80).where("kept")
    judged = judged.groupBy(F.col("doc_id").alias("kept_id"), F.col("text_hash").alias("kept_hash")).count()
    kept = stored(judged, "kept")
    same = docs["doc_id"].eqNullSafe(kept["kept_id"]) & (F.xxhash64(docs["text"]) == kept["kept_hash"])
    repeated = kept.where("count > 1")
    if repeated.isEmpty():
        return docs.join(kept, same, "left_semi")
    once = docs.join(kept.where("count = 1"), same, "left_semi")
    return once.unionByName(docs.join(repeated, same, "left_semi").dropDuplicates(["doc_id", "text"]))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that hold a benchmark item."""
    settings(spark)
    found = leaks(docs, table(spark, sf_dir, "benchmark")).select(F.col("doc_id").alias("leaked"), F.col("text_hash").alias("leaked_hash"))
    found = stored(found.distinct(), "leaks")
    same = docs["doc_id"].eqNullSafe(found["leaked"]) & (F.xxhash64(docs["text"]) == found["leaked_hash"])
    return docs.join(found, same, "left_anti")


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data in the texts by the name of its kind, and count the characters again."""
    settings(spark)
    spans = "_pii_spans"
    clean = docs.withColumn(spans, spans_column("text")).withColumn("text", redacted("text", spans)).drop(spans)
    return clean.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in docs.columns else clean


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokens of the texts, packed into sequences."""
    import public_tokenizers

    settings(spark)
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("packing", packing),
]

# No SQL can express a learned list, alignments and packing; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to the documents, writing and rereading after each."""
    settings(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
