"""From raw documents to token ids: quality rules, near-duplicates, benchmark passages, personal data, ids.

Each stage is one operator over all rows that the stage before it kept. All but
the last keep the columns of `documents`; n_chars follows the text. The ids of
the last stage are those of the SentencePiece operator, as little-endian
unsigned 32-bit integers.

Defined cases are those of the operators: documents without text go with the
quality rules; a null id is nobody's copy and holds no test passage; an empty
table stays empty; more columns pass through to the last stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketmill.llm import decontam, neardup, pii, quality, sentencepiece
from marketmill.llm.shared import stored


def _counted(docs: DataFrame) -> DataFrame:
    """n_chars of the text as it is now."""
    kind = dict(docs.dtypes).get("n_chars")
    return docs if kind is None else docs.withColumn("n_chars", F.length("text").cast(kind))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep, without the lines that too many documents of their source share."""
    return _counted(quality.clean_documents(docs))


def neardup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest id."""
    return neardup.drop_near_duplicates(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of a benchmark item."""
    return decontam.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the kind of personal data in its place."""
    return _counted(pii.redact(docs))


def sentencepiece_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, ids of each text, their number and crc32, and whether they decode to the text."""
    coded = sentencepiece.encode_checked(docs.select("doc_id", "lang", "source", "text"))
    return coded.select("doc_id", "lang", "source", (F.octet_length("piece_ids") / 4).cast("long").alias("n_ids"), F.crc32("piece_ids").alias("ids_crc32"), "piece_ids", "round_trip")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality_stage),
    ("neardup", neardup_stage),
    ("decontamination", decontamination_stage),
    ("pii", pii_stage),
    ("sentencepiece", sentencepiece_stage),
]

#: Components of near copies, seeded overlaps and Viterbi paths are not for SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
