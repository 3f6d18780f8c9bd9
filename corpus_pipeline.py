"""From raw documents to packed training windows, in stages that each read the one before.

Stages return the columns of documents, the last one the pieces of its windows:

- language_id: documents without a letter, or as near to a second language as to the first, go;
- line_dedup: lines found on many sites go, but for one occurrence;
- near_dedup: one document of each group of near copies (0.8 of their 5-word shingles) stays;
- secret_scan: secrets in the texts are masked;
- packing: the texts' ids are packed into windows of 4096.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.llm import jaccard, langid, linededup, packing, secrets
from tallyspark.session import configure, materialise

ORACLE_SQL = None  # fingerprints, classifiers and token ids are not expressible in SQL


def _as_documents(docs: DataFrame, names: list[str]) -> DataFrame:
    """The columns ``names``, with n_chars of the texts as they are now."""
    counted = docs.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in names else docs
    return counted.select(*names)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    configure(spark)
    found = langid.identify(docs)
    return found.where((F.col("lang_pred") != langid.UNKNOWN) & ~F.col("ambiguous")).select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    configure(spark)
    return _as_documents(linededup.remove_boilerplate(docs), docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    configure(spark)
    return jaccard.keep_first(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    configure(spark)
    return _as_documents(secrets.redact(docs), docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    configure(spark)
    return packing.pack(packing.pieces(docs, with_ids=False))


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("secret_scan", secret_scan),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table documents; each is stored before the next reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
