"""A corpus pipeline over ``documents``: each stage calls one operator of ``stockroom.llm``.

Toxic documents go, one document of each near-duplicate group stays, documents with
benchmark passages go, secrets are masked, and what is left is packed into sequences.
Stages up to the last return the columns of ``documents``; a stage that filters keeps
every row it does not reject, NULL and empty texts included.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stockroom.llm import decontam, hyperminhash, packing, secrets, toxicity
from stockroom.llm.common import stored, table, vocabulary


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.keep_harmless(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return hyperminhash.deduplicate(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.remove(docs, table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, packing.Settings(vocabulary("word_bpe_49k.json")))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secret_scan", mask_secrets),
    ("packing", pack),
]
# Models, sketches and tokenizers are not SQL: tests/llm/test_pipeline.py follows each stage in plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages in order; each result is written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, name)
    return docs
