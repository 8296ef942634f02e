"""The package's queries; each takes (spark, folder of tables) and reads its tables whole."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    chat,
    ctw,
    decontam,
    hyperminhash,
    packing,
    periodic,
    pii,
    quality,
    secrets,
    token_count,
    token_file,
    toxicity,
    whitening,
)
from .common import remainder, stored, table, vocabulary
from .sql import oracle_sql

__all__ = ["oracle_sql", "queries"]


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(table(spark, sf_dir, "documents"))


def op2_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = token_count.write_flat(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))
    return token_count.counts(files)


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.digest(table(spark, sf_dir, "documents"))


def op4_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    settings = token_file.Settings(vocabulary("byte_bpe_50k.json"))
    return token_file.read(token_file.write(table(spark, sf_dir, "documents"), settings), settings)


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame(
        [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")],
        "conv_id long, turn long, role string, text string",
    )
    return chat.digest(stored(chat.examples(rows.unionByName(probe)), "chat"))


def op6_ctw_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ctw.score(table(spark, sf_dir, "documents"), remainder(F.col("doc_id"), 7) == 2)


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hyperminhash.near_duplicates(table(spark, sf_dir, "documents"), hyperminhash.Settings(percent=85))


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    settings = packing.Settings(vocabulary("word_bpe_49k.json"))
    return packing.pack(table(spark, sf_dir, "documents"), settings)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.digest(table(spark, sf_dir, "embeddings"))


def op12_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(table(spark, sf_dir, "documents"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.digest(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_secret_scan": op1_secret_scan,
        "op2_token_count": op2_token_count,
        "op3_quality_rules": op3_quality_rules,
        "op4_token_file": op4_token_file,
        "op5_chat_format": op5_chat_format,
        "op6_ctw_score": op6_ctw_score,
        "op7_decontaminate": op7_decontaminate,
        "op8_minhash_dedup": op8_minhash_dedup,
        "op9_best_fit_packing": op9_best_fit_packing,
        "op10_toxicity": op10_toxicity,
        "op11_embedding_whitening": op11_embedding_whitening,
        "op12_pii": op12_pii,
        "op13_periodic_runs": op13_periodic_runs,
    }
