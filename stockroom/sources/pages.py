"""Landed record pages: one JSON envelope ``{"data": [...], "meta": {...}}`` per page."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockroom.sources.registry import EntitySpec

# Records stay as JSON text until flattening, so fields nobody declared survive.
ENVELOPE = (
    "data array<string>, meta struct<has_more: boolean, cursor: string>, _corrupt_record string"
)


def _page_options(multi_line: bool) -> dict[str, str]:
    return {
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": "_corrupt_record",
        "multiLine": str(multi_line).lower(),
    }


def _records(pages: DataFrame) -> DataFrame:
    """One row per record. An unreadable page stays whole, as one record without a key."""
    unreadable = F.col("_corrupt_record").isNotNull()
    texts = F.when(unreadable, F.array("_corrupt_record")).otherwise(F.col("data"))
    return pages.select(F.explode(texts).alias("record")).filter("record IS NOT NULL")


def entity_path(root: str, spec: EntitySpec) -> str:
    return f"{root.rstrip('/')}/{spec.endpoint}"


def read_pages(
    spark: SparkSession,
    root: str,
    spec: EntitySpec,
    multi_line: bool = False,
) -> DataFrame:
    """All records of an entity's pages as JSON text, one row each, read in parallel.

    ``multi_line`` reads one pretty-printed page per file; the default of one
    page per line lets Spark split large files.
    """
    reader = spark.read.schema(ENVELOPE).options(**_page_options(multi_line))
    return _records(reader.json(entity_path(root, spec)))


def stream_pages(
    spark: SparkSession,
    root: str,
    spec: EntitySpec,
    multi_line: bool = False,
    max_files: int = 1000,
    max_file_age: str = "90d",
) -> DataFrame:
    """The same records as a stream that picks up newly landed files.

    The source remembers the files it has taken as long as they are not ``max_file_age``
    older than the newest; what lands with an older time than that is passed over.
    """
    reader = (
        spark.readStream.schema(ENVELOPE)
        .options(**_page_options(multi_line))
        .options(maxFilesPerTrigger=max_files, maxFileAge=max_file_age)
    )
    return _records(reader.json(entity_path(root, spec)))


def land_pages(
    records: DataFrame, root: str, spec: EntitySpec, pages: int
) -> None:
    """Write records as ``pages`` envelopes, spread by the hash of the key.

    Choose ``pages`` as records ÷ page size: keys are unique within an extract,
    so the hash keeps every page near that size.
    """
    page = F.pmod(F.xxhash64(spec.key), F.lit(pages))
    (
        records.select(page.alias("page"), F.struct("*").alias("record"))
        .groupBy("page")
        .agg(F.collect_list("record").alias("data"))
        .select(
            "data",
            F.struct(
                (F.col("page") < pages - 1).alias("has_more"),
                F.col("page").cast("string").alias("cursor"),
            ).alias("meta"),
        )
        .write.mode("append")
        .json(entity_path(root, spec))
    )
