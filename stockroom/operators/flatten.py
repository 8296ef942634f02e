"""From landed JSON records to lake rows, and from lake rows to typed columns."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockroom.functions.coerce import RULES, coerce, coerce_ts
from stockroom.functions.naming import merged_columns
from stockroom.sources.registry import EntitySpec

LINEAGE = ("_lake_id", "_lake_loaded_at", "_lake_updated_at")


def camel_case(name: str) -> str:
    head, *tail = name.split("_")
    return head + "".join(part.capitalize() for part in tail)


def to_payload(records: DataFrame, spec: EntitySpec) -> DataFrame:
    """Lake rows ``(id, raw_data, updated_at)`` from records held as JSON text.

    The update time is read from either spelling; an empty camelCase value falls
    through to the other. An absent or null key gives a NULL id: see :func:`split_keyed`.
    """
    # One generator reads all three fields in a single pass over the text.
    head = F.json_tuple("record", spec.key, camel_case(spec.cursor), spec.cursor)
    updated = F.coalesce(F.nullif("_camel", F.lit("")), F.nullif("_snake", F.lit("")))
    return records.select("record", head.alias("id", "_camel", "_snake")).select(
        "id", F.col("record").alias("raw_data"), coerce_ts(updated).alias("updated_at")
    )


def rows_to_records(df: DataFrame) -> DataFrame:
    """Serialise whole rows to the JSON text form of a landed record."""
    return df.select(F.to_json(F.struct("*")).alias("record"))


def split_keyed(lake_rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows with a usable key, and the rejected rest. Every row is in exactly one."""
    keyed = F.coalesce(F.col("id"), F.lit("")) != ""
    return lake_rows.filter(keyed), lake_rows.filter(~keyed)


def with_lineage(lake_rows: DataFrame) -> DataFrame:
    """Rename the lake's own columns so they can stand beside the payload's."""
    return lake_rows.select(
        F.col("id").alias("_lake_id"),
        F.col("loaded_at").alias("_lake_loaded_at"),
        F.col("updated_at").alias("_lake_updated_at"),
        "raw_data",
    )


def text_schema(schema: T.StructType, extra: Sequence[str] = ()) -> T.StructType:
    """The schema with every field as text, in both spellings, and ``extra`` fields."""
    names = dict.fromkeys(n for f in schema for n in (camel_case(f.name), f.name))
    names.update(dict.fromkeys(extra))
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def _spark_ddl(variant_schema: str) -> str:
    """A variant's schema text as DDL: types are renamed, field names (quoted or not) stay."""
    parts = re.split(r"(`(?:[^`]|``)*`)", variant_schema)
    for k in range(0, len(parts), 2):  # every other part is a quoted name
        text = re.sub(r"(^|: |ARRAY<)OBJECT<", r"\1STRUCT<", parts[k])
        parts[k] = re.sub(r"(: |ARRAY<)VOID(?=[,>]|$)", r"\1STRING", text)
    return "".join(parts)


def discover_schema(lake_rows: DataFrame) -> T.StructType:
    """Schema of a batch whose fields are not declared; a distributed aggregate, one row back."""
    found = lake_rows.select(
        F.schema_of_variant_agg(F.try_parse_json("raw_data")).alias("s")
    ).first()
    ddl = _spark_ddl(found["s"] or "")
    if not ddl.startswith("STRUCT<"):
        return T.StructType([])
    return T.StructType.fromDDL(ddl[len("STRUCT<") : -1])


def discover_names(lake_rows: DataFrame) -> list[str]:
    """Names of all fields of a batch's records, as the records write them."""
    names = lake_rows.select(F.explode(F.json_object_keys("raw_data")).alias("name"))
    return sorted(r["name"] for r in names.distinct().collect())


def flatten(
    lake_rows: DataFrame, schema: T.StructType | None = None, evolve: bool = False
) -> DataFrame:
    """Payload fields as snake_case columns beside the lineage columns.

    With a declared ``schema`` all fields arrive as text, so that coercion sees
    what the source wrote; ``evolve`` adds the batch's undeclared fields, as text
    too, so their type never changes between batches. Without a schema the
    batch's own types are used. A NULL or unreadable payload keeps its lineage
    columns only.
    """
    if schema is None:
        target = discover_schema(lake_rows)
    else:
        extra = discover_names(lake_rows) if evolve else []
        target = text_schema(schema, extra)
    rows = with_lineage(lake_rows)
    if not target.fields:
        return rows.drop("raw_data")
    # Fields go by number until spellings that differ in case alone have been merged.
    numbered = T.StructType([T.StructField(f"_{k}", f.dataType) for k, f in enumerate(target)])
    wanted = T.StructType([T.StructField(f.name, f.dataType) for f in target])
    parsed = rows.withColumn("rec", F.from_json("raw_data", wanted).cast(numbered))
    fields = {f.name: F.col(f"rec._{k}") for k, f in enumerate(target)}
    types = {f.name: f.dataType.simpleString() for f in target}
    lineage = {c: F.col(c) for c in LINEAGE}
    return parsed.select(*merged_columns(fields | lineage, types))


def typed(flat: DataFrame, schema: T.StructType) -> DataFrame:
    """Coerce leniently, then give every declared column its declared type."""
    lenient = coerce(flat)
    declared = {f.name: f.dataType for f in schema}

    def column(name: str):
        if name not in declared or name in RULES:
            return F.col(f"`{name}`")
        return F.col(name).cast(declared[name]).alias(name)

    return lenient.select(*(column(c) for c in lenient.columns))
