"""Column naming: camelCase and free-form names to snake_case."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_WORD = re.compile(r"[A-Z]+[0-9]*(?![a-z])|[A-Z]?[a-z]+[0-9]*|[0-9]+")


def snake_case(name: str) -> str:
    """``updatedAt`` → ``updated_at``; a leading underscore marks metadata and is kept."""
    words = "_".join(w.lower() for w in _WORD.findall(name))
    return f"_{words}" if name.startswith("_") or words[:1].isdigit() else words


def merged_columns(columns: Mapping[str, Column], types: Mapping[str, str]) -> list[Column]:
    """Columns under their snake_case names; spellings of one name merge, other spellings first when not empty."""
    spellings: dict[str, list[str]] = {}
    for name in columns:
        spellings.setdefault(snake_case(name), []).append(name)

    def merged(target: str, sources: list[str]) -> Column:
        if len(sources) == 1:
            return columns[sources[0]].alias(target)
        kinds = {types.get(s) for s in sources}
        parts = []
        for source in sorted(sources, key=lambda s: s == target):
            part = columns[source] if len(kinds) == 1 else columns[source].cast("string")
            text = len(kinds) > 1 or types.get(source) == "string"
            parts.append(F.nullif(part, F.lit("")) if text else part)
        return F.coalesce(*parts).alias(target)

    return [merged(t, s) for t, s in spellings.items()]


def snake_case_columns(df: DataFrame) -> DataFrame:
    """Rename all columns; both spellings of one field merge, camelCase first when not empty."""
    return df.select(*merged_columns({c: F.col(f"`{c}`") for c in df.columns}, dict(df.dtypes)))
