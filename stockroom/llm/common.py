"""Helpers shared by the operators of this package."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stockroom.session import work_dir
from stockroom.sources.files import qualified

# The white space that ends a word: U+0020 and U+0009 to U+000D.
SPACES = " \t\n\x0b\x0c\r"
GOLD = np.uint64(0x9E3779B97F4A7C15)
WORDS_KEPT = 40_000  # entries of a worker's word table, some 8 MB; only speed depends on it
WORD_BYTES = 64  # longer words are not kept, so that the table is bounded in bytes


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver found it, if they see that folder."""
    here = str(Path(__file__).resolve().parents[2])
    env = spark.sparkContext.environment
    known = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if here not in known:
        env["PYTHONPATH"] = os.pathsep.join([here, *known])


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a frame to the folder all executors share and read it back: lineage ends here."""
    spark = df.sparkSession
    importable(spark)
    path = work_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def folder(spark: SparkSession, label: str) -> str:
    """A fresh folder below the shared one, as a URI that tasks can open."""
    path = work_dir(spark, label)
    scheme, colon, rest = qualified(spark, path if ":" in path else f"file:{path}").partition(":")
    return f"{scheme}{colon}{rest if rest.startswith('//') else '//' + rest}"


def vocabulary(name: str) -> str:
    """Path of a public tokenizer's file; workers open the same path."""
    import public_tokenizers

    return public_tokenizers.path(name)


def remainder(doc_id: Column, by: int) -> Column:
    """crc32 of the id as text, modulo ``by``; NULL for a NULL id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % by


def fresh(df: DataFrame, stem: str) -> str:
    """A column name that no column of ``df`` has, whatever the case."""
    taken = {c.lower() for c in df.columns}
    return stem if stem.lower() not in taken else f"{stem}_{uuid.uuid4().hex[:8]}"


class _WordTable(dict):
    """Hash of a word, computed once for each word a worker meets."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh64_intdigest(word)
        if len(word) <= WORD_BYTES:
            if len(self) >= WORDS_KEPT:
                self.clear()
            self[word] = value
        return value


_hash_of = _WordTable()


def words(text: str | None) -> list[bytes]:
    """Words of a text with A-Z in lower case, as UTF-8; none for NULL.

    On bytes, ``lower`` touches A-Z alone and ``split`` cuts at :data:`SPACES` alone.
    """
    return text.encode("utf-8", "replace").lower().split() if text else []


def word_hashes(tokens: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_hash_of.__getitem__, tokens), np.uint64, len(tokens))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingles(tokens: list[bytes], width: int) -> np.ndarray:
    """Sorted distinct hashes of all ``width``-word runs; a shorter sequence is one run."""
    if not tokens:
        return np.empty(0, np.uint64)
    h = word_hashes(tokens)
    width = min(width, len(h))
    total = np.full(len(h) - width + 1, np.uint64(width), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(width):
            total = total * GOLD + h[k : len(h) - width + 1 + k]
        return np.unique(mixed(total))


def pieces(batches: Iterable[pa.RecordBatch], column: str = "text", chars: int = 4_000_000) -> Iterator[tuple]:
    """Cut batches so that a piece holds about ``chars`` bytes of text (or one long text): (slice, texts)."""
    for batch in batches:
        sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
        at = 0
        while at < batch.num_rows:
            before = sizes[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(sizes, before + chars, "right")))
            part = batch.slice(at, end - at)
            yield part, part.column(column).to_pylist()
            at = end
