"""Token files: ids of documents in blocks coded by :mod:`.range_coder`.

A file holds the documents of one range of ids, in ascending order::

    b"TOKS" | groups | index | footer
    group:  blocks, bytes and crc32 of its tables (3 x u32), the coder's tables, its blocks
    block:  n_ids, payload bytes, crc32 of the payload, crc32 of the ids (4 x u32), payload
    index:  zlib of the documents' ids (i64), whether they have one (u8), sizes (i64)
    footer: index place (u64), index bytes, documents, crc32 of the index (3 x u32), b"TOKS"

Blocks are reset to their group's tables and checked independently; damage to one is found and named. Files are
written beside their final name and renamed, so a task that is lost and run again leaves
the same file. Range partitions keep the order across files without one task seeing all.

Defined results: a NULL or empty text is its end id alone; a NULL doc_id comes first;
rows with equal ids follow each other in the order of their texts' hashes; an empty
table gives no documents; extra columns are ignored.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import range_coder
from .common import folder, pieces, stored
from .encode import encoder

MAGIC = b"TOKS"
GROUP, BLOCK, FOOTER = struct.Struct("<III"), struct.Struct("<IIII"), struct.Struct("<QIII4s")


@dataclass(frozen=True)
class Settings:
    vocabulary: str  # a tokenizers file
    end: int = 0  # id that ends every document
    block: int = 2048  # ids of a block
    lanes: int = 2600  # blocks coded side by side, which bounds a task's memory
    file_bytes: int = 12_000_000  # text of a file, about: as many blocks as there are lanes


class Damaged(ValueError):
    """A checksum or size of a token file does not hold."""


class FileWriter:
    def __init__(self, sink, settings: Settings):
        self.sink, self.settings = sink, settings
        self.at = sink.write(MAGIC)
        self.waiting: list[np.ndarray] = []
        self.held = 0
        self.docs: list[tuple[int | None, int]] = []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append((doc_id, len(ids)))
        self.waiting.append(ids)
        self.held += len(ids)
        if self.held >= self.settings.block * self.settings.lanes:
            self._flush(last=False)

    def _flush(self, last: bool) -> None:
        flat = np.concatenate([*self.waiting, np.empty(0, np.uint16)])
        size = self.settings.block
        end = len(flat) if last else len(flat) // size * size
        blocks = [flat[k : min(k + size, end)] for k in range(0, end, size)]
        for k in range(0, len(blocks), self.settings.lanes):
            some = blocks[k : k + self.settings.lanes]
            tables = range_coder.Tables.of(some)
            packed = tables.pack()
            self.at += self.sink.write(GROUP.pack(len(some), len(packed), zlib.crc32(packed))) + self.sink.write(packed)
            for ids, payload in zip(some, range_coder.encode(some, tables), strict=True):
                head = BLOCK.pack(len(ids), len(payload), zlib.crc32(payload), zlib.crc32(ids.tobytes()))
                self.at += self.sink.write(head) + self.sink.write(payload)
        self.waiting, self.held = [flat[end:].copy()], len(flat) - end

    def close(self) -> int:
        """Write what is left; the file's size in bytes."""
        self._flush(last=True)
        names = np.array([d or 0 for d, _ in self.docs], "<i8").tobytes()
        known = np.array([d is not None for d, _ in self.docs], np.uint8).tobytes()
        index = zlib.compress(names + known + np.array([n for _, n in self.docs], "<i8").tobytes())
        self.sink.write(index)
        self.sink.write(FOOTER.pack(self.at, len(index), len(self.docs), zlib.crc32(index), MAGIC))
        return self.at + len(index) + FOOTER.size


def read_index(source) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(ids, known, sizes, where the blocks end) of an open file."""
    size = source.size()
    if size < FOOTER.size + 4 or source.read_at(4, 0) != MAGIC:
        raise Damaged("not a token file")
    at, length, n, crc, magic = FOOTER.unpack(source.read_at(FOOTER.size, size - FOOTER.size))
    index = source.read_at(length, at)
    if magic != MAGIC or zlib.crc32(index) != crc:
        raise Damaged("index")
    index = zlib.decompress(index)
    return (
        np.frombuffer(index, "<i8", n), np.frombuffer(index, np.uint8, n, 8 * n),
        np.frombuffer(index, "<i8", n, 9 * n), at,
    )


def read_blocks(source, end: int, lanes: int) -> Iterator[np.ndarray]:
    """The ids of a file, block by block."""
    at, number, left, tables = 4, 0, 0, None
    while at < end:
        if not left:
            left, length, crc = GROUP.unpack(source.read_at(GROUP.size, at))
            packed = source.read_at(length, at + GROUP.size)
            if not left or zlib.crc32(packed) != crc:
                raise Damaged(f"tables of block {number}")
            tables = range_coder.Tables.unpack(packed)
            at += GROUP.size + length
        payloads, sizes, checks = [], [], []
        while left and len(sizes) < lanes:
            if at + BLOCK.size > end:
                raise Damaged(f"block {number + len(sizes)}")
            n, length, crc, check = BLOCK.unpack(source.read_at(BLOCK.size, at))
            payload = source.read_at(length, at + BLOCK.size)
            if zlib.crc32(payload) != crc:
                raise Damaged(f"block {number + len(sizes)}")
            payloads.append(payload)
            sizes.append(n)
            checks.append(check)
            at += BLOCK.size + length
            left -= 1
        for ids, check in zip(range_coder.decode(payloads, sizes, tables), checks, strict=True):
            if zlib.crc32(ids.tobytes()) != check:
                raise Damaged(f"ids of block {number}")
            number += 1
            yield ids


def write(docs: DataFrame, settings: Settings) -> DataFrame:
    """Write all documents; a stored row per file: (file, path, n_docs, n_ids, n_bytes)."""
    base = folder(docs.sparkSession, "token_files")
    size = docs.agg(F.sum(F.octet_length("text")).alias("n")).first().n or 0
    files = max(1, -(-size // settings.file_bytes))

    def save(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = fs.FileSystem.from_uri(base)
        system.create_dir(path, recursive=True)
        number = TaskContext.get().partitionId()
        final, beside = f"{path}/{number:06d}.toks", f"{path}/.{number:06d}-{uuid.uuid4().hex}"
        own = encoder(settings.vocabulary)
        tail = np.array([settings.end], np.uint16)
        writer = sink = None
        n_ids = 0
        for part, texts in pieces(batches):
            if sink is None:
                sink = system.open_output_stream(beside)
                writer = FileWriter(sink, settings)
            names = part.column("doc_id").to_pylist()
            for name, data in zip(names, own.encode([t or "" for t in texts]), strict=True):
                ids = np.concatenate([np.frombuffer(data, np.uint16), tail])
                n_ids += len(ids)
                writer.add(name, ids)
        if sink is not None:
            n_bytes = writer.close()
            sink.close()
            system.move(beside, final)
            row = [[number], [f"{base}/{number:06d}.toks"], [len(writer.docs)], [n_ids], [n_bytes]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(v) for v in row], names=["file", "path", "n_docs", "n_ids", "n_bytes"]
            )

    # The last two keys tell rows with equal ids apart, so even those are dealt evenly.
    keyed = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("h"),
        F.monotonically_increasing_id().alias("row"),
    )
    ordered = keyed.repartitionByRange(files, "doc_id", "h", "row").sortWithinPartitions("doc_id", "h", "row")
    written = ordered.select("doc_id", "text").mapInArrow(
        save, "file long, path string, n_docs long, n_ids long, n_bytes long"
    )
    return stored(written, "token_file_list")


def read(files: DataFrame, settings: Settings) -> DataFrame:
    """Decode files into (doc_id, start, n_tokens, ids_crc32), ``start`` counting from the first file's first id."""
    # One row per file; a running sum over them gives each file's first id.
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    placed = files.withColumn("first", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))
    count = max(1, files.count())

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, first in zip(batch.column("path").to_pylist(), batch.column("first").to_pylist(), strict=True):
                system, inner = fs.FileSystem.from_uri(path)
                with system.open_input_file(inner) as source:
                    names, known, sizes, end = read_index(source)
                    ends = np.cumsum(sizes)
                    crc = np.zeros(len(sizes), np.int64)
                    at = doc = 0
                    for ids in read_blocks(source, end, settings.lanes):
                        data = memoryview(ids.astype("<u4")).cast("B")
                        done = 0
                        while done < len(ids):  # a document may span blocks
                            if doc >= len(sizes):
                                raise Damaged("more ids than the index has")
                            n = min(len(ids) - done, int(ends[doc]) - at)
                            crc[doc] = zlib.crc32(data[4 * done : 4 * (done + n)], int(crc[doc]))
                            at += n
                            done += n
                            doc += at == ends[doc]
                    if at != (ends[-1] if len(ends) else 0):
                        raise Damaged("fewer ids than the index has")
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(names, pa.int64(), mask=known == 0), pa.array(first + ends - sizes),
                        pa.array(sizes), pa.array(crc),
                    ],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    dealt = placed.select("path", "first", "file").repartitionByRange(count, "file")
    return dealt.mapInArrow(load, "doc_id long, start long, n_tokens long, ids_crc32 long")
