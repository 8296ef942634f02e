"""Token counts of flat files without an index, by scanning for end-of-document ids.

A file is nothing but ids, two bytes each. It is read in blocks of a fixed size by any
number of tasks; each finds its end ids in one vectorised comparison and passes on where
they are. A document that spans blocks is stitched by a prefix scan over the blocks'
summaries: the running maximum of the last end seen says where the open document began,
the running sum of ends which number it has. No block is read twice.

Defined results: documents of no ids count 0; ids after a file's last end are a document
that is not ended; an empty file has none; a file with half an id raises an error. When
documents are written, a NULL or empty text is its end id alone, end-of-document strings
inside a text are ordinary text, repeated rows are written as often as they occur, and
extra columns are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import folder, pieces, stored
from .encode import encoder


@dataclass(frozen=True)
class Settings:
    end: int = 50256
    block: int = 1 << 22  # ids of a block


def write_flat(docs: DataFrame, vocabulary: str, settings: Settings = Settings()) -> DataFrame:
    """Write texts as flat files, one per partition; a stored row per file: (file, path, n_bytes)."""
    base = folder(docs.sparkSession, "flat_tokens")

    def save(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = fs.FileSystem.from_uri(base)
        system.create_dir(path, recursive=True)
        number = TaskContext.get().partitionId()
        beside = f"{path}/.{number:06d}-{uuid.uuid4().hex}"
        own = encoder(vocabulary, plain=True)
        tail = np.array([settings.end], "<u2").tobytes()
        size, sink = 0, None
        for _, texts in pieces(batches):
            sink = sink or system.open_output_stream(beside)
            for data in own.encode([t or "" for t in texts]):
                size += sink.write(data) + sink.write(tail)
        if sink is not None:
            sink.close()
            system.move(beside, f"{path}/{number:06d}.ids")
            yield pa.RecordBatch.from_arrays(
                [pa.array([number]), pa.array([f"{base}/{number:06d}.ids"]), pa.array([size])],
                names=["file", "path", "n_bytes"],
            )

    return stored(docs.select("text").mapInArrow(save, "file long, path string, n_bytes long"), "flat_list")


def scan(files: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(file, block, first, n, ends): every block's first id's place, size, and places of end ids."""

    def seek(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, path, block, first, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                system, inner = fs.FileSystem.from_uri(path)
                with system.open_input_file(inner) as source:
                    data = source.read_at(2 * n, 2 * first)
                if len(data) != 2 * n:
                    raise ValueError(f"{path} ends early")
                ends = np.flatnonzero(np.frombuffer(data, "<u2") == settings.end) + first
                yield pa.RecordBatch.from_arrays(
                    [pa.array([file]), pa.array([block]), pa.array([first]), pa.array([n]),
                     pa.array([ends], pa.list_(pa.int64()))],
                    names=["file", "block", "first", "n", "ends"],
                )

    total = F.col("n_bytes") / 2
    whole = F.when(F.col("n_bytes") % 2 == 0, F.ceil(total / settings.block)).otherwise(
        F.raise_error(F.concat(F.col("path"), F.lit(" ends within an id")))
    )
    last = F.greatest(whole.cast("long"), F.lit(1)) - 1
    blocks = files.filter("n_bytes > 0").select(
        "file", "path", "n_bytes", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("block")
    )
    first = F.col("block") * settings.block
    blocks = blocks.select(
        "file", "path", "block", first.alias("first"),
        F.least(F.lit(settings.block), (F.col("n_bytes") / 2).cast("long") - first).cast("long").alias("n"),
    )
    dealt = blocks.repartition(F.col("file"), F.col("block"))
    return dealt.mapInArrow(seek, "file long, block long, first long, n long, ends array<long>")


def counts(files: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(file, doc, start, n_tokens, ended), a row per document; ends are not counted."""
    scanned = stored(scan(files, settings), "token_blocks")
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    summary = scanned.select(
        "file", "block", "first", "n", F.size("ends").cast("long").alias("found"),
        F.when(F.size("ends") > 0, F.element_at("ends", -1)).alias("last"),
    )
    # A few numbers per block: the scan orders summaries, not ids.
    carried = summary.select(
        "file", "block",
        F.coalesce(F.max("last").over(earlier), F.lit(-1)).alias("open"),
        F.coalesce(F.sum("found").over(earlier), F.lit(0)).alias("before"),
        F.lead("block").over(Window.partitionBy("file").orderBy("block")).isNull().alias("final"),
    )
    joined = scanned.join(carried, ["file", "block"])
    # In a file's last block, what follows the last end is a document without one.
    stop = F.col("first") + F.col("n")
    tail = F.col("final") & (F.coalesce(F.try_element_at("ends", F.lit(-1)), F.col("open")) < stop - 1)
    ends = F.when(tail, F.concat("ends", F.array(stop))).otherwise(F.col("ends"))
    return (
        joined.withColumn("ends", ends)
        .select("file", "before", "open", "ends", "final", stop.alias("stop"), F.posexplode("ends").alias("k", "end"))
        .select(
            "file",
            (F.col("before") + F.col("k")).alias("doc"),
            (F.when(F.col("k") > 0, F.get("ends", F.col("k") - 1)).otherwise(F.col("open")) + 1).alias("start"),
            "end",
            (F.col("end") < F.col("stop")).alias("ended"),
        )
        .select("file", "doc", "start", (F.col("end") - F.col("start")).alias("n_tokens"), "ended")
    )
