"""Best-fit packing of documents into sequences, improved by swaps.

Documents become ids plus an end id; only those longer than a sequence are cut. Pieces
are dealt into groups of about :attr:`Settings.group`, a number that grows with their
count, so a task holds one group of numbers and no texts. A group is packed best-fit,
longest first, and then searched: documents of the emptiest sequence are moved to, or
exchanged one for one, two for one or one for two with, fuller sequences, always raising
the sum of squared fills, until the count meets its lower bound or no sequence with room
has such an exchange left.

Defined results: a NULL or empty text is its end id alone; every row is a document of
its own, so repeated rows and equal or NULL ids are packed each; an empty table gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pieces, stored
from .encode import encoder


@dataclass(frozen=True)
class Settings:
    vocabulary: str  # a tokenizers file
    end: int = 1  # id that ends every document
    capacity: int = 4096
    group: int = 40_000  # pieces packed together


def cut(docs: DataFrame, settings: Settings, with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]): ids are little-endian unsigned 32-bit."""
    path, end, capacity = settings.vocabulary, settings.end, settings.capacity

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        tail = np.array([end], np.uint16).tobytes()
        for part, texts in pieces(batches):
            rows, piece, start, length, crc, kept = [], [], [], [], [], []
            for row, data in enumerate(own.encode([t or "" for t in texts])):
                ids = np.frombuffer(data + tail, np.uint16).astype("<u4")
                for k, at in enumerate(range(0, len(ids), capacity)):
                    some = ids[at : at + capacity].tobytes()
                    rows.append(row)
                    piece.append(k)
                    start.append(at)
                    length.append(len(some) // 4)
                    crc.append(zlib.crc32(some))
                    if with_ids:
                        kept.append(some)
            columns = {
                "doc_id": part.column("doc_id").take(pa.array(rows, pa.int64())),
                "piece": pa.array(piece, pa.int32()),
                "start": pa.array(start, pa.int64()),
                "length": pa.array(length, pa.int64()),
                "ids_crc32": pa.array(crc, pa.int64()),
            }
            if with_ids:
                columns["ids"] = pa.array(kept, pa.binary())
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    ddl = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(encode, ddl)


def best_fit(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Longest first, each into the fullest bin that still holds it. Items are indexes."""
    bins: list[list[int]] = []
    by_free: list[list[int]] = [[] for _ in range(capacity + 1)]
    some_free = 0  # bit f: a bin has f free places
    for item in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[item])
        fits = some_free >> size
        if fits:
            free = size + (fits & -fits).bit_length() - 1
            at = by_free[free].pop()
            if not by_free[free]:
                some_free &= ~(1 << free)
        else:
            free, at = capacity, len(bins)
            bins.append([])
        bins[at].append(item)
        by_free[free - size].append(at)
        some_free |= 1 << (free - size)
    return bins


class Search:
    """Exchanges between the emptiest bin and others, each raising the sum of squared fills.

    A bin with ``free`` places that gives ``size`` can take up to ``room = size + free``.
    Taking ``t`` from a bin filled to ``base`` gains (t - size) * (capacity - base + t -
    room), so of all offers of a room only the smallest counts: that is the index.
    """

    def __init__(self, lengths: np.ndarray, bins: list[list[int]], capacity: int):
        self.size = [int(x) for x in lengths]
        self.capacity = capacity
        self.bins = {k: list(b) for k, b in enumerate(bins)}
        self.fill = {k: sum(self.size[i] for i in b) for k, b in self.bins.items()}
        self.version = dict.fromkeys(self.bins, 0)
        self.offers: dict[int, dict[int, tuple[int, ...]]] = {}
        self.by_room: list[list[tuple[int, int, int]]] = [[] for _ in range(capacity + 1)]  # heaps of (size, bin, version)
        self.smallest = np.full(capacity + 1, capacity + 1, np.int64)
        for k in self.bins:
            self._offer(k)

    def _offer(self, k: int) -> None:
        """What a bin with room can give in exchange: nothing, an item, or two."""
        if self.fill[k] < self.capacity:
            items = sorted(set(self.bins[k]), key=lambda i: self.size[i])
            found = {0: ()} | {self.size[i]: (i,) for i in items}
            for n, a in enumerate(items):
                for b in items[n + 1 :]:
                    found.setdefault(self.size[a] + self.size[b], (a, b))
            self.offers[k] = found
            free = self.capacity - self.fill[k]
            for size in found:
                heapq.heappush(self.by_room[size + free], (size, k, self.version[k]))
                self.smallest[size + free] = min(size, self.smallest[size + free])

    def _withdraw(self, k: int) -> None:
        """Take back all offers of a bin, before its contents change or while it is the source."""
        self.version[k] += 1
        free = self.capacity - self.fill[k]
        for size in self.offers.pop(k, ()):
            heap = self.by_room[size + free]
            while heap and heap[0][2] != self.version.get(heap[0][1]):
                heapq.heappop(heap)
            self.smallest[size + free] = heap[0][0] if heap else self.capacity + 1

    def _best(self, source: int) -> tuple[int, int, tuple[int, ...]] | None:
        """(bin, size it gives, items it takes) with the largest gain; the source's offers are withdrawn."""
        mine = sorted(set(self.bins[source]), key=lambda i: -self.size[i])
        takes = {self.size[i]: (i,) for i in mine}
        for n, a in enumerate(mine):
            for b in mine[n + 1 :]:
                takes.setdefault(self.size[a] + self.size[b], (a, b))
        left = self.capacity - self.fill[source]
        best, found = 0, None
        for size, items in takes.items():
            if size > self.capacity:
                continue
            more = size - self.smallest[size:]
            gain = np.where(more > 0, more * (left - self.distance[: len(more)]), 0)
            at = int(gain.argmax())
            if gain[at] > best:
                given, target, _ = self.by_room[size + at][0]
                best, found = int(gain[at]), (target, given, items)
        return found

    def run(self, steps: int | None = None) -> list[list[int]]:
        """Search until the bound is met or no bin gains, or for a number of tries."""
        least = -(-sum(self.fill.values()) // self.capacity)
        self.distance = np.arange(self.capacity + 1)
        queue = [(self.fill[k], k, self.version[k]) for k in self.offers]
        heapq.heapify(queue)
        stuck: dict[int, int] = {}  # bins that found no exchange, and after how many changes
        changes = 0
        while len(self.bins) > least and steps != 0:
            if not queue:
                # What has changed since may help a bin that was stuck.
                again = [k for k, at in stuck.items() if at < changes and k in self.offers]
                queue = [(self.fill[k], k, self.version[k]) for k in again]
                heapq.heapify(queue)
                if not queue:
                    break
            _, source, version = heapq.heappop(queue)
            if source not in self.offers or version != self.version[source]:
                continue
            self._withdraw(source)
            move = self._best(source)
            steps = None if steps is None else steps - 1
            if move is None:
                stuck[source] = changes
                self._offer(source)
                continue
            target, given, taken = move
            back = self.offers[target][given]
            self._withdraw(target)
            changes += 1
            for k, out, into in ((source, taken, back), (target, back, taken)):
                self.bins[k] = [i for i in self.bins[k] if i not in out] + list(into)
                self.fill[k] = sum(self.size[i] for i in self.bins[k])
                stuck.pop(k, None)
                if not self.bins[k]:
                    del self.bins[k], self.fill[k]
                    continue
                self._offer(k)
                if k in self.offers:
                    heapq.heappush(queue, (self.fill[k], k, self.version[k]))
        return list(self.bins.values())


def pack_lengths(lengths: np.ndarray, capacity: int, steps: int | None = None) -> list[list[int]]:
    """Bins of item indexes: best fit, then the search where the count is above its lower bound."""
    bins = best_fit(lengths, capacity)
    if len(bins) * capacity - int(lengths.sum()) < capacity:
        return bins
    return Search(lengths, bins, capacity).run(steps)


def assign(cuts: DataFrame, settings: Settings) -> DataFrame:
    """Stored pieces with ``sequence_id`` and ``offset``."""
    groups = max(1, -(-cuts.count() // settings.group))
    capacity = settings.capacity

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(list(batches)).combine_chunks() if (batches := list(batches)) else None
        if rows is None or not rows.num_rows:
            return
        lengths = rows.column("length").to_numpy()
        sequence = np.zeros(len(lengths), np.int64)
        offset = np.zeros(len(lengths), np.int64)
        first = TaskContext.get().partitionId() << 32
        for k, items in enumerate(pack_lengths(lengths, capacity)):
            sequence[items] = first + k
            offset[items] = np.concatenate([[0], np.cumsum(lengths[items])[:-1]])
        out = rows.append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offset))
        yield from out.to_batches()

    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cuts.schema.fields)
    return cuts.repartition(groups).mapInArrow(pack, ddl + ", sequence_id long, offset long")


def pack(docs: DataFrame, settings: Settings) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset), a row per piece."""
    return assign(stored(cut(docs, settings), "pieces"), settings)


def sequences(docs: DataFrame, settings: Settings) -> DataFrame:
    """(sequence_id, ids): the packed sequences themselves, each of at most ``capacity`` ids."""
    placed = assign(stored(cut(docs, settings, with_ids=True), "pieces"), settings)
    ordered = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return placed.groupBy("sequence_id").agg(ordered.alias("parts")).select(
        "sequence_id",
        F.unhex(F.array_join(F.transform("parts", lambda p: F.hex(p["ids"])), "")).alias("ids"),
    )
