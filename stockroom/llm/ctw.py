"""Language-model scores by context-tree weighting, beside a smoothed unigram base.

Bytes are coded as eight binary decisions. The context of a byte is what stands before
it, the latest byte first: every depth from no bit to the 16 bits of two bytes, then
three to six whole bytes, has a Krichevsky-Trofimov estimate of each decision.
Context-tree weighting mixes all depths: a node's weighted probability is the mean of its
own estimate and the product of its children's, and a prediction follows the posterior
weights down the tree. A text's score is the log10 probability of its bytes and its end.

Neither words nor deep contexts have a bound, so neither is gathered. Texts are read in
blocks, about ``BLOCK`` bytes of consecutive texts of an input partition.

1. A block lists its distinct words and its distinct :func:`grams` (six bytes and the
   next) with their training counts. A shuffle by word sums the words' counts.
2. The grams are packed into slices of their last three context bytes, the ``top``, and shuffled
   by slice; many blocks are first merged in parts, so that a frequent top is no hot key. A
   top's distinct grams hold its whole subtree: depths three to six are weighed there.
3. Sums of the subtrees and of the counts by two bytes (at most 2**24 each, whatever
   the input) weigh the upper tree, which is broadcast.
4. Every distinct gram gets its log probability, and goes back to the blocks that list
   it, as the words' totals do. Blocks meet a slice's predictions some at a time.

Defined results: a NULL or empty text has only its end; a NULL id is not held out; every
row is a text of its own, repeated rows count as often as they occur; an empty table
gives an empty result; without training texts the word counts are 0 and every decision
is even; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import mixed, pieces, stored, word_hashes, words

DEPTH = 16  # bits of context of the upper tree
DEEPEST = 6  # bytes of context
END_WORD = b"\n"  # no word holds a newline
BLOCK = 24_000_000  # bytes of text in a block; the last text may go beyond
PIECE = 1_000_000  # bytes of text taken at once
SHARE = 1_000_000  # grams of a task, on average
TOGETHER = 1024  # blocks whose lists of a slice meet in a task
NODES = 8  # decisions of a byte
SLICES = 4096  # groups of tops


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Stirling's series after a shift by eight."""
    x = np.asarray(x, np.float64)
    low = np.zeros_like(x)
    for k in range(8):
        low += np.log(x + k)
    y = x + 8
    return (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - low


def kt_block(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log of the Krichevsky-Trofimov probability of a sequence with these counts."""
    return log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - log_gamma(zeros + ones + 1) - math.log(math.pi)


@dataclass(frozen=True)
class Tree:
    """Row of each 16-bit context. A row predicts a one at each decision of the next byte:
    ``fixed`` plus ``passed`` times what the deeper context predicts (even where it was not seen)."""

    row: np.ndarray
    fixed: np.ndarray
    passed: np.ndarray


def weigh(keys: np.ndarray, counts: np.ndarray, deep: tuple[np.ndarray, np.ndarray] | None = None) -> Tree:
    """Build the upper tree from counts of (context << 8 | next byte).

    ``deep`` has, for (context << 8 | decision), the log of what the subtrees below that context
    weigh; without it the tree ends here.
    """
    contexts, at = np.unique(keys >> 8, return_inverse=True)
    heap = np.zeros((len(contexts), 512))
    np.add.at(heap, (at, 256 + (keys & 255)), counts)
    for node in range(255, 0, -1):
        heap[:, node] = heap[:, 2 * node] + heap[:, 2 * node + 1]
    # Per depth from the deepest: contexts seen, KT prediction of a one, posterior weight of stopping here.
    levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    below = None
    if deep is not None:
        below = np.zeros((len(contexts), 255))
        below[np.searchsorted(contexts, deep[0] >> 8), (deep[0] & 255) - 1] = deep[1]
    for depth in range(DEPTH, -1, -1):
        if depth < DEPTH:
            contexts, parent = np.unique(contexts >> 1, return_inverse=True)
            starts = np.flatnonzero(np.diff(parent, prepend=-1))
            heap = np.add.reduceat(heap, starts, axis=0) if len(starts) else heap
            below = np.add.reduceat(below, starts, axis=0) if len(starts) else below
        zeros, ones = heap[:, 2:512:2], heap[:, 3:512:2]  # of nodes 1 to 255
        own = kt_block(zeros, ones)
        if below is None:
            weighted, stop = own, np.ones_like(own)
        else:
            weighted = np.logaddexp(own, below) - math.log(2)
            stop = np.exp(own - math.log(2) - weighted)
        levels.append((contexts, (ones + 0.5) / (zeros + ones + 1), stop))
        below = weighted

    # A context that leaves the tree at some depth shares its row with all that leave it at the same node.
    every = np.arange(1 << DEPTH)
    left_at = np.full(1 << DEPTH, -1)
    for depth, (seen, _, _) in zip(range(DEPTH, -1, -1), levels, strict=True):
        inside = np.isin(every >> (DEPTH - depth), seen) & (left_at < 0)
        left_at[inside] = depth
    name = np.where(left_at < 0, 0, (left_at + 1) << DEPTH | (every >> (DEPTH - np.maximum(left_at, 0))))
    _, first, row = np.unique(name, return_index=True, return_inverse=True)
    fixed, passed = np.zeros((len(first), 255)), np.ones((len(first), 255))
    for depth, (seen, kt, stop) in zip(range(DEPTH, -1, -1), levels, strict=True):
        inside = np.flatnonzero(left_at[first] >= depth)
        if len(inside):
            at = np.searchsorted(seen, first[inside] >> (DEPTH - depth))
            fixed[inside] = stop[at] * kt[at] + (1 - stop[at]) * fixed[inside]
            passed[inside] *= 1 - stop[at]
    return Tree(row.astype(np.int32), fixed, passed)


class Subtrees:
    """Depths three to six over sorted distinct grams: per depth and decision its nodes' ids,
    predictions of a one and posterior weights of stopping, and the weight of each whole subtree.

    The id of a node is the context, then the bits of the next byte that are already known.
    """

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        self.levels: dict[int, list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = {}
        below: list[np.ndarray] | None = None
        for depth in range(DEEPEST, 2, -1):
            nodes, weighted = [], []
            for k in range(NODES):
                known = keys >> (8 - k)
                starts = np.flatnonzero(np.diff(known, prepend=-1))
                total = np.add.reduceat(counts, starts)
                ones = np.add.reduceat(counts * (keys >> (7 - k) & 1), starts)
                own = kt_block(total - ones, ones)
                both = own if below is None else np.logaddexp(own, below[k]) - math.log(2)
                stop = np.ones_like(own) if below is None else np.exp(own - math.log(2) - both)
                nodes.append((known[starts], (ones + 0.5) / (total + 1), stop))
                weighted.append(both)
            self.levels[depth] = nodes
            shorter = keys >> 16 << 8 | keys & 255
            above, at = np.unique(shorter, return_inverse=True)
            below, parents = [], []
            for k, (ids, _, _) in enumerate(nodes):
                parent, to = np.unique(_shorter(ids, k), return_inverse=True)
                parents.append(parent)
                below.append(np.bincount(to, weighted[k], len(parent)))
            keys, counts = above, np.bincount(at, counts, len(above))
        self.bytes = keys, counts  # counts of (two bytes of context << 8 | next byte)
        # Weights of the subtrees by (two bytes of context << 8 | decision).
        self.slots = [((p >> k) << 8 | 1 << k | p & ((1 << k) - 1), w) for k, (p, w) in enumerate(zip(parents, below, strict=True))]

    def ones(self, keys: np.ndarray, k: int) -> np.ndarray:
        """Chance of a one at decision ``k`` of each gram; even where the context was not seen."""
        chance = np.full(len(keys), 0.5)
        for depth in range(DEEPEST, 2, -1):
            ids, kt, stop = self.levels[depth][k]
            node = (keys >> (8 * (DEEPEST - depth) + 8)) << k | (keys & 255) >> (8 - k)
            at = np.minimum(np.searchsorted(ids, node), len(ids) - 1)
            seen = np.flatnonzero(ids[at] == node)
            at = at[seen]
            chance[seen] = stop[at] * kt[at] + (1 - stop[at]) * chance[seen]
        return chance


def _shorter(ids: np.ndarray, k: int) -> np.ndarray:
    """Node ids without the oldest byte of their context."""
    return (ids >> (k + 8)) << k | ids & ((1 << k) - 1)


def predict(keys: np.ndarray, counts: np.ndarray, tree: Tree) -> np.ndarray:
    """Log10 probability of each gram's last byte; ``keys`` hold whole tops, sorted, some with no count."""
    trained = counts > 0
    deep = Subtrees(keys[trained], counts[trained].astype(np.float64)) if trained.any() else None
    row, byte = tree.row[keys >> 40], keys & 255
    logs = np.zeros(len(keys))
    for k in range(NODES):
        node = (1 << k | byte >> (8 - k)) - 1
        one = tree.fixed[row, node] + tree.passed[row, node] * (0.5 if deep is None else deep.ones(keys, k))
        logs += np.log10(np.where(byte >> (7 - k) & 1, one, 1 - one))
    return logs


def grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Six bytes of context, the latest first, and the byte, of every byte and end, as one number each
    (zeros stand before a text, 255 for its end); and where each text starts."""
    gap = b"\0" * DEEPEST
    data = np.frombuffer(b"".join(gap + t + b"\xff" for t in texts), np.uint8).astype(np.int64)
    sizes = np.array([len(t) + 1 for t in texts], np.int64)
    starts = np.cumsum(sizes) - sizes
    key = data[DEEPEST:].copy()
    for back in range(1, DEEPEST + 1):
        key |= data[DEEPEST - back : len(data) - back] << (8 * (DEEPEST + 1 - back))
    own = np.ones(len(key), bool)  # not the zeros before the other texts
    for gone in range(DEEPEST):
        own[(starts + np.arange(len(starts)) * DEEPEST - 1 - gone)[1:]] = False
    return key[own], starts


class Sums:
    """Distinct keys with their summed counts, merged whenever much has come in."""

    def __init__(self):
        self.keys, self.counts = np.empty(0, np.int64), np.empty(0, np.int64)
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.waiting = 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.parts.append((keys, counts))
        self.waiting += len(keys)
        if self.waiting > max(500_000, len(self.keys) // 2):
            self.merged()

    def merged(self) -> tuple[np.ndarray, np.ndarray]:
        if self.parts:
            keys = np.concatenate([self.keys, *(k for k, _ in self.parts)])
            counts = np.concatenate([self.counts, *(n for _, n in self.parts)])
            order = np.argsort(keys, kind="stable")  # the parts are mostly sorted stretches
            keys, counts = keys[order], counts[order]
            starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[: len(keys)])
            self.keys, self.counts = keys[starts], np.add.reduceat(counts, starts) if len(starts) else counts
            self.parts, self.waiting = [], 0
        return self.keys, self.counts


def squeezed(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers from 0 to 2**56 - 1 in groups of seven bits, the lowest first, and how many bytes each takes."""
    sizes = np.ones(len(values), np.int64)
    for k in range(1, 8):
        sizes += values >= 1 << 7 * k
    at = np.cumsum(sizes) - sizes
    out = np.empty(int(sizes.sum()), np.uint8)
    left = np.arange(len(values))
    for k in range(8):
        more = sizes[left] > k + 1
        out[at[left] + k] = (values[left] >> 7 * k) & 127 | more << 7
        left = left[more]
    return out, sizes


def stretched(data: np.ndarray) -> np.ndarray:
    """The numbers that :func:`squeezed` wrote."""
    ends = np.flatnonzero(data < 128)
    starts = np.append(0, ends[:-1] + 1)[: len(ends)]
    out = np.zeros(len(ends), np.int64)
    for k in range(int((ends - starts).max(initial=-1)) + 1):
        some = np.flatnonzero(ends - starts >= k)
        out[some] |= (data[starts[some] + k] & 127).astype(np.int64) << 7 * k
    return out


def _cut(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Stretches of an array as binary values."""
    places = pa.py_buffer((bounds * values.itemsize).astype(np.int32))
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, places, pa.py_buffer(np.ascontiguousarray(values))])


def _squeezed(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    data, sizes = squeezed(values)
    return _cut(data, np.append(0, np.cumsum(sizes))[bounds])


def _values(column: pa.Array | pa.ChunkedArray, kind) -> np.ndarray:
    """All binary values of a column, one after the other."""
    chunks = column.chunks if isinstance(column, pa.ChunkedArray) else [column]
    return np.concatenate([np.empty(0, kind), *(np.frombuffer(b"".join(c.to_pylist()), kind) for c in chunks)])


def unpacked(rows: pa.RecordBatch | pa.Table) -> np.ndarray:
    """Grams of packed rows, in their order."""
    sums = np.cumsum(stretched(_values(rows.column("grams"), np.uint8)))
    sizes = rows.column("size").to_numpy()
    ends = np.cumsum(sizes)
    return sums - np.repeat(np.append(0, sums[ends[:-1] - 1])[: len(sizes)], sizes)


def _packs(keys: np.ndarray, counts: np.ndarray | None = None, logs: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
    """Packed rows of sorted grams: a row a slice, which holds whole tops; grams by their differences."""
    starts = np.flatnonzero(np.diff(keys >> 32, prepend=-1))
    own = (mixed((keys[starts] >> 32).astype(np.uint64)) % np.uint64(SLICES)).astype(np.uint16)
    of = np.repeat(own, np.diff(np.append(starts, len(keys))))
    order = np.argsort(of, kind="stable")
    of, keys = of[order], keys[order]
    starts = np.flatnonzero(np.diff(of.astype(np.int64), prepend=-1))
    bounds = np.append(starts, len(keys))
    steps = np.diff(keys, prepend=0)
    steps[starts] = keys[starts]
    counts, logs = (None if v is None else v[order] for v in (counts, logs))
    at = 0
    while at < len(starts):  # about a quarter of a million grams a batch
        end = max(at + 1, int(np.searchsorted(bounds, bounds[at] + 250_000, "right")) - 1)
        low, high = bounds[at], bounds[end]
        spans = bounds[at : end + 1] - low
        columns = {
            "slice": pa.array(of[starts[at:end]].astype(np.int32)),
            "size": pa.array(np.diff(spans).astype(np.int32)),
            "grams": _squeezed(steps[low:high], spans),
        }
        if counts is not None:
            columns["counts"] = _squeezed(counts[low:high], spans)
        if logs is not None:
            columns["logs"] = _cut(logs[low:high], spans)
        yield pa.RecordBatch.from_pydict(columns)
        at = end


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Consecutive texts and the number of their block, which batch bounds do not change."""
    partition, read = TaskContext.get().partitionId(), 0
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        number = (read + np.cumsum(sizes) - sizes) // BLOCK
        read += int(sizes.sum())
        starts = np.flatnonzero(np.diff(number, prepend=-1))
        for at, end in zip(starts, [*starts[1:], len(number)], strict=True):
            yield partition << 24 | int(number[at]), batch.slice(at, end - at)


def _bytes(texts: list[str | None]) -> list[bytes]:
    return [(t or "").encode("utf-8", "replace") for t in texts]


def _hashes(text: str | None) -> np.ndarray:
    return word_hashes([*words(text), END_WORD]).view(np.int64)


def gathered(docs: DataFrame, trained: Column) -> DataFrame:
    """A block's distinct words (``key``, ``n``) and its grams (``slice``, ``size``, ``grams``, ``counts``), trained counts beside them."""

    def listed(block: int, of_words: Sums, of_grams: Sums) -> Iterator[pa.RecordBatch]:
        def rows(batch: pa.RecordBatch) -> pa.RecordBatch:
            n, have = batch.num_rows, dict(zip(batch.schema.names, batch.columns, strict=True))
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(n, block)) if f.name == "block" else have[f.name].cast(f.type) if f.name in have else pa.nulls(n, f.type)
                    for f in LISTED
                ],
                schema=LISTED,
            )

        keys, n = of_words.merged()
        for at in range(0, len(keys), 100_000):
            yield rows(pa.RecordBatch.from_pydict({"key": keys[at : at + 100_000], "n": n[at : at + 100_000]}))
        keys, n = of_grams.merged()
        yield from map(rows, _packs(keys, counts=n))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current = None
        for block, some in _blocks(batches):
            if block != current:
                if current is not None:
                    yield from listed(current, of_words, of_grams)
                current, of_words, of_grams = block, Sums(), Sums()
            for part, texts in pieces([some], chars=PIECE):
                learn = part.column("learn").to_pylist()
                for used in (True, False):
                    own = [t for t, x in zip(texts, learn, strict=True) if x is used]
                    if own:
                        for sums, found in ((of_words, np.concatenate([_hashes(t) for t in own])), (of_grams, grams(_bytes(own))[0])):
                            distinct, n = np.unique(found, return_counts=True)
                            sums.add(distinct, n if used else np.zeros_like(n))
        if current is not None:
            yield from listed(current, of_words, of_grams)

    return docs.select("text", trained.alias("learn")).mapInArrow(
        count, "block long, key long, n long, slice int, size int, grams binary, counts binary"
    )


LISTED = pa.schema(
    [("block", pa.int64()), ("key", pa.int64()), ("n", pa.int64()), ("slice", pa.int32()), ("size", pa.int32()),
     ("grams", pa.binary()), ("counts", pa.binary())]
)


def _merged(packs: DataFrame, tasks: int, *by: str | Column) -> DataFrame:
    """Packed rows with the counts of equal grams added up, ``by`` deciding which rows meet."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = Sums()
        for batch in batches:
            sums.add(unpacked(batch), stretched(_values(batch.column("counts"), np.uint8)))
        keys, counts = sums.merged()
        yield from _packs(keys, counts=counts)

    met = packs.repartition(tasks, *by).select("slice", "size", "grams", "counts")
    return met.mapInArrow(merge, "slice int, size int, grams binary, counts binary")


def _portions(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Sorted grams and their counts of some whole slices at a time, about ``SHARE`` / 4 grams or one slice."""
    for batch in batches:
        ends = np.cumsum(batch.column("size").to_numpy())
        at = 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(ends, before + SHARE // 4, "right")))
            some = batch.slice(at, end - at)
            keys, counts = unpacked(some), stretched(_values(some.column("counts"), np.uint8))
            order = np.argsort(keys, kind="stable")
            yield keys[order], counts[order]
            at = end


def _upper(merged: DataFrame) -> Tree:
    """The tree of the first two bytes, from what the subtrees of all tops sum up to."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, counts in _portions(batches):
            keys, counts = keys[counts > 0], counts[counts > 0]
            if len(keys):
                deep = Subtrees(keys, counts.astype(np.float64))
                for is_count, slots, values in [(True, *deep.bytes), *((False, *s) for s in deep.slots)]:
                    yield pa.RecordBatch.from_pydict(
                        {"is_count": np.full(len(slots), is_count), "slot": slots.astype(np.int32), "value": values.astype(np.float64)}
                    )

    parts = merged.mapInArrow(sums, "is_count boolean, slot int, value double")
    found = parts.groupBy("is_count", "slot").agg(F.sum("value").alias("value")).toPandas().sort_values("slot")
    counts, deep = found[found["is_count"]], found[~found["is_count"].astype(bool)]
    return weigh(
        counts["slot"].to_numpy(np.int64), counts["value"].to_numpy(np.float64),
        (deep["slot"].to_numpy(np.int64), deep["value"].to_numpy(np.float64)),
    )


def _answered(listed: DataFrame) -> DataFrame:
    """(block, size, grams, logs): the log probability of every gram a block lists."""
    total, most = listed.agg(F.sum("size"), F.count_distinct("block")).first()
    tasks, parts = 1 + (total or 0) // SHARE, 1 + most // TOGETHER
    part = F.col("block") % parts
    merged = listed if parts == 1 else _merged(listed, tasks, "slice", part)
    merged = stored(_merged(merged, tasks, "slice"), "grams")
    shared = listed.sparkSession.sparkContext.broadcast(_upper(merged))

    def rated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, counts in _portions(batches):
            yield from _packs(keys, logs=predict(keys, counts, shared.value).astype(np.float32))

    def look_up(lists: pa.Table, model: pa.Table) -> pa.Table:
        keys, logs = unpacked(model), _values(model.column("logs"), np.float32)
        order = np.argsort(keys, kind="stable")
        lists = lists.combine_chunks()
        own = logs[order][np.searchsorted(keys[order], unpacked(lists))]
        bounds = np.append(0, np.cumsum(lists.column("size").to_numpy()))
        return lists.select(["block", "size", "grams"]).append_column("logs", _cut(own, bounds))

    group = F.pmod(F.hash("slice"), F.lit(tasks))
    model = merged.mapInArrow(rated, "slice int, size int, grams binary, logs binary")
    model = model.select("size", "grams", "logs", group.alias("share"), F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"))
    lists = listed.select("block", "size", "grams", group.alias("share"), part.cast("int").alias("part"))
    both = lists.groupBy("share", "part").cogroup(model.groupBy("share", "part"))
    return both.applyInArrow(look_up, "block long, size int, grams binary, logs binary")


def score(docs: DataFrame, held_out: Column) -> DataFrame:
    """One row per text: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte.

    ``docs`` must be a stored table: blocks are cut from the partitions of its scan, which both
    passes read alike. Should they not, a word or gram without its total raises an error.
    """
    held = F.coalesce(held_out, F.lit(False))
    counts = stored(gathered(docs, ~held), "counts")
    by_word = Window.partitionBy("key")
    totals = stored(
        counts.filter("key IS NOT NULL").select(
            "block", "key", "n", F.sum("n").over(by_word).alias("c"), F.min("block").over(by_word).alias("first")
        ),
        "totals",
    )
    sizes = totals.agg(F.sum("n").alias("n"), F.count_if((F.col("c") > 0) & (F.col("block") == F.col("first"))).alias("v"))
    n_train, n_words = sizes.first()
    n_train = n_train or 0
    answers = _answered(counts.filter("slice IS NOT NULL").select("block", "slice", "size", "grams", "counts"))
    unit = math.log10(n_train + n_words + 1)

    def found(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        at = np.searchsorted(keys, wanted)
        if (at >= len(keys)).any() or (keys[at] != wanted).any():
            raise RuntimeError("the two passes read different partitions; store the table first")
        return at

    def rate(texts_of: pa.Table, listed: pa.Table) -> pa.Table:
        words_of, grams_of = (listed.filter(pc.is_valid(listed.column(c))) for c in ("key", "grams"))
        order = np.argsort(words_of.column("key").to_numpy())
        keys, totals = (words_of.column(c).to_numpy()[order] for c in ("key", "c"))
        gains = np.log10(totals + 1.0)
        spots, logs = unpacked(grams_of), _values(grams_of.column("logs"), np.float32)
        order = np.argsort(spots, kind="stable")
        spots, logs = spots[order], logs[order].astype(np.float64)
        out = {c: [] for c in ("doc_id", "held_out", "n_tokens", "n_known", "base_score", "score", "bits")}
        for some in texts_of.column("texts"):
            for part, texts in pieces(pa.ipc.open_stream(some.as_buffer()), chars=PIECE):
                hashes = [_hashes(t) for t in texts]
                at = found(keys, np.concatenate(hashes))
                sizes = np.array([len(f) for f in hashes])
                starts = np.cumsum(sizes) - sizes
                out["n_tokens"].append(sizes)
                out["n_known"].append(np.add.reduceat((totals[at] > 0).astype(np.int64), starts))
                out["base_score"].append(np.add.reduceat(gains[at], starts) - sizes * unit)
                data = _bytes(texts)
                every, starts = grams(data)
                order = np.argsort(every)  # sought in order, the table is read in order
                each = np.empty(len(every))
                each[order] = logs[found(spots, every[order])]
                total = np.add.reduceat(each, starts)
                out["score"].append(total)
                out["bits"].append(-total / math.log10(2) / np.array([len(t) + 1 for t in data]))
                out["doc_id"].append(part.column("doc_id"))
                out["held_out"].append(part.column("held_out"))
        rows = sum(map(len, out["doc_id"]))
        return pa.table(
            {
                "doc_id": pa.chunked_array(out["doc_id"], pa.int64()),
                "held_out": pa.chunked_array(out["held_out"], pa.bool_()),
                **{c: pa.array(np.concatenate(out[c]), pa.int64()) for c in ("n_tokens", "n_known")},
                "train_tokens": pa.array(np.full(rows, n_train), pa.int64()),
                **{c: pa.array(np.concatenate(out[c]), pa.float64()) for c in ("base_score", "score")},
                "bits_per_byte": pa.array(np.concatenate(out["bits"]), pa.float64()),
            }
        )

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, some in _blocks(batches):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, some.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
                stream.write_batch(some)
            yield pa.RecordBatch.from_pydict({"block": [block], "texts": [sink.getvalue().to_pybytes()]})

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", held.alias("held_out"))
    texts = texts.mapInArrow(numbered, "block long, texts binary")  # compressed: every text is shuffled once
    none = {c: F.lit(None).cast(t).alias(c) for c, t in (("key", "long"), ("c", "long"), ("size", "int"), ("grams", "binary"), ("logs", "binary"))}
    listed = totals.select("block", "key", "c", *(none[c] for c in ("size", "grams", "logs"))).unionAll(
        answers.select("block", none["key"], none["c"], "size", "grams", "logs")
    )
    return texts.groupBy("block").cogroup(listed.groupBy("block")).applyInArrow(
        rate,
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
        "base_score double, score double, bits_per_byte double",
    )
