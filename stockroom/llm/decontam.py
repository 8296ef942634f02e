"""Benchmark decontamination by spaced-seed hashing.

A mask names the word positions of a window that enter its hash; the others may differ.
Two fixed masks find every 13-word window with up to two words substituted: whatever the
two positions, one of the masks avoids them somewhere inside the window (a test tries
all). Hashes of the benchmark fill a bit table of fixed size; documents are hashed in
tasks, positions whose bits are set become regions of hashed words, and Spark joins their
hashes with the benchmark's. A joined pair fixes an alignment, and alignments are
verified word by word: a window of 13 words with 11 or more equal is contamination.
Benchmark items shorter than a window are sought whole, with the same share of equal
words: one substitution from 7 words on, none below. Three masks, each without every
third position, find those of 7 to 12 words; one solid mask those of fewer.

Words are those of :func:`.common.words` without ASCII punctuation at their ends.

Defined results: a NULL or empty text is clean; a NULL or empty item, or one of fewer
than :attr:`Settings.least` words, finds nothing (:func:`unsought` lists them); repeated rows get equal verdicts;
equal ids with different texts are judged one by one; equal item ids are told apart by
their texts and reported under their id; empty tables give an empty or a clean result;
extra columns are kept by :func:`remove` and ignored by :func:`find`.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import GOLD, WORD_BYTES, WORDS_KEPT, fresh, mixed, pieces, stored, words

# Positions of a window that the two masks hash.
MASKS = ((0, 1, 3, 6, 7, 8), (0, 3, 4, 6, 8, 9))
PUNCTUATION = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


@dataclass(frozen=True)
class Settings:
    window: int = 13  # words
    equal: int = 11  # of a window, at the same places
    least: int = 5  # words of the shortest item that is sought
    bits: int = 1 << 25  # of the table of benchmark hashes; its size never changes results

    def masks(self) -> list[tuple[int, ...]]:
        """The masks of whole windows, then those of short items, three places for each length from 1."""
        short = (m for n in range(1, self.window) for m in self._short(n))
        return [*MASKS, *short]

    def _short(self, n: int) -> list[tuple[int, ...]]:
        if self.needed(n) == n:
            return [tuple(range(n))] * 3
        return [tuple(i for i in range(n) if i % 3 != r) for r in range(3)]

    def used(self, n: int) -> list[int]:
        """Which masks an item of ``n`` words has."""
        if n < self.least:
            return []
        if n >= self.window:
            return list(range(len(MASKS)))
        first = len(MASKS) + 3 * (n - 1)
        return [first] if self.needed(n) == n else [first, first + 1, first + 2]

    def needed(self, n: int) -> int:
        """Equal words that an item of ``n`` words, or a window of it, must have."""
        return self.equal if n >= self.window else -(-n * self.equal // self.window)


class _Bare(dict):
    """Hash of a word without punctuation at its ends; 0 if nothing is left."""

    def __missing__(self, word: bytes) -> int:
        bare = word.strip(PUNCTUATION)
        value = (xxhash.xxh64_intdigest(bare) or 1) if bare else 0
        if len(word) <= WORD_BYTES:
            if len(self) >= WORDS_KEPT:
                self.clear()
            self[word] = value
        return value


_bare = _Bare()


def hashed_words(text: str | None) -> np.ndarray:
    tokens = words(text)
    h = np.fromiter(map(_bare.__getitem__, tokens), np.uint64, len(tokens))
    return h[h != 0]


def seeds(h: np.ndarray, mask: tuple[int, ...], number: int) -> np.ndarray:
    """Hash of every window under a mask, by its first word's place."""
    n = len(h) - mask[-1]
    if n <= 0:
        return np.empty(0, np.uint64)
    with np.errstate(over="ignore"):
        total = np.full(n, np.uint64(number + 1), np.uint64)
        for place in mask:
            total = total * GOLD + h[place : place + n]
        return mixed(total)


def item_seeds(benchmark: DataFrame, settings: Settings) -> DataFrame:
    """(key, item, item_id, place, words): a row per hash; ``words`` are the item's hashed words."""
    masks = settings.masks()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in pieces(batches):
            for row, text in enumerate(texts):
                h = hashed_words(text)
                used = settings.used(len(h))
                if not used:
                    continue
                found = [seeds(h, masks[m], m) for m in used]
                keys = np.concatenate(found)
                n = len(keys)
                item = int(np.int64(np.uint64(xxhash.xxh64_intdigest(h.tobytes()))))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(keys.view(np.int64)),
                        pa.array(np.full(n, item)),
                        part.column("item_id").take(pa.array([row] * n)),
                        pa.array(np.concatenate([np.arange(len(f)) for f in found])),
                        pa.array([h.tobytes()] * n, pa.binary()),
                    ],
                    names=["key", "item", "item_id", "place", "words"],
                )

    chosen = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text")
    return chosen.mapInArrow(cut, "key long, item long, item_id long, place long, words binary")


def unsought(benchmark: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(item_id, n_words) of the items that are too short to be sought, NULL and empty ones included."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in pieces(batches):
            sizes = pa.array([len(hashed_words(t)) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([part.column("item_id"), sizes], names=["item_id", "n_words"])

    chosen = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text")
    return chosen.mapInArrow(count, "item_id long, n_words long").filter(F.col("n_words") < settings.least)


def _table(keys: DataFrame, bits: int) -> np.ndarray:
    """A bit table with two bits set per key; at most ``bits / 64`` rows reach the driver."""
    slots = bits // 64

    def bit(shift: int):
        at = F.pmod(F.shiftrightunsigned("key", shift), F.lit(bits))
        return F.struct((at / 64).cast("long").alias("slot"), F.pmod(at, F.lit(64)).cast("int").alias("bit"))

    rows = (
        keys.select(F.explode(F.array(bit(0), bit(31))).alias("b"))
        .groupBy("b.slot")
        .agg(F.bit_or(F.expr("shiftleft(1L, b.bit)")).alias("set"))
        .toPandas()
    )
    out = np.zeros(slots, np.int64)
    out[rows["slot"].to_numpy(np.int64)] = rows["set"].to_numpy(np.int64)
    return out.view(np.uint64)


def _marked(table: np.ndarray, keys: np.ndarray, bits: int) -> np.ndarray:
    def probe(at: np.ndarray) -> np.ndarray:
        at = at % np.uint64(bits)
        return (table[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1)

    hit = probe(keys).astype(bool)
    spots = np.flatnonzero(hit)
    hit[spots] = probe(keys[spots] >> np.uint64(31)).astype(bool)
    return hit


def regions(docs: DataFrame, table: np.ndarray, settings: Settings, used: list[int]) -> DataFrame:
    """(doc_id, place, region, words, keys, at): stretches of a text around hashes in the table."""
    shared = docs.sparkSession.sparkContext.broadcast(table)
    masks = settings.masks()
    reach = settings.window

    def seek(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits_set = shared.value
        for part, texts in pieces(batches):
            rows, region, kept, keys_of, at_of = [], [], [], [], []
            each = [hashed_words(t) for t in texts]
            ends = np.cumsum([len(h) for h in each])
            flat = np.concatenate([*each, np.empty(0, np.uint64)])
            spots, keys = [], []
            for m in used:  # windows across two texts are found here and dropped below
                found = seeds(flat, masks[m], m)
                at = np.flatnonzero(_marked(bits_set, found, settings.bits))
                doc = np.searchsorted(ends, at, "right")
                inside = at + masks[m][-1] < ends[doc]
                spots.append(at[inside])
                keys.append(found[at[inside]])
            spot, key = np.concatenate(spots), np.concatenate(keys)
            order = np.argsort(spot, kind="stable")
            spot, key = spot[order], key[order]
            doc = np.searchsorted(ends, spot, "right")
            breaks = np.flatnonzero((np.diff(spot) > 2 * reach) | (np.diff(doc) > 0)) + 1
            for group in np.split(np.arange(len(spot)), breaks) if len(spot) else []:
                d = int(doc[group[0]])
                first = int(ends[d]) - len(each[d])
                low = max(first, int(spot[group[0]]) - reach)
                high = min(int(ends[d]), int(spot[group[-1]]) + 2 * reach)
                rows.append(d)
                region.append(low - first)
                kept.append(flat[low:high].tobytes())
                keys_of.append(key[group].view(np.int64))
                at_of.append(spot[group] - low)
            if rows:
                take = pa.array(rows, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id").take(take), part.column("place").take(take),
                        pa.array(region, pa.int64()), pa.array(kept, pa.binary()),
                        pa.array(keys_of, pa.list_(pa.int64())), pa.array(at_of, pa.list_(pa.int64())),
                    ],
                    names=["doc_id", "place", "region", "words", "keys", "at"],
                )

    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("place"))
    return chosen.mapInArrow(
        seek, "doc_id long, place long, region long, words binary, keys array<long>, at array<long>"
    )


def _verify(pairs: DataFrame, settings: Settings) -> DataFrame:
    """(doc_id, place, item_id, start, length, equal) of aligned pairs that hold; words count from the text's first."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good, start, length, equal = [], [], [], []
            for row in range(batch.num_rows):
                x = np.frombuffer(batch.column("words")[row].as_py(), np.uint64)
                y = np.frombuffer(batch.column("item_words")[row].as_py(), np.uint64)
                shift = batch.column("shift")[row].as_py()
                low, high = max(0, shift), min(len(x), shift + len(y))
                same = x[low:high] == y[low - shift : high - shift]
                width, need = min(settings.window, len(y)), settings.needed(len(y))
                if len(same) < width:
                    continue
                sums = np.convolve(same, np.ones(width, int), "valid")
                inside = np.flatnonzero(sums >= need)
                if len(inside):
                    good.append(row)
                    start.append(batch.column("region")[row].as_py() + low + int(inside[0]))
                    length.append(int(inside[-1] - inside[0]) + width)
                    equal.append(int(same[inside[0] : inside[-1] + width].sum()))
            part = batch.select(["doc_id", "place", "item_id"]).take(pa.array(good, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*part.columns, *(pa.array(v, pa.int64()) for v in (start, length, equal))],
                names=["doc_id", "place", "item_id", "start", "length", "equal"],
            )

    return pairs.mapInArrow(
        check, "doc_id long, place long, item_id long, start long, length long, equal long"
    )


def overlaps(docs: DataFrame, benchmark: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Verified overlaps: (doc_id, place, item_id, start, length, equal), ``place`` a hash of the text."""
    items = stored(item_seeds(benchmark, settings), "seeds")
    n_words = F.least((F.length("words") / 8).cast("int"), F.lit(settings.window))
    lengths = {r.n for r in items.select(n_words.alias("n")).distinct().collect()}
    used = sorted({m for n in lengths for m in settings.used(n)})
    if not used:
        return docs.sparkSession.createDataFrame(
            [], "doc_id long, place long, item_id long, start long, length long, equal long"
        )
    found = stored(regions(docs, _table(items.select("key"), settings.bits), settings, used).distinct(), "regions")
    hits = found.select("doc_id", "place", "region", F.inline(F.arrays_zip("keys", "at")))
    # Alignments before words: a passage gives many hits but few alignments.
    pairs = (
        hits.withColumnRenamed("keys", "key")
        .join(items.select("key", "item", F.col("place").alias("in_item")), "key")
        .select("doc_id", "place", "region", "item", (F.col("at") - F.col("in_item")).alias("shift"))
        .distinct()
    )
    texts = items.groupBy("item", "item_id").agg(F.first("words").alias("item_words"))
    spots = found.select(
        F.col("doc_id").alias("d"), F.col("place").alias("p"), F.col("region").alias("r"), "words"
    )
    near = (F.col("doc_id").eqNullSafe(F.col("d"))) & (F.col("place") == F.col("p")) & (F.col("region") == F.col("r"))
    return _verify(pairs.join(spots, near).drop("d", "p", "r").join(texts, "item"), settings)


def find(docs: DataFrame, benchmark: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(doc_id, contaminated, items, n_words), a row per document: item ids and the longest overlap."""
    bad = overlaps(docs, benchmark, settings).groupBy("doc_id", "place").agg(
        F.array_sort(F.collect_set("item_id")).alias("items"), F.max("length").alias("n_words"),
        F.lit(True).alias("contaminated"),
    )
    bad = bad.withColumnsRenamed({"doc_id": "d", "place": "p"})
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("place"))
    return rows.join(bad, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("place") == F.col("p")), "left").select(
        "doc_id",
        F.coalesce("contaminated", F.lit(False)).alias("contaminated"),
        F.coalesce("items", F.array().cast("array<long>")).alias("items"),
        F.coalesce("n_words", F.lit(0)).cast("long").alias("n_words"),
    )


def remove(docs: DataFrame, benchmark: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark passage."""
    d, p = fresh(docs, "bad_id"), fresh(docs, "bad_place")
    bad = overlaps(docs, benchmark, settings).select(F.col("doc_id").alias(d), F.col("place").alias(p)).distinct()
    bad = stored(bad, "contaminated")
    same = docs["doc_id"].eqNullSafe(F.col(d)) & (F.xxhash64(docs["text"]) == F.col(p))
    return docs.join(bad.hint("shuffle_hash"), same, "left_anti")
