"""Near-duplicate groups by HyperMinHash.

1. :func:`signatures`: a text's distinct word shingles are hashed; every bucket keeps its
   smallest hash as a leading-zero count plus mantissa bits. Buckets without a shingle
   borrow from others in an order that is fixed for all texts.
2. Texts with equal shingle sets become one node.
3. Banding: registers of a band make a key. Every node of a key's bucket is compared
   with the bucket's smallest node, which is linear in the rows however large the bucket.
4. A pair is estimated from its registers (corrected for registers that collide by
   chance) and, above a slack bound, confirmed on the full shingle sets. Small sets fill
   few buckets, so their estimate says little: they are confirmed without it.
5. Buckets that the links so far leave in several components still owe comparisons:
   their members are compared across components, in blocks inside tasks, by the same
   estimate and confirmation, and a task passes on only links that join what was apart.
   No pair is left out and no pair is written down that does not link.

Defined results: a text without words (NULL, empty or white space) has an empty set and
is linked with nothing, also not with its like; equal ids are one document for linking
and each of their rows is returned; a NULL id is greater than any other when a group's
smallest id is chosen; an empty table gives an empty one; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import GOLD, fresh, mixed, pieces, shingles, stored, words
from .graph import components


@dataclass(frozen=True)
class Settings:
    """With 40 bands of 6 registers a pair at 0.80 meets in no band once in 10^5, at 0.85 once in 10^8."""

    width: int = 5
    percent: int = 80  # link when 100 * common >= percent * all
    bands: int = 40
    rows: int = 6
    mantissa: int = 10  # bits beside the leading-zero count
    slack: float = 0.15  # how far an estimate may fall short before a pair is given up unconfirmed
    few: int = 64  # shingles below which registers are mostly borrowed: such pairs are confirmed without an estimate
    block: int = 2048  # members of a bucket compared at once

    @property
    def buckets(self) -> int:
        return self.bands * self.rows


TRIES = 24


def _donors(buckets: int) -> np.ndarray:
    """For each bucket, the buckets to borrow from, in a fixed pseudo-random order."""
    at = np.arange(buckets * TRIES, dtype=np.uint64)
    with np.errstate(over="ignore"):
        return (mixed((at + np.uint64(1)) * GOLD) % np.uint64(buckets)).astype(np.int64).reshape(buckets, TRIES)


def compress(values: np.ndarray, mantissa: int) -> np.ndarray:
    """Leading zeros (6 bits) and the ``mantissa`` bits after the first one, as one number.

    The exponent and mantissa of a float are these two fields; 53 bits convert exactly.
    """
    bits = ((values >> np.uint64(11)) | np.uint64(1)).astype(np.float64).view(np.uint64)
    zeros = np.uint64(1023 + 52) - (bits >> np.uint64(52))
    kept = (bits >> np.uint64(52 - mantissa)) & np.uint64((1 << mantissa) - 1)
    return (zeros << np.uint64(mantissa) | kept).astype(np.uint16)


def registers(hashes: np.ndarray, settings: Settings, donors: np.ndarray) -> np.ndarray:
    """Compressed registers of sorted distinct hashes, which must not be empty."""
    k = settings.buckets
    at = (hashes % np.uint64(k)).astype(np.int64)
    out = np.zeros(k, np.uint16)
    full = np.zeros(k, bool)
    out[at[::-1]] = compress(hashes[::-1], settings.mantissa)  # the smallest of a bucket is written last
    full[at] = True
    empty = np.flatnonzero(~full)
    for t in range(TRIES):
        if not len(empty):
            return out
        lender = donors[empty, t]
        found = full[lender]
        out[empty[found]] = out[lender[found]]
        empty = empty[~found]
    if len(empty):  # very small sets: the next bucket that has one, around the ring
        own = np.flatnonzero(full)
        out[empty] = out[own[np.searchsorted(own, empty) % len(own)]]
    return out


def band_keys(regs: np.ndarray, settings: Settings) -> np.ndarray:
    """One 64-bit key per text and band from an array of register rows."""
    parts = regs.reshape(len(regs), settings.bands, settings.rows).astype(np.uint64)
    with np.errstate(over="ignore"):
        key = np.arange(1, settings.bands + 1, dtype=np.uint64)[None, :] * GOLD + np.zeros((len(regs), 1), np.uint64)
        for r in range(settings.rows):
            key = mixed(key + parts[:, :, r] + np.uint64(1)) * GOLD
    return mixed(key)


def signatures(docs: DataFrame, settings: Settings) -> DataFrame:
    """(doc_id, place, n, digest, regs): place hashes the text, digest the set; NULL digest for empty sets."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        donors = _donors(settings.buckets)
        for part, texts in pieces(batches):
            sizes, digests, regs = [], [], []
            for text in texts:
                found = shingles(words(text), settings.width)
                sizes.append(len(found))
                digests.append(xxhash.xxh3_128_digest(found.tobytes()) if len(found) else None)
                regs.append(registers(found, settings, donors).tobytes() if len(found) else None)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("place"), pa.array(sizes, pa.int64()),
                 pa.array(digests, pa.binary()), pa.array(regs, pa.binary())],
                names=["doc_id", "place", "n", "digest", "regs"],
            )

    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("place"))
    return chosen.mapInArrow(sign, "doc_id long, place long, n long, digest binary, regs binary")


def _banded(nodes: DataFrame, settings: Settings) -> DataFrame:
    def band(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                regs = np.frombuffer(b"".join(part.column("regs").to_pylist()), np.uint16)
                keys = band_keys(regs.reshape(part.num_rows, -1), settings)
                node = np.repeat(part.column("node").to_numpy(), settings.bands)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.ravel().view(np.int64)), pa.array(node)], names=["key", "node"]
                )

    return nodes.select("node", "regs").mapInArrow(band, "key long, node long")


def chance(n: np.ndarray, m: np.ndarray, settings: Settings) -> np.ndarray:
    """How often two registers of unlike sets of ``n`` and ``m`` shingles agree by chance."""
    total = np.zeros(np.broadcast(n, m).shape)
    a, b = np.maximum(n / settings.buckets, 1.0), np.maximum(m / settings.buckets, 1.0)
    for z in range(64):
        low, high = 2.0 ** -(z + 1), 2.0**-z
        total += (np.exp(-a * low) - np.exp(-a * high)) * (np.exp(-b * low) - np.exp(-b * high))
    return total / (1 << settings.mantissa)


def estimate(same: np.ndarray, n: np.ndarray, m: np.ndarray, settings: Settings) -> np.ndarray:
    """Jaccard estimate from the share of equal registers, corrected for chance collisions."""
    c = chance(n, m, settings)
    return np.clip((same - c) / (1 - c), 0, 1)


def _sets(docs: DataFrame, wanted: DataFrame, settings: Settings) -> DataFrame:
    """(node, regs, n, hashes): full shingle sets of the wanted nodes' texts, sorted 8-byte values."""

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in pieces(batches):
            found = [shingles(words(t), settings.width) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [part.column("node"), part.column("regs"), pa.array([len(f) for f in found], pa.int64()),
                 pa.array([f.tobytes() for f in found], pa.binary())],
                names=["node", "regs", "n", "hashes"],
            )

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("place"))
    joined = texts.join(
        wanted.hint("shuffle_hash"), texts.doc_id.eqNullSafe(wanted.rep) & (texts.place == wanted.rep_place)
    )
    return joined.select("node", "regs", "text").mapInArrow(
        collect, "node long, regs binary, n long, hashes binary"
    )


def _confirm(pairs: DataFrame, sets: DataFrame, settings: Settings) -> DataFrame:
    """The (a, b) pairs whose estimate and then whose full sets reach the threshold."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, m = batch.column("n").to_numpy(), batch.column("m").to_numpy()
            small, large = np.minimum(n, m), np.maximum(n, m)
            hopeful = 100 * small >= settings.percent * large
            ra, rb, ha, hb = (batch.column(c) for c in ("ra", "rb", "ha", "hb"))
            good = np.zeros(batch.num_rows, bool)
            for i in np.flatnonzero(hopeful):
                x, y = (np.frombuffer(r[int(i)].as_py(), np.uint16) for r in (ra, rb))
                guess = estimate((x == y).mean(), n[i], m[i], settings)
                if small[i] >= settings.few and guess < settings.percent / 100 - settings.slack:
                    continue
                x, y = (np.frombuffer(h[int(i)].as_py(), np.uint64) for h in (ha, hb))
                both = len(np.intersect1d(x, y, assume_unique=True))
                good[i] = 100 * both >= settings.percent * (len(x) + len(y) - both)
            yield batch.select(["a", "b"]).filter(pa.array(good))

    left = sets.select(F.col("node").alias("a"), F.col("regs").alias("ra"), F.col("n"), F.col("hashes").alias("ha"))
    right = sets.select(
        F.col("node").alias("b"), F.col("regs").alias("rb"), F.col("n").alias("m"), F.col("hashes").alias("hb")
    )
    # A hot bucket's smallest node has many pairs: AQE splits that side of the second join.
    joined = pairs.join(right, "b").join(left, "a")
    return joined.select("a", "b", "n", "m", "ra", "rb", "ha", "hb").mapInArrow(check, "a long, b long")


def _across(members: DataFrame, sets: DataFrame, settings: Settings) -> DataFrame:
    """Links (a, b) between components that meet in one bucket.

    ``members`` has (key, node, comp, size). A bucket is cut into blocks; each pair of
    blocks meets in one task, which estimates, confirms on the full sets, and passes on
    a link only where it joins two parts of the block that were apart until then, so
    there are fewer links than members.
    """
    rows = (
        members.withColumn("blocks", F.ceil(F.col("size") / settings.block).cast("int"))
        .withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "key", "node", "comp", "own",
            F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"),
        )
    )
    least = settings.percent / 100 - settings.slack

    def meet(group: pd.DataFrame) -> pd.DataFrame:
        donors = _donors(settings.buckets)
        found = [np.frombuffer(h, np.uint64) for h in group["hashes"]]
        regs = np.stack([registers(h, settings, donors) for h in found])
        n = np.array([len(h) for h in found])
        node, part, own = (group[c].to_numpy().copy() for c in ("node", "comp", "own"))
        flat, at = np.unique(np.concatenate(found), return_inverse=True)
        ids = np.split(at, np.cumsum(n)[:-1])
        inside = np.zeros(len(flat), bool)
        low, high = group["low"].iloc[0], group["high"].iloc[0]
        right = np.flatnonzero(own == high)
        links = []
        for i in np.flatnonzero(own == low):
            near = right[
                (part[right] != part[i])
                & (100 * np.minimum(n[right], n[i]) >= settings.percent * np.maximum(n[right], n[i]))
            ]
            if low == high:
                near = near[near > i]
            if not len(near):
                continue
            guess = estimate((regs[near] == regs[i]).mean(1), n[near], n[i], settings)
            near = near[(guess >= least) | (np.minimum(n[near], n[i]) < settings.few)]
            if not len(near):
                continue
            inside[ids[i]] = True
            both = np.add.reduceat(inside[np.concatenate([ids[j] for j in near])], np.cumsum(n[near]) - n[near], dtype=np.int64)
            inside[ids[i]] = False
            for j in near[100 * both >= settings.percent * (n[near] + n[i] - both)]:
                if part[j] != part[i]:
                    part[part == part[j]] = part[i]
                    links.append((min(node[i], node[j]), max(node[i], node[j])))
        return pd.DataFrame(links, columns=["a", "b"], dtype="int64")

    return (
        rows.join(sets.select("node", "hashes"), "node")
        .groupBy("key", "low", "high")
        .applyInPandas(meet, "a long, b long")
        .distinct()
    )


def near_duplicates(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), a row per row of ``docs``.

    Links join texts whose shingle sets reach ``percent``; a component is what links
    connect, ``component_id`` its smallest id, and ``kept`` marks the row that has it.
    """
    signed = stored(signatures(docs, settings), "signatures")
    order = F.coalesce("doc_id", F.lit((1 << 63) - 1))
    nodes = stored(
        signed.filter("digest IS NOT NULL")
        .groupBy("digest")
        .agg(
            F.min("doc_id").alias("rep"), F.min_by("place", order).alias("rep_place"),
            F.first("n").alias("n"), F.first("regs").alias("regs"),
        )
        .withColumn("node", F.monotonically_increasing_id()),
        "nodes",
    )
    banded = stored(_banded(nodes, settings), "bands")
    pivots = (
        banded.groupBy("key")
        .agg(F.min("node").alias("pivot"), F.max("node").alias("last"), F.count("*").alias("size"))
        .filter("pivot < last")
    )
    members = stored(banded.join(pivots.select("key", "pivot", "size"), "key"), "members")
    pairs = stored(members.filter("node <> pivot").select(F.col("pivot").alias("a"), F.col("node").alias("b")).distinct(), "pairs")

    def sets_of(wanted: DataFrame) -> DataFrame:
        wanted = wanted.distinct().join(nodes, "node")
        return stored(_sets(docs, wanted, settings).dropDuplicates(["node"]), "sets")

    paired = pairs.select(F.col("a").alias("node")).union(pairs.select("b"))
    links = stored(_confirm(pairs, sets_of(paired), settings), "confirmed")
    labels = components(links)

    # Buckets of three and more whose members are not yet of one component.
    def labelled(df: DataFrame) -> DataFrame:
        return df.join(labels, "node", "left").withColumn("comp", F.coalesce("comp", "node"))

    large = labelled(members.filter("size > 2"))
    spread = large.groupBy("key").agg(
        F.min("comp").alias("first"), F.max("comp").alias("last"), F.count("*").alias("n"),
        F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("sum"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("xor"),
    )
    # Bands often gather the same members; one bucket then stands for all of them.
    owing = spread.filter("first < last").groupBy("n", "sum", "xor").agg(F.min("key").alias("key"))
    owing = stored(large.join(owing.select("key"), "key").select("key", "node", "comp", "size"), "owing")
    if not owing.isEmpty():
        sets = sets_of(owing.select("node"))
        links = links.union(stored(_across(owing, sets, settings), "confirmed"))
        labels = components(links)

    grouped = labelled(nodes.select("digest", "node", "rep"))
    smallest = grouped.groupBy("comp").agg(F.min("rep").alias("component_id"))
    named = grouped.join(smallest, "comp").select("digest", "component_id")
    kept = F.col("doc_id").eqNullSafe(F.col("component_id"))
    return (
        signed.select("doc_id", "n", "digest")
        .join(named, "digest", "left")
        .withColumn("component_id", F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("component_id")))
        .select("doc_id", F.col("n").alias("n_shingles"), "component_id", kept.alias("kept"))
    )


def deduplicate(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The rows of ``docs`` whose document stays; rows with equal ids stay or go together."""
    kept: Column = F.col("kept")
    name = fresh(docs, "kept_id")
    stay = near_duplicates(docs, settings).filter(kept).select(F.col("doc_id").alias(name)).distinct()
    return docs.join(stay.hint("shuffle_hash"), docs.doc_id.eqNullSafe(F.col(name)), "left_semi")
