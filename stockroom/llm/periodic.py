"""Periodic runs: stretches of words that repeat with a period three times and more.

A run of period q is a stretch w[s:e] whose words q apart are equal; the places i with
w[i] == w[i + q] are then the interval [s, e - q), here its core. The search is tiled by
the scale of the period:

1. :func:`_prepared` reads each text once, numbers its words and hashes every stretch of
   :data:`GRAM` words. A core holds such a stretch twice at the distance of its period;
   where no distance recurs, a document has no run and is settled on the spot.
2. :func:`_tiles` cuts the others into overlapping tiles for each octave of periods
   [P, 2 P): a boundary every 2 P words, and as many words around it as a core can be
   followed over. Every core of the octave holds a boundary, being 2 P words or longer.
   Boundaries with no recurring stretch of that octave near them are left out. Rows of
   some boundaries each are dealt over the cluster, so a long document is many tasks'.
3. :func:`_solve` finds, by Z-functions of the words after a boundary and of those before
   it, reversed, how far the core of each period reaches on both sides. A core whose
   first period is itself a power of something shorter belongs to that shorter period.
4. :func:`_stitched` shuffles the pieces by document and period, and joins those that
   meet: whole cores, of which the long ones are runs.

Defined results: a NULL or empty text has no words and no runs; rows are told apart by id
and text, so equal ids, NULL ids and repeated rows have a result each; an empty table gives
an empty one; texts of any length are read whole. Ties follow the order of
:func:`digest`. Only the id and the text are read, so other columns cannot clash.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import GOLD, mixed, pieces, stored

LEAST = 24  # words of a run
TIMES = 3  # periods of a run
GRAM = 16  # words: a core of period up to 8 has 24 - 8, of a longer one 2 * 9 or more
FIRST = 16  # periods below this form the first octave
TILE_WORDS = 1 << 16  # words of a row of tiles, margins apart; a wider tile is a row of its own

# -- documents ----------------------------------------------------------------


def planted(doc_id: int | None, n: int) -> tuple[int, int] | None:
    """(a, p): words from a on repeat with period p, for a tenth of the ids; else None."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    return a, 1 + (n - a) // (3 + g % 8)


def refolded(tokens: list, fold: tuple[int, int] | None) -> list:
    if fold is None:
        return tokens
    a, p = fold
    return tokens[:a] + [tokens[a + k % p] for k in range(len(tokens) - a)]


def numbered(tokens: list[bytes]) -> np.ndarray:
    """Words as numbers in order of first use: equal numbers are equal words."""
    seen: dict[bytes, int] = {}
    return np.fromiter((seen.setdefault(w, len(seen)) for w in tokens), np.int64, len(tokens))


def _gram_order(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """(places, keys) of stretches that occur twice or more: keys sort by stretch, then place."""
    count = len(ids) - GRAM + 1
    if count < 2:
        return None
    with np.errstate(over="ignore"):
        h = mixed(ids.astype(np.uint64) + np.uint64(1))
        step = 1
        while step < GRAM:
            h = mixed(h[: len(h) - step] * GOLD + h[step:])
            step *= 2
    order = np.argsort(h, kind="stable")
    first = np.concatenate([[True], h[order][1:] != h[order][:-1]])
    group = np.cumsum(first) - 1
    several = np.bincount(group)[group] > 1
    if not several.any():
        return None
    places = order[several]
    return places, group[several] * (4 * len(ids)) + places


def octaves(n: int) -> Iterator[tuple[int, int, int, int]]:
    """(lowest period, first beyond, distance of boundaries, reach around one) up to a third of n words."""
    low, high = 1, FIRST
    while TIMES * low <= n:
        step = max(GRAM, 2 * low)
        yield low, high, step, max(2 * step if low == 1 else step, GRAM)
        low, high = high, 2 * high


def boundaries(ids: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(octave, boundaries worth solving) of a document, ascending."""
    grams = _gram_order(ids) if len(ids) >= LEAST else None
    if grams is None:
        return
    places, keys = grams
    for octave, (low, high, step, reach) in enumerate(octaves(len(ids))):
        # The next equal stretch at a distance in [low, high), if there is one.
        found = np.searchsorted(keys, keys + low)
        near = found < len(keys)
        near[near] = keys[found[near]] < keys[near] + high
        live = places[near]
        if not len(live):
            continue
        mark = np.zeros(len(ids) // step + 2, np.int64)  # boundaries within reach of a live place
        np.add.at(mark, (np.maximum(live - reach, 0) + step - 1) // step, 1)
        np.add.at(mark, np.minimum((live + reach) // step + 1, len(mark) - 1), -1)
        chosen = np.flatnonzero(np.cumsum(mark[:-1]) > 0) * step
        chosen = chosen[chosen < len(ids)]
        if len(chosen):
            yield octave, chosen


# -- tiles --------------------------------------------------------------------


def z_function(s: list[int]) -> list[int]:
    """z[i]: length of the longest common start of s and s[i:]."""
    n = len(s)
    z = [0] * n
    if n:
        z[0] = n
    left = right = 0
    for i in range(1, n):
        k = 0
        if i < right:
            k = z[i - left]
            if k < right - i:
                z[i] = k
                continue
            k = right - i
        while i + k < n and s[k] == s[i + k]:
            k += 1
        z[i] = k
        left, right = i, i + k
    return z


def _primes_of(high: int) -> list[list[int]]:
    primes: list[list[int]] = [[] for _ in range(high)]
    for p in range(2, high):
        if not primes[p]:
            for q in range(p, high, p):
                primes[q].append(p)
    return primes


def tile_cores(ids: list[int], at: int, low: int, high: int, reach: int, primes: list[list[int]]) -> Iterator[tuple[int, int, int]]:
    """(period, from, to): cores that hold boundary ``at``, as far as ``reach`` on either side, for low <= period < high.

    ``ids`` may begin and end anywhere beyond ``reach`` and the longest period.
    """
    after = ids[at : at + reach + high]
    ahead = z_function(after)
    before = ids[max(0, at - reach) : at][::-1]
    # Words before a place q later, reversed, lie at high - q behind those from at + high on.
    back = z_function([*before, -1, *ids[max(0, at - reach) : at + high][::-1]])
    skipped = len(before) + 1 + min(at + high, len(ids)) - at
    for q in range(low, min(high, len(after))):
        forth = ahead[q]
        if not forth or any(ahead[q // p] >= q - q // p for p in primes[q]):
            continue
        yield q, at - back[skipped - q], at + min(forth, reach)


def solved(ids: np.ndarray, base: int, octave: int, chosen: Iterable[int], n: int) -> Iterator[tuple[int, int, int]]:
    """Joined cores (period, from, to) around the boundaries of one octave, in places of the document.

    A core that ends inside all its tiles is whole, so a short one is dropped at once.
    """
    low, high, _, reach = next(o for k, o in enumerate(octaves(n)) if k == octave)
    words, primes = ids.tolist(), _primes_of(high)
    open_: dict[int, tuple[int, int, bool]] = {}  # period -> core that may go on, and whether it was cut

    def closed(q: int, a: int, b: int, cut: bool) -> Iterator[tuple[int, int, int]]:
        if cut or b - a >= max(LEAST - q, (TIMES - 1) * q):
            yield q, a, b

    for at in chosen:
        m = at - base
        for q, a, b in tile_cores(words, m, low, high, reach, primes):
            cut = a + base > 0 and a <= m - reach or b >= m + reach
            a, b = a + base, b + base
            if q in open_ and a <= open_[q][1]:
                open_[q] = (min(a, open_[q][0]), max(b, open_[q][1]), open_[q][2] or cut)
            else:
                if q in open_:
                    yield from closed(q, *open_[q])
                open_[q] = (a, b, cut)
    for q, core in open_.items():
        yield from closed(q, *core)


def tile_rows(ids: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(octave, base, boundaries, words from base on): what a task needs to solve some boundaries."""
    for octave, chosen in boundaries(ids):
        _, high, _, reach = next(o for k, o in enumerate(octaves(len(ids))) if k == octave)
        cuts = np.flatnonzero(np.diff(chosen // TILE_WORDS) > 0) + 1
        for part in np.split(chosen, cuts):
            base = max(0, int(part[0]) - reach)
            yield octave, base, part, ids[base : int(part[-1]) + reach + high]


# -- Spark --------------------------------------------------------------------

PREPARED = "key binary, doc_id {id}, n_words long, words_sha256 string, body string"
TILES = "key binary, n_words long, octave int, base long, boundaries array<long>, ids array<int>"


def _prepared(docs: DataFrame, plant: bool) -> DataFrame:
    """One row per document; ``body`` (its words) is there only where runs must be sought."""

    def prepare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in pieces(batches):
            ids = part.column("doc_id").to_pylist()
            out: dict[str, list] = {c: [] for c in ("key", "doc_id", "n_words", "words_sha256", "body")}
            for doc_id, text in zip(ids, texts, strict=True):
                raw = (text or "").encode("utf-8", "replace")
                tokens = raw.split()  # on bytes: at the six white spaces of ASCII alone
                tokens = refolded(tokens, planted(doc_id, len(tokens)) if plant else None)
                body = b" ".join(tokens)
                sought = next(boundaries(numbered(tokens)), None) is not None
                out["key"].append(hashlib.blake2b(repr(doc_id).encode() + b"\0" + raw, digest_size=16).digest())
                out["doc_id"].append(doc_id)
                out["n_words"].append(len(tokens))
                out["words_sha256"].append(hashlib.sha256(body).hexdigest())
                out["body"].append(body.decode() if sought else None)
            types = (pa.binary(), part.column("doc_id").type, pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), types, strict=True)], list(out))

    schema = PREPARED.format(id=docs.schema["doc_id"].dataType.simpleString())
    return docs.select("doc_id", "text").mapInArrow(prepare, schema)


def _tiles(sought: DataFrame) -> DataFrame:
    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("key", pa.binary()), ("n_words", pa.int64()), ("octave", pa.int32()), ("base", pa.int64()), ("boundaries", pa.list_(pa.int64())), ("ids", pa.list_(pa.int32()))])
        for part, texts in pieces(batches, "body"):
            for key, body in zip(part.column("key").to_pylist(), texts, strict=True):
                ids = numbered(body.encode().split())
                for octave, base, chosen, words in tile_rows(ids):
                    row = ([key], [len(ids)], [octave], [base], [chosen], [words.astype(np.int32)])
                    yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(row, schema, strict=True)], schema=schema)

    return sought.select("key", "body").mapInArrow(cut, TILES)


def _solve(tiles: DataFrame) -> DataFrame:
    def solve(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, found = [], []
            for k in range(batch.num_rows):
                key, n, octave, base, chosen, ids = (c[k] for c in batch.columns)
                words = ids.values.to_numpy(zero_copy_only=False)
                cores = list(solved(words, base.as_py(), octave.as_py(), chosen.values.to_pylist(), n.as_py()))
                keys += [key.as_py()] * len(cores)
                found += cores
            period, low, high = np.array(found, np.int64).reshape(-1, 3).T
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.binary()), pa.array(period), pa.array(low), pa.array(high)],
                ["key", "period", "core_from", "core_to"],
            )

    return tiles.mapInArrow(solve, "key binary, period long, core_from long, core_to long")


def _stitched(cores: DataFrame) -> DataFrame:
    """(key, runs): pieces of a document and period that meet are one core; long ones are runs."""
    line = Window.partitionBy("key", "period").orderBy("core_from", "core_to")
    reached = F.max("core_to").over(line.rowsBetween(Window.unboundedPreceding, -1))
    begins = F.coalesce(F.col("core_from") > reached, F.lit(True)).cast("int")
    islands = cores.withColumn("begins", begins).withColumn("island", F.sum("begins").over(line))
    whole = islands.groupBy("key", "period", "island").agg(
        F.min("core_from").alias("start"), (F.max("core_to") - F.min("core_from") + F.col("period")).alias("length")
    )
    runs = whole.filter(F.col("length") >= F.greatest(F.lit(LEAST), TIMES * F.col("period")))
    # A document has fewer runs than words.
    return runs.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("start", "period", "length"))).alias("runs"))


def find(docs: DataFrame, plant: bool = False) -> DataFrame:
    """Per document: doc_id, n_words, ``runs`` (start, period, length; by start, then period), ``words_sha256`` of
    all its words joined by a space, and ``collapsed``, what is left of them once repeats are dropped (NULL: all).

    ``plant`` makes a tenth of the documents periodic first; see :func:`planted`.
    """
    known = stored(_prepared(docs, plant), "prepared")
    sought = known.filter("body IS NOT NULL")
    tiles = _tiles(sought)
    # Rows of tiles are dealt by what they are, so a lost task's rows come back the same.
    cores = _solve(tiles.repartition(F.col("key"), F.col("octave"), F.col("base")))
    runs = _stitched(cores)
    runs = runs.select(F.col("key").alias("run_key"), "runs")
    done = sought.join(runs, F.col("key") == F.col("run_key"), "left").select(
        "doc_id", "n_words", "words_sha256", "body", "runs"
    )
    kind = "array<struct<start: long, period: long, length: long>>"
    none = F.array().cast(kind)
    settled = known.filter("body IS NULL").select(
        "doc_id", "n_words", none.alias("runs"), "words_sha256", F.lit(None).cast("string").alias("collapsed")
    )
    return settled.unionByName(
        done.select(
            "doc_id", "n_words", F.coalesce("runs", none).alias("runs"), "words_sha256", _collapsed().alias("collapsed")
        )
    )


def _collapsed() -> Column:
    """The words of ``body`` outside the repeats of ``runs``, joined; NULL when there is no run."""

    @F.arrow_udf("string")
    def collapse(body: pa.Array, runs: pa.Array) -> pa.Array:
        out = []
        for text, found in zip(body, runs, strict=True):
            spans = [(r["start"] + r["period"], r["start"] + r["length"]) for r in found.as_py() or ()]
            out.append(b" ".join(kept(text.as_py().encode().split(), spans)).decode() if spans else None)
        return pa.array(out, pa.string())

    return collapse("body", "runs")


def kept(tokens: list, spans: list[tuple[int, int]]) -> list:
    """Tokens outside all spans."""
    out, at = [], 0
    for start, end in sorted(spans):
        if start > at:
            out += tokens[at:start]
        at = max(at, end)
    return out + tokens[at:]


def digest(docs: DataFrame) -> DataFrame:
    """One row per document: its runs' number and digest, the run repeated most often, the digest of what is kept."""
    df = find(docs, plant=True)

    def better(a: Column, b: Column) -> Column:
        left, right = a["length"] * b["period"], b["length"] * a["period"]
        # Runs come by start, then period, so the earlier one stays on equal terms.
        return F.when(a.isNull() | (left < right), b).otherwise(a)

    best = F.aggregate("runs", F.lit(None).cast("struct<start: long, period: long, length: long>"), better)
    lines = F.concat_ws("", F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))))
    return df.select("*", best.alias("best")).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.coalesce(F.sha2("collapsed", 256), F.col("words_sha256")).alias("collapsed_sha256"),
    )
