"""Embedding whitening: eigenvectors in single precision, refined by matrix products.

1. Vectors become whole numbers, ``floor(256 * c)``; each distinct one counts once
   (:func:`distinct_vectors`, combined map-side, so a vector that a third of the rows
   share is one row a task). The written table is the fit list.
2. Tasks add up sums, then the centred products of their vectors; Spark adds the tasks'
   parts cell by cell (:func:`fit`). The driver sees d sums and d * d cells, d being the
   length of a vector, whatever the number of rows.
3. :func:`refined_eigen` takes float32 eigenvectors and applies the iteration of Ogita and
   Aishima in extended precision: only matrix products, quadratic convergence. Eigenvalues
   too close for it form clusters, each solved again by itself as the small matrix
   ``Q' (V - mean) Q``, whose eigenvalues are far apart relative to its own size.
4. :func:`transform` projects every row; nothing is shuffled.

Defined results: a NULL vector, or one with a NULL or non-finite entry, drops its row; a
vector shorter than the longest reads as ending in zeros; entries beyond the range of a
long take its nearest end. Rows with equal or NULL ids, ties and repeats keep a row each.
Of an empty table the result is empty. A component of eigenvalue 0 (one distinct vector,
or more components than the data has dimensions) has NULL ``whitened`` values and a share
of 0, the share being NULL if there is no variance at all; ``identity_error`` is over the
other components, NULL without any. A ``deviation`` beyond a long is NULL in the query
and whole as a decimal of 38 digits in :func:`transform`. Extra columns are kept; the
names added give way to theirs.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh, stored

SCALE = 256.0  # steps of a unit
CELLS = 1 << 20  # entries of a matrix worked on at once
LOW = np.int64(32)  # sums are kept in two halves of 32 bits, so that no task overflows
WIDE = np.longdouble


# -- vectors ------------------------------------------------------------------


def whole(vectors: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Blocks of (places, whole-number rows) of a list column; unusable vectors are left out."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    offsets = vectors.offsets.to_numpy().astype(np.int64)
    values = pc.cast(vectors.values, pa.float64()).to_numpy(zero_copy_only=False)
    valid = vectors.is_valid().to_numpy(zero_copy_only=False)
    lengths = np.where(valid, np.diff(offsets), 0)
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
    good = np.flatnonzero(valid & (bad[offsets[1:]] == bad[offsets[:-1]]))
    at = 0
    while at < len(good):
        width = int(lengths[good[at : at + CELLS]].max(initial=0))
        rows = good[at : at + max(1, CELLS // max(1, width))]
        size = lengths[rows]
        box = np.zeros((len(rows), int(size.max(initial=0))), np.int64)
        column = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        entries = np.floor(SCALE * values[np.repeat(offsets[rows], size) + column])
        # The greatest double below 2^63; the lowest long is a double itself.
        entries = np.clip(entries, -(2.0**63), 2.0**63 - 1024).astype(np.int64)
        box[np.repeat(np.arange(len(rows)), size), column] = entries
        yield rows, box
        at += len(rows)


def _packed(box: np.ndarray) -> list[bytes]:
    """One key per row: equal keys are equal vectors. Trailing zeros go, entries take as few bytes as fit."""
    keys = []
    top = np.abs(np.where(box == np.iinfo(np.int64).min, np.iinfo(np.int64).max, box)).max(axis=1, initial=0)
    last = np.where(box != 0, np.arange(1, box.shape[1] + 1), 0).max(axis=1, initial=0)
    for row, peak, end in zip(box, top, last, strict=True):
        kind = next(k for k in ("<i1", "<i2", "<i4", "<i8") if k == "<i8" or peak <= np.iinfo(k).max)
        keys.append(kind[2:].encode() + row[:end].astype(kind).tobytes())
    return keys


def _unpacked(keys: pa.Array, width: int) -> np.ndarray:
    box = np.zeros((len(keys), width), np.int64)
    for row, key in zip(box, keys.to_pylist(), strict=True):
        entries = np.frombuffer(key, f"<i{key[:1].decode()}", offset=1)
        row[: len(entries)] = entries
    return box


def distinct_vectors(df: DataFrame, column: str = "embedding") -> DataFrame:
    """(vector, width): each distinct whole-number vector packed in one binary, and its greatest length."""

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = pc.fill_null(pc.list_value_length(batch.column(0)), 0).to_numpy(zero_copy_only=False)
            for rows, box in whole(batch.column(0)):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(_packed(box), pa.binary()), pa.array(lengths[rows], pa.int32())], ["vector", "width"]
                )

    found = df.select(F.col(f"`{column}`")).mapInArrow(pack, "vector binary, width int")
    return found.groupBy("vector").agg(F.max("width").alias("width"))


def _blocks(batches: Iterable[pa.RecordBatch], width: int) -> Iterator[np.ndarray]:
    step = max(1, CELLS // max(1, width))
    for batch in batches:
        for at in range(0, batch.num_rows, step):
            yield _unpacked(batch.column(0).slice(at, step), width)


# -- statistics ---------------------------------------------------------------


@dataclass(frozen=True)
class Model:
    """What a fit leaves: row count and exact sums, components by falling eigenvalue, shares and quality."""

    n: int
    sums: tuple[int, ...]
    vectors: np.ndarray  # width x components
    values: np.ndarray
    explained: tuple[float | None, ...]
    identity_error: float | None


def offsets_from_mean(box: np.ndarray, n: int, sums: tuple[int, ...]) -> np.ndarray:
    """``n * x - sums``, exact: as longs where no entry can overflow, as Python's integers elsewhere."""
    peak = max(abs(int(box.max(initial=0))), abs(int(box.min(initial=0))))
    if n * peak + max(map(abs, sums), default=0) < 1 << 62:
        return n * box - np.array(sums, np.int64)
    return n * box.astype(object) - np.array(sums, object)


def centred(box: np.ndarray, n: int, sums: tuple[int, ...]) -> np.ndarray:
    """``x - mean`` in double precision, the difference taken before any rounding."""
    return (offsets_from_mean(box, n, sums) / n).astype(np.float64)


def _added(df: DataFrame, parts, columns: str, by: str, sums: dict[str, str]) -> list:
    """Add up what tasks find, cell by cell; as many rows come back as a matrix has cells."""
    found = df.select("vector").mapInArrow(parts, columns)
    return found.groupBy(by).agg(*[F.sum(F.col(c).cast(t)).alias(c) for c, t in sums.items()]).collect()


def _sums(vectors: DataFrame, width: int) -> tuple[int, tuple[int, ...]]:
    def parts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = 0
        high, low = np.zeros(width, np.int64), np.zeros(width, np.int64)
        for box in _blocks(batches, width):
            rows += len(box)
            high += (box >> LOW).sum(axis=0)
            low += (box & np.int64((1 << 32) - 1)).sum(axis=0)
        place = np.arange(-1, width)
        yield pa.RecordBatch.from_arrays(
            [pa.array(place), pa.array(np.append(0, high)), pa.array(np.append(rows, low))], ["place", "high", "low"]
        )

    whole_sum = "decimal(38,0)"
    found = _added(vectors, parts, "place long, high long, low long", "place", {"high": whole_sum, "low": whole_sum})
    at = {r["place"]: (int(r["high"]) << 32) + int(r["low"]) for r in found}
    return at.get(-1, 0), tuple(at.get(i, 0) for i in range(width))


def _covariance(vectors: DataFrame, n: int, sums: tuple[int, ...], onto: np.ndarray | None = None) -> np.ndarray:
    """Covariance of the fit list, or of its projections on the columns of ``onto``."""
    width = len(sums)
    size = width if onto is None else onto.shape[1]
    upper = np.triu_indices(size)

    def parts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for box in _blocks(batches, width):
            rows = centred(box, n, sums)
            if onto is not None:
                rows = rows @ onto
            total += rows.T @ rows
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(upper[0]))), pa.array(total[upper])], ["cell", "value"]
        )

    found = _added(vectors, parts, "cell long, value double", "cell", {"value": "double"})
    matrix = np.zeros((size, size))
    for r in found:
        matrix[upper[0][r["cell"]], upper[1][r["cell"]]] = r["value"] / n
    return matrix + np.triu(matrix, 1).T


# -- eigenvectors -------------------------------------------------------------


def _clusters(values: np.ndarray, width: float) -> list[np.ndarray]:
    """Places of eigenvalues (in any order) whose neighbours lie within ``width``, where several do."""
    order = np.argsort(values)
    cuts = np.flatnonzero(np.diff(values[order]) > width) + 1
    return [c for c in np.split(order, cuts) if len(c) > 1]


def refined_eigen(matrix: np.ndarray, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors of a symmetric matrix, to double precision.

    Starts from float32 eigenvectors X. A round measures what they lack, R = I - X'X and
    S = X'VX, in extended precision, and corrects X by X E, where E is (S + value R) over
    the gap of the two eigenvalues, or R / 2 inside a cluster. Each round then solves its
    clusters as matrices of their own, recursively, until only equal eigenvalues are left
    together: any basis of their space serves.
    """
    size = len(matrix)
    matrix = matrix.astype(WIDE)
    peak = np.abs(matrix).max(initial=0)
    if size == 0 or peak == 0:
        return np.zeros(size), np.eye(size)
    scaled = matrix / peak
    vectors = np.linalg.eigh(scaled.astype(np.float32))[1].astype(WIDE)
    values, vectors = _refine(scaled, vectors, rounds)
    order = np.argsort(-values, kind="stable")
    return (values[order] * peak).astype(np.float64), vectors[:, order].astype(np.float64)


def _slices(matrix: np.ndarray, axis: int, bits: int, count: int) -> list[np.ndarray]:
    """Doubles of ``bits`` bits each that add up to the matrix, lined up along each row or column."""
    rest = matrix.astype(WIDE)
    exponent = np.frexp(np.abs(rest).max(axis=axis, keepdims=True))[1]
    parts = []
    for k in range(1, count + 1):
        unit = np.ldexp(WIDE(1), exponent - k * bits)
        part = np.rint(rest / unit) * unit
        parts.append(part.astype(np.float64))
        rest = rest - part
    return parts


def wide_product(left: np.ndarray, right: np.ndarray, count: int = 4) -> np.ndarray:
    """A matrix product in extended precision from products of doubles: those of short slices have no rounding."""
    bits = (53 - max(1, int(left.shape[1] - 1).bit_length())) // 2
    rows, columns = _slices(left, 1, bits, count), _slices(right, 0, bits, count)
    total = np.zeros((left.shape[0], right.shape[1]), WIDE)
    for k in reversed(range(count)):
        for i in range(k + 1):
            total += rows[i] @ columns[k - i]
    return total


def _step(matrix: np.ndarray, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray], float]:
    """One round: eigenvalues, corrected vectors, clusters, and the greatest correction outside them."""
    size = len(matrix)
    lacking = _lacking(vectors)
    inner = wide_product(vectors.T, wide_product(matrix, vectors))
    inner = (inner + inner.T) / 2
    values = np.diag(inner) / (1 - np.diag(lacking))
    off = inner - np.diag(values)
    noise = 2 * (np.linalg.norm(off.astype(np.float64), 2) + np.linalg.norm(lacking.astype(np.float64), 2))
    noise = max(noise, 4 * size * float(np.finfo(WIDE).eps))
    group = np.arange(size)
    clusters = _clusters(values.astype(np.float64), noise)
    for c in clusters:  # a chain of close values counts as close throughout
        group[c] = c[0]
    apart = group[None, :] != group[:, None]
    gap = np.where(apart, values[None, :] - values[:, None], 1)
    # (inner + value lacking) / gap, split so that the turning part is antisymmetric to the last bit.
    turn = np.where(apart, (inner + lacking * (values[None, :] + values[:, None]) / 2) / gap, 0)
    change = turn + lacking / 2
    return values, vectors + wide_product(vectors, change), clusters, float(np.abs(change).max())


def _lacking(vectors: np.ndarray) -> np.ndarray:
    lacking = np.eye(vectors.shape[1], dtype=WIDE) - wide_product(vectors.T, vectors)
    return (lacking + lacking.T) / 2


def _apart(matrix: np.ndarray, vectors: np.ndarray, places: np.ndarray, depth: int) -> bool:
    """Turn a cluster's vectors to those of its own small matrix; False if nothing is left to tell apart."""
    part = vectors[:, places]
    middle = (part[:, 0] @ matrix @ part[:, 0]) / (part[:, 0] @ part[:, 0])
    small = wide_product(part.T, wide_product(matrix, part) - middle * part)
    small = (small + small.T) / 2
    spread = np.abs(small).max()
    if spread <= 4 * len(matrix) * np.finfo(WIDE).eps or depth == 0:
        return False  # equal to the last bit: any basis
    small = small / spread
    start = np.linalg.eigh(small.astype(np.float32))[1].astype(WIDE)
    vectors[:, places] = wide_product(part, _refine(small, start, 4, depth - 1)[1])
    return True


def _refine(matrix: np.ndarray, vectors: np.ndarray, rounds: int, depth: int = 6) -> tuple[np.ndarray, np.ndarray]:
    last = np.inf
    for k in range(rounds):
        values, vectors, clusters, change = _step(matrix, vectors)
        turned = [_apart(matrix, vectors, c, depth) for c in clusters]
        if change < np.finfo(np.float64).eps / 4 and not any(turned):
            break
        if k > 2 and change > last / 2:  # rounding over the smallest gap is reached
            break
        last = change
    for _ in range(2):  # turns within narrow gaps leave a second-order error of length and angle
        vectors = vectors + wide_product(vectors, _lacking(vectors) / 2)
    return values, vectors


# -- the operator -------------------------------------------------------------


def fit(df: DataFrame, components: int = 4, column: str = "embedding") -> Model | None:
    """The whitening of a table's distinct vectors; None if it has no usable one."""
    vectors = stored(distinct_vectors(df, column), "vectors")
    width = vectors.agg(F.max("width")).first()[0]
    if width is None:
        return None
    n, sums = _sums(vectors, width)
    covariance = _covariance(vectors, n, sums)
    trace = float(np.trace(covariance))
    values, basis = refined_eigen(covariance)
    kept = min(components, width)
    values, basis = values[:kept], basis[:, :kept]
    # Below this, an eigenvalue cannot be told from 0 in sums of doubles.
    real = values > 4 * max(width, 16) * np.finfo(np.float64).eps * max(values.max(initial=0), 0)
    error = None
    if real.any():
        onto = basis[:, real] / np.sqrt(values[real])
        error = float(np.abs(_covariance(vectors, n, sums, onto) - np.eye(int(real.sum()))).max())
    shares = tuple((float(v) / trace if r else 0.0) if trace > 0 else None for v, r in zip(values, real, strict=True))
    return Model(n, sums, basis, np.where(real, values, 0.0), shares, error)


def transform(
    df: DataFrame, model: Model | None, column: str = "embedding", whitened: str = "whitened", deviation: str = "deviation"
) -> DataFrame:
    """Rows with a usable vector, their projections (NULL where the eigenvalue is 0) and exact deviation."""
    whitened, deviation = fresh(df, whitened), fresh(df, deviation)
    added = [
        T.StructField(whitened, T.ArrayType(T.DoubleType())),
        T.StructField(deviation, T.DecimalType(38, 0)),
    ]
    schema = T.StructType([*df.schema.fields, *added])
    if model is None:
        return df.sparkSession.createDataFrame([], schema)
    n, sums, width, k = model.n, model.sums, len(model.sums), len(model.values)
    real = model.values > 0
    onto = np.where(real, model.vectors / np.sqrt(np.where(real, model.values, 1)), np.nan)
    most = 10**38 - 1

    def project(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, box in whole(batch.column(batch.schema.get_field_index(column))):
                if box.shape[1] < width:
                    box = np.pad(box, ((0, 0), (0, width - box.shape[1])))
                far = offsets_from_mean(box, n, sums)
                flat = ((far / n).astype(np.float64) @ np.where(real, onto, 0)).reshape(-1)
                lacking = np.tile(~real, len(box))
                ends = pa.array(np.arange(len(box) + 1) * k, pa.int32())
                lists = pa.ListArray.from_arrays(ends, pa.array(flat, pa.float64(), mask=lacking))
                if far.dtype != object and int(np.abs(far).max(initial=0)) ** 2 * max(width, 1) < 1 << 63:
                    square = (far * far).sum(axis=1).tolist()
                else:
                    square = [sum(int(v) ** 2 for v in row) for row in far]
                total = pa.array([v if v <= most else None for v in square], pa.decimal128(38, 0))
                kept = batch.take(pa.array(rows))
                yield pa.RecordBatch.from_arrays(
                    [*kept.columns, lists, total], [*kept.schema.names, whitened, deviation]
                )

    return df.mapInArrow(project, schema)


def digest(df: DataFrame, components: int = 4) -> DataFrame:
    """A row per usable vector and component."""
    df = df.select("vec_id", "embedding")
    model = fit(df, components)
    rows = transform(df, model)
    shares = [] if model is None else list(model.explained)
    explained = F.array(*[F.lit(s).cast("double") for s in shares]).cast("array<double>")
    return rows.select(
        "vec_id", F.expr("try_cast(deviation AS bigint)").alias("deviation"), F.posexplode("whitened").alias("k", "whitened")
    ).select(
        "vec_id",
        (F.col("k") + 1).cast("int").alias("component"),
        F.lit(0 if model is None else model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(explained, F.col("k")).alias("explained"),
        F.lit(None if model is None else model.identity_error).cast("double").alias("identity_error"),
    )
