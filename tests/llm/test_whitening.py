"""Whitening: exact counts and deviations, eigenvectors against numpy and planted clusters, edge cases."""

import math

import numpy as np
import pytest

from stockroom.llm import queries, whitening
from stockroom.llm.whitening import WIDE, refined_eigen

DDL = "vec_id long, embedding array<float>"


def spectrum(values, seed=3):
    """A symmetric matrix of given eigenvalues, and its eigenvectors to extended precision."""
    size = len(values)
    basis = np.linalg.qr(np.random.default_rng(seed).normal(size=(size, size)))[0].astype(WIDE)
    for _ in range(3):
        basis = basis + basis @ ((np.eye(size, dtype=WIDE) - basis.T @ basis) / 2)
    return basis @ np.diag(np.array(values, WIDE)) @ basis.T, basis


def test_separate_eigenvalues_to_double_precision():
    values = 2.0 ** -np.arange(30)
    matrix, basis = spectrum(values)
    found, vectors = refined_eigen(matrix)
    assert np.allclose(found, values, rtol=1e-15, atol=1e-17)
    assert np.abs(np.abs((basis * vectors).sum(axis=0)) - 1).max() < 1e-15
    assert np.abs(np.abs(vectors) - np.abs(basis))[:, :8].max() < 1e-14


@pytest.mark.parametrize("gap", [1e-6, 1e-9, 1e-12])
def test_clusters_are_solved_apart(gap):
    values = [4, 4 - gap, 4 - 2 * gap, 2, 2 - gap / 3, 1, 0.5]
    matrix, basis = spectrum(values)
    found, vectors = refined_eigen(matrix)
    assert np.allclose(found, values, rtol=0, atol=1e-15)
    assert np.abs(vectors.T @ vectors - np.eye(7)).max() < 1e-15
    # Extended precision tells vectors of a cluster apart up to its rounding over the gap.
    slack = 1e-15 + 200 * float(np.finfo(WIDE).eps) / gap
    assert np.abs(np.abs(vectors) - np.abs(basis)).max() < slack


def test_equal_eigenvalues_and_odd_matrices():
    found, vectors = refined_eigen(np.diag([3.0, 3.0, 3.0, 1.0]))
    assert found.tolist() == [3, 3, 3, 1] and np.abs(vectors.T @ vectors - np.eye(4)).max() < 1e-15
    assert refined_eigen(np.zeros((2, 2)))[0].tolist() == [0, 0]
    assert refined_eigen(np.zeros((0, 0)))[0].tolist() == []
    assert refined_eigen(np.array([[5.0]]))[0].tolist() == [5]


def brute(rows):
    """vec_id -> (n, deviation) and the whitened matrix, from the definition."""
    kept = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    width = max((len(v) for _, v in kept), default=0)
    whole = [tuple(math.floor(256 * float(np.float32(c))) for c in v) + (0,) * (width - len(v)) for _, v in kept]
    distinct = sorted(set(whole))
    n = len(distinct)
    sums = [sum(c) for c in zip(*distinct, strict=True)]
    deviations = [sum((n * x - s) ** 2 for x, s in zip(v, sums, strict=True)) for v in whole]
    mean = np.array(sums) / n
    centred = np.array(distinct, float) - mean
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)
    values, vectors = values[order], vectors[:, order]
    return [i for i, _ in kept], n, deviations, (np.array(whole) - mean) @ vectors / np.sqrt(values), values


def test_whole_query_against_the_definition(frame, monkeypatch):
    rng = np.random.default_rng(5)
    rows = [(k, (rng.normal(size=6) * [4, 2, 1, 0.5, 0.3, 0.1]).tolist()) for k in range(300)]
    rows += [(1000 + k, rows[7][1]) for k in range(150)]  # a third of the rows share a vector
    rows += [(7, rows[7][1]), (None, rows[9][1]), (3000, None), (3001, [1.0, None, 2.0, 0.0, 0.0, 0.0])]
    rows += [(3002, [float("nan")] * 6), (3003, [float("inf")] + [0.0] * 5), (3004, [1.0, 2.0]), (3005, []), (3006, [-0.0] * 6)]
    monkeypatch.setattr(whitening, "CELLS", 40)
    out = whitening.digest(frame(rows, DDL).repartition(5)).collect()
    ids, n, deviations, white, values = brute(rows)
    assert {r.n for r in out} == {n} and len(out) == 4 * len(ids)
    for component in range(4):
        mine = sorted((r.vec_id is None, r.vec_id or 0, r.deviation, r.whitened) for r in out if r.component == component + 1)
        want = sorted((i is None, i or 0, d, w) for i, d, w in zip(ids, deviations, white[:, component], strict=True))
        sign = np.sign(sum(m[3] * w[3] for m, w in zip(mine, want, strict=True)))
        if sign < 0:
            want = sorted((a, b, d, -w) for a, b, d, w in want)
        assert [m[:3] for m in mine] == [w[:3] for w in want]
        assert np.allclose([m[3] for m in mine], [w[3] for w in want], rtol=1e-10, atol=1e-11)
        share = {r.explained for r in out if r.component == component + 1}
        assert list(share) == [pytest.approx(values[component] / values.sum(), rel=1e-12)]
    assert out[0].identity_error < 1e-12


def test_large_values_stay_exact(frame):
    rows = [(1, [3e8, -1.0]), (2, [-3e8, 5.5]), (3, [1e30, 0.0])]
    model = whitening.fit(frame(rows, DDL))
    got = {r.vec_id: r.deviation for r in whitening.transform(frame(rows, DDL), model).collect()}
    whole = [[math.floor(256 * float(np.float32(c))) for c in v] for _, v in rows]
    whole[2][0] = 2**63 - 1024
    sums = [sum(c) for c in zip(*whole, strict=True)]
    want = {i + 1: sum((3 * x - s) ** 2 for x, s in zip(v, sums, strict=True)) for i, v in enumerate(whole)}
    assert model.sums == tuple(sums) and got == {k: v if v < 10**38 else None for k, v in want.items()}
    assert all(r.deviation is None for r in whitening.digest(frame(rows, DDL)).collect())


def test_degenerate_tables(frame):
    assert whitening.digest(frame([], DDL)).collect() == []
    assert whitening.digest(frame([(1, None)], DDL)).collect() == []
    one = whitening.digest(frame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], DDL)).collect()
    assert len(one) == 4 and {(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in one} == {(1, 0, None, None, None)}
    flat = whitening.digest(frame([(1, [1.0, 2.0]), (2, [2.0, 4.0])], DDL)).collect()
    assert {(r.component, r.explained) for r in flat} == {(1, 1.0), (2, 0.0)}
    assert {abs(round(r.whitened, 12)) for r in flat if r.component == 1} == {1.0}
    assert {r.whitened for r in flat if r.component == 2} == {None}


def test_extra_columns_and_clashing_names(frame):
    df = frame([(1, [1.0, 0.0], "a", 5), (2, [0.0, 1.0], None, 6)], f"{DDL}, whitened string, n int")
    out = whitening.transform(df, whitening.fit(df))
    assert out.columns[:4] == df.columns and len(set(out.columns)) == 6
    assert {(r.vec_id, r.whitened, r.n) for r in out.collect()} == {(1, "a", 5), (2, None, 6)}


def test_registered_query(spark):
    out = queries.queries()["op11_embedding_whitening"](spark, "/root/testdata/sf0.001")
    rows = out.collect()
    assert {r.component for r in rows} == {1, 2, 3, 4} and rows[0].identity_error < 1e-10
    assert len({r.vec_id for r in rows}) * 4 == len(rows)
