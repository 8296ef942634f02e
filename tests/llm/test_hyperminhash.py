"""Near-duplicate groups against comparing all pairs."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from stockroom.llm import graph, hyperminhash
from stockroom.llm.common import shingles, words

from . import brute

SETTINGS = hyperminhash.Settings(percent=85)


def result(docs, settings=SETTINGS):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in hyperminhash.near_duplicates(docs, settings).collect()}


def test_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    assert result(docs) == brute.components(map(tuple, docs.collect()), 85)


@pytest.fixture(scope="module")
def chain():
    """A hot group whose members drift apart, so links form long chains; and short texts."""
    rng = random.Random(5)
    base = [f"w{k}" for k in range(400)]
    rows, text = [], base
    for k in range(150):
        rows.append((k, " ".join(text)))
        text = list(text)
        text[rng.randrange(len(text))] = f"x{k}"
        if k % 3 == 0:
            text[rng.randrange(len(text))] = f"y{k}"
    for k in range(150, 200):  # short texts that lose or gain their last words
        rows.append((k, " ".join(f"s{j}" for j in range(20 + k % 7))))
    rows += [(k, " ".join(base[:300] + [f"z{k}_{j}" for j in range(100)])) for k in range(200, 260)]
    return rows


def test_chains(spark, chain):
    docs = spark.createDataFrame(chain, "doc_id long, text string")
    want = brute.components(chain, 85)
    assert result(docs) == want
    # Small blocks: the pairs that the first pass owes meet across blocks.
    assert result(docs, hyperminhash.Settings(percent=85, block=16)) == want
    assert len({c for _, c in want.values()}) > 60


def test_short_texts_are_not_given_up(spark):
    """6 shingles and twice 7: the shorter text links with both others, which do not link with each other."""
    rows = []
    for k in range(500):
        base = " ".join(f"w{k}_{j}" for j in range(10))
        rows += [(3 * k, f"{base} x{k}"), (3 * k + 1, base), (3 * k + 2, f"{base} y{k}")]
    got = result(spark.createDataFrame(rows, "doc_id long, text string"))
    assert [d for d, (_, c) in got.items() if c != d - d % 3] == []


def test_odd_rows(spark):
    same = "one two three four five six seven"
    rows = [
        (9, same), (3, same.upper()), (3, same), (None, same), (4, None), (5, ""), (6, " \n"), (7, "a b"), (8, "A\tB"),
        (10, "a b c"), (11, "é È"), (12, "é è"), (None, "alone in the dark of night tonight"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n", F.lit(1)).withColumn("digest", F.lit(1))
    out = sorted(map(tuple, hyperminhash.near_duplicates(docs, SETTINGS).collect()), key=str)
    assert out == sorted(
        [
            (9, 3, 3, False), (3, 3, 3, True), (3, 3, 3, True), (None, 3, 3, False), (4, 0, 4, True), (5, 0, 5, True),
            (6, 0, 6, True), (7, 1, 7, True), (8, 1, 7, False), (10, 1, 10, True), (11, 1, 11, True), (12, 1, 12, True),
            (None, 3, None, True),
        ],
        key=str,
    )
    assert hyperminhash.near_duplicates(docs.limit(0), SETTINGS).isEmpty()
    kept = hyperminhash.deduplicate(docs, SETTINGS)
    assert kept.columns == docs.columns and kept.count() == 11  # both NULL ids stay


def test_estimate():
    donors = hyperminhash._donors(SETTINGS.buckets)
    rng = random.Random(1)
    for size in (30, 300, 3000):
        base = [str(rng.random()).encode() for _ in range(size)]
        other = base[: size * 9 // 10] + [str(rng.random()).encode() for _ in range(size // 10)]
        x, y = shingles(base, 1), shingles(other, 1)
        true = len(np.intersect1d(x, y)) / len(np.union1d(x, y))
        same = (hyperminhash.registers(x, SETTINGS, donors) == hyperminhash.registers(y, SETTINGS, donors)).mean()
        got = hyperminhash.estimate(same, np.array(len(x)), np.array(len(y)), SETTINGS)
        assert abs(got - true) < 0.15
    assert hyperminhash.chance(np.array(1e4), np.array(1e4), SETTINGS) == pytest.approx(0.17 / 2**10, rel=0.05)


def test_compress_keeps_order():
    x = np.sort(np.random.default_rng(0).integers(1, 2**63, 1000).astype(np.uint64) * np.uint64(2))
    code = hyperminhash.compress(x, 10).astype(int)
    zeros, kept = code >> 10, code & 1023
    assert all(a > b or (a == b and c <= d) for a, b, c, d in zip(zeros, zeros[1:], kept, kept[1:], strict=False))
    assert [int(z) for z in hyperminhash.compress(np.array([2**63, 2**62, 1], np.uint64), 10) >> 10] == [0, 1, 52]


def test_components_of_a_path(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(40)] + [(101, 100), (100, 101)], "a long, b long")
    got = {r.node: r.comp for r in graph.components(links).collect()}
    assert got == {k: 0 for k in range(41)} | {100: 100, 101: 100}


def test_words_are_cut_at_ascii_space_only():
    assert words("A b\x1cc D\x0be") == ["a b\x1cc".encode(), b"d", b"e"]
