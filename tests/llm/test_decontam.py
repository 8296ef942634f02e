"""Decontamination against comparing every alignment, and what the masks promise."""

import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

from stockroom.llm import decontam
from stockroom.llm.common import words

FOLDER = "/root/testdata/sf0.01"
SETTINGS = decontam.Settings()


def bare(text):
    return [w for w in (x.strip(decontam.PUNCTUATION) for x in words(text)) if w]


def brute(docs, items, least=5):
    """doc row -> item ids with some aligned window of 13 words, 11 equal (short items: the same share of all words)."""
    out = []
    cut = [(i, bare(t)) for i, t in items]
    where = {}
    for i, y in cut:
        for k, w in enumerate(y):
            where.setdefault(w, []).append((i, k, y))
    for d, t in docs:
        x = bare(t)
        found = set()
        shifts = {(i, p - k, tuple(y)) for p, w in enumerate(x) for i, k, y in where.get(w, ())}
        for i, s, y in shifts:
            width, need = (13, 11) if len(y) >= 13 else (len(y), math.ceil(len(y) * 11 / 13))
            if len(y) < least:
                continue
            low, high = max(0, s), min(len(x), s + len(y))
            same = [x[p] == y[p - s] for p in range(low, high)]
            if any(sum(same[p : p + width]) >= need for p in range(len(same) - width + 1)):
                found.add(i)
        out.append((d, sorted(found)))
    return sorted(out, key=str)


def result(docs, benchmark):
    return sorted(((r.doc_id, r["items"]) for r in decontam.find(docs, benchmark).collect()), key=str)


def test_masks_find_any_two_substitutions():
    for bad in itertools.combinations(range(13), 2):
        assert any(
            all(start + place not in bad for place in mask)
            for mask in decontam.MASKS
            for start in range(13 - mask[-1])
        )


def test_table(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").limit(400)
    benchmark = spark.read.parquet(f"{FOLDER}/benchmark.parquet")
    want = brute(map(tuple, docs.collect()), map(tuple, benchmark.collect()))
    assert result(docs, benchmark) == want and any(x for _, x in want)


@pytest.fixture(scope="module")
def planted():
    rng = random.Random(2)
    noise = lambda n: [f"n{rng.randrange(10**6)}" for _ in range(n)]
    items = [(k, " ".join(noise(30))) for k in range(8)]
    items += [(8, "five words are just enough"), (9, "four are too few"), (10, None), (11, ""), (8, items[0][1])]
    docs = []
    for k in range(60):
        passage = items[k % 8][1].split()[5:18]
        for place in rng.sample(range(13), k % 4):  # up to two substitutions count, three do not
            passage[place] = f"s{k}"
        docs.append((k, " ".join(noise(rng.randrange(40)) + passage + noise(rng.randrange(40)))))
    docs += [
        (60, "Well: FIVE words, are \"just\" enough!"), (61, "four are too few"), (62, None), (63, ""),
        (0, "clean"), (None, items[3][1]), (64, items[3][1] + " " + items[4][1]), (64, items[3][1] + " " + items[4][1]),
        (65, " ".join(items[5][1].split()[:12])), (66, " ".join(noise(50_000) + items[6][1].split())),
    ]
    return docs, items


@pytest.mark.parametrize("bits", [1 << 25, 64])
def test_planted(spark, planted, bits):
    docs, items = planted
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumn("place", F.lit("x"))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = decontam.find(frame, benchmark, decontam.Settings(bits=bits)).collect()
    assert sorted(((r.doc_id, r["items"]) for r in got), key=str) == brute(docs, items)
    assert {r.doc_id for r in got if r.contaminated} >= {0, 1, 2, 60, 64, 66} and all(r.doc_id != 3 or not r.contaminated for r in got)


@pytest.mark.parametrize("n", range(1, 13))
def test_masks_of_short_items(n):
    """Up to the substitutions allowed, one mask of an item's length avoids them all."""
    masks = [SETTINGS.masks()[m] for m in decontam.Settings(least=1).used(n)]
    allowed = n - SETTINGS.needed(n)
    assert allowed == (n >= 7)
    for bad in itertools.combinations(range(n), allowed):
        assert any(not set(bad) & set(mask) for mask in masks)
    assert all(max(mask) < n for mask in masks)


@pytest.mark.parametrize("least", [5, 1])
def test_short_items(spark, least):
    """Items of 1 to 12 words, whole and with one or two words replaced, alone and at both ends of a text."""
    items = [(n, " ".join(f"w{n}x{i}" for i in range(n))) for n in range(1, 13)]
    docs = []
    for n, text in items:
        for places in [(), *((i,) for i in range(n)), *itertools.combinations(range(0, n, 2), 2)]:
            passage = [f"s{i}" if i in places else w for i, w in enumerate(text.split())]
            for before, after in (([], []), (["a"] * 20, []), ([], ["b"] * 20), (["a"], ["b"])):
                docs.append((len(docs), " ".join(before + passage + after)))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    benchmark = spark.createDataFrame([*items, (13, None), (14, " . ")], "item_id long, text string")
    settings = decontam.Settings(least=least)
    got = decontam.find(frame, benchmark, settings).collect()
    want = brute(docs, items, least)
    assert sorted(((r.doc_id, r["items"]) for r in got), key=str) == want
    assert {i for _, x in want for i in x} == set(range(least, 13))
    left = sorted(map(tuple, decontam.unsought(benchmark, settings).collect()))
    assert left == [(n, n) for n in range(1, least)] + [(13, 0), (14, 0)]


def test_remove(spark, planted):
    docs, items = planted
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumn("bad_id", F.lit(1))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    left = decontam.remove(frame, benchmark)
    want = [d for d, x in brute(docs, items) if not x]
    assert left.columns == frame.columns
    assert sorted((r.doc_id for r in left.collect()), key=str) == sorted(want, key=str)


def test_empty(spark, planted):
    docs, items = planted
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    assert decontam.find(frame.limit(0), benchmark).isEmpty()
    assert decontam.find(frame, benchmark.limit(0)).filter("contaminated").isEmpty()
    assert decontam.remove(frame, benchmark.limit(0)).count() == len(docs)
