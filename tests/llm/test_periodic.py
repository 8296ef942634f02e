"""Periodic runs against their definition, tile by tile and as a whole, and edge cases."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from stockroom.llm import periodic, queries

DDL = "doc_id long, text string"


def brute_runs(w):
    """(start, length, period) of all runs, from the definition."""
    found = []
    for q in range(1, len(w) // 3 + 1):
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            s = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            part = w[s : i + q]
            smallest = next(p for p in range(1, q + 1) if all(part[k] == part[k + p] for k in range(len(part) - p)))
            if smallest == q and len(part) >= max(24, 3 * q):
                found.append((s, len(part), q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def brute(doc_id, text):
    """The whole row of the digest, and the runs."""
    w = [x for x in re.split("[\x20\x09-\x0d]+", text or "") if x]
    n = len(w)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(w)
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    left = [x for i, x in enumerate(w) if i not in dropped]
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    top = (best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4

    def digest(s):
        return hashlib.sha256(s.encode()).hexdigest()

    return (doc_id, len(runs), *top, digest("".join(f"{s},{n},{q}\n" for s, n, q in runs)), digest(" ".join(left)))


def random_words(rng, size):
    """Words with planted repeats of many periods, some repeats inside others."""
    letters = [f"w{k}" for k in range(rng.choice((1, 2, 3, 50)))]
    out = []
    while len(out) < size:
        unit = [rng.choice(letters) for _ in range(rng.choice((1, 2, 3, 5, 8, 9, 15, 16, 17, 31, 32, 33, 40, 70)))]
        if rng.random() < 0.3:
            unit = unit * rng.randrange(1, 4) + [rng.choice(letters)]
        out += unit * rng.choice((1, 1, 2, 3, 4, 7))
        if rng.random() < 0.5:
            out += [f"x{rng.randrange(1000)}" for _ in range(rng.randrange(4))]
    return out[:size]


def solved_runs(w):
    """Runs by way of the tiles, stitched in plain Python."""
    ids = periodic.numbered([x.encode() for x in w])
    pieces = {}
    for octave, base, chosen, words in periodic.tile_rows(ids):
        for q, a, b in periodic.solved(words, base, octave, chosen.tolist(), len(ids)):
            pieces.setdefault(q, []).append((a, b))
    out = []
    for q, parts in pieces.items():
        whole = []
        for a, b in sorted(parts):
            if whole and a <= whole[-1][1]:
                whole[-1][1] = max(whole[-1][1], b)
            else:
                whole.append([a, b])
        out += [(a, b - a + q, q) for a, b in whole if b - a + q >= max(24, 3 * q)]
    return sorted(out, key=lambda r: (r[0], r[2]))


@pytest.mark.parametrize("tile", [1, 100, 1 << 16])
def test_tiles_equal_the_definition(tile, monkeypatch):
    monkeypatch.setattr(periodic, "TILE_WORDS", tile)
    rng = random.Random(tile)
    found = 0
    for _ in range(250):
        w = random_words(rng, rng.choice((3, 23, 24, 25, 60, 150, 400)))
        want = brute_runs(w)
        assert solved_runs(w) == want, w
        found += len(want)
    assert found > 100


def test_every_period_at_every_place():
    for q in range(1, 60):
        for lead in (0, 1, 15, 16, 17, 33):
            size = max(24, 3 * q)
            w = [f"l{k}" for k in range(lead)] + [f"u{k % q}" for k in range(size)] + ["end"]
            assert solved_runs(w) == [(lead, size, q)]
            assert solved_runs(w[:-2]) == []


def test_z_function():
    rng = random.Random(4)
    for _ in range(300):
        s = [rng.randrange(2) for _ in range(rng.randrange(30))]
        want = [next((k for k in range(len(s) - i) if s[k] != s[i + k]), len(s) - i) for i in range(len(s))]
        assert periodic.z_function(s) == want


def test_digest_against_the_definition(frame, monkeypatch):
    monkeypatch.setattr(periodic, "TILE_WORDS", 64)  # many rows a document, so that pieces are stitched by Spark
    rng = random.Random(9)
    data = [(k, rng.choice((" ", "\n", " \t")).join(random_words(rng, rng.randrange(300)))) for k in range(120)]
    data += [(k, " ".join(f"p{i}" for i in range(rng.randrange(200)))) for k in range(200, 260)]
    data += [(None, " ".join(["a"] * 30)), (5, data[5][1]), (5, data[5][1]), (5, "b " * 100), (300, None), (301, ""), (302, " \n")]
    data += [(303, "é\xa0ü " * 40), (304, "a\x1cb " * 30)]  # U+00A0 and U+001C are no ends of words
    out = periodic.digest(frame(data, DDL).repartition(4)).collect()
    want = [brute(d, t) for d, t in data]
    assert sum(r[1] > 0 for r in want) > 50
    assert sorted(map(tuple, out), key=str) == sorted(want, key=str)


def test_long_text_of_one_word(frame):
    text = "la " * 200_000
    out = periodic.digest(frame([(1, text), (2, text + "end"), (3, "x " + text)], DDL)).collect()
    assert {(r.doc_id, r.n_runs, r.start, r.length, r.period) for r in out if r.doc_id != 2} == {
        (1, 1, 0, 200_000, 1), (3, 1, 1, 200_000, 1)
    }


def test_find_gives_texts(frame):
    df = frame([(1, "a b " * 20 + "c", "z"), (2, "one two", "y")], f"{DDL}, runs string")
    out = {r.doc_id: r for r in periodic.find(df).collect()}
    assert out[1].collapsed == "a b c" and [tuple(r) for r in out[1].runs] == [(0, 2, 40)]
    assert out[2].collapsed is None and out[2].runs == [] and out[2].n_words == 2


def test_empty_table(frame):
    assert periodic.digest(frame([], DDL)).collect() == []


def test_settled_documents_hold_no_recurring_stretch():
    rng = np.random.default_rng(1)
    assert list(periodic.boundaries(rng.permutation(5000))) == []


def test_registered_query(spark):
    folder = "/root/testdata/sf0.001"
    out = queries.queries()["op13_periodic_runs"](spark, folder).collect()
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    few = {r.doc_id for r in docs if len((r.text or "").split()) < 500}
    want = sorted(brute(r.doc_id, r.text) for r in docs if r.doc_id in few)
    assert len(out) == len(docs) and len(few) > 150
    assert sorted((tuple(r) for r in out if r.doc_id in few), key=str) == sorted(want, key=str)
