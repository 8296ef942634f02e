"""Toxicity: the smoothing by hand, held-out accuracy, and odd inputs."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from stockroom.llm import toxicity
from stockroom.llm.common import remainder

FOLDER = "/root/testdata/sf0.1"


def plain(word, order):
    padded = toxicity.START * (order - 1) + word + toxicity.END
    return [padded[i : i + order] for i in range(len(word) + 1)]


def test_grams():
    tokens = [b"ab", b"c", "é".encode(), b"abcdefgh"]
    keys, starts = toxicity.grams(tokens, 6)
    want = [[int.from_bytes(g, "big") for g in plain(w, 6)] for w in tokens]
    assert [list(map(int, k)) for k in np.split(keys, starts[1:])] == want


def by_definition(grams, order, discount):
    """Interpolated Kneser-Ney below the top order, from its formula."""
    level, levels = set(grams), {}
    for size in range(order - 1, 0, -1):
        levels[size] = Counter(g[1:] for g in level)
        level = set(levels[size])

    def prob(g):
        if not g:
            return 1 / 257
        followers = {h: n for h, n in levels[len(g)].items() if h[:-1] == g[:-1]}
        total = sum(followers.values())
        return max(followers.get(g, 0) - discount, 0) / total + discount * len(followers) / total * prob(g[1:])

    return prob


def test_shared_backoff_follows_the_formula():
    grams = {g for w in (b"abc", b"abd", b"bad", b"aaa", b"") for g in plain(w, 4)}
    keys = np.array(sorted(int.from_bytes(g, "big") for g in grams))
    prob = by_definition(grams, 4, 0.75)
    want = [prob(int(k).to_bytes(4, "big")[1:]) for k in keys]
    assert np.allclose(toxicity.shared_backoff(keys, 4, 0.75), want)


def test_ratio_prefers_the_class_that_knows_a_word():
    counts = []
    for listed in ([b"good", b"day", b"sun"], [b"scum", b"day", b"sun"]):
        found = Counter(g for w in listed for g in toxicity.grams([w], 4)[0].tolist())
        keys = np.array(sorted(found))
        counts.append((keys, np.array([9 * found[k] for k in keys])))
    scores = toxicity.WordScores(toxicity.compare(tuple(counts), 4, 0.75), 4)
    scores.learn([[b"scum", b"sun"], [b"good", b"zzz"]])
    assert scores[b"scum"] > 2 > 0.2 > abs(scores[b"sun"]) and scores[b"good"] < -2
    assert abs(scores[b"zzz"]) < math.inf


def test_calibration_separates():
    y = np.array([0.0, 0, 0, 1, 1, 1])
    x = np.stack([np.ones(6), np.array([0.0, 1, 2, 5, 6, 7])], 1)
    w = toxicity.calibrate(y, x)
    p = 1 / (1 + np.exp(-(x @ np.array(w))))
    assert (p[:3] < 0.3).all() and (p[3:] > 0.7).all()


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    rated = toxicity.digest(docs, labels).join(labels, "doc_id").filter("held_out")
    assert docs.count() == toxicity.digest(docs, labels).count()
    by = {
        (r.toxic, r.predicted): r.n
        for r in rated.groupBy("toxic", "predicted").agg(F.count("*").alias("n")).collect()
    }
    # A few hundred toxic documents to learn from here; see the README for larger tables.
    assert by[1, 1] / (by[1, 1] + by[1, 0]) > 0.5 and by[0, 1] / (by[0, 1] + by[0, 0]) < 0.05


def test_held_out_toxic_texts_are_found_in_every_language(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    rated = toxicity.digest(docs, labels).join(labels, "doc_id").join(docs.select("doc_id", "lang"), "doc_id")
    by = rated.filter("held_out AND toxic = 1").groupBy("lang").agg(F.sum("predicted").alias("found"), F.count("*").alias("n"))
    found = {r.lang: (r.found, r.n) for r in by.collect()}
    print("found", found, "false", rated.filter("held_out AND toxic = 0").agg(F.sum("predicted"), F.count("*")).first())
    assert all(2 * found[lang][0] > found[lang][1] for lang in ("de", "en", "fr"))
    assert found["es"][0] and sum(f for f, _ in found.values()) > 0.75 * sum(n for _, n in found.values())


def test_repeats_count(spark):
    rows = spark.createDataFrame([(1, "ab ab ab"), (1, "ab"), (0, "ab")], "toxic int, text string")
    assert {(r.toxic, r.n) for r in toxicity.gram_counts(rows, 4).collect()} == {(1, 4), (0, 1)}


@pytest.fixture(scope="module")
def small(spark):
    rows = [(k, ("scum idiot " if k % 2 else "sun day ") + f"n{k} the cat sat on a mat " * 3) for k in range(60)]
    docs = spark.createDataFrame([*rows, (60, None), (61, ""), (61, ""), (None, "scum"), (62, "x " * 100_000)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(60)] + [(None, 1), (5, None)], "doc_id long, toxic int")
    return docs, labels


def test_odd_rows(spark, small):
    docs, labels = small
    clash = docs.withColumns({"score": F.lit("x"), "word_count": F.lit(1)})
    out = toxicity.digest(clash, labels).collect()
    assert len(out) == 65 and all(0 <= r.score <= 1 for r in out)
    held = [r for r in out if r.held_out and r.doc_id is not None and r.doc_id < 60]
    assert held and all(r.predicted == r.doc_id % 2 for r in held)
    stay = toxicity.keep_harmless(clash, labels)
    assert stay.columns == clash.columns and {r.doc_id for r in stay.collect()} >= {0, 60, 61, 62}


def test_labels_of_held_out_rows_do_not_matter(spark, small):
    docs, labels = small
    held = remainder(F.col("doc_id"), 3) == 1
    turned = labels.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert sorted(toxicity.digest(docs, labels).collect(), key=str) == sorted(toxicity.digest(docs, turned).collect(), key=str)


def test_without_labels(spark, small):
    docs, labels = small
    out = toxicity.digest(docs, labels.filter("toxic = 0"))
    assert out.filter("score <> 0 or predicted <> 0").isEmpty() and out.count() == 65
    assert toxicity.digest(docs.limit(0), labels).isEmpty()
