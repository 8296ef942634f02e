"""Toxicity by two class-conditional Kneser-Ney models over the bytes of words.

Each class (toxic, ordinary) has its own counts of byte n-grams inside words, repeats
included; both back off to one shared Kneser-Ney distribution of the pooled counts, which
also weighs :attr:`Settings.prior` occurrences of a context, so that a rare expression is
judged by what both classes know and one occurrence does not set a ratio.

A text's evidence is the difference of the classes' log-likelihoods per word, normalised
by its length over all of its words. Three inputs stand beside it, as a few words vanish
in a long text: the same for words that tell the classes apart (:attr:`Settings.telling`),
the ratio of a text of which a share of the words is toxic (:attr:`Settings.share`), and
the single most toxic expression. A logistic curve over all four, fitted on labelled rows
that the counts have not seen, gives the score, at equal odds of the two classes.

The models learn from a bounded sample of the labelled rows: up to
:attr:`Settings.per_class` documents of each class (expected size, chosen by a hash of
the id), so the model and its broadcast do not grow with the corpus. Every document is
scored, whole, by tasks that keep only the model and a table of word scores.

Defined results: a NULL or empty text gets the score of a text without evidence; rows
are scored one by one, so repeated rows get equal scores; a NULL id is nobody's label;
without labelled rows of both classes every score is 0; extra columns are kept.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORDS_KEPT, fresh, pieces, remainder, stored, words

START, END = b"\x01", b"\x02"


@dataclass(frozen=True)
class Settings:
    order: int = 6  # bytes of an n-gram, at most 7: it is kept as a number
    discount: float = 0.75
    per_class: int = 4000  # labelled documents of each class to learn from, about
    telling: float = 3.0  # a word's log-likelihood ratio from which it counts in the second mean
    prior: float = 50.0  # occurrences of a context that the shared distribution stands for
    share: float = 0.02  # of a toxic text's words that are toxic, for the third mean
    threshold: float = 0.7


def grams(tokens: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray]:
    """All n-grams of the words as numbers, word by word, and where each word's begin."""
    sizes = np.array([len(w) + 1 for w in tokens], np.int64)
    pad = START * (order - 1)
    flat = np.frombuffer(b"".join(pad + w + END for w in tokens), np.uint8).astype(np.int64)
    starts = np.cumsum(sizes) - sizes
    # A word's padding lies before it: its windows begin (order - 1) bytes further per word.
    first = np.arange(sizes.sum()) + np.repeat(np.arange(len(sizes)) * (order - 1), sizes)
    keys = np.zeros(len(first), np.int64)
    for k in range(order):
        keys = keys << 8 | flat[first + k]
    return keys, starts


def sample(docs: DataFrame, labels: DataFrame, settings: Settings) -> DataFrame:
    """(toxic, fold, text) of a bounded number of labelled documents; fold 0 counts, fold 1 calibrates."""
    known = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).dropna().filter("toxic IN (0, 1)")
    sizes = {r.toxic: r.n for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    place = F.pmod(F.xxhash64(F.col("doc_id"), F.lit(17)), F.lit(1 << 30)) / float(1 << 30)
    share = F.lit(0.0)
    for toxic, n in sizes.items():
        share = F.when(F.col("toxic") == toxic, F.lit(min(settings.per_class, n) / n)).otherwise(share)
    fold = F.pmod(F.xxhash64(F.col("doc_id"), F.lit(29)), F.lit(3)) == 0
    chosen = known.filter(place < share).select("doc_id", "toxic", fold.cast("int").alias("fold"))
    # At most about 2 * per_class rows of numbers, whatever the input.
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    return texts.withColumn("same", F.xxhash64("text")).dropDuplicates(["toxic", "same"]).select("toxic", "fold", "text")


def gram_counts(rows: DataFrame, order: int) -> DataFrame:
    """(toxic, gram, n): how often, combined in each task first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = {0: Counter(), 1: Counter()}
        for part, texts in pieces(batches):
            for toxic, text in zip(part.column("toxic").to_pylist(), texts, strict=True):
                found[toxic].update(words(text))
        for toxic, tokens in found.items():
            if tokens:
                keys, starts = grams(list(tokens), order)
                per_word = np.diff(starts, append=len(keys))
                distinct, at = np.unique(keys, return_inverse=True)
                n = np.bincount(at, np.repeat(np.fromiter(tokens.values(), np.int64, len(tokens)), per_word))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(distinct), toxic, np.int32)), pa.array(distinct), pa.array(n.astype(np.int64))],
                    names=["toxic", "gram", "n"],
                )

    found = rows.select("toxic", "text").mapInArrow(count, "toxic int, gram long, n long")
    return found.groupBy("toxic", "gram").agg(F.sum("n").alias("n"))


def _by_context(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Contexts, each key's context, and per context the sum and the number of its counts."""
    contexts, at = np.unique(keys >> 8, return_inverse=True)
    return contexts, at, np.bincount(at, n, len(contexts)), np.bincount(at, n > 0, len(contexts))


def shared_backoff(keys: np.ndarray, order: int, discount: float) -> np.ndarray:
    """Kneser-Ney probability of each n-gram's last byte after all but its first byte.

    ``keys`` are the distinct n-grams of both classes. Every lower order counts in how
    many distinct ways an n-gram continues to the left.
    """
    levels, level = {}, keys
    for size in range(order - 1, 0, -1):
        level, n = np.unique(level & ((1 << 8 * size) - 1), return_counts=True)
        levels[size] = level, n
    below, prob = np.zeros(1, np.int64), np.array([1 / 257])
    for size in range(1, order):
        level, n = levels[size]
        _, at, total, kinds = _by_context(level, n)
        base = prob[np.searchsorted(below, level & ((1 << 8 * (size - 1)) - 1))]
        prob = np.maximum(n - discount, 0) / total[at] + discount * kinds[at] / total[at] * base
        below = level
    return prob[np.searchsorted(below, keys & ((1 << 8 * (order - 1)) - 1))]


@dataclass(frozen=True)
class Ratios:
    """Log-likelihood ratio (toxic over ordinary) of n-grams; none that neither class has seen tells them apart."""

    keys: np.ndarray
    values: np.ndarray

    def of(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.zeros(len(keys))
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.values[at], 0.0)


def compare(
    counts: tuple[tuple[np.ndarray, np.ndarray], ...], order: int, discount: float, prior: float = 0.0
) -> Ratios:
    """Ratios from the (keys, counts) of the ordinary and the toxic class."""
    pooled = np.union1d(counts[0][0], counts[1][0])
    owns = []
    for keys, n in counts:
        own = np.zeros(len(pooled))
        own[np.searchsorted(pooled, keys)] = n
        owns.append(own)
    _, at, total, kinds = _by_context(pooled, sum(owns))
    shared = np.maximum(sum(owns) - discount, 0) / total[at]
    shared += (discount * kinds / total)[at] * shared_backoff(pooled, order, discount)
    prob = []
    for own in owns:
        _, at, total, kinds = _by_context(pooled, own)
        size, left = total + prior, discount * kinds + prior
        size, left = np.where(size > 0, size, 1.0), np.where(size > 0, left, 1.0)
        prob.append((np.maximum(own - discount, 0) + left[at] * shared) / size[at])
    return Ratios(pooled, np.log(prob[1] / prob[0]))


class WordScores(dict):
    """Log-likelihood ratios of words, computed once for each word a worker meets."""

    def __init__(self, ratios: Ratios, order: int):
        super().__init__()
        self.ratios, self.order = ratios, order

    def learn(self, texts: list[list[bytes]]) -> None:
        """Score all words of some texts that are not yet known."""
        if len(self) >= WORDS_KEPT:
            self.clear()
        unknown = list({w for tokens in texts for w in tokens if w not in self})
        for k in range(0, len(unknown), 50_000):
            some = unknown[k : k + 50_000]
            keys, starts = grams(some, self.order)
            self.update(zip(some, np.add.reduceat(self.ratios.of(keys), starts).tolist(), strict=True))


INPUTS = ("mean_ratio", "telling_ratio", "mixed_ratio", "highest_ratio")


def evidence(
    docs: DataFrame, ratios: Ratios, settings: Settings, into: tuple[str, ...], drop_text: bool = True
) -> DataFrame:
    """``docs`` and a column more for each of :data:`INPUTS`.

    The means are over all words, times the square root of their number: in units of the
    deviation that a text of that length has by chance.
    """
    model = docs.sparkSession.sparkContext.broadcast(ratios)
    order, telling, share = settings.order, settings.telling, settings.share

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = WordScores(model.value, order)
        for part, texts in pieces(batches):
            found = np.zeros((len(INPUTS), len(texts)))
            cut = [words(t) for t in texts]
            scores.learn(cut)
            for k, tokens in enumerate(cut):
                if tokens:
                    each = np.fromiter(map(scores.__getitem__, tokens), float, len(tokens))
                    mixed = np.log1p(share * np.expm1(np.minimum(each, 500.0)))
                    sums = each.sum(), each[np.abs(each) >= telling].sum(), mixed.sum()
                    found[:, k] = *(x / len(each) ** 0.5 for x in sums), each.max()
            keep = [k for k, name in enumerate(part.schema.names) if not (drop_text and name == "text")]
            yield pa.RecordBatch.from_arrays(
                [*(part.column(k) for k in keep), *map(pa.array, found)],
                names=[*(part.schema.names[k] for k in keep), *into],
            )

    kept = [f for f in docs.schema.fields if not (drop_text and f.name == "text")]
    ddl = [*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), *(f"`{c}` double" for c in into)]
    return docs.mapInArrow(score, ", ".join(ddl))


def calibrate(toxic: np.ndarray, x: np.ndarray) -> tuple[float, ...]:
    """Logistic weights by ridge-damped Newton steps."""
    w = np.zeros(x.shape[1])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (toxic - p) - 1e-2 * w
        bend = (x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(x.shape[1])
        step = np.linalg.solve(bend, slope)
        w = w + step / max(1.0, float(np.abs(step).max()) / 2)
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(v) for v in w)


@dataclass(frozen=True)
class Model:
    ratios: Ratios
    weights: tuple[float, ...] | None  # of 1 and of INPUTS
    settings: Settings


def _ratios(rows: DataFrame, settings: Settings) -> Ratios | None:
    """What the rows' classes know; None unless there are both. Counts come to the driver as numbers."""
    counts = gram_counts(rows, settings.order).toArrow()
    toxic = counts.column("toxic").to_numpy()
    classes = []
    for c in (0, 1):
        mine = counts.filter(pa.array(toxic == c))
        keys, n = mine.column("gram").to_numpy(), mine.column("n").to_numpy()
        order = np.argsort(keys)
        classes.append((keys[order], n[order]))
    if not all(len(keys) for keys, _ in classes):
        return None
    return compare(tuple(classes), settings.order, settings.discount, settings.prior)


def fit(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Model:
    """Learn from labelled rows; the sample's counts and scores come to the driver, nothing else.

    The curve is fitted on a third of the sample, scored by counts of the other two
    thirds; the final counts are those of the whole sample.
    """
    rows = stored(sample(docs, labels, settings), "toxic_sample")
    weights = (-8.0, 1.0, 0.0, 0.0, 1.0)
    held = rows.filter("fold = 1").select("toxic", "text")
    part = _ratios(rows.filter("fold = 0"), settings)
    if part is not None and held.select("toxic").distinct().count() == 2:
        seen = evidence(held, part, settings, INPUTS).toPandas()
        toxic = seen["toxic"].to_numpy(float)
        bias, *slopes = calibrate(toxic, np.column_stack([np.ones(len(seen)), seen[list(INPUTS)].to_numpy(float)]))
        # Toxic documents are few: at their own odds most would stay below the threshold.
        weights = (bias + float(np.log((1 - toxic).sum() / toxic.sum())), *slopes)
    ratios = _ratios(rows, settings)
    empty = np.empty(0, np.int64)
    if ratios is None:
        return Model(Ratios(empty, np.empty(0)), None, settings)
    return Model(ratios, weights, settings)


def scored(
    docs: DataFrame, model: Model, score: str = "score", predicted: str = "predicted", drop_text: bool = True
) -> DataFrame:
    """``docs``, with or without ``text``, with ``score`` and ``predicted``."""
    if model.weights is None:
        plain = docs.drop("text") if drop_text else docs
        return plain.withColumns({score: F.lit(0.0), predicted: F.lit(0)})
    into = tuple(fresh(docs, c) for c in INPUTS)
    bias, *slopes = model.weights
    df = evidence(docs, model.ratios, model.settings, into, drop_text)
    z = sum((F.col(c) * w for c, w in zip(into, slopes, strict=True)), F.lit(bias))
    df = df.withColumn(score, 1 / (1 + F.exp(-F.greatest(F.lit(-500.0), F.least(F.lit(500.0), z)))))
    return df.withColumn(predicted, (F.col(score) >= model.settings.threshold).cast("int")).drop(*into)


def digest(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Scores of all documents by a model that has seen no label of a held-out one."""
    model = fit(docs, labels.filter(remainder(F.col("doc_id"), 3) != 1), settings)
    held_out = F.coalesce(remainder(F.col("doc_id"), 3) == 1, F.lit(False)).alias("held_out")
    return scored(docs.select("doc_id", "text"), model).select("doc_id", held_out, "score", "predicted")


def keep_harmless(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic."""
    model = fit(docs, labels, settings)
    score, predicted = fresh(docs, "score"), fresh(docs, "predicted")
    rated = scored(docs, model, score, predicted, drop_text=False)
    return rated.filter(F.col(predicted) == 0).select(*docs.columns)
