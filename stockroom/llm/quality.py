"""Quality rules: a threshold table compiled into one projection.

:func:`measures` adds what the rules look at, :func:`verdict` compiles a table of
:class:`Rule` into one boolean expression and a list of failed rules. Everything is
built-in functions in a single projection: no shuffle, no user function.

Defined results: a NULL or empty text has no words and fails ``min_words``; rows with
equal or NULL ids are judged one by one; an empty table gives an empty one; columns
of the input are never replaced, the operator's own columns carry a prefix.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACES

WINDOW = 8  # words of a window that counts as repeated; a power of two
SYMBOLS = "#*$%&|<>"

# Frequent function words of the four languages.
STOP_WORDS = (
    "the", "of", "and", "to", "in", "a", "is", "that", "it", "for", "was", "on", "as", "with", "be",
    "der", "die", "das", "und", "in", "den", "von", "zu", "mit", "ist", "des", "auf", "für", "nicht", "ein",
    "le", "la", "les", "de", "des", "et", "en", "un", "une", "du", "que", "pour", "qui", "dans", "est",
    "el", "los", "las", "del", "y", "que", "por", "con", "para", "se", "una", "no", "su", "al", "lo",
)


STOP_FORMS = sorted({form for w in STOP_WORDS for form in (w, w.capitalize(), w.upper())})


@dataclass(frozen=True)
class Rule:
    """Keep a text while ``low <= value <= high``; ``value`` names a measure or an expression of measures."""

    name: str
    value: str
    low: float | None = None
    high: float | None = None


BASE_RULES = (
    Rule("min_words", "n_words", low=20),
    Rule("repeated_windows", "100 * n_repeat_words - 30 * n_words", high=0),
)

RULES = (
    *BASE_RULES,
    Rule("word_length", "word_chars / n_words", low=1.5, high=15),
    Rule("symbol_ratio", "n_symbols / n_words", high=0.3),
    Rule("duplicate_lines", "n_dup_lines / n_lines", high=0.5),
    Rule("bullet_lines", "n_bullet_lines / n_lines", high=0.9),
    Rule("stop_words", "n_stop_words / n_words", low=0.005),
    Rule("stutter", "n_stutter_words / n_words", high=0.3),
    Rule("upper_case", "n_upper / word_chars", high=0.5),
    Rule("shouting", "n_exclaim / n_words", high=0.3),
)


def _once(value: Column, body) -> Column:
    """Evaluate ``value`` once per row and hand it to ``body`` as a variable."""
    return F.transform(F.array(value), body)[0]


def _repeated(tokens: Column) -> Column:
    """Words inside windows found twice or more, the first included.

    Windows are hashed by doubling runs of words; only where a hash recurs are the
    positions sorted along, so the cost is n log n for any text.
    """

    def covered(spots: Column) -> Column:
        # Positions of repeated windows, ascending: each adds what the next does not cover.
        ends = F.transform(
            spots,
            lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get(spots, i + 1) - p, F.lit(WINDOW))),
        )
        return F.aggregate(ends, F.lit(0), lambda a, b: a + b)

    def located(hashes: Column) -> Column:
        pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def spots(p: Column) -> Column:
            same = F.filter(
                p,
                lambda x, k: (F.get(p, k - 1)["h"].eqNullSafe(x["h"])) | (F.get(p, k + 1)["h"].eqNullSafe(x["h"])),
            )
            return F.sort_array(F.transform(same, lambda x: x["i"]))

        return _once(_once(pairs, spots), covered)

    def counted(hashes: Column) -> Column:
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(located(hashes))

    def doubled(hashes: Column, step: int) -> Column:
        # Hashes of runs twice as long; entries past the end are cut in the last step.
        return _once(hashes, lambda v: F.transform(v, lambda h, i: F.xxhash64(h, F.get(v, i + step))))

    def hashed(w: Column) -> Column:
        runs, step = F.transform(w, lambda x: F.xxhash64(x)), 1
        while step < WINDOW:
            runs, step = doubled(runs, step), 2 * step
        return _once(F.slice(runs, F.lit(1), F.size(w) - (WINDOW - 1)), counted)

    return F.when(F.size(tokens) > WINDOW, hashed(tokens)).otherwise(F.lit(0))


def measures(text: Column) -> Column:
    """All measures of a text as one struct of longs."""
    text = F.coalesce(text, F.lit(""))

    def of_words(w: Column) -> Column:
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.concat_ws("", w)).cast("long").alias("word_chars"),
            _repeated(w).cast("long").alias("n_repeat_words"),
            F.size(F.filter(w, lambda x: x.isin(*STOP_FORMS))).cast("long").alias("n_stop_words"),
            F.size(F.filter(w, lambda x, i: x == F.get(w, i - 1))).cast("long").alias("n_stutter_words"),
        )

    def of_lines(lines: Column) -> Column:
        return F.struct(
            F.size(lines).cast("long").alias("n_lines"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
            F.size(F.filter(lines, lambda x: F.ltrim(x).rlike("^[-*•]"))).cast("long").alias("n_bullet_lines"),
        )

    tokens = F.array_remove(F.split(text, "[" + SPACES + "]+"), "")
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.btrim(x, F.lit(SPACES))) > 0)
    return F.struct(
        _once(tokens, of_words).alias("words"),
        _once(lines, of_lines).alias("lines"),
        F.regexp_count(text, F.lit("[" + SYMBOLS + "]")).cast("long").alias("n_symbols"),
        F.regexp_count(text, F.lit(r"\p{Lu}")).cast("long").alias("n_upper"),
        F.regexp_count(text, F.lit("!")).cast("long").alias("n_exclaim"),
    )


FIELDS = {
    "n_words": "words", "word_chars": "words", "n_repeat_words": "words", "n_stop_words": "words",
    "n_stutter_words": "words",
    "n_lines": "lines", "n_dup_lines": "lines", "n_bullet_lines": "lines",
    "n_symbols": "", "n_upper": "", "n_exclaim": "",
}


def apply_rules(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text", prefix: str = "q_") -> DataFrame:
    """``docs`` with every measure, ``<prefix>failed`` (names of failed rules) and ``<prefix>kept``.

    A ratio whose divisor is 0 passes its rule; texts without words fail by their word count.
    """
    # A generator of one row per document: later filters and columns read the measures, and
    # the optimizer cannot copy their expressions into each place that names one.
    box = F.explode_outer(F.array(measures(F.col(f"`{text}`")))).alias(f"{prefix}all")
    flat = {f"{prefix}{k}": F.col(f"{prefix}all.{at + '.' if at else ''}{k}") for k, at in FIELDS.items()}
    df = docs.select("*", box).withColumns(flat).drop(f"{prefix}all")

    def failed(rule: Rule) -> Column:
        value = rule.value
        for field in sorted(FIELDS, key=len, reverse=True):
            value = value.replace(field, f"\0{sorted(FIELDS).index(field)}\0")
        for k, field in enumerate(sorted(FIELDS)):
            value = value.replace(f"\0{k}\0", f"`{prefix}{field}`")
        top, slash, bottom = value.partition(" / ")
        value = F.expr(f"try_divide({top}, {bottom})" if slash else value)
        low = F.lit(False) if rule.low is None else value < rule.low
        high = F.lit(False) if rule.high is None else value > rule.high
        return F.coalesce(low | high, F.lit(False))

    names = F.array_compact(F.array(*[F.when(failed(r), F.lit(r.name)) for r in rules]))
    return df.withColumn(f"{prefix}failed", names).withColumn(f"{prefix}kept", F.size(F.col(f"{prefix}failed")) == 0)


def digest(docs: DataFrame) -> DataFrame:
    """One row per document: the base counts, the base verdict and the whole verdict."""
    df = apply_rules(docs.select("doc_id", "text"))
    base = F.array(*[F.lit(r.name) for r in BASE_RULES])
    return df.select(
        "doc_id",
        F.col("q_n_words").alias("n_words"),
        F.col("q_word_chars").alias("word_chars"),
        F.col("q_n_symbols").alias("n_symbols"),
        F.col("q_n_dup_lines").alias("n_dup_lines"),
        F.col("q_n_repeat_words").alias("n_repeat_words"),
        F.arrays_overlap(F.col("q_failed"), base).alias("base_failed"),
        F.col("q_kept").alias("kept"),
        F.concat_ws(",", "q_failed").alias("failed_rules"),
    )
