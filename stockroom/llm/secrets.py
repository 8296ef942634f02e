"""Secret scans through a trigram index, in DataFrame functions throughout.

1. :func:`trigram_query` derives from a rule's regular expression the clauses a match
   implies: an OR of sets of trigrams (an AND each). A rule without a mandatory
   trigram has no query and is verified against every text.
2. :func:`postings` lists (trigram, document) for the trigrams that any query names.
3. :func:`candidates` intersects the postings of each clause.
4. :func:`scan` verifies the candidates with the expressions themselves and gives the
   spans in code points. Hex runs, which have no trigram, are sought in every text.

Defined results: a NULL text is empty; equal ids share postings, which only adds
candidates, and each row is verified by itself; NULL ids are matched null-safely;
an empty table gives an empty result; extra columns are kept, and the names this
module adds avoid theirs.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh

try:  # the parser of the standard library, to read rules
    from re import _constants as sre, _parser as sre_parse
except ImportError:  # older interpreters
    import sre_constants as sre
    import sre_parse


@dataclass(frozen=True)
class Rule:
    """A kind of secret: its expression, which group must be how long, and letter case."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    any_case: bool = False

    def java(self) -> str:
        return ("(?i)" if self.any_case else "") + self.pattern


# The base kinds, in their order.
BASE = (
    Rule(
        "assign",
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        group=2, least=6, any_case=True,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", least=20),
    Rule("hex", r"[0-9a-f]{24,}"),  # maximal runs, so the same as any run cut at 24
)
# Public formats of well-known credentials.
MORE = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", r"[sr]k_live_[A-Za-z0-9]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("pem", r"-----BEGIN (?:[A-Z]+ )?PRIVATE KEY-----"),
)
RULES = BASE + MORE

PART = 1024  # code points of the parts in which places of a text are sought; only speed depends on it
MOST_STRINGS = 64  # alternatives kept apart while a query is derived; beyond, it gets weaker, never wrong


def _exact(node) -> list[str] | None:
    """All strings a piece of an expression can match, if they are few; else None."""
    kind, arg = node
    if kind is sre.LITERAL:
        return [chr(arg)]
    if kind is sre.IN:
        if any(k is not sre.LITERAL for k, _ in arg) or len(arg) > 8:
            return None
        return [chr(v) for _, v in arg]
    if kind is sre.SUBPATTERN:
        return _exact_run(arg[-1])
    if kind is sre.BRANCH:
        found = [_exact_run(b) for b in arg[1]]
        return None if None in found else sorted({s for f in found for s in f})
    if kind in (sre.MAX_REPEAT, sre.MIN_REPEAT):
        low, high, body = arg
        unit = _exact_run(body)
        if unit is None or high is sre.MAXREPEAT or high > 5 or len(unit) ** high > MOST_STRINGS:
            return None
        return sorted({"".join(p) for n in range(low, high + 1) for p in product(unit, repeat=n)})
    return None


def _exact_run(nodes) -> list[str] | None:
    out = [""]
    for node in nodes:
        part = _exact(node)
        if part is None or len(out) * len(part) > MOST_STRINGS:
            return None
        out = [a + b for a in out for b in part]
    return out


def _clauses(nodes) -> list[frozenset[str]]:
    """OR of ANDs of trigrams that any match of the sequence must contain; ``[set()]``: nothing is mandatory."""
    found = [frozenset()]

    def both(more: list[frozenset[str]]) -> None:
        nonlocal found
        if len(found) * len(more) <= MOST_STRINGS:
            found = [a | b for a in found for b in more]

    def flush(strings: list[str]) -> None:
        both([frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings])

    run = [""]
    for node in nodes:
        part = _exact(node)
        if part is not None and len(run) * len(part) <= MOST_STRINGS:
            run = [a + b for a in run for b in part]
            continue
        flush(run)
        run = [""]
        kind, arg = node
        if kind is sre.SUBPATTERN:
            both(_clauses(arg[-1]))
        elif kind is sre.BRANCH:
            both([c for b in arg[1] for c in _clauses(b)])
        elif kind in (sre.MAX_REPEAT, sre.MIN_REPEAT) and arg[0] > 0:
            both(_clauses(arg[2]))
    flush(run)
    least = [c for c in set(found) if not any(d < c for d in found)]  # a AND b is implied by a
    return sorted(least, key=sorted)


def trigram_query(pattern: str) -> list[frozenset[str]]:
    """Clauses for lower-cased text; empty if some match needs no trigram at all."""
    clauses = _clauses(sre_parse.parse(pattern.lower() if "\\" not in pattern else _lowered(pattern)))
    return [] if any(not c for c in clauses) else clauses


def _lowered(pattern: str) -> str:
    """Lower case outside escapes, so that ``\\S`` stays ``\\S``."""
    return re.sub(r"\\.|[^\\]+", lambda m: m[0] if m[0][0] == "\\" else m[0].lower(), pattern)


def postings(docs: DataFrame, trigrams: list[str], key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, trigram number) for each of ``trigrams`` that a lower-cased text contains."""

    def held(lower: Column) -> Column:
        return F.array_compact(F.array(*[F.when(F.contains(lower, F.lit(t)), F.lit(i)) for i, t in enumerate(trigrams)]))

    found = F.transform(F.array(F.lower(F.col(f"`{text}`"))), held)[0]
    return docs.select(F.col(f"`{key}`").alias("key"), F.explode(found).alias("trigram"))


def candidates(docs: DataFrame, rules: tuple[Rule, ...], key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, rules): numbers of the rules of whose queries some clause is met, one row per key."""
    clauses = [(r, c) for r, rule in enumerate(rules) for c in trigram_query(rule.pattern)]
    trigrams = sorted({t for _, c in clauses for t in c})
    number = {t: i for i, t in enumerate(trigrams)}
    spark = docs.sparkSession
    wanted = spark.createDataFrame(
        [(k, r, number[t], len(c)) for k, (r, c) in enumerate(clauses) for t in sorted(c)],
        "clause int, rule int, trigram int, needed int",
    )
    # The clause table is as large as the rules, whatever the input, so it is broadcast.
    # A text's postings lie in one partition: counting combines them before the shuffle.
    met = (
        postings(docs, trigrams, key, text)
        .join(F.broadcast(wanted), "trigram")
        .groupBy("key", "clause", "rule", "needed")
        .agg(F.collect_set("trigram").alias("have"))
        .filter(F.size("have") == F.col("needed"))
    )
    return met.groupBy("key").agg(F.collect_set("rule").alias("rules"))


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), use)[0]


def _running(values: Column, step: Callable[[Column, Column], Column]) -> Column:
    """``step`` folded from 0 over an array of ints, with every result on the way: n + 1 of them.

    An array can only be appended to by a copy, so the array is cut into about sqrt(n) parts of
    sqrt(n) elements that are folded by themselves: n**1.5 small copies instead of n**2.
    """
    grown = F.array(F.lit(0))

    def folded(part: Column) -> Column:
        return F.aggregate(part, grown, lambda acc, x: F.concat(acc, F.array(step(F.element_at(acc, -1), x))))

    def whole(of: Column) -> Column:
        n = of["n"]
        width = F.ceil(F.sqrt(n)).cast("int")
        parts = F.transform(
            F.sequence(F.lit(0), F.floor((n - 1) / width).cast("int")),
            lambda k: folded(F.slice(of["v"], k * width + 1, width)),
        )
        return _let(
            F.struct(parts.alias("parts"), width.alias("width")),
            lambda p: _let(
                folded(F.transform(p["parts"], lambda part: F.element_at(part, -1))),
                lambda before: F.concat(
                    grown,
                    F.flatten(
                        F.transform(
                            p["parts"],
                            lambda part, k: F.transform(F.slice(part, 2, p["width"]), lambda x: step(F.get(before, k), x)),
                        )
                    ),
                ),
            ),
        )

    return _let(
        F.struct(values.alias("v"), F.size(values).alias("n")),
        lambda of: F.when(of["n"] == 0, grown).otherwise(whole(of)),
    )


def _spans(text: Column, rule: Rule) -> Column:
    """Spans of a rule, leftmost and non-overlapping: pieces between matches give the places."""
    pattern = F.lit(rule.java())

    def placed(pieces: Column, found: Column, measured: Column) -> Column:
        used = _let(pieces, lambda p: F.transform(found, lambda m, i: F.length(F.get(p, i)) + F.length(m)))
        spans = _let(
            F.struct(_running(used, lambda a, x: a + x).alias("ends"), measured.alias("g")),
            lambda t: F.transform(
                found,
                lambda m, i: F.struct(
                    (F.get(t["ends"], i + 1) - F.length(m)).alias("s"),
                    F.get(t["ends"], i + 1).alias("e"),
                    F.length(F.get(t["g"], i)).alias("g"),
                ),
            ),
        )
        kept = F.filter(spans, lambda s: s["g"] >= rule.least)
        return F.transform(kept, lambda s: F.struct(s["s"].alias("s"), s["e"].alias("e"), F.lit(rule.kind).alias("kind")))

    found = F.regexp_extract_all(text, pattern, F.lit(0))
    measured = F.regexp_extract_all(text, pattern, F.lit(rule.group))
    none = F.array().cast("array<struct<s:int,e:int,kind:string>>")
    return _let(found, lambda f: F.when(F.size(f) == 0, none).otherwise(placed(F.split(text, rule.java(), -1), f, measured)))


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES, key: str = "doc_id", text: str = "text", spans: str = "spans") -> DataFrame:
    """``docs`` with ``spans``: an array of (s, e, kind), by start, then kind as listed in ``rules``."""
    found = fresh(docs, "found_rules")
    id_of = fresh(docs, "candidate_key")
    cand = candidates(docs, rules, key, text).select(F.col("key").alias(id_of), F.col("rules").alias(found))
    # Texts are shuffled once by key; the candidates, a row of numbers each, are the hash side.
    df = docs.join(cand.hint("shuffle_hash"), docs[key].eqNullSafe(F.col(id_of)), "left")
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    none = F.array().cast("array<struct<s:int,e:int,kind:string>>")
    order = F.array(*[F.lit(r.kind) for r in rules])
    parts = []
    for k, rule in enumerate(rules):
        one = _spans(body, rule)
        parts.append(
            F.when(F.array_contains(F.col(found), k), one).otherwise(none) if trigram_query(rule.pattern) else one
        )
    ranked = F.sort_array(
        F.transform(
            F.concat(*parts),
            lambda x: F.struct(x["s"].alias("s"), F.array_position(order, x["kind"]).alias("k"), x["e"].alias("e"), x["kind"].alias("kind")),
        )
    )
    ordered = F.transform(ranked, lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), x["kind"].alias("kind")))
    return df.withColumn(spans, ordered).drop(found, id_of)


def listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["s"], x["e"])), ",")


def digest(docs: DataFrame) -> DataFrame:
    """One row per document: counts of the base kinds, digest of their spans, all spans."""
    df = scan(docs.select("doc_id", "text"))
    base = F.filter("spans", lambda x: x["kind"].isin([r.kind for r in BASE]))

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return df.select(
        "doc_id",
        *[count(r.kind) for r in BASE],
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )


def redact(docs: DataFrame, rules: tuple[Rule, ...] = RULES, mask: str = "[SECRET]") -> DataFrame:
    """Documents with every span replaced by ``mask`` and ``n_chars``, where there is one, counted anew."""
    spans = fresh(docs, "secret_spans")
    df = scan(docs, rules, spans=spans)
    body = F.col("text")
    # What lies between the end of all earlier spans and a later start is kept. A place is sought
    # in its own part of the text: counting characters from the text's start would be quadratic.
    def kept(gap: Column, parts: Column) -> Column:
        first, last = F.floor(gap["a"] / PART), F.floor((gap["b"] - 1) / PART)
        near = F.array_join(F.slice(parts, (first + 1).cast("int"), (last - first + 1).cast("int")), "")
        return F.when(gap["b"] > gap["a"], F.substring(near, gap["a"] % PART + 1, gap["b"] - gap["a"])).otherwise("")

    def gaps(reach: Column) -> Column:
        every = F.transform(
            F.concat(F.col(spans)["s"], F.array(F.length(body))),
            lambda s, i: F.struct(F.get(reach, i).alias("a"), s.alias("b")),
        )
        return F.filter(every, lambda g: g["b"] >= g["a"])

    done = _let(
        F.regexp_extract_all(body, F.lit(f"(?s).{{1,{PART}}}"), F.lit(0)),
        lambda parts: F.array_join(
            F.transform(
                _let(_running(F.col(spans)["e"], lambda a, x: F.greatest(a, x)), gaps),
                lambda gap: kept(gap, parts),
            ),
            mask,
        ),
    )
    df = df.withColumn("text", F.when(F.size(spans) > 0, done).otherwise(body))
    if "n_chars" in docs.columns:
        counted = F.when(F.size(spans) > 0, F.length("text").cast(docs.schema["n_chars"].dataType))
        df = df.withColumn("n_chars", counted.otherwise(F.col("n_chars")))
    return df.drop(spans).select(*docs.columns)
