"""Personal data, plain and disguised, with spans in the characters of the source.

Texts are read twice. The plain reading applies the kinds' expressions to the text as it
is. The other goes through a chain of transducers, each of which rewrites some places and
notes where (:class:`Layer`):

* :func:`characters`: full-width forms, letters of other scripts that look like Latin
  ones, digits of other scripts, typographic dashes and spaces; invisible characters go;
* :func:`spelled_digits`: runs of three and more digit words of four languages, or fewer
  beside a spelled dot or plus; "plus" before a digit;
* :func:`dots`: bracketed dots and ats, and spelled dots between numbers;
* :func:`ats`: spelled or spaced ats and dots of an address, with its last label in
  :data:`TOP_LABELS`.

The same expressions run over the rewritten text, and a match that holds a rewritten
place is mapped back through the layers to the source characters it came from. Such spans
are added; those of the plain reading stay as they are, also inside a wider added one.

Expressions are sought so that the work is linear in the text, whatever it holds.

Defined results: a NULL text is empty and has no spans; rows with equal or NULL ids are
read one by one; an empty table gives an empty one; texts are read whole. Extra columns
are kept; the name added gives way to theirs.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh, pieces

KINDS = ("email", "ip", "card", "phone")

# Letters of other scripts that look like a Latin one, in the same order.
LOOKALIKES = dict(
    zip(
        "аеорсхуіјѕԁһԛԝАВЕКМНОРСТХУІЈЅԌαονρικΑΒΕΖΗΙΚΜΝΟΡΤΥΧ",
        "aeopcxyijsdhqwABEKMHOPCTXYIJSGaovpikABEZHIKMNOPTYX",
        strict=True,
    )
)
# Characters that show nothing.
INVISIBLE = "­​‌‍⁠﻿"
DASHES = "‐‑‒–—―−"

# Digits as words of four languages.
DIGIT_WORDS = (
    ("zero", "oh", "null", "zéro", "cero"),
    ("one", "eins", "un", "uno"),
    ("two", "zwei", "deux", "dos"),
    ("three", "drei", "trois", "tres"),
    ("four", "vier", "quatre", "cuatro"),
    ("five", "fünf", "cinq", "cinco"),
    ("six", "sechs", "seis"),
    ("seven", "sieben", "sept", "siete"),
    ("eight", "acht", "huit", "ocho"),
    ("nine", "neun", "neuf", "nueve"),
)
DOT_WORDS = ("dot", "punkt", "point", "punto")
AT_WORDS = ("at", "arobase", "arroba")
PLUS_WORDS = ("plus", "más")
# Last labels an address spelled in words may have.
TOP_LABELS = frozenset((
    "com", "org", "net", "edu", "gov", "mil", "int", "info", "biz", "name", "io", "co", "me", "tv", "app",
    "dev", "ai", "cloud", "online", "site", "xyz", "eu", "de", "fr", "es", "uk", "us", "ca", "au", "nz", "ie",
    "ch", "at", "be", "nl", "it", "pt", "se", "no", "dk", "fi", "pl", "cz", "in", "cn", "jp", "br", "mx",
    "ar", "test", "example", "invalid",
))
# Words behind a bare "at" that begin no domain.
NO_LABELS = frozenset(("a", "an", "the", "this", "that", "each", "every", "any", "some", "my", "our", "your", "his", "her"))

# -- plain reading ------------------------------------------------------------

_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_NUMBERS = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_LABELS = re.compile(r"[A-Za-z0-9-]+")

Span = tuple[int, int]


def emails(text: str) -> list[Span]:
    """Each at sign has its own local part, the run before it, so signs are taken one by one."""
    found, end, sign = [], 0, text.find("@")
    while sign >= 0:
        start = sign
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, sign + 1) if start < sign else None
        if domain:
            end = domain.end()
            found.append((start, end))
        # Characters up to the next sign are looked at once more at most.
        sign = text.find("@", max(end, sign + 1))
    return found


def ips(text: str) -> list[Span]:
    return [m.span() for m in _NUMBERS.finditer(text) if all(_small(p) for p in m[0].split("."))]


def _small(part: str) -> bool:
    part = part.lstrip("0")  # int() of a very long part would be slow, or refused
    return len(part) < 4 and int(part or "0") <= 255


def passes_luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2]))
    return (total + sum(d // 5 + 2 * d % 10 for d in map(int, digits[-2::-2]))) % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if c in "0123456789")


def cards(text: str) -> list[Span]:
    return [
        m.span()
        for m in _CARD.finditer(text)
        if m.end() - m.start() < 38 and 13 <= len(d := _digits(m[0])) <= 19 and passes_luhn(d)
    ]


def phones(text: str) -> list[Span]:
    return [m.span() for m in _PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]


FINDERS: dict[str, Callable[[str], list[Span]]] = {"email": emails, "ip": ips, "card": cards, "phone": phones}

# -- transducers --------------------------------------------------------------

Edit = tuple[int, int, str]  # from, to, text in its place


@dataclass(frozen=True)
class Layer:
    """What a transducer did: the rewritten text, and where each rewritten place was and is."""

    text: str
    was: tuple[list[int], list[int]]
    now: tuple[list[int], list[int]]

    @classmethod
    def of(cls, text: str, edits: list[Edit]) -> Layer:
        """Apply edits, which are in order and do not overlap."""
        parts, was, now, at, length = [], ([], []), ([], []), 0, 0
        for start, end, new in edits:
            parts += (text[at:start], new)
            length += start - at
            was[0].append(start)
            was[1].append(end)
            now[0].append(length)
            length += len(new)
            now[1].append(length)
            at = end
        return cls("".join([*parts, text[at:]]), was, now)

    def start(self, at: int) -> int:
        """Source place of a span that starts at ``at``: a rewritten place counts whole."""
        k = bisect_right(self.now[0], at) - 1
        if k < 0:
            return at
        return self.was[0][k] if at < self.now[1][k] else self.was[1][k] + at - self.now[1][k]

    def end(self, at: int) -> int:
        """Source place of a span that ends before ``at``."""
        k = bisect_left(self.now[0], at) - 1
        if k < 0:
            return at
        return self.was[1][k] if at <= self.now[1][k] else self.was[1][k] + at - self.now[1][k]


class _Characters(dict):
    """What a character reads as, worked out once for each that a task meets; None: as itself."""

    def __missing__(self, c: str) -> str | None:
        if c in LOOKALIKES:
            new = LOOKALIKES[c]
        elif c in INVISIBLE:
            new = ""
        elif c in DASHES:
            new = "-"
        elif unicodedata.category(c) == "Zs":
            new = " "
        elif unicodedata.category(c) == "Nd":
            new = str(unicodedata.decimal(c))
        else:
            form = unicodedata.normalize("NFKC", c)
            new = form if form.isascii() and form.isprintable() and " " not in form else None
        self[c] = new
        return new


def characters(text: str, table: dict[str, str | None]) -> list[Edit]:
    if text.isascii():
        return []
    changed = [c for c in set(text) if ord(c) > 127 and table[c] is not None]
    if not changed:
        return []
    return [(m.start(), m.end(), table[m[0]]) for m in re.finditer("[" + re.escape("".join(changed)) + "]", text)]


def _any(words: Iterable[str]) -> str:
    return "(?:" + "|".join(sorted(map(re.escape, words), key=len, reverse=True)) + ")"


_DIGIT_OF = {w: str(d) for d, words in enumerate(DIGIT_WORDS) for w in words}
_DIGIT = _any(_DIGIT_OF) + r"(?!\w)"
# Words parted by a space, a hyphen or a comma; the first letter is looked at before the words are tried.
_FIRST = "".join(sorted({w[0] for w in _DIGIT_OF}))
_SPELLED = re.compile(rf"(?<!\w)(?=[{_FIRST}])({_DIGIT}(?:(?:[ \t-]|, ){_DIGIT})*+)", re.I)
_WORD = re.compile(r"\w+")
_DOT_MARK = rf"[\[({{<] ?(?:\.|{_any(DOT_WORDS)}) ?[\])}}>]"
_BEFORE = re.compile(rf"(?:\b{_any(DOT_WORDS)}|\b{_any(PLUS_WORDS)}|\+|{_DOT_MARK}) ?$", re.I)
_AFTER = re.compile(rf" ?(?:{_any(DOT_WORDS)}\b|{_DOT_MARK})", re.I)
_PLUS = re.compile(rf"(?<![0-9] )\b{_any(PLUS_WORDS)} (?=\(?[0-9])", re.I)


def spelled_digits(text: str) -> list[Edit]:
    edits = []
    for m in _SPELLED.finditer(text):
        said = [_DIGIT_OF.get(w) for w in _WORD.findall(m[0].lower())]
        if None in said:  # a letter that only ignoring case makes equal
            continue
        before = text[max(0, m.start() - 16) : m.start()]
        if len(said) > 2 or _AFTER.match(text, m.end()) or _BEFORE.search(before):
            edits.append((m.start(), m.end(), "".join(said)))
    return edits


def plus_signs(text: str) -> list[Edit]:
    return [(m.start(), m.end(), "+") for m in _PLUS.finditer(text)]


_OPEN, _SHUT = r"[ \t]{0,3}[\[({<][ \t]?", r"[ \t]?[\])}>][ \t]{0,3}"
_BRACKETS = re.compile(
    rf"(?<=[A-Za-z0-9._%+-]){_OPEN}(?:(?P<at>@|ät|{_any(AT_WORDS)})|\.|{_any(DOT_WORDS)}){_SHUT}(?=[A-Za-z0-9])"
    rf"|(?<=[0-9])[ \t]{{1,3}}{_any(DOT_WORDS)}[ \t]{{1,3}}(?=[0-9])",
    re.I,
)


def dots(text: str) -> list[Edit]:
    return [(m.start(), m.end(), "@" if m["at"] else ".") for m in _BRACKETS.finditer(text)]


_AT = re.compile(rf"[ \t]{{0,3}}@[ \t]{{0,3}}|(?<=[A-Za-z0-9._%+-])[ \t]{{1,3}}{_any(AT_WORDS)}[ \t]{{1,3}}", re.I)
_MORE_LABELS = re.compile(rf"(\.|[ \t]{{1,3}}(?:\.|{_any(DOT_WORDS)})[ \t]{{1,3}})([A-Za-z0-9-]+)", re.I)
_DOT_BEFORE = re.compile(rf"(?<=[A-Za-z0-9])[ \t]{{1,3}}{_any(DOT_WORDS)}[ \t]{{1,3}}$", re.I)


def _spelled_domain(text: str, at: int) -> tuple[list[Edit], bool, int]:
    """Edits of the longest domain from ``at`` that ends in a known last label; whether it was in words; its end."""
    label = _LABELS.match(text, at)
    edits, best, end = [], None, at
    while label:
        more = _MORE_LABELS.match(text, label.end() if end == at else end)
        if not more:
            break
        if more[1] != ".":
            edits.append((*more.span(1), "."))
        end = more.end()
        if more[2].lower() in TOP_LABELS:
            best = (len(edits), end)
    if best is None:
        return [], False, at
    return edits[: best[0]], best[0] > 0, best[1]


def ats(text: str) -> list[Edit]:
    """Addresses in words: a spelled at needs a spelled dot, a spaced sign or a spelled dot a known last label."""
    edits, done = [], 0
    for m in _AT.finditer(text):
        if m.start() < done or m.start() == 0 or text[m.start() - 1] not in _LOCAL:
            continue
        rest, spelled, end = _spelled_domain(text, m.end())
        sign = m[0].strip(" \t") == "@"
        if end == m.end() or not (spelled or (sign and len(m[0]) > 1)):
            continue
        if not sign and _LABELS.match(text, m.end())[0].lower() in NO_LABELS:
            continue
        local, start = [], m.start()
        while True:
            while start > done and text[start - 1] in _LOCAL:
                start -= 1
            dot = _DOT_BEFORE.search(text[max(done, start - 16) : start])
            if not dot:
                break
            cut = max(done, start - 16)
            local.append((cut + dot.start(), start, "."))
            start = cut + dot.start()
        edits += reversed(local)
        if m[0] != "@":
            edits.append((m.start(), m.end(), "@"))
        edits += rest
        done = end
    return edits


TRANSDUCERS: tuple[Callable[[str], list[Edit]], ...] = (spelled_digits, plus_signs, dots, ats)

# -- both readings ------------------------------------------------------------


def find(text: str, table: dict[str, str | None] | None = None) -> list[tuple[str, int, int, bool]]:
    """(kind, start, end, plain?) of a text, by kind as listed, then start, then end."""
    table = _Characters() if table is None else table
    spans = {kind: finder(text) for kind, finder in FINDERS.items()}
    out = {(KINDS.index(k), s, e): True for k, found in spans.items() for s, e in found}
    layers, body = [], text
    for transducer in (lambda t: characters(t, table), *TRANSDUCERS):
        edits = transducer(body)
        if edits:
            layers.append(Layer.of(body, edits))
            body = layers[-1].text
    if layers:
        for kind, finder in FINDERS.items():
            plain, k = spans[kind], 0
            for s, e in finder(body):
                start, end = s, e
                for layer in reversed(layers):
                    start, end = layer.start(start), layer.end(end)
                if text[start:end] == body[s:e]:
                    continue
                while k < len(plain) and plain[k][1] < end:
                    k += 1
                if k == len(plain) or plain[k][0] > start:  # not inside a plain span
                    out.setdefault((KINDS.index(kind), start, end), False)
    return [(KINDS[k], s, e, plain) for (k, s, e), plain in sorted(out.items())]


SPANS = "array<struct<kind: string, s: int, e: int, plain: boolean>>"


def scan(docs: DataFrame, text: str = "text", spans: str = "pii", keep: Iterable[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``keep``) with the spans found: an array of (kind, s, e, plain)."""
    spans = fresh(docs, spans)
    kept = docs.columns if keep is None else list(keep)
    schema = T.StructType([*(docs.schema[c] for c in kept), T.StructField(spans, T.DataType.fromDDL(SPANS))])

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _Characters()
        for part, texts in pieces(batches, text):
            found = [
                [{"kind": k, "s": s, "e": e, "plain": p} for k, s, e, p in find(t, table)] if t else [] for t in texts
            ]
            struct = pa.struct([("kind", pa.string()), ("s", pa.int32()), ("e", pa.int32()), ("plain", pa.bool_())])
            column = pa.array(found, pa.list_(struct))
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), column], [*kept, spans])

    return docs.mapInArrow(read, schema)


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """Documents with every span replaced by its kind in brackets; spans that meet are one."""
    schema = docs.schema
    at = docs.columns.index(text)

    def mask(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _Characters()
        for part, texts in pieces(batches, text):
            new = [None if t is None else masked(t, find(t, table)) for t in texts]
            columns = [pa.array(new, c.type) if i == at else c for i, c in enumerate(part.columns)]
            yield pa.RecordBatch.from_arrays(columns, part.schema.names)

    return docs.mapInArrow(mask, schema)


def masked(text: str, spans: list[tuple[str, int, int, bool]]) -> str:
    parts, at = [], 0
    for kind, start, end, _ in sorted(spans, key=lambda x: (x[1], -x[2])):
        if start >= at:
            parts += (text[at:start], f"[{kind.upper()}]")
        at = max(at, end)
    return "".join([*parts, text[at:]])


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["s"], x["e"])), ",")


def digest(docs: DataFrame) -> DataFrame:
    """One row per document: counts of the plain kinds, digest of their spans, all spans."""
    df = scan(docs.select("doc_id", "text"), keep=["doc_id"])
    plain = F.filter("pii", lambda x: x["plain"])

    def count(kind: str) -> Column:
        return F.size(F.filter("pii", lambda x: x["plain"] & (x["kind"] == kind))).cast("long").alias(f"n_{kind}")

    return df.select(
        "doc_id",
        *[count(k) for k in KINDS],
        F.sha2(_listed(plain), 256).alias("base_sha256"),
        _listed(F.col("pii")).alias("spans"),
        F.size(F.filter("pii", lambda x: ~x["plain"])).cast("long").alias("n_added"),
    )
