"""Personal data: the plain kinds against their expressions, disguises with places, maps against single characters."""

import hashlib
import random
import re
import time

import pytest

from stockroom.llm import pii, queries

DDL = "doc_id long, text string"
# The expressions as the definition writes them.
PLAIN = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
    "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: luhn(re.sub("[^0-9]", "", m))),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(re.sub("[^0-9]", "", m)) <= 15),
}


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return 13 <= len(digits) <= 19 and total % 10 == 0


def plain(text):
    return [
        (kind, m.start(), m.end())
        for kind, (pattern, holds) in PLAIN.items()
        for m in re.finditer(pattern, text)
        if holds(m[0])
    ]


def test_plain_kinds_equal_their_expressions():
    rng = random.Random(1)
    parts = ["a", "b.c", "@", "@x.de", ".", "-", "%", "+", "+1", "1", "23", "256", "255", "10.0.0.1", " ", "  ", "(", ")", "4111111111111111", "0", "9", "\n", "é", "@@", "..", "5500 0000 0000 0004"]
    for _ in range(20_000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(25)))
        assert [x[:3] for x in pii.find(text) if x[3]] == plain(text), text


# Each case: a text, the kind, and the part of the text that is personal data.
DISGUISES = [
    ("write to john (at) example (dot) com now", "email", "john (at) example (dot) com"),
    ("write to john[at]mail.example[dot]org now", "email", "john[at]mail.example[dot]org"),
    ("write to JOHN AT example DOT com, please", "email", "JOHN AT example DOT com"),
    ("an ana dot lopez arroba correo punto es hoy", "email", "ana dot lopez arroba correo punto es"),
    ("bei max.muster at firma punkt de melden", "email", "max.muster at firma punkt de"),
    ("écrire à luc arobase poste point fr ce soir", "email", "luc arobase poste point fr"),
    ("mail john @ example.com today", "email", "john @ example.com"),
    ("mail john@example dot com today", "email", "john@example dot com"),
    ("mail jоhn@еxample.com today", "email", "jоhn@еxample.com"),  # Cyrillic letters
    ("mail ｊｏｈｎ＠ｅｘａｍｐｌｅ．ｃｏｍ today", "email", "ｊｏｈｎ＠ｅｘａｍｐｌｅ．ｃｏｍ"),
    ("mail jo​hn@exam­ple.com today", "email", "jo​hn@exam­ple.com"),  # invisible characters
    ("host one nine two dot one six eight dot zero dot one up", "ip", "one nine two dot one six eight dot zero dot one"),
    ("host 10 dot 0 dot 0 dot 7 up", "ip", "10 dot 0 dot 0 dot 7"),
    ("host 10[.]0[.]0[.]7 up", "ip", "10[.]0[.]0[.]7"),
    ("host ١٠.٠.٠.٧ up", "ip", "١٠.٠.٠.٧"),
    ("card four one one one 1111 1111 1111 ok", "card", "four one one one 1111 1111 1111"),
    ("card 4111‑1111‑1111‑1111 ok", "card", "4111‑1111‑1111‑1111"),
    ("Karte vier eins eins eins, 1111 1111 1111 ok", None, None),
    ("call plus four four two zero seven nine four six zero nine five eight soon", "phone", "plus four four two zero seven nine four six zero nine five eight"),
    ("call ＋１ (555) five five five 0100 soon", "phone", "＋１ (555) five five five 0100"),
    ("appelez plus trois trois un deux trois quatre cinq six sept huit neuf vite", "phone", "plus trois trois un deux trois quatre cinq six sept huit neuf"),
]


@pytest.mark.parametrize("text, kind, part", DISGUISES)
def test_disguises_map_back_to_their_places(text, kind, part):
    added = [(k, text[s:e]) for k, s, e, p in pii.find(text) if not p]
    assert added == ([(kind, part)] if kind else [])


@pytest.mark.parametrize(
    "text",
    [
        "meet me at the dot com boom, at noon dot",
        "we looked at example.com and at two point five percent",
        "one two buckle my shoe, three four knock at the door",
        "5 plus 3000000000 is more", "version 1 point 2", "he stood at point five at home", "see (at) nothing", "a (dot) b",
    ],
)
def test_ordinary_text_is_left_alone(text):
    assert pii.find(text) == []


def test_plain_spans_stay_inside_wider_ones():
    text = "jоhn@example.com"  # the second letter is Cyrillic
    assert pii.find(text) == [("email", 0, 16, False), ("email", 2, 16, True)]


def test_maps_equal_character_by_character():
    rng = random.Random(2)
    words = ["one", "nine", "null", "dot", " ", " ", "@", "at", "(at)", "[dot]", "a", "com", "es", "1", "23", "​", "о", "１", "plus", ",", "."]
    for _ in range(5_000):
        body = text = "".join(rng.choice(words) for _ in range(rng.randrange(30)))
        cells, layers = [(k, k + 1) for k in range(len(text))], []
        table = pii._Characters()
        for transducer in (lambda t: pii.characters(t, table), *pii.TRANSDUCERS):
            edits, new, at = transducer(body), [], 0
            assert all(a[1] <= b[0] for a, b in zip(edits, edits[1:], strict=False))
            for s, e, rep in edits:
                new += cells[at:s] + [(cells[s][0], cells[e - 1][1])] * len(rep)
                at = e
            cells = new + cells[at:]
            if edits:
                layers.append(pii.Layer.of(body, edits))
                body = layers[-1].text
        assert len(cells) == len(body)
        for s in range(len(body)):
            start, end = s, s + 1
            for layer in reversed(layers):
                start, end = layer.start(start), layer.end(end)
            assert (start, end) == cells[s]


def test_digest_and_edge_cases(frame):
    texts = [t for t, *_ in DISGUISES] + ["", None, "a@b.co +1 555 010 0199", "x" * 300_000 + "@y.org"]
    data = [(k, t) for k, t in enumerate(texts)] + [(None, "a@b.co"), (3, texts[3]), (3, texts[3])]
    out = pii.digest(frame(data, DDL).repartition(3)).collect()
    want = []
    for d, t in data:
        base = plain(t or "")
        found = [(k, s, e) for k, s, e, _ in pii.find(t or "")]
        digest = hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in base).encode()).hexdigest()
        counts = [sum(k == kind for k, *_ in base) for kind in pii.KINDS]
        want.append((d, *counts, digest, ",".join(f"{k}:{s}:{e}" for k, s, e in found), len(found) - len(base)))
    order = lambda rows: sorted(map(tuple, rows), key=str)
    assert order(out) == order(want)
    assert pii.digest(frame([], DDL)).collect() == []


def test_scan_keeps_columns_and_redacts(frame):
    df = frame([(1, "to john (at) example (dot) com!", "x"), (2, None, "y")], f"{DDL}, PII string")
    out = pii.scan(df)
    assert out.columns[:3] == df.columns and len({c.lower() for c in out.columns}) == 4
    assert sorted(r.text or "" for r in pii.redact(df).collect()) == ["", "to [EMAIL]!"]
    assert pii.masked("jоhn@example.com.", pii.find("jоhn@example.com.")) == "[EMAIL]."


@pytest.mark.parametrize("unit", ["a", "1", "1 ", "1.", "+1", "a@", "@", " at ", "one ", "dot ", "(at)", "a at b dot ", "о", "arroba b dot "])
def test_long_texts_take_linear_time(unit):
    start = time.perf_counter()
    pii.find(unit * (400_000 // len(unit)))
    assert time.perf_counter() - start < 8


def test_registered_query(spark):
    out = queries.queries()["op12_pii"](spark, "/root/testdata/sf0.001").collect()
    assert len(out) == spark.read.parquet("/root/testdata/sf0.001/documents.parquet").count()
    assert sum(r.n_email + r.n_ip + r.n_card + r.n_phone for r in out) > 0
