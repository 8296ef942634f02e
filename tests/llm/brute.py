"""Plain Python versions of the operators, one document at a time."""

import hashlib
import re
from collections import Counter

WORD = re.compile("[^\x20\x09-\x0d]+")
KINDS = {
    "assign": re.compile(
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII
    ),
    "access": re.compile(r"AKIA[A-Z0-9]+"),
    "hex": re.compile(r"[0-9a-f]+"),
}


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def secrets(text):
    """n_assign, n_access, n_hex, base_sha256."""
    text = text or ""
    spans = [(m.start(), 0, f"assign:{m.start()}:{m.end()}") for m in KINDS["assign"].finditer(text) if len(m[2]) >= 6]
    spans += [(m.start(), 1, f"access:{m.start()}:{m.end()}") for m in KINDS["access"].finditer(text) if len(m[0]) >= 20]
    spans += [(m.start(), 2, f"hex:{m.start()}:{m.end()}") for m in KINDS["hex"].finditer(text) if len(m[0]) >= 24]
    kinds = Counter(k for _, k, _ in spans)
    return kinds[0], kinds[1], kinds[2], sha(",".join(s for *_, s in sorted(spans)))


def quality(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    text = text or ""
    tokens = WORD.findall(text)
    windows = [tuple(tokens[i : i + 8]) for i in range(len(tokens) - 7)]
    seen = Counter(windows)
    inside = {j for i, w in enumerate(windows) if seen[w] > 1 for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (
        len(tokens),
        sum(map(len, tokens)),
        sum(c in "#*$%&|<>" for c in text),
        len(lines) - len(set(lines)),
        len(inside),
        len(tokens) < 20 or 100 * len(inside) > 30 * len(tokens),
    )


def chats(rows):
    """conv_id -> n_turns, turns_sha256, loss_chars, loss_sha256 from (conv_id, turn, role, text)."""
    out = {}
    for c in {r[0] for r in rows}:
        turns = sorted((t, r or "", x or "") for k, t, r, x in rows if k == c)
        loss = "".join(x for _, r, x in turns if r == "assistant")
        out[c] = (len(turns), sha("".join(f"{r}\n{x}\n" for _, r, x in turns)), len(loss), sha(loss))
    return out


def tokens5(text, width=5):
    found = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    width = min(width, len(found))
    return {tuple(found[i : i + width]) for i in range(len(found) - width + 1)} if found else set()


def components(docs, percent):
    """doc_id -> (set size, smallest linked doc_id), comparing every pair that shares a shingle."""
    sets = {d: tokens5(t) for d, t in docs}
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    where = {}
    for d, s in sets.items():
        for g in s:
            where.setdefault(g, []).append(d)
    pairs = {(a, b) for ds in where.values() for a in ds for b in ds if a < b}
    for a, b in pairs:
        both = len(sets[a] & sets[b])
        if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            low, high = sorted((find(a), find(b)))
            root[high] = low
    return {d: (len(s), find(d)) for d, s in sets.items()}


