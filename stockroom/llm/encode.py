"""Ids of whole texts by the tokenizers library, with a table of pieces already encoded.

Both public vocabularies merge bytes inside a piece of text only, and a single space
between two other characters always ends a piece. So a text is cut at spaces, each cut
is encoded once per worker, and its ids are joined. Where a vocabulary folds case, texts of
Latin letters are folded and single marks behind words cut off first, as it would do itself,
so that words share an entry whatever their case and mark. Texts where cutting does not hold (two
white-space characters in a row with a space among them, special-token strings, rare
white space) go to the library whole.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
from tokenizers import Tokenizer

KEPT = 150_000  # entries of either table, some 30 MB; only speed depends on it
LONGEST = 64  # longer cuts are not kept beyond a call, so that the table is bounded in bytes

_RARE = re.compile("[\0\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
_WIDE = re.compile("[^\0-\xff]")  # beyond these, folding and composing depend on neighbours and Unicode versions
_MARK = re.compile("(?<=[a-z\xdf-\xf6\xf8-\xff])([.,;:!?])(?!\\S)")  # a piece of its own: one mark behind a letter
_BESIDE = ("  ", " \n", "\n ", " \t", "\t ", " \r", "\r ", "<|")  # a space beside white space; a special token


def _cuttable(text: str, drops_space: bool) -> bool:
    if _RARE.search(text) or "<|" in text:
        return False
    return drops_space or not any(b in text for b in _BESIDE)


class Encoder:
    """Ids as little-endian unsigned 16-bit bytes; the vocabularies have fewer than 65,536 ids."""

    def __init__(self, path: str, plain: bool = False):
        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = plain  # then their strings in a text are ordinary text
        vocabulary = self.library.get_vocab(with_added_tokens=True)
        if max(vocabulary.values()) >= 1 << 16:
            raise ValueError("ids of this vocabulary do not fit in 16 bits")
        # With a normalizer this vocabulary drops white space; without one a space opens the next piece.
        self.drops_space = self.library.normalizer is not None
        if self.drops_space:
            (self.mark,) = self._ids("\0")
            self.closes = np.zeros(1 << 16, bool)  # ids that end a piece
            self.closes[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        else:  # byte-level vocabularies write the space byte as U+0120
            self.opens = np.zeros(1 << 16, bool)
            self.opens[[i for t, i in vocabulary.items() if t.startswith("\u0120")]] = True
        self.table: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.library.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint16)

    def _learn(self, cuts: list[str]) -> None:
        """Encode cuts in one go, next to each other, and find where each one's ids end."""
        if self.drops_space:
            ids = self._ids(" \0 ".join(cuts))
            ends = np.flatnonzero(ids == self.mark).tolist() + [len(ids)]
            starts = [0, *(e + 1 for e in ends[:-1])]
        else:  # every cut begins with its only space
            ids = self._ids("".join(cuts))
            starts = np.flatnonzero(self.opens[ids]).tolist()
            ends = [*starts[1:], len(ids)]
        data = ids.tobytes()
        found = [data[2 * a : 2 * b] for a, b in zip(starts, ends, strict=True)]
        self.table.update(zip(cuts, found, strict=True))

    def _learn_words(self, words: list[str]) -> None:
        """The same for words of letters alone: each is one piece, so the ids themselves show the ends."""
        ids = self._ids(" ".join(words))
        ends = (np.flatnonzero(self.closes[ids]) + 1).tolist()
        if len(ends) != len(words):
            return self._learn(words)
        data = ids.tobytes()
        found = [data[2 * a : 2 * b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]
        self.table.update(zip(words, found, strict=True))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as bytes, two an id."""
        cuts: list[list[str] | None] = []
        for text in texts:
            if not _cuttable(text, self.drops_space):
                cuts.append(None)
            elif self.drops_space:
                cuts.append((text if _WIDE.search(text) else _MARK.sub(r" \1", text.lower())).split())
            else:  # the first cut has no space before it and is encoded by itself
                cuts.append([" " + c for c in text.split(" ")])
        if len(self.table) > KEPT:  # cuts that are met again come over from the older table
            self.older, self.table = self.table, {}
        table, older = self.table, self.older
        met = set().union(*(cut if self.drops_space else cut[1:] for cut in cuts if cut)).difference(table)
        again = met.intersection(older)
        table.update(zip(again, map(older.__getitem__, again), strict=True))
        unknown = list(met - again)
        words = [c for c in unknown if c.isalpha() and not _WIDE.search(c)] if self.drops_space else []
        rest = list(set(unknown).difference(words)) if words else unknown
        for learn, new in ((self._learn_words, words), (self._learn, rest)):
            for at in range(0, len(new), 5000):
                learn(new[at : at + 5000])
        out = []
        for text, cut in zip(texts, cuts, strict=True):
            if cut is None:
                out.append(self._ids(text).tobytes())
            elif self.drops_space:
                out.append(b"".join(map(table.__getitem__, cut)))
            else:
                out.append(self._ids(cut[0][1:]).tobytes() + b"".join(map(table.__getitem__, cut[1:])))
        for c in unknown:
            if len(c) > LONGEST:
                del table[c]
        return out


@lru_cache(maxsize=2)
def encoder(path: str, plain: bool = False) -> Encoder:
    """One encoder per worker and vocabulary."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    return Encoder(path, plain)
