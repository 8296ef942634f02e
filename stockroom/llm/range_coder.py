"""An adaptive context-mixing range coder for token ids, run on many blocks side by side.

A group of blocks has :class:`Tables`: how often each id comes (order 0) and follows each
other id (order 1; pairs too rare to pay for their entry are left out). They are stored
once, ahead of the blocks. Every block starts from them and an otherwise empty model, so
blocks are independent; numpy carries out one step of all of them at a time ("lanes").
A step codes one id per lane:

* Order 2 (the two ids before) and order 1 (the id before) each remember the id that
  followed last in the block and how long it has held true. The order-2 id, else the
  order-1 id, else the most frequent follower in the tables is the candidate.
* "Is it the candidate?" is one binary decision. Estimates of orders 2 and 1 (by how sure
  each is, and whether they agree), the candidate's share among the followers in the
  tables, its share among all ids, and how recent candidates fared are mixed in a
  stretched domain by weights learned along the way.
* If not, a second decision, mixed likewise, says whether order 1 lists the id. If so it
  is coded by its count among the followers, else by its count in order 0.

Inside, an id is a *sign*: the place of the pair it ends, or the number of pairs plus the
id where that pair is not listed. Signs index every count, so a step searches nothing.

Decisions narrow an interval of 64 bits that emits 16 at a time, after each id; carries
run back into what is out. Only IEEE additions, products and quotients of single
precision are used, in a fixed order, so every machine decodes alike.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable

import numpy as np

FULL, DIGIT, SHIFT = np.uint64(1 << 48), np.uint64(16), np.uint64(48)  # an interval is this wide before an id
FINE, COARSE = np.uint64(16), np.uint64(12)  # bits of the two decisions' probabilities
ZERO, ONE, FOUR, THIRTYTWO = (np.uint32(k) for k in (0, 1, 4, 32))
ORDER1, ORDER2 = 10, 12  # bits that number a lane's contexts
LEAST = 4  # a pair that comes less often is not listed
MOST = 1 << 28  # ids of a group, so that an interval never gets empty
RATE = 0.02  # of learning weights
SURE = np.uint32(15)  # confidence stops here
HEAD = struct.Struct("<III")  # ids, pairs, bytes of a group's tables


def _rows(*columns: np.ndarray) -> np.ndarray:
    """Three columns of 32 bits, fetched together as one value of 16 bytes."""
    out = np.zeros((len(columns[0]), 4), np.int32)
    for i, column in enumerate(columns):
        out[:, i] = column
    return out.view(np.complex128)[:, 0]


def _columns(rows: np.ndarray) -> np.ndarray:
    return rows.view(np.int32).reshape(-1, 4).T


def _stretched(p: np.ndarray) -> np.ndarray:
    t = (2 * p - 1).astype(np.float32)
    return t / (1 - np.abs(t))


class Tables:
    """Counts of a group of blocks: of ids, and of the pairs worth listing."""

    def __init__(self, ids: np.ndarray, counts: np.ndarray, pairs: np.ndarray, pair_counts: np.ndarray):
        self.ids, self.counts, self.pairs, self.pair_counts = ids, counts, pairs, pair_counts
        self.total = int(counts.sum())
        if self.total >= MOST:
            raise ValueError("too many ids for one group")
        often = np.zeros(1 << 16, np.int64)
        often[ids] = counts
        # Followers of id i are the places first[i] to first[i + 1] of the pairs.
        self.first = np.searchsorted(pairs, np.arange((1 << 16) + 1) << 16)
        reached = np.concatenate([np.zeros(1, np.int64), pair_counts.cumsum()])
        start, head, every = reached[self.first[:-1]], pairs >> 16, np.arange(1 << 16)
        # By id: how often its listed followers come, how often it does, and the first slot of the followers.
        self.heads = _rows(reached[self.first[1:]] - start, often, start)
        # By sign: how often it comes, how much comes ahead of it, and the id before it.
        count = np.concatenate([pair_counts, often])
        ahead = np.concatenate([reached[:-1] - start[head], often.cumsum() - often])
        self.signs = _rows(count, ahead, np.concatenate([head, np.full(1 << 16, -1)]))
        self.id_of = np.concatenate([pairs & 0xFFFF, every]).astype(np.uint16)
        self.top = np.full(1 << 16, len(pairs), np.uint32)
        order = np.lexsort((pairs, pair_counts))
        self.top[head[order]] = order  # the last one written is the most frequent
        among = np.concatenate([(pair_counts + 0.5) / (often[head] + 2.0), 0.5 / (often + 2.0)])
        plain = often[self.id_of] / max(self.total, 1)
        shares = np.stack([among, plain], 1).clip(1 / 1024, 1 - 1 / 1024)
        self.shares = _stretched(shares).view(np.complex64)[:, 0]  # a place of both

    @classmethod
    def of(cls, blocks: list[np.ndarray]) -> Tables:
        counts = np.bincount(np.concatenate([*blocks, np.empty(0, np.uint16)]), minlength=1 << 16)
        ids = np.flatnonzero(counts)
        follow = [b[:-1].astype(np.uint32) << np.uint32(16) | b[1:] for b in blocks]
        pairs = np.sort(np.concatenate([*follow, np.empty(0, np.uint32)]))
        bounds = np.flatnonzero(np.concatenate([[True], pairs[1:] != pairs[:-1], [True]])) if len(pairs) else np.zeros(1, int)
        many = np.diff(bounds)
        kept = many >= LEAST
        return cls(ids, counts[ids], pairs[bounds[:-1][kept]].astype(np.int64), many[kept])

    def signs_of(self) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
        """A function that gives the signs of ids after the ids before them.

        It looks a pair up by its hash; where several share a place there, by search.
        """
        bits = len(self.pairs).bit_length() + 2
        place_of = lambda keys: (keys * np.uint32(0x9E3779B1) >> np.uint32(32 - bits)).astype(np.int64)
        pairs = self.pairs.astype(np.uint32)
        places = place_of(pairs)
        many = np.bincount(places, minlength=1 << bits) > 1
        held = np.zeros((1 << bits, 2), np.uint32)  # a pair and its sign; an empty place holds a pair that is not sought there
        held[place_of(np.zeros(1, np.uint32)), 0] = 1
        held[places] = np.stack([pairs, np.arange(len(pairs), dtype=np.uint32)], 1)
        held = held.view(np.complex64)[:, 0]

        def find(before: np.ndarray, ids: np.ndarray) -> np.ndarray:
            keys = before << np.uint32(16) | ids
            at = place_of(keys)
            key, sign = held.take(at).view(np.uint32).reshape(-1, 2).T
            known = key == keys
            out = np.where(known, sign, ids + np.uint32(len(pairs)))
            rest = (many.take(at) & ~known).nonzero()[0]
            if len(rest):
                place = np.minimum(np.searchsorted(pairs, keys[rest]), len(pairs) - 1)
                known = pairs[place] == keys[rest]
                out[rest[known]] = place[known]
            return out

        return find

    def slots(self) -> np.ndarray:
        """The sign at each place of the followers' counts, then at each place of order 0."""
        return np.repeat(np.arange(len(self.id_of), dtype=np.uint32), _columns(self.signs)[0])

    def pack(self) -> bytes:
        """Heads of pairs come back from how many followers each id has, so they are stored as gaps."""
        follower = (self.pairs & 0xFFFF).astype("<u2")
        lists = np.diff(self.first)[self.ids].astype("<u4")
        body = zlib.compress(
            np.diff(self.ids, prepend=0).astype("<u2").tobytes() + self.counts.astype("<u4").tobytes()
            + lists.tobytes() + follower.tobytes() + self.pair_counts.astype("<u4").tobytes(), 9,
        )
        return HEAD.pack(len(self.ids), len(self.pairs), len(body)) + body

    @classmethod
    def unpack(cls, data: bytes) -> Tables:
        n, m, _ = HEAD.unpack_from(data)
        body, at, columns = zlib.decompress(data[HEAD.size :]), 0, []
        for size, kind in ((n, "<u2"), (n, "<u4"), (n, "<u4"), (m, "<u2"), (m, "<u4")):
            column = np.frombuffer(body, kind, size, at)
            at += column.nbytes
            columns.append(column.astype(np.int64))
        gaps, counts, lists, follower, pair_counts = columns
        ids = gaps.cumsum()
        return cls(ids, counts, np.repeat(ids, lists) << 16 | follower, pair_counts)


class Writer:
    def __init__(self, lanes: int, steps: int):
        self.low = np.zeros(lanes, np.uint64)
        self.range = np.full(lanes, np.iinfo(np.uint64).max, np.uint64)
        self.row = 3 * steps + 1  # an id emits three digits at most
        self.out = np.zeros(lanes * self.row, np.uint16)
        self.at = np.arange(lanes) * self.row

    def bit(self, low, rng, p, scale: np.uint64, truth) -> tuple:
        """Code ``truth``, which is wrong with probability ``p`` of 2 ** ``scale``: (low, range, truth)."""
        zeros = (rng >> scale) * p
        return low + zeros * truth, np.where(truth, rng - zeros, zeros), truth

    def settle(self, n: int, low, rng) -> None:
        """Take over the intervals of the first ``n`` lanes after an id, and emit digits."""
        self._carry((low < self.low[:n]).nonzero()[0])
        self.low[:n], self.range[:n] = low, rng
        lanes = (rng < FULL).nonzero()[0]
        while len(lanes):
            self._emit(lanes)
            rng = self.range[lanes] << DIGIT
            self.range[lanes] = rng
            lanes = lanes[rng < FULL]

    def _carry(self, lanes) -> None:
        back = 1
        while len(lanes):
            at = self.at[lanes] - back
            digit = self.out[at] + np.uint16(1)
            self.out[at] = digit
            lanes, back = lanes[digit == 0], back + 1

    def _emit(self, lanes) -> None:
        at, low = self.at[lanes], self.low[lanes]
        self.out[at] = low >> SHIFT
        self.at[lanes] = at + 1
        self.low[lanes] = low << DIGIT

    def close(self) -> list[bytes]:
        """A digit more names a number inside each interval; the reader goes on with zeros."""
        end = self.low + (FULL - np.uint64(1))
        self._carry((end < self.low).nonzero()[0])
        self.low = end
        self._emit(np.arange(len(end)))
        return [self.out[i * self.row : at].astype("<u2").tobytes() for i, at in enumerate(self.at.tolist())]


class Reader:
    """Its ``low`` is how far the number read lies above the lower end of the interval."""

    def __init__(self, payloads: list[bytes]):
        row = max(map(len, payloads), default=0) // 2 + 8
        data = np.zeros((len(payloads), row), np.uint16)
        for i, p in enumerate(payloads):
            data[i, : len(p) // 2] = np.frombuffer(p, "<u2", len(p) // 2)
        self.low = np.zeros(len(payloads), np.uint64)
        for d in range(4):
            self.low = self.low << DIGIT | data[:, d]
        self.data, self.at = data.ravel(), np.arange(len(payloads)) * row + 4
        self.range = np.full(len(payloads), np.iinfo(np.uint64).max, np.uint64)

    def bit(self, low, rng, p, scale: np.uint64, truth) -> tuple:
        zeros = (rng >> scale) * p
        one = low >= zeros
        return low - zeros * one, np.where(one, rng - zeros, zeros), one

    def settle(self, n: int, low, rng) -> None:
        self.low[:n], self.range[:n] = low, rng
        lanes = (rng < FULL).nonzero()[0]
        while len(lanes):
            at = self.at[lanes]
            self.low[lanes] = self.low[lanes] << DIGIT | self.data.take(at, mode="clip")  # so damaged input stays inside
            self.at[lanes] = at + 1
            rng = self.range[lanes] << DIGIT
            self.range[lanes] = rng
            lanes = lanes[rng < FULL]


class _Mixer:
    """A binary decision from several estimates, with weights of each lane."""

    def __init__(self, lanes: int, tables: list[np.ndarray], plain: int):
        """``tables`` hold the first estimate for each state; ``plain`` estimates come from outside, stretched."""
        sizes = [len(t) for t in tables]
        self.base = np.arange(lanes) * sum(sizes) + (np.cumsum(sizes) - sizes)[:, None]
        self.table = np.tile((2 * np.concatenate(tables) - 1).astype(np.float32), lanes)  # from -1 to 1
        self.adaptive, self.count = len(tables), len(tables) + plain
        self.weight = np.full((self.count, lanes), 0.9 / self.count, np.float32)

    def decide(self, coder, k, states, plain, low, rng, scale: np.uint64, truth) -> tuple:
        at = states
        at += self.base[:, k]
        guess = self.table.take(at)
        x = np.empty((self.count, len(low)), np.float32)
        np.divide(guess, 1 - np.abs(guess), out=x[: self.adaptive])
        for i, p in enumerate(plain, self.adaptive):
            x[i] = p
        weights = [w[k] for w in self.weight]
        dot = weights[0] * x[0]
        for w, p in zip(weights[1:], x[1:], strict=True):
            dot += w * p
        mixed = dot / (1 + np.abs(dot))  # from -1 to 1
        half = 1 << int(scale) - 1
        p = (mixed * ((half >> 10) - half) + half).astype(np.uint64)
        low, rng, one = coder.bit(low, rng, p, scale, truth)
        target = one.astype(np.float32)
        target += target
        target -= 1
        x *= (target - mixed) * (RATE / 2)
        for w, old, p in zip(self.weight, weights, x, strict=True):
            w[k] = old + p
        guess *= 0.95
        guess += target * (0.05 * (1 - 2 / 512))
        self.table[at] = guess
        return low, rng, one


class _Model:
    """The adaptive state of all lanes, in flat tables."""

    def __init__(self, tables: Tables, lanes: int):
        lane = np.arange(lanes)
        self.tables = tables
        # What a context saw, as check << bits | sign << 4 | sure; 0: nothing seen.
        bits = 4 + len(tables.id_of).bit_length()
        self.limit = np.uint32(1 << bits)
        self.check = np.uint32((1 << 32) - (1 << bits))
        self.base = np.stack([lane << ORDER1, (lane << ORDER2) + (lanes << ORDER1)])
        self.seen = np.zeros((lanes << ORDER1) + (lanes << ORDER2), np.uint32)
        sure = np.arange(int(SURE) + 1)
        two = (sure + 0.6) / (sure + 2.0)
        one = (sure + 0.3) / (sure + 2.5)
        self.hit = _Mixer(lanes, [two, np.concatenate([np.full(int(SURE) + 1, 0.3), one]), np.full(64, 0.4)], 2)
        self.follows = _Mixer(lanes, [np.full(8, 0.7)], 1)
        self.recent = np.zeros(lanes, np.int64)
        self.before = np.zeros(lanes, np.uint32)
        self.hash = np.zeros(lanes, np.uint32)  # of the id before the last
        self.slots = None

    def encode(self, coder: Writer, lengths: np.ndarray, ids: np.ndarray) -> None:
        """Code the ids; lanes are sorted by length, longest first."""
        signs_of = self.tables.signs_of()
        for t, n in enumerate(self._active(lengths)):
            self._step(coder, n, signs_of(self.before[:n], ids[t, :n]))

    def decode(self, coder: Reader, lengths: np.ndarray, ids: np.ndarray) -> None:
        """Fill the ids in."""
        self.slots = self.tables.slots()
        for t, n in enumerate(self._active(lengths)):
            ids[t, :n] = self._step(coder, n, None)

    @staticmethod
    def _active(lengths: np.ndarray) -> list[int]:
        return np.searchsorted(-lengths, -np.arange(int(lengths.max(initial=0))), "left").tolist()

    def _step(self, coder, n: int, truth: np.ndarray | None) -> np.ndarray:
        tables, before = self.tables, self.before[:n]
        key = np.empty((2, n), np.uint32)
        np.multiply(before, np.uint32(0x9E3779B1), out=key[0])
        key[1] = (key[0] ^ self.hash[:n] * np.uint32(0x85EBCA77)) * np.uint32(0xC2B2AE3D)
        self.hash[:n] = key[0]
        at = np.empty((2, n), np.int64)
        at[0], at[1] = key[0] >> (THIRTYTWO - ORDER1), key[1] >> (THIRTYTWO - ORDER2)
        at += self.base[:, :n]
        key *= np.uint32(0x27D4EB2F)
        key &= self.check
        seen = self.seen.take(at)
        seen ^= key
        seen *= seen < self.limit
        sure, name = seen & SURE, seen >> FOUR
        candidate = np.where(seen[0] > ZERO, name[0], tables.top.take(before))
        candidate = np.where(seen[1] > ZERO, name[1], candidate)

        states = np.empty((3, n), np.int64)
        states[0] = sure[1]
        states[1] = sure[0] + (name[0] == candidate) * (SURE + ONE)
        states[2] = self.recent[:n]
        low, rng, hit = self.hit.decide(
            coder, slice(0, n), states, tables.shares.take(candidate).view(np.float32).reshape(-1, 2).T,
            coder.low[:n], coder.range[:n], FINE, None if truth is None else truth == candidate,
        )
        self.recent[:n] = (self.recent[:n] << 1 | hit) & 63
        out = candidate
        missed = (~hit).nonzero()[0]
        if len(missed):
            out = candidate.copy() if truth is None else truth
            out[missed], low[missed], rng[missed] = self._spell(
                coder, missed, before[missed], candidate[missed], low[missed], rng[missed],
                None if truth is None else truth[missed],
            )
        coder.settle(n, low, rng)

        # A right guess gains confidence, a wrong one halves it; at the bottom the new id takes the place.
        half = sure >> ONE
        wrong = np.where(half > ZERO, seen - sure + half, out << FOUR | ONE)
        kept = np.where(name == out, seen + (sure < SURE), wrong)
        kept |= key
        self.seen[at] = kept
        ids = tables.id_of.take(out)
        self.before[:n] = ids
        return ids

    def _spell(self, coder, k, before, candidate, low, rng, truth) -> tuple:
        """Code ids that are not the candidate: (signs, low, range)."""
        tables = self.tables
        bar, edge, head, _ = _columns(tables.signs.take(candidate))  # the candidate's share begins at the edge
        bar = bar * (head == before)  # what it has of the list
        listed, often, start, _ = _columns(tables.heads.take(before))
        listed = listed - bar
        share = (listed.astype(np.float32) / (often - bar + 1).astype(np.float32)).clip(1 / 256, 1 - 1 / 256)
        follows = None if truth is None else truth < len(tables.pairs)
        states = (share * 8).astype(np.int64)
        low, rng, follows = self.follows.decide(coder, k, states[None], (_stretched(share),), low, rng, COARSE, follows)
        bar = bar * follows
        total = np.where(follows, np.maximum(listed, 1), tables.total)
        unit = rng // total.astype(np.uint64)
        if truth is None:
            value = np.minimum((low // unit).astype(np.int64), total - 1)
            value += bar * (value >= edge)
            value += np.where(follows, start, len(self.slots) - tables.total)
            truth = self.slots.take(value, mode="clip")
        count, ahead, *_ = _columns(tables.signs.take(truth))
        ahead = unit * (ahead - bar * (ahead > edge)).astype(np.uint64)
        low = low - ahead if isinstance(coder, Reader) else low + ahead
        return truth, low, unit * count.astype(np.uint64)


def encode(blocks: list[np.ndarray], tables: Tables) -> list[bytes]:
    """Payload of each block of ids, all of which the tables count."""
    order = sorted(range(len(blocks)), key=lambda i: -len(blocks[i]))
    lengths = np.array([len(blocks[i]) for i in order], np.int64)
    ids = np.zeros((int(lengths.max(initial=0)), len(blocks)), np.uint16)
    for lane, i in enumerate(order):
        ids[: lengths[lane], lane] = blocks[i]
    writer = Writer(len(blocks), len(ids))
    _Model(tables, len(blocks)).encode(writer, lengths, ids)
    out = [b""] * len(blocks)
    for lane, payload in enumerate(writer.close()):
        out[order[lane]] = payload
    return out


def decode(payloads: list[bytes], sizes: list[int], tables: Tables) -> list[np.ndarray]:
    """The ids of each block, given how many it has."""
    order = sorted(range(len(sizes)), key=lambda i: -sizes[i])
    lengths = np.array([sizes[i] for i in order], np.int64)
    ids = np.zeros((int(lengths.max(initial=0)), len(sizes)), np.uint16)
    _Model(tables, len(sizes)).decode(Reader([payloads[i] for i in order]), lengths, ids)
    out = [np.empty(0, np.uint16)] * len(sizes)
    for lane, i in enumerate(order):
        out[i] = ids[: lengths[lane], lane].copy()
    return out
