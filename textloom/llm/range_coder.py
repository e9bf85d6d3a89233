"""Adaptive context-mixing range coder for token ids, many independent blocks in step.

A run of ids has a head: its distinct ids from frequent to rare and how often each bucket of them occurs. A block is coded by itself
with the head: its models are reset to it, and a checksum is stored beside it. Three predictions are mixed for every id.
Order 0 gives every id a share by adaptive counts of buckets, whose ids share alike. Order 2 and order 1 each put on the id that
their context names as much as contexts of that confidence have been right so far in the block, and leave the rest to order 0. The weights
of the three follow how likely each found the ids so far: after every other id a weight moves towards its share
of the mixture's probability. An id's slot is the sum of what all three give it.

numpy works on one position of all blocks of a group at a time, so a group costs
the same number of array operations as one block. Both sides compute the mixture by the same sequence of
floating-point operations on single elements, which IEEE arithmetic makes the same everywhere.

The coder is a 48-bit range coder without carries: low and range are
kept in 64-bit arrays, and 16 bits go out while the top bits of both ends
agree or the range has become too small.
"""

from __future__ import annotations

import zlib

import numpy as np

BLOCK = 2048  # ids a block
LANES = 4096  # blocks coded in step
HASH = 512  # entries of each context table
SINGLE, STEP = 16, 4  # the first buckets have one id; after them, after each STEP buckets the number of ids doubles
SHARES = 1 << 19  # what order 0 deals out, about
PRIOR, SEEN = 320.0, 4  # weight of the head's counts, and of an id of the block
COARSE = 8  # buckets that a search takes together at first
LEVELS = 8  # confidences of a context's entry
RATE, PACE = np.float32(1 / 16), np.float32(1 / 20)  # of the confidences and the weights
ONE, LEAST, MOST = np.float32(1), np.float32(0.02), np.float32(0.48)  # a weight lies between the last two
SPREAD, SHIFT = (np.uint32(2654435761), np.uint32(2246822519)), np.uint32(32 - 9)  # HASH has nine binary digits
EDGE, FULL, WORD = 1 << 32, (1 << 48) - 1, 16
HEAD = 12  # bytes: count, size, crc32


def _ratio(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Floor of a / b for 0 <= a < 2^52 and b > 0, where a double's quotient is never rounded up to the next whole number."""
    return (a / b).astype(np.int64)


class Alphabet:
    """The ids of a run by rank, and its buckets."""

    def __init__(self, ids: np.ndarray, counts: np.ndarray):
        self.ids = ids
        width = [1] * SINGLE
        while sum(width) < len(ids):
            width += [2 * width[-1]] * STEP
        self.buckets = len(width)
        self.depth = max(1, (self.buckets - 1).bit_length())
        self.width = np.array(width + [0] * ((1 << self.depth) - self.buckets), np.int64)
        self.base = np.cumsum(self.width) - self.width
        self.bucket = np.repeat(np.arange(len(self.width)), self.width)
        self.counts = counts

    @classmethod
    def of(cls, ids: np.ndarray) -> tuple[Alphabet, np.ndarray]:
        """The alphabet of a run and the run in ranks."""
        if len(ids) and int(ids.max()) >= max(1 << 20, 4 * len(ids)):  # too thin for a table of all numbers
            found, place, times = np.unique(ids, return_inverse=True, return_counts=True)
        else:
            every = np.bincount(ids)
            found = np.flatnonzero(every)
            place, times = ids, every[found]
        order = np.argsort(-times, kind="stable")
        rank = np.zeros(int(found[-1]) + 1 if len(found) and place is ids else len(found), np.int32)
        rank[found[order] if place is ids else order] = np.arange(len(found))
        own = cls(found[order].astype("<u4"), np.zeros(0, "<u4"))
        own.counts = np.bincount(own.bucket[: len(found)], weights=times[order], minlength=len(own.width)).astype("<u4")
        return own, rank[place]

    def packed(self) -> bytes:
        return np.array([len(self.ids), len(self.counts)], "<u4").tobytes() + self.ids.tobytes() + self.counts.tobytes()

    @classmethod
    def unpacked(cls, data: bytes, at: int = 0) -> tuple[Alphabet, int]:
        """The alphabet that stands at a place, and where it ends."""
        n, m = (int(x) for x in np.frombuffer(data, "<u4", 2, at))
        return cls(np.frombuffer(data, "<u4", n, at + 8), np.frombuffer(data, "<u4", m, at + 8 + 4 * n)), at + 8 + 4 * (n + m)


class _Models:
    def __init__(self, lanes: int, alphabet: Alphabet):
        self.lanes, self.alphabet, self.lane = lanes, alphabet, np.arange(lanes)
        self.inside, self.bucket = alphabet.base.astype(np.int32), alphabet.bucket.astype(np.int32)
        self.table = np.zeros(2 * lanes * HASH, np.int32)  # order 2's entries, then order 1's: rank and confidence
        self.base = np.stack([self.lane, self.lane + lanes]) * HASH
        self.hash = np.zeros((2, lanes), np.uint32)
        start = np.array([0.01, 0.25, 0.45, 0.6, 0.7, 0.78, 0.84, 0.9], np.float32)
        self.right = np.tile(start, 2 * lanes)  # how often entries of an order and a confidence are right
        self.level = np.stack([self.lane, self.lane + lanes]) * LEVELS
        prior = alphabet.counts * (PRIOR / max(1, int(alphabet.counts.sum()))) + 0.05 * (alphabet.width > 0)
        self.count = np.repeat(prior.astype(np.float32)[:, None], lanes, 1)
        self.counts = self.count.ravel()
        self.share = (np.maximum(alphabet.width, 1) / SHARES)[:, None]
        self.width = alphabet.width.astype(np.int32)[:, None]
        self.cum = np.zeros((len(alphabet.width) + 1, lanes), np.int32)
        self.flat = self.cum.ravel()
        self.b, self.turn = np.zeros(lanes, np.uint32), False
        self.weight = np.full((2, lanes), 0.4, np.float32)
        self.refresh()

    def refresh(self) -> None:
        """Order 0's shares from the counts: of each id of a bucket, and where each bucket's begin."""
        total = self.count.sum(0, dtype=np.float64)
        self.each = np.maximum((self.count / (self.share * total)).astype(np.int32), 1)
        self.own = self.each.ravel()
        np.cumsum(self.each * self.width, 0, out=self.cum[1:])
        self.all, self.coarse = self.cum[-1], self.cum[COARSE : self.alphabet.buckets : COARSE].copy()
        self.room = self.all.astype(np.float32)

    def guess(self) -> None:
        self.at = (self.hash >> SHIFT).astype(np.int64)
        self.at += self.base
        self.entry = self.table[self.at]
        self.sure = self.entry & LEVELS - 1
        self.named = self.entry >> 3
        self.cell = self.sure + self.level
        self.odds = self.right[self.cell]
        part = self.weight * self.odds
        self.mass = (part * (self.room / (ONE - part[0] - part[1]))).astype(np.int32)
        self.total = self.all + self.mass[0]
        self.total += self.mass[1]

    def zero(self, rank: np.ndarray, bucket: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Begin and size of order 0's share of ids."""
        self.place = bucket.astype(np.int64)
        self.place *= self.lanes
        self.place += self.lane
        each = self.own[self.place]
        return self.flat[self.place] + (rank - self.inside.take(bucket)) * each, each

    def slot(self, rank: np.ndarray, begin: np.ndarray, each: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Begin and size of an id's slot in the mixture, from those of its order-0 share: ids lie in order of their ranks."""
        self.hit = self.named == rank
        before = self.mass * (self.named < rank).astype(np.int32)
        own = self.mass * self.hit.astype(np.int32)
        begin = begin + before[0]
        begin += before[1]
        self.each_own = each
        self.size = each + own[0]
        self.size += own[1]
        return begin, self.size

    def find(self, v: np.ndarray) -> tuple[np.ndarray, ...]:
        """Rank of the id whose slot holds v, and begin and size of its order-0 share: the masses before it are taken off, then order 0's shares are searched."""
        one, two = self.named
        ends = np.empty_like(self.named)
        np.minimum(one, two, out=ends[0])
        np.maximum(one, two, out=ends[1])
        bucket = self.bucket.take(ends)
        cell = bucket.astype(np.int64)
        cell *= self.lanes
        cell += self.lane
        ends -= self.inside.take(bucket)
        ends += 1
        ends *= self.own[cell]
        ends += self.flat[cell]
        ends -= 1  # the last place of each named id's share
        lower = np.where(one <= two, self.mass[0], self.mass[1])
        v = v - np.minimum(np.maximum(v - ends[0], 0), lower)
        v -= np.minimum(np.maximum(v - ends[1], 0), self.mass[0] + self.mass[1] - lower)
        bucket = np.add.reduce((self.coarse <= v).view(np.int8), 0, dtype=np.int64)
        bucket *= COARSE
        at = bucket * self.lanes
        at += self.lane
        for step in (4, 2, 1):
            at += (self.flat[at + step * self.lanes] <= v) * (step * self.lanes)
        bucket = at // self.lanes
        self.place = at
        begin, each = self.flat[self.place], self.own[self.place]
        place = ((v - begin) / each).astype(np.int32)
        return self.inside.take(bucket) + place, begin + place * each, each

    def learn(self, rank: np.ndarray) -> None:
        hit = self.hit.astype(np.float32)
        self.turn = not self.turn
        if self.turn:  # weights move with every other id
            rest = (ONE - self.odds) * (self.each_own.astype(np.float32) / self.room)
            gain = (self.odds * hit + rest) * (self.total.astype(np.float32) / self.size.astype(np.float32)) - ONE
            self.weight += PACE * self.weight * gain
            np.minimum(np.maximum(self.weight, LEAST, out=self.weight), MOST, out=self.weight)
        self.right[self.cell] = self.odds + RATE * (hit - self.odds)
        entry, sure = self.entry, self.sure
        lower = np.where(sure <= 1, rank << 3 | 1, entry - (sure + 1 >> 1))
        self.table[self.at] = np.where(self.hit, entry + (sure < LEVELS - 1).astype(np.int32), lower)
        self.counts[self.place] += SEEN
        mixed = rank.astype(np.uint32) * SPREAD[0]
        np.add(self.b, mixed, out=self.hash[0])
        self.hash[1], self.b = mixed, mixed * SPREAD[1]


def _fresh(t: int) -> bool:
    """Whether order 0's shares are worked out anew after position t."""
    return t & 63 == 63 or t in (7, 15, 31)


def encode_blocks(ids: np.ndarray, block: int = BLOCK) -> tuple[bytes, list[bytes]]:
    """The head of one run of ids and its blocks, each with its own head."""
    alphabet, ranks = Alphabet.of(ids)
    parts = [ranks[i : i + block] for i in range(0, len(ids), block)]
    out: list[bytes] = []
    for i in range(0, len(parts), LANES):
        out += _encode_group(parts[i : i + LANES], alphabet)
    return alphabet.packed(), out


def _encode_group(parts: list[np.ndarray], alphabet: Alphabet) -> list[bytes]:
    sizes = np.array([len(p) for p in parts])
    order = np.argsort(-sizes, kind="stable")
    lanes, longest = len(parts), int(sizes.max())
    grid = np.zeros((longest, lanes), np.int32)
    for k, j in enumerate(order):
        grid[: sizes[j], k] = parts[j]
    alive = np.searchsorted(-sizes[order], -np.arange(longest), side="left")  # lanes with an id at each position
    m = _Models(lanes, alphabet)
    low, rng = np.zeros(lanes, np.int64), np.full(lanes, FULL)
    width = longest * 2 + 16
    buf, used = np.zeros((width, lanes), "<u2"), np.zeros(lanes, np.int64)
    words = buf.ravel()

    def out_word(rows, top):
        words[used[rows] * lanes + rows] = top

    for t in range(longest):
        n, x = int(alive[t]), grid[t]
        m.guess()
        start, size = m.slot(x, *m.zero(x, m.bucket.take(x)))
        _narrow(low, rng, _ratio(rng, m.total), start, size, n)
        _shift(low, rng, used, n, out_word)
        m.learn(x)
        if _fresh(t):
            m.refresh()
    for _ in range(3):
        buf[used, np.arange(lanes)] = (low >> 32).astype(np.uint16)
        used += 1
        low = (low << WORD) & FULL
    out, buf = [b""] * lanes, np.ascontiguousarray(buf[: int(used.max())].T)
    for k, j in enumerate(order):
        body = buf[k, : used[k]].tobytes()
        crc = zlib.crc32(alphabet.ids[parts[j]].tobytes())
        out[j] = np.array([sizes[j], len(body), crc], "<u4").tobytes() + body
    return out


def _narrow(low, rng, unit, start, size, n) -> None:
    low[:n] += unit[:n] * start[:n]
    low[:n] &= FULL
    np.multiply(unit[:n], size[:n], out=rng[:n])


def _shift(low, rng, used, n, moved) -> None:
    """Gives the settled words of the first n lanes to `moved` until each range is wide again."""
    rows = np.flatnonzero(rng[:n] < EDGE)  # a narrower range is within one word's edges, or goes over one
    while len(rows):
        l, r = low[rows], rng[rows]
        settled = (l ^ (l + r)) < EDGE
        if not settled.all():
            r = np.where(settled, r, -l & (EDGE - 1))  # too narrow over an edge: up to the edge
        moved(rows, (l >> 32).astype(np.uint16))
        used[rows] += 1
        r <<= WORD
        low[rows], rng[rows] = (l << WORD) & FULL, r & FULL
        rows = rows[r < EDGE]


def decode_blocks(head: bytes, blocks: list[bytes]) -> list[np.ndarray]:
    """The ids of each block; a block whose checksum differs raises an error."""
    alphabet, out = Alphabet.unpacked(head)[0], []
    for i in range(0, len(blocks), LANES):
        out += _decode_group(blocks[i : i + LANES], alphabet)
    return out


def _decode_group(blocks: list[bytes], alphabet: Alphabet) -> list[np.ndarray]:
    heads = np.array([np.frombuffer(b, "<u4", 3) for b in blocks], np.int64)
    sizes = heads[:, 0]
    order = np.argsort(-sizes, kind="stable")
    lanes, longest = len(blocks), int(sizes.max())
    alive = np.searchsorted(-sizes[order], -np.arange(longest), side="left")
    buf = np.zeros((lanes, int(heads[:, 1].max()) // 2 + 8), "<u2")
    for k, j in enumerate(order):
        body = np.frombuffer(blocks[j], "<u2", offset=HEAD)
        buf[k, : len(body)] = body
    m = _Models(lanes, alphabet)
    low, rng, used = np.zeros(lanes, np.int64), np.full(lanes, FULL), np.full(lanes, 3, np.int64)
    words, last = np.ascontiguousarray(buf.T).ravel(), len(alphabet.ids) - 1
    code = (buf[:, 0].astype(np.int64) << 32) | (buf[:, 1].astype(np.int64) << WORD) | buf[:, 2]
    grid = np.zeros((longest, lanes), np.int32)

    def in_word(rows, top):
        code[rows] = ((code[rows] << WORD) & FULL) | words[used[rows] * lanes + rows]

    for t in range(longest):
        n = int(alive[t])
        m.guess()
        unit = _ratio(rng, m.total)
        v = np.minimum(_ratio((code - low) & FULL, unit), m.total - 1).astype(np.int32)
        x, begin, each = m.find(v)
        if n < lanes:  # finished blocks
            x[n:] = 0
        start, size = m.slot(x, begin, each)
        _narrow(low, rng, unit, start, size, n)
        _shift(low, rng, used, n, in_word)
        grid[t] = x
        m.learn(x)
        if _fresh(t):
            m.refresh()
    out: list[np.ndarray] = [np.zeros(0, "<u4")] * lanes
    for k, j in enumerate(order):
        ids = alphabet.ids[np.minimum(grid[: sizes[j], k], last)]
        if zlib.crc32(ids.tobytes()) != heads[j, 2]:
            raise ValueError("a block's checksum differs")
        out[j] = ids
    return out
