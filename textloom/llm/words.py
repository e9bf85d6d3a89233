"""Word and shingle hashes of whole texts, computed a megabyte at a time with numpy.

Words are the runs of bytes other than ASCII white space, A-Z lower-cased, so
they agree with `[^\\x20\\x09-\\x0D]+` over the lower-cased text. A word is hashed eight bytes
at a time: each piece is mixed with a key of its place by a function that is not linear,
and the mixed pieces and the length are added up and mixed again. (A polynomial modulo 2^64 gives one hash to some
pairs of long regular words, whatever its base.)
"""

from __future__ import annotations

import numpy as np

_rng = np.random.Generator(np.random.PCG64(20260101))
_STEP = _rng.integers(1, 2**63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_MASK = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)  # the first n of eight bytes
SLICE = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _hashed(buf: np.ndarray, eights: np.ndarray, at: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and start of each word of one slice that begins and ends at word limits; eights: the eight bytes from each place on, of the whole."""
    solid = ~_SPACE[buf]
    edge = np.flatnonzero(np.diff(np.concatenate(([False], solid, [False])).view(np.int8)))
    starts, ends = edge[::2] + at, edge[1::2] + at
    if not len(starts):
        return np.zeros(0, np.uint64), starts
    return piece_hashes(eights, starts, ends), starts


def piece_hashes(eights: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each piece [start, end) of the bytes behind `eights`; no piece is empty."""
    sizes = ends - starts
    pieces = (sizes + 7) >> 3
    if int(pieces.max()) == 1:
        return mix(mix((eights[starts] & _MASK[sizes]) ^ _FIRST_KEY) + sizes.astype(np.uint64) * _STEP[15])
    first = np.cumsum(pieces) - pieces
    step = np.arange(first[-1] + pieces[-1]) - np.repeat(first, pieces)
    place = np.repeat(starts, pieces) + 8 * step
    value = eights[place] & _MASK[np.minimum(np.repeat(ends, pieces) - place, 8)]
    value = mix(value ^ mix(step.astype(np.uint64) * _STEP[13] + _STEP[12]))
    return mix(np.add.reduceat(value, first) + sizes.astype(np.uint64) * _STEP[15])


def word_hashes(blobs: list[bytes], lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the documents, one after another, and where each document's begin (one more at the end)."""
    whole = b"\n".join(blobs) + b"\n" * 9
    if lower:
        whole = whole.lower()
    buf = np.frombuffer(whole, np.uint8)
    eights = np.ndarray((len(whole) - 7,), "<u8", whole, strides=(1,))
    found, places, at = [], [], 0
    while at < len(buf):
        end = min(len(buf), at + SLICE)
        while end < len(buf) and not _SPACE[buf[end - 1]]:
            more = np.flatnonzero(_SPACE[buf[end : end + SLICE]])
            end = end + int(more[0]) + 1 if len(more) else min(len(buf), end + SLICE)
        h, s = _hashed(buf[at:end], eights, at)
        found.append(h)
        places.append(s)
        at = end
    h, s = np.concatenate(found), np.concatenate(places)
    limits = np.cumsum([0] + [len(b) + 1 for b in blobs])
    return h, np.searchsorted(s, limits)


_FIRST_KEY = mix(_STEP[12:13])


def windows(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k words from each place on; the last k-1 places have none."""
    if len(h) < k:
        return np.zeros(0, np.uint64)
    total = np.zeros(len(h) - k + 1, np.uint64)
    for j in range(k):
        total += h[j : len(h) - k + 1 + j] * _STEP[j]
    return mix(total)


def shingle_sets(blobs: list[bytes], k: int) -> list[np.ndarray]:
    """The sorted distinct k-word shingles of each document; fewer words count as one shingle, none as an empty set."""
    h, limits = word_hashes(blobs)
    every = windows(h, k)
    sets = []
    for a, b in zip(limits[:-1], limits[1:]):
        if b - a >= k:
            sets.append(np.unique(every[a : b - k + 1]))
        elif b > a:
            part = sum((h[a + j : a + j + 1] * _STEP[j] for j in range(b - a)), np.zeros(1, np.uint64))
            sets.append(mix(part + np.array([b - a], np.uint64) * _STEP[14]))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets
