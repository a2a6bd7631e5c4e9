"""Word shingle sets of whole texts as sorted 64-bit hashes, vectorised over a batch of documents.

Words are runs of anything but ASCII white space in the text with A-Z
lower-cased.  A set holds a hash of every run of ``k`` words; a text with fewer
words has its whole sequence as one element; without words the set is empty.

A word's hash is the sum of its bytes' values, each times an odd factor of its
place (words of ``LONG`` bytes and more: BLAKE2).  Factors and values are
independent random numbers, not powers of a base, so no pattern of bytes
collides by itself: two words chosen without regard to these tables agree with a
chance of at most 2^-56, two shingles or sets of such words with 2^-62.
"""

from __future__ import annotations

import hashlib

import numpy as np

SHINGLE_WORDS = 5
PIECE = 1 << 21
#: Words from this many bytes on are hashed one by one.
LONG = 4096
_BASE = np.uint64(0x9E3779B97F4A7C15)
_U = np.uint64
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BYTES = np.random.default_rng(5).integers(1, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)
# values of bytes differ in their lowest eight bits: no difference is a multiple of 256
_VALUES = (_BYTES & ~_U(255)) | np.arange(256, dtype=np.uint64)
_PLACES = np.random.default_rng(11).integers(1, 1 << 63, LONG, dtype=np.uint64) * _U(2) + _U(1)
_TURNS = np.random.default_rng(7).integers(1, 1 << 63, 64, dtype=np.uint64) * _U(2) + _U(1)


def mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one scramble of 64-bit values (the splitmix64 finaliser)."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _powers(n: int, base: np.uint64) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_UP = _powers(PIECE + 1, _BASE)
_DOWN = _powers(PIECE + 1, _U(pow(int(_BASE), -1, 1 << 64)))


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(start, hash) of every word; long data goes through in pieces that end between words."""
    starts, hashes, at = [], [], 0
    raw = np.frombuffer(data, np.uint8)
    while at < len(raw):
        stop = min(len(raw), at + PIECE)
        if stop < len(raw):
            gaps = np.flatnonzero(_SPACE[raw[at:stop]])
            if len(gaps):
                stop = at + int(gaps[-1]) + 1
            else:  # a word longer than a piece: on to its end
                ends = np.flatnonzero(_SPACE[raw[stop:]])
                stop = stop + int(ends[0]) + 1 if len(ends) else len(raw)
        part = raw[at:stop]
        space = _SPACE[part]
        edge = np.flatnonzero(np.diff(np.concatenate([[True], space, [True]]).astype(np.int8)))
        first, last = edge[::2], edge[1::2]
        hashes.append(_run_hashes(part, space, first, last))
        starts.append(first + at)
        at = stop
    if not starts:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(starts), np.concatenate(hashes)


def _run_hashes(part: np.ndarray, space: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    if not len(first):
        return np.zeros(0, np.uint64)
    size = last - first
    inside = part[~space]
    begin = np.cumsum(size) - size  # of each word among the bytes of words
    place = np.arange(len(inside), dtype=np.int32) - np.repeat(begin, size).astype(np.int32)
    out = mix(np.add.reduceat(_VALUES[inside] * _PLACES[np.minimum(place, LONG - 1)], begin) + size.astype(np.uint64))
    for i in np.flatnonzero(size >= LONG).tolist():
        out[i] = int.from_bytes(hashlib.blake2b(part[first[i]:last[i]].tobytes(), digest_size=8).digest(), "little")
    return out


def shingle_sets(texts: list[str | None], k: int = SHINGLE_WORDS) -> list[np.ndarray]:
    """The sorted set of shingle hashes of each text."""
    raw = [(t or "").encode("utf-8").lower() for t in texts]  # bytes.lower() changes A-Z only
    bounds = np.cumsum([0, *(len(r) + 1 for r in raw)])
    starts, words = word_hashes(b"\n".join(raw))
    cut = np.searchsorted(starts, bounds)
    if len(words) >= k:
        runs = words[:len(words) - k + 1] * _TURNS[0]
        for j in range(1, k):
            runs = runs + words[j:len(words) - k + 1 + j] * _TURNS[j]
        runs = mix(runs)
    out = []
    for a, b in zip(cut[:-1], cut[1:], strict=True):
        if b - a >= k:
            out.append(np.unique(runs[a:b - k + 1]))
        elif b > a:
            out.append(mix((words[a:b] * _TURNS[:b - a]).sum(dtype=np.uint64, keepdims=True) + _TURNS[k + (b - a)]))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def set_key(tokens: np.ndarray) -> int:
    """A signed 64-bit key of a set; equal sets have equal keys."""
    total = mix(tokens ^ _TURNS[40]).sum(dtype=np.uint64, keepdims=True)
    return int(mix(total + np.array([len(tokens)], np.uint64) * _TURNS[41])[0].astype(np.int64))
