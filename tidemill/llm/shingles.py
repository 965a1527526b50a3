"""Hashes of words, word shingles and byte strings, computed with numpy over a text's bytes.

A string's hash is a polynomial in an odd base modulo 2 ** 64, with a random 64-bit coefficient for each byte value, so that the hash
of any substring follows from prefix sums. Strings that collide for every base are over 1,000 bytes long; words that long are
hashed as a whole instead.
"""

from __future__ import annotations

import hashlib

import numpy as np

SHINGLE = 5
LONG_WORD = 500
PIECE = 1 << 20  # bytes that are hashed at a time
_BASE = 0x9E3779B97F4A7C15
_STATE: dict[str, np.ndarray] = {}


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def coefficients(which: int) -> np.ndarray:
    """A random number for each byte value; white space counts 0 in the first table."""
    name = f"coefficients{which}"
    if name not in _STATE:
        table = mixed(np.arange(256, dtype=np.uint64) + np.uint64(1 + (which << 32)))
        if which == 0:
            table[0x20] = 0
        _STATE[name] = table
    return _STATE[name]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse, modulo 2 ** 64."""
    if "powers" not in _STATE or len(_STATE["powers"]) < n:
        size = max(n, 1 << 16)
        for name, value in (("powers", _BASE), ("inverses", pow(_BASE, -1, 1 << 64))):
            p = np.full(size, value, np.uint64)
            p[0] = 1
            _STATE[name] = np.multiply.accumulate(p)
    return _STATE["powers"][:n], _STATE["inverses"][:n]


def canonical(text: str) -> bytes:
    """The words, A-Z lower-cased, one space between them."""
    return b" ".join(text.encode("utf-8", "surrogatepass").lower().split())


def word_hashes(words: bytes) -> np.ndarray:
    """A hash for each word of a canonical text, in order. Long texts are read in pieces, so that memory is that of a piece."""
    if len(words) <= PIECE:
        return _piece_hashes(words)
    out, lo = [], 0
    while lo < len(words):
        hi = len(words) if lo + PIECE >= len(words) else words.rfind(b" ", lo, lo + PIECE)
        if hi <= lo:  # a word longer than a piece
            hi = words.find(b" ", lo)
            hi = len(words) if hi < 0 else hi
            out.append(np.array([_long_hash(words[lo:hi])], np.uint64))
        else:
            out.append(_piece_hashes(words[lo:hi]))
        lo = hi + 1
    return np.concatenate(out)


def _long_hash(word: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")


def _piece_hashes(words: bytes) -> np.ndarray:
    if not words:
        return np.zeros(0, np.uint64)
    raw = np.frombuffer(words, np.uint8)
    space = np.flatnonzero(raw == 0x20)
    starts = np.empty(len(space) + 1, np.int64)
    starts[0] = 0
    np.add(space, 1, out=starts[1:])
    p, inverse = powers(len(raw))
    h = mixed(np.add.reduceat(coefficients(0)[raw] * p, starts) * inverse[starts])
    lengths = np.diff(starts, append=len(raw) + 1) - 1
    for i in np.flatnonzero(lengths > LONG_WORD):
        h[i] = _long_hash(words[starts[i] : starts[i] + lengths[i]])
    return h


def shingles(words: bytes, n: int = SHINGLE) -> np.ndarray:
    """The distinct n-word shingles of a canonical text, sorted; a shorter text is one shingle; no words, none."""
    w = word_hashes(words)
    if not len(w):
        return w
    m = min(n, len(w))
    size = len(w) - m + 1
    h = w[:size] + np.uint64(m)
    for i in range(1, m):
        h *= np.uint64(_BASE)
        h += w[i : i + size]
    h = mixed(h)
    h.sort()
    keep = np.empty(size, bool)
    keep[0] = True
    np.not_equal(h[1:], h[:-1], out=keep[1:])
    return h[keep]


def common(a: np.ndarray, b: np.ndarray) -> int:
    """How many values two sorted arrays of distinct values share."""
    both = np.concatenate([a, b])
    both.sort(kind="stable")
    return int((both[1:] == both[:-1]).sum())
