"""Hashes of word shingles, computed per document with numpy."""

from __future__ import annotations

import hashlib

import numpy as np

SHINGLE = 5  # words
BLOCK = 65_536  # words that are hashed at once

_rng = np.random.default_rng(20_240_229)
BYTE_CODES = _rng.integers(1, 2**63, 256, dtype=np.uint64)
BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)
PLACES = _rng.integers(1, 2**63, SHINGLE, dtype=np.uint64) | np.uint64(1)


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every bit."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


class _Powers:
    """Powers of a number modulo 2**64, as many as were needed so far."""

    def __init__(self, base: int):
        self.base, self.known = np.uint64(base), np.ones(1, np.uint64)

    def first(self, n: int) -> np.ndarray:
        while len(self.known) < n:
            self.known = np.concatenate((self.known, self.known * self.known[-1] * self.base))
        return self.known[:n]


_up, _down = _Powers(BASE), _Powers(INVERSE)


def words_of(text: str | None) -> list[bytes]:
    """The words of a text with A-Z lower-cased; ``bytes`` methods treat exactly the ASCII blanks and letters."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def word_hashes(words: list[bytes]) -> np.ndarray:
    out = []
    for at in range(0, len(words), BLOCK):
        part = words[at:at + BLOCK]
        data = np.frombuffer(b"".join(part), np.uint8)
        ends = np.cumsum(np.fromiter(map(len, part), np.int64, len(part)))
        starts = np.concatenate((np.zeros(1, np.int64), ends[:-1]))
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(BYTE_CODES[data] * _up.first(len(data)))))
        # a word's sum, moved back to where a text begins, does not depend on its place
        out.append(mixed((sums[ends] - sums[starts]) * _down.first(len(data) + 1)[starts] + (ends - starts).astype(np.uint64)))
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def shingle_set(text: str | None) -> np.ndarray:
    """The sorted distinct shingle hashes; a text of fewer words is one shingle, a text without words has none."""
    words = word_hashes(words_of(text))
    if not len(words):
        return words
    n = max(1, len(words) - SHINGLE + 1)
    total = np.full(n, min(len(words), SHINGLE), np.uint64)
    for i in range(min(SHINGLE, len(words))):
        total += words[i:i + n] * PLACES[i]
    return np.unique(mixed(total))


def set_digest(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()
