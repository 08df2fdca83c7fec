"""Sets of hashed word shingles (shared by operator 3 and its tests).

Words are runs without ASCII white space after A-Z is lower-cased.  A set holds the hashes of
all distinct runs of ``WIDTH`` words; a text with fewer words has one member, the whole
sequence; a text without words has none.
"""

from __future__ import annotations

import numpy as np
import xxhash

WIDTH = 5
#: Bits of a short sketch, a multiple of 64.
SHORT = 1024
_A, _B = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def mixed(h: np.ndarray) -> np.ndarray:
    """Bits of 64-bit numbers, mixed."""
    h = h ^ (h >> np.uint64(33))
    h = h * _A
    h ^= h >> np.uint64(33)
    h *= _B
    return h ^ (h >> np.uint64(33))


class Hasher:
    """Hashes of words, remembered up to a number of words."""

    def __init__(self, most: int = 100_000):
        self.known: dict[bytes, bytes] = {}
        self.most = most

    def _make(self, word: bytes) -> bytes:
        made = self.known[word] = xxhash.xxh64_digest(word)
        return made

    def words(self, text: str) -> np.ndarray:
        parts = text.encode("utf-8", "surrogatepass").lower().split()  # both are ASCII only on bytes
        if len(self.known) > self.most:
            self.known.clear()
        get, make = self.known.get, self._make
        return np.frombuffer(b"".join([get(w) or make(w) for w in parts]), np.uint64)

    def members(self, text: str | None) -> np.ndarray:
        """Sorted distinct shingle hashes of a text: a polynomial of the word hashes, mixed."""
        h = self.words(text) if text else np.empty(0, np.uint64)
        if len(h) == 0:
            return h
        width = min(WIDTH, len(h))
        rolled = np.full(len(h) - width + 1, np.uint64(width))
        for j in range(width):
            rolled *= _STEP
            rolled += h[j : len(h) - width + 1 + j]
        rolled = mixed(rolled)
        rolled.sort()
        return rolled[np.r_[True, rolled[1:] != rolled[:-1]]]


def sketch(members: np.ndarray) -> bytes:
    """Parities of the members by their low bits; as many bits as members, rounded up to a power of two.

    Two sketches differ in at most as many bits as their sets do in members.
    """
    bits = max(64, 1 << (len(members) - 1).bit_length()) if len(members) else 64
    counts = np.bincount((members & np.uint64(bits - 1)).astype(np.int64), minlength=bits)
    return np.packbits((counts & 1).astype(np.uint8), bitorder="little").tobytes()


def short_sketch(members: np.ndarray) -> bytes:
    """Parities of the members in ``SHORT`` bits, whatever their number; bounds differences as ``sketch`` does."""
    counts = np.bincount((members & np.uint64(SHORT - 1)).astype(np.int64), minlength=SHORT)
    return np.packbits((counts & 1).astype(np.uint8), bitorder="little").tobytes()


def sketch_distance(a: bytes, b: bytes) -> int:
    """Bits in which two sketches differ, the longer folded to the length of the shorter."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    if len(x) < len(y):
        x, y = y, x
    while len(x) > len(y):
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    return int(np.bitwise_count(x ^ y).sum())


def fingerprint(members: np.ndarray) -> tuple[int, int]:
    """Two 63-bit hashes of a set."""
    raw = members.tobytes()
    return xxhash.xxh3_128_intdigest(raw) >> 65, xxhash.xxh64_intdigest(raw, 7) >> 1
