"""A minimal perfect hash function over 128-bit keys: bit levels with ranks, as arrays."""

from __future__ import annotations

import numpy as np

#: Bits a level has for each key that reaches it.
GAMMA = 2
#: Distinct keys leave all levels long before this one.
MOST_LEVELS = 200
STEP = 0x9E3779B97F4A7C15


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _places(h: np.ndarray, g: np.ndarray, level: int, size: int) -> np.ndarray:
    return _mix(h ^ _mix(g + np.uint64(STEP * (level + 1) % 2**64))) % np.uint64(size)


def fingerprints(h: np.ndarray, g: np.ndarray) -> np.ndarray:
    """32 bits of a key that its slot keeps."""
    return (_mix(g ^ (h << np.uint64(1))) >> np.uint64(32)).astype(np.uint32)


class PerfectHash:
    """Numbers 0 ... n - 1 for the n distinct keys (h, g) it was built over; about four bits a key.

    At each level a key takes a bit that no other key of the level wants; the
    keys that collide go on to the next.  A key's number is the count of bits
    set before its own.  Keys it was not built over get -1 or any number.
    """

    def __init__(self, sizes: np.ndarray, words: np.ndarray):
        self.sizes, self.words = sizes, words
        self.first = np.cumsum(sizes) - sizes
        self.before = np.cumsum(np.bitwise_count(words), dtype=np.int64) - np.bitwise_count(words)

    @classmethod
    def build(cls, h: np.ndarray, g: np.ndarray) -> PerfectHash:
        sizes, parts = [], []
        while len(h):
            if len(sizes) == MOST_LEVELS:
                raise ValueError("two keys have the same 128-bit hash")
            size = -(-GAMMA * len(h) // 64) * 64
            at = _places(h, g, len(sizes), size).astype(np.int64)
            wanted = np.bincount(at, minlength=size)
            parts.append(np.packbits(wanted == 1, bitorder="little").view("<u8"))
            sizes.append(size)
            left = wanted[at] > 1
            h, g = h[left], g[left]
        return cls(np.array(sizes, np.int64), np.concatenate([np.zeros(0, np.uint64), *parts]).astype(np.uint64))

    def __call__(self, h: np.ndarray, g: np.ndarray) -> np.ndarray:
        out = np.full(len(h), -1, np.int64)
        rest = np.arange(len(h))
        for level, size in enumerate(self.sizes.tolist()):
            if not len(rest):
                break
            at = self.first[level] + _places(h[rest], g[rest], level, size).astype(np.int64)
            word, bit = self.words[at >> 6], (at & 63).astype(np.uint64)
            hit = (word >> bit) & np.uint64(1) == 1
            below = np.bitwise_count(word & ((np.uint64(1) << bit) - np.uint64(1)))
            out[rest[hit]] = (self.before[at >> 6] + below)[hit]
            rest = rest[~hit]
        return out

    def dump(self) -> bytes:
        head = np.array([len(self.sizes), len(self.words)], "<i8")
        return head.tobytes() + self.sizes.astype("<i8").tobytes() + self.words.astype("<u8").tobytes()

    @classmethod
    def load(cls, raw: bytes) -> tuple[PerfectHash, int]:
        """The function and the number of bytes it took."""
        levels, words = np.frombuffer(raw, "<i8", 2).tolist()
        sizes = np.frombuffer(raw, "<i8", levels, 16).astype(np.int64)
        bits = np.frombuffer(raw, "<u8", words, 16 + 8 * levels).astype(np.uint64)
        return cls(sizes, bits), 16 + 8 * levels + 8 * words
