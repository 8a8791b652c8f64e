"""Minimal perfect hashing of 64-bit keys by levels of bitmaps.

A key's hash of level k picks a bit among those of its bucket; keys that are
alone on their bit stay there, the others go to the next level. A key's slot is
the number of set bits before its own, over all levels. Buckets are built in
tasks; the whole is their bitmaps one after another, level by level. Keys are
kept in slot order, so that a key which was never there is told apart.
"""

from __future__ import annotations

import numpy as np

BITS_PER_KEY = 2
_MUL1, _MUL2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    h = keys.astype(np.uint64) + np.uint64((seed + 1) * 0x9E3779B97F4A7C15 % 2**64)
    h = (h ^ (h >> np.uint64(30))) * _MUL1
    h = (h ^ (h >> np.uint64(27))) * _MUL2
    return h ^ (h >> np.uint64(31))


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    return (mixed(keys, -1) % np.uint64(buckets)).astype(np.int64)


def build_bucket(keys: np.ndarray) -> list[tuple[int, bytes, bytes]]:
    """(bits, bitmap, keys in slot order) per level, for distinct keys."""
    out, level = [], 0
    keys = np.asarray(keys, np.uint64)
    while len(keys):
        size = -(-max(64, BITS_PER_KEY * len(keys)) // 64) * 64
        at = (mixed(keys, level) % np.uint64(size)).astype(np.int64)
        alone = np.bincount(at, minlength=size) == 1
        stays = alone[at]
        order = np.argsort(at[stays])
        out.append((size, np.packbits(alone, bitorder="little").tobytes(), keys[stays][order].astype("<u8").tobytes()))
        keys, level = keys[~stays], level + 1
    return out


class PerfectHash:
    """The buckets' levels put together; ``parts`` has (bucket, level, bits, bitmap, keys)."""

    def __init__(self, parts: list[tuple[int, int, int, bytes, bytes]], buckets: int):
        parts = sorted(parts, key=lambda p: (p[1], p[0]))
        levels = max((p[1] for p in parts), default=-1) + 1
        self.buckets = buckets
        self.begin = np.zeros((levels, buckets), np.int64)  # in bits
        self.size = np.zeros((levels, buckets), np.int64)
        at = 0
        for bucket, level, bits, _, _ in parts:
            self.begin[level, bucket], self.size[level, bucket] = at, bits
            at += bits
        self.words = np.frombuffer(b"".join(p[3] for p in parts), "<u8")
        counts = np.bitwise_count(self.words).astype(np.int64)
        self.ranks = np.cumsum(counts) - counts
        self.keys = np.frombuffer(b"".join(p[4] for p in parts), "<u8")

    def __len__(self) -> int:
        return len(self.keys)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The keys' slots; -1 for keys that are not there."""
        keys = np.asarray(keys, np.uint64)
        out = np.full(len(keys), -1, np.int64)
        left, bucket = np.arange(len(keys)), bucket_of(keys, self.buckets)
        for level in range(len(self.begin)):
            own = bucket[left]
            size = self.size[level, own]
            left, own, size = left[size > 0], own[size > 0], size[size > 0]
            if not len(left):
                break
            bit = self.begin[level, own] + (mixed(keys[left], level) % size.astype(np.uint64)).astype(np.int64)
            word, low = self.words[bit >> 6], (bit & 63).astype(np.uint64)
            found = (word >> low) & np.uint64(1) == 1
            before = np.bitwise_count(word & ((np.uint64(1) << low) - np.uint64(1)))
            out[left[found]] = (self.ranks[bit >> 6] + before)[found]
            left = left[~found]
        known = out >= 0
        known[known] = self.keys[out[known]] == keys[known]
        return np.where(known, out, -1)
