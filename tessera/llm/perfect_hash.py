"""Minimal perfect hashing of distinct numbers: every key its own index from 0
to n - 1, about four bits a key, no probing.

Keys are dealt to shards by a hash.  A shard has levels of bits: a key that
meets no other at its place of a level is settled there by a set bit, the rest
goes on to the next level.  The index of a key is the number of set bits before
its own.  A key that was not hashed may land on any index, so the table keeps
the keys and compares.
"""

from __future__ import annotations

import numpy as np

GAMMA = 2               # bits of a level per key that reaches it

_U = np.uint64


def mix(keys: np.ndarray, seed: int) -> np.ndarray:
    """64 well-mixed bits of each key (a bijection for every seed)."""
    x = keys.astype(_U) + _U((seed + 1) * 0x9E3779B97F4A7C15 % 2 ** 64)
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def bucket(keys: np.ndarray) -> np.ndarray:
    """30 bits of each key by which it is dealt to a shard."""
    return (mix(keys, 1000) >> _U(34)).astype(np.int32)


def build(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(sizes, words)`` for distinct keys: bits of each level, and all levels' bits as 64-bit words."""
    sizes, words = [], []
    while len(keys):
        size = 64 * -(-GAMMA * len(keys) // 64)
        at = (mix(keys, len(sizes)) % _U(size)).astype(np.int64)
        alone = np.bincount(at, minlength=size) == 1
        sizes.append(size)
        words.append(np.packbits(alone, bitorder="little").view("<u8"))
        keys = keys[~alone[at]]
    return np.array(sizes, np.int64), np.concatenate(words) if words else np.empty(0, "<u8")


class Hash:
    """The functions of neighbouring shards: ``first`` is the number of the
    first one, ``shards`` the number of all, ``parts`` their ``build`` results."""

    def __init__(self, parts: list[tuple[np.ndarray, np.ndarray]], first: int = 0, shards: int = 1):
        self.first, self.shards, self.n = first, shards, len(parts)
        depth = max((len(s) for s, _ in parts), default=0)
        self.sizes, self.bases = np.zeros((len(parts), depth), np.int64), np.zeros((len(parts), depth), np.int64)
        base = 0
        for i, (sizes, words) in enumerate(parts):
            self.sizes[i, :len(sizes)] = sizes
            self.bases[i, :len(sizes)] = base + (sizes.cumsum() - sizes) // 64
            base += len(words)
        self.words = np.concatenate([w for _, w in parts]) if parts else np.empty(0, "<u8")
        ones = np.bitwise_count(self.words).astype(np.int64)
        self.before = ones.cumsum() - ones

    def index(self, keys: np.ndarray) -> np.ndarray:
        """Index of each key among all keys of these shards; -1 for some that were not hashed."""
        out = np.full(len(keys), -1, np.int64)
        shard = bucket(keys) % self.shards - self.first
        rest = np.flatnonzero((shard >= 0) & (shard < self.n))
        for level in range(self.sizes.shape[1]):
            row = shard[rest]
            rest, row = rest[(held := self.sizes[row, level] > 0)], row[held]
            at = mix(keys[rest], level) % self.sizes[row, level].astype(_U)
            word, bit = self.bases[row, level] + (at >> _U(6)).astype(np.int64), at & _U(63)
            bits = self.words[word]
            hit = (bits >> bit & _U(1)) == 1
            below = np.bitwise_count(bits & ((_U(1) << bit) - _U(1))).astype(np.int64)
            out[rest[hit]] = (self.before[word] + below)[hit]
            rest = rest[~hit]
        return out
