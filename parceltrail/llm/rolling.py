"""Prefix polynomial hashes of byte arrays, modulo 2**64, and tokens as hashed byte runs."""

from __future__ import annotations

import numpy as np

BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(BASE, -1, 1 << 64)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**k and BASE**-k for k up to n, kept by the process and grown when a longer text comes."""
    if len(_powers[0]) <= n:
        size = max(n + 1, 1 << 16)
        for k, b in enumerate((BASE, _INVERSE)):
            steps = np.full(size, b, np.uint64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps)
    return _powers[0], _powers[1]


class PrefixHash:
    """Hash of any piece of `data` in constant time; equal pieces have equal hashes wherever they stand."""

    def __init__(self, data: np.ndarray) -> None:
        self.up, self.down = powers(len(data))
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.up[: len(data)], out=self.sums[1:])

    def of(self, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
        return (self.sums[stops] - self.sums[starts]) * self.down[starts]

    def all_of(self, size: int) -> np.ndarray:
        """Hashes of all pieces of one size, by their starts."""
        return (self.sums[size:] - self.sums[:-size]) * self.down[: len(self.sums) - size]


def mixed(h: np.ndarray) -> np.ndarray:
    """Spreads a hash over all 64 bits."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(a place of each different key, number of each place's key)."""
    order = np.argsort(keys)
    new = np.ones(len(keys), bool)
    new[1:] = keys[order[1:]] != keys[order[:-1]]
    which = np.empty(len(keys), np.int64)
    which[order] = np.cumsum(new) - 1
    return order[new], which


def runs(kind: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, stops) of maximal runs of one kind other than 0 that don't cross `bounds` (offsets of texts)."""
    if not len(kind):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    change = np.empty(len(kind), bool)
    change[0] = True
    np.not_equal(kind[1:], kind[:-1], out=change[1:])
    change[bounds[bounds < len(kind)]] = True
    starts = np.flatnonzero(change)
    stops = np.r_[starts[1:], len(kind)]
    filled = kind[starts] != 0
    return starts[filled], stops[filled]
