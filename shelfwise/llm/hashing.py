"""Rolling hashes and winnowing over whole Arrow batches (numpy).

``Rolling`` holds prefix sums of a polynomial hash modulo 2**64 over a byte
buffer, so the hash of any byte range costs two look-ups. Equal ranges have
equal hashes wherever they stand. Modulo a power of two some different texts of
regular build collide (a Thue-Morse string of 1,024 bytes and its complement), so it
serves where a hit is checked or only guides; ``PrimeRolling``, modulo the prime
2**61 - 1, serves where equality rests on the hash.
"""

from __future__ import annotations

import numpy as np
from pyspark import TaskContext

BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(BASE, -1, 1 << 64)
_powers: dict[str, np.ndarray] = {}


def _power_table(name: str, base: int, n: int) -> np.ndarray:
    table = _powers.get(name)
    if table is None or len(table) < n:
        size = max(n, 1 << 16)
        table = np.full(size, base, np.uint64)
        table[0] = 1
        table = np.cumprod(table, dtype=np.uint64)
        if size <= 1 << 23 and TaskContext.get():  # the driver's copy would travel with every task
            _powers[name] = table
    return table[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread all bits of ``x`` over 64 bits (a bijection)."""
    x = x ^ (x >> np.uint64(32))
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


class Rolling:
    def __init__(self, data: np.ndarray):
        n = len(data)
        self.sums = np.zeros(n + 1, np.uint64)
        if n:
            np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _power_table("up", BASE, n), out=self.sums[1:])
        self.down = _power_table("down", _INVERSE, n + 1)

    def ranges(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return mix((self.sums[stop] - self.sums[start]) * self.down[start])

    def grams(self, k: int) -> np.ndarray:
        """Hash of each ``k``-byte string, by start."""
        n = len(self.sums) - 1
        if n < k:
            return np.zeros(0, np.uint64)
        return mix((self.sums[k:] - self.sums[:-k]) * self.down[:n - k + 1])


P61 = np.uint64((1 << 61) - 1)
_BASE61 = 0x1B873593CC9E2D51 % int(P61)
_BLOCK61 = 1 << 20


def _fold61(x: np.ndarray) -> np.ndarray:
    x = (x & P61) + (x >> np.uint64(61))
    return np.where(x >= P61, x - P61, x)


def mulmod61(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products modulo 2**61 - 1 of numbers below it."""
    half, low = np.uint64(31), np.uint64((1 << 31) - 1)
    a1, a0, b1, b0 = a >> half, a & low, b >> half, b & low
    mid = a1 * b0 + a0 * b1
    return _fold61(((a1 * b1) << np.uint64(1)) + (mid >> np.uint64(30)) + ((mid & np.uint64((1 << 30) - 1)) << half) + a0 * b0)


def _powers61(name: str, base: int, n: int) -> np.ndarray:
    table = _powers.get(name)
    if table is None or len(table) < n:
        table = np.ones(1, np.uint64)
        while len(table) < max(n, 1 << 16):
            table = np.concatenate([table, mulmod61(table, np.uint64(pow(base, len(table), int(P61))))])
        if len(table) <= 1 << 23 and TaskContext.get():
            _powers[name] = table
    return table[:n]


class PrimeRolling:
    """As ``Rolling``, modulo 2**61 - 1."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        up = _powers61("up61", _BASE61, n)
        self.sums = np.zeros(n + 1, np.uint64)
        for lo in range(0, n, _BLOCK61):  # parts of a block's sums stay below 2**64
            hi = min(lo + _BLOCK61, n)
            c = data[lo:hi].astype(np.uint64) + np.uint64(1)
            high = np.cumsum(c * (up[lo:hi] >> np.uint64(32)))
            high = ((high & np.uint64((1 << 29) - 1)) << np.uint64(32)) + (high >> np.uint64(29))
            low = np.cumsum(c * (up[lo:hi] & np.uint64(0xFFFFFFFF)))
            self.sums[lo + 1:hi + 1] = _fold61(_fold61(low) + _fold61(high) + self.sums[lo])
        self.down = _powers61("down61", pow(_BASE61, -1, int(P61)), n + 1)

    def ranges(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        between = _fold61(self.sums[stop] + (P61 - self.sums[start]))
        return mix(mulmod61(between, self.down[start]))


def hash_one(data: bytes) -> int:
    """The same hash of a whole string."""
    r = Rolling(np.frombuffer(data, np.uint8))
    return int(r.ranges(np.array([0]), np.array([len(data)]))[0])


def window_owners(grams: np.ndarray, width: int) -> np.ndarray:
    """For each run of ``width`` consecutive grams the place of its smallest hash (leftmost of ties)."""
    n = len(grams)
    if n < width:
        return np.zeros(0, np.int64)
    low = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(n, dtype=np.uint64)
    have = 1
    while have < width:
        step = min(have, width - have)
        low = np.minimum(low[:-step], low[step:])
        have += step
    return (low & np.uint64(0xFFFFFFFF)).astype(np.int64)
