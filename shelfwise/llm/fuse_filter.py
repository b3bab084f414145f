"""Static binary-fuse filter (three places per key, 16-bit fingerprints), built with numpy.

About 18 bits a key, one false positive in 65,536, no false negative.
"""

from __future__ import annotations

import math
import struct

import numpy as np

from shelfwise.llm.hashing import mix

_HEAD = "<QQQ"


def _places(keys: np.ndarray, seed: int, segment: int, count: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Three places of each key, in three neighbouring segments, and its fingerprint."""
    h = mix(keys + np.uint64(seed))
    mask = np.uint64(segment - 1)
    first = ((h >> np.uint64(32)) * np.uint64(count * segment)) >> np.uint64(32)
    second = (first + np.uint64(segment)) ^ ((h >> np.uint64(18)) & mask)
    third = (first + np.uint64(2 * segment)) ^ (h & mask)
    return np.stack([first, second, third]).astype(np.int64), (mix(h) >> np.uint64(48)).astype(np.uint16), h


def build(keys: np.ndarray) -> bytes:
    """The filter of 64-bit ``keys`` (repeats allowed) as bytes."""
    keys = np.unique(keys)
    n = len(keys)
    if not n:
        return struct.pack(_HEAD, 0, 0, 0)
    segment = min(1 << 18, 1 << int(math.log(max(n, 2)) / math.log(3.33) + 2.25))
    factor = max(1.125, 0.875 + 0.25 * math.log(1e6) / math.log(max(n, 2)))
    count = max(1, math.ceil(n * factor / segment) - 2)
    seed = 1
    while True:
        where, prints, _ = _places(keys, seed, segment, count)
        size = (count + 2) * segment
        load = np.bincount(where.ravel(), minlength=size)
        alive = np.zeros(size, np.int64)  # exclusive-or of the keys that still use a place
        for row in where:
            np.bitwise_xor.at(alive, row, np.arange(n))
        rounds, left = [], n
        single = np.flatnonzero(load == 1)
        while len(single):
            owner, at = np.unique(alive[single], return_index=True)
            rounds.append((owner, single[at]))
            left -= len(owner)
            touched = where[:, owner].ravel()
            np.subtract.at(load, touched, 1)
            np.bitwise_xor.at(alive, touched, np.tile(owner, 3))
            touched = np.unique(touched)
            single = touched[load[touched] == 1]
        if not left:
            break
        seed += 1
        count += 1 + count // 8
    table = np.zeros(size, np.uint16)
    for owner, place in reversed(rounds):  # the places of one round don't depend on each other
        table[place] = 0
        a, b, c = where[:, owner]
        table[place] = prints[owner] ^ table[a] ^ table[b] ^ table[c]
    return struct.pack(_HEAD, seed, segment, count) + table.tobytes()


def contains(blob: bytes, keys: np.ndarray) -> np.ndarray:
    seed, segment, count = struct.unpack_from(_HEAD, blob)
    if not segment:
        return np.zeros(len(keys), bool)
    table = np.frombuffer(blob, np.uint16, offset=struct.calcsize(_HEAD))
    (a, b, c), prints, _ = _places(keys, seed, segment, count)
    return (table[a] ^ table[b] ^ table[c]) == prints
