"""Binary fuse filters of one byte a key: static sets of 64-bit keys, built and asked in whole arrays.

Every key belongs to three cells in neighbouring segments; the cells are filled so that the three bytes of a key XOR to
its fingerprint. A key of the set is always found; another one is found once in 256 times.
"""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np


class Filter(NamedTuple):
    seed: int
    segment: int
    starts: int
    cells: np.ndarray


def _mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    h = keys.astype(np.uint64) + np.uint64(seed)
    for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
        h ^= h >> np.uint64(shift)
        h *= np.uint64(factor)
    return h ^ (h >> np.uint64(33))


def _places(h: np.ndarray, segment: int, starts: int) -> np.ndarray:
    """The three cells of each key, one row each."""
    first = ((h >> np.uint64(32)) * np.uint64(starts)) >> np.uint64(32)
    mask = np.uint64(segment - 1)
    second = (first + np.uint64(segment)) ^ ((h >> np.uint64(18)) & mask)
    third = (first + np.uint64(2 * segment)) ^ (h & mask)
    return np.stack([first, second, third]).astype(np.int64)


def _fingerprints(h: np.ndarray) -> np.ndarray:
    return ((h ^ (h >> np.uint64(32))) & np.uint64(255)).astype(np.uint8)


def _peel(places: np.ndarray, size: int) -> list[tuple[np.ndarray, np.ndarray]] | None:
    """Rounds of (keys, the cell that only this key still has), or None if some keys can't be told apart."""
    n = places.shape[1]
    count = np.bincount(places.ravel(), minlength=size)
    total = np.zeros(size, np.int64)
    for row in places:
        np.add.at(total, row, np.arange(n))
    rounds, left = [], n
    cells = np.flatnonzero(count == 1)
    while len(cells):
        keys, index = np.unique(total[cells], return_index=True)
        rounds.append((keys, cells[index]))
        left -= len(keys)
        touched = places[:, keys]
        np.subtract.at(count, touched.ravel(), 1)
        np.subtract.at(total, touched.ravel(), np.tile(keys, 3))
        touched = np.unique(touched)
        cells = touched[count[touched] == 1]
    return None if left else rounds


def build(keys: np.ndarray) -> Filter:
    """A filter of these keys; repeated ones count once."""
    keys = np.unique(np.asarray(keys).astype(np.uint64))
    n = len(keys)
    segment = 1 << min(18, int(math.log(max(n, 2)) / math.log(3.33) + 2.25))
    spare = max(1.125, 0.875 + 0.25 * math.log(1e6) / math.log(max(n, 2)))
    starts = max(1, math.ceil(n * spare / segment) - 2) * segment
    size = starts + 2 * segment
    for seed in range(1000):
        h = _mixed(keys, seed * 0x9E3779B97F4A7C15 % 2**64)
        places = _places(h, segment, starts)
        if (rounds := _peel(places, size)) is None:
            continue
        cells, marks = np.zeros(size, np.uint8), _fingerprints(h)
        for part, alone in reversed(rounds):
            around = places[:, part]
            cells[alone] = marks[part] ^ np.bitwise_xor.reduce(cells[around], axis=0)
        return Filter(seed * 0x9E3779B97F4A7C15 % 2**64, segment, starts, cells)
    raise RuntimeError("no seed fits")


def contains(f: Filter, keys: np.ndarray) -> np.ndarray:
    h = _mixed(np.asarray(keys), f.seed)
    return np.bitwise_xor.reduce(f.cells[_places(h, f.segment, f.starts)], axis=0) == _fingerprints(h)
