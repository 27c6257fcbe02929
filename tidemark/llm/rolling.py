"""Prefix polynomial hashes modulo 2^64, for all positions of an array at once."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for base in (BASE, INVERSE):
        row = np.full(n, base, dtype=np.uint64)
        row[0] = 1
        out.append(np.multiply.accumulate(row))
    return out[0], out[1]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, at least ``n`` of each."""
    return _powers(1 << max(int(n - 1).bit_length(), 16))


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values over all bits, one to one."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def prefix_hashes(symbols: np.ndarray) -> np.ndarray:
    """One more value than symbols; ``span`` takes differences of them."""
    forward, _ = powers(len(symbols) + 1)
    codes = mix(symbols.astype(np.uint64) + np.uint64(1))
    out = np.zeros(len(symbols) + 1, dtype=np.uint64)
    np.cumsum(codes * forward[: len(symbols)], out=out[1:])
    return out


def span(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of symbols start..end, equal for equal strings wherever they stand."""
    _, back = powers(len(prefix))
    return (prefix[end] - prefix[start]) * back[start]


def grams(prefix: np.ndarray, k: int) -> np.ndarray:
    """Mixed hashes of all stretches of ``k`` symbols."""
    n = len(prefix) - k
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    _, back = powers(len(prefix))
    return mix((prefix[k:] - prefix[:n]) * back[:n])


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Least value of every ``width`` neighbours, by doubling."""
    have, low = 1, values
    while have * 2 <= width:
        low = np.minimum(low[:-have], low[have:]) if len(low) > have else low[:0]
        have *= 2
    rest = width - have
    if rest:
        low = np.minimum(low[:-rest], low[rest:]) if len(low) > rest else low[:0]
    return low
