"""Words and word windows of a text as arrays of 64-bit hashes."""

from __future__ import annotations

from functools import cache

import numpy as np
import xxhash


@cache
def _factors(size: int) -> np.ndarray:
    """Odd multipliers of the hashes in a window; no two places have the same."""
    return np.array(
        [pow(0x9E3779B97F4A7C15, 2 * i + 1, 1 << 64) for i in range(size)], np.uint64
    )


def word_hashes(text: bytes) -> np.ndarray:
    """A 64-bit hash of each run that is free of ASCII white space."""
    words = text.split()
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit integers under which near values end up far apart."""
    x = values ^ (values >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def window_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of every ``size`` consecutive words; empty for shorter texts."""
    count = len(hashes) - size + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(count, np.uint64)
    for i, factor in enumerate(_factors(size)):
        total += hashes[i : i + count] * factor
    return mixed(total)


def utf8(value) -> bytes:
    """The bytes of an Arrow string; none for NULL."""
    return value.as_buffer().to_pybytes() if value.is_valid else b""
