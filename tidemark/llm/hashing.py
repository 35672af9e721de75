"""Hashes of byte ranges and of word sequences, for whole batches of texts at once."""

from __future__ import annotations

import numpy as np

_byte = np.arange(256)
SPACE = (_byte == 32) | ((_byte >= 9) & (_byte <= 13))
UPPER = (_byte >= 65) & (_byte <= 90)
LOWER = np.where(UPPER, _byte + 32, _byte).astype(np.uint8)
_WORTH = np.random.Generator(np.random.PCG64(7)).integers(1, 2**63, 256, np.uint64)
BASE = 0x9E3779B97F4A7C15
_BACK = pow(BASE, -1, 2**64)
SLICE = 1 << 20


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def range_hashes(data: np.ndarray, first: np.ndarray, after: np.ndarray) -> np.ndarray:
    """A hash of each of the byte ranges."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_WORTH[data] * powers(BASE, len(data) + 1)[:-1], out=sums[1:])
    return mixed((sums[after] - sums[first]) * powers(_BACK, len(data) + 1)[first])


def slices(data: np.ndarray, size: int = SLICE):
    """Ranges of about ``size`` bytes that end behind white space, so never inside a word."""
    low = 0
    while low < len(data):
        high = min(low + size, len(data))
        while high < len(data):
            gaps = np.flatnonzero(SPACE[data[low:high]])
            if len(gaps):
                high = low + int(gaps[-1]) + 1
                break
            high = min(high + size, len(data))
        yield low, high
        low = high


def words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of the maximal runs of anything but white space."""
    space = np.concatenate([[True], SPACE[data], [True]])
    return np.flatnonzero(space[:-1] & ~space[1:]), np.flatnonzero(~space[:-1] & space[1:])


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the texts' words, A-Z in lower case, one text after the other; words per text."""
    joined = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
    bounds = np.cumsum([0, *(len(t) + 1 for t in texts)])
    codes, starts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for low, high in slices(joined):
        data = LOWER[joined[low:high]]
        begin, end = words(data)
        codes.append(range_hashes(data, begin, end))
        starts.append(begin + low)
    text = np.searchsorted(bounds, np.concatenate(starts), "right") - 1
    return np.concatenate(codes), np.bincount(text, minlength=len(texts))
