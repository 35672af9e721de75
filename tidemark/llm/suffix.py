"""Sorting suffixes in two stages, as far as windows of a fixed length need it.

Texts are joined, each with an end mark that is smaller than every byte. A
suffix is small if it is smaller than its successor, else large. Small suffixes
are sorted directly. Large ones are induced: the suffixes are scanned bucket by
bucket (a bucket begins with one byte, large ones stand before small ones in it), and
where the suffix before the scanned one is large, it is the next large one of
its own bucket. Adjacent common prefixes then tell which windows are equal.
"""

from __future__ import annotations

import numpy as np


def packed(data: np.ndarray) -> np.ndarray:
    """The eight bytes from every place on, as a number that sorts like them; 0 behind the end."""
    word = np.concatenate([data, np.zeros(8, np.uint8)]).astype(np.uint64)
    for step in (1, 2, 4):
        word = (word[:-step] << np.uint64(8 * step)) | word[step:]
    return word[: len(data)]


def _next(flags: np.ndarray) -> np.ndarray:
    """For every place the first flagged one from there on (the last place if there is none)."""
    at = np.where(flags, np.arange(len(flags)), len(flags) - 1)
    return np.minimum.accumulate(at[::-1])[::-1]


def _words(word: np.ndarray, places: np.ndarray, ends: np.ndarray, k: int) -> np.ndarray:
    """The k-th eight bytes of the suffixes, with 0 from the end of their text on."""
    at = np.minimum(places + 8 * k, len(word) - 1)
    left = np.clip(ends - places - 8 * k, 0, 8)
    found = word[at]
    short = np.flatnonzero(left < 8)
    shift = (8 * (8 - left[short])).astype(np.uint64)
    found[short] = np.where(left[short] > 0, (found[short] >> shift) << shift, np.uint64(0))
    return found


def direct(word: np.ndarray, places: np.ndarray, ends: np.ndarray, width: int) -> np.ndarray:
    """``places`` in the order of the first ``width`` bytes of their suffixes."""
    order = np.argsort(_words(word, places, ends, 0), kind="stable")
    places, ends = places[order], ends[order]
    last = _words(word, places, ends, 0)
    fresh = np.concatenate([[True], last[1:] != last[:-1]])
    for k in range(1, -(-width // 8)):
        tied = np.flatnonzero(~fresh | np.concatenate([~fresh[1:], [False]]))
        if not len(tied):
            break
        group = np.cumsum(fresh[tied])
        some = _words(word, places[tied], ends[tied], k)
        order = np.lexsort((some, group))
        places[tied], ends[tied], some = places[tied][order], ends[tied][order], some[order]
        differs = np.concatenate([[True], some[1:] != some[:-1]])
        fresh[tied] |= differs
    return places


def sorted_windows(data: np.ndarray, lengths: np.ndarray, width: int) -> np.ndarray:
    """Begins of all windows of ``width`` bytes within the texts, in the order of their bytes.

    ``data`` holds the texts one after the other, each followed by one byte for
    the end mark, whose value doesn't matter; ``lengths`` count texts without it.
    """
    ends = np.cumsum(lengths + 1) - 1
    begins = ends - lengths
    char = data.astype(np.int16)
    char[ends] = -1
    differs = np.concatenate([char[1:] != char[:-1], [True]])
    at = _next(differs)
    small = char[at] < char[np.minimum(at + 1, len(char) - 1)]
    small[ends] = True
    # Windows need themselves, and large suffixes their successors up to a small one.
    windows = np.maximum(lengths - width + 1, 0)
    stop = np.where(windows > 0, _next(small)[np.maximum(begins + windows - 1, 0)], begins - 1)
    turn = np.zeros(len(char) + 1, np.int32)
    np.add.at(turn, begins, 1)
    np.add.at(turn, stop + 1, -1)
    needed = np.cumsum(turn[:-1]) > 0
    text = np.repeat(ends, lengths + 1)
    seeds = np.flatnonzero(needed & small & (char >= 0))
    seeds = direct(packed(data), seeds, text[seeds], width) if len(seeds) else seeds
    large = needed & ~small
    heads = char[seeds]
    cuts = np.searchsorted(heads, np.arange(-1, 257))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    order = []

    def induce(scanned: np.ndarray, own: int) -> np.ndarray:
        before = scanned[scanned > 0] - 1
        before = before[large[before]]
        head = data[before]
        same = before[head == own] if own >= 0 else before[:0]
        rank = np.argsort(head, kind="stable")
        before, head = before[rank], head[rank]
        for value in np.unique(head):
            if value != own:
                waiting[value].append(before[np.searchsorted(head, value) : np.searchsorted(head, value, "right")])
        return same

    induce(ends[needed[ends]], -1)
    for value in range(256):
        wave = np.concatenate(waiting[value]) if waiting[value] else seeds[:0]
        while len(wave):
            order.append(wave)
            wave = induce(wave, value)
        own = seeds[cuts[value + 1] : cuts[value + 2]]
        if len(own):
            order.append(own)
            induce(own, value)
        waiting[value] = []
    order = np.concatenate(order) if order else seeds
    inside = order + width <= text[order]
    return order[inside]


def common(data_words: np.ndarray, a: np.ndarray, b: np.ndarray, width: int) -> np.ndarray:
    """Whether the windows at ``a`` and ``b`` have a common prefix of ``width`` bytes, the whole window."""
    equal = np.ones(len(a), bool)
    for k in range(-(-width // 8)):
        some = np.flatnonzero(equal)
        x, y = data_words[a[some] + 8 * k], data_words[b[some] + 8 * k]
        left = width - 8 * k
        if left < 8:
            x, y = x >> np.uint64(8 * (8 - left)), y >> np.uint64(8 * (8 - left))
        equal[some] = x == y
    return equal


def least_of_equal(data: np.ndarray, lengths: np.ndarray, least: np.ndarray, width: int) -> np.ndarray:
    """For every place that begins a window: the smallest ``least`` of the texts that hold this window."""
    out = np.zeros(len(data), np.int64)
    order = sorted_windows(data, lengths, width)
    if not len(order):
        return out
    value = np.repeat(least, lengths + 1)
    fresh = np.concatenate([[True], ~common(packed(data), order[:-1], order[1:], width)])
    first = np.flatnonzero(fresh)
    low = np.minimum.reduceat(value[order], first)
    out[order] = np.repeat(low, np.diff(np.append(first, len(order))))
    return out
