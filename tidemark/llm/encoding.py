"""Encoding texts with the tokenizers library, one pre-token at a time where that is exact.

Byte-level BPE encodes each pre-token on its own, and texts repeat their
pre-tokens. So a block of texts is cut into parts as one array of bytes, each
different part is encoded once, and the ids of the texts are gathered from those
of their parts. Where the rule for pre-tokens can't be told for sure here
(another kind of tokenizer, unusual white space, added tokens in the text), a text
is encoded as a whole.
"""

from __future__ import annotations

import contextlib
import functools
import gc
import json
import os
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# The pre-token pattern of byte-level BPE, in terms that mean the
# same for all characters that ``UNPLAIN`` doesn't find.
PIECE = re.compile(r"'(?:s|t|re|ve|m|ll|d)| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")
UNPLAIN = re.compile(
    "[^\t\n\r -~¡-±´-¸º»¿-ɏͰ-ԯ‐-‧€]"
)
# A space and a line end as tokens of byte-level BPE spell them.
OPENING = ("\u0120", "\u010a")
# Parts in one long text; with more of them the library takes longer for each.
BESIDE = 300
# Texts whose ids are given at once.
ROWS = 256
# Bytes of white space, of ASCII letters and digits, and those that stand in the characters of ``ODD``,
# which are white space, or may be taken for it, beside the four that ``WHITE`` has.
WHITE, ALNUM, HINTS = np.zeros((3, 256), bool)
WHITE[list(b"\t\n\r ")] = True
ALNUM[[c for c in range(128) if chr(c).isalnum()]] = True
HINTS[:32] = HINTS[[0x7F, 0xC2, 0xE1, 0xE2, 0xE3, 0xEF]] = True
HINTS &= ~WHITE
ODD = re.compile(
    "[\0-\x08\x0b\x0c\x0e-\x1f\x7f-\xa0\u1680\u180e\u2000-\u200f\u2028-\u202f\u205f-\u206f\u3000\ufeff]"
)
# Parts whose ids a task keeps, about 250 bytes each.
KEPT = 600_000


class Encoder:
    """Ids of texts under a tokenizer given by the content of its file."""

    def __init__(self, content: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(content)
        rule = json.loads(content)
        before = rule.get("pre_tokenizer") or {}
        self.by_piece = (
            rule["model"].get("type") == "BPE" and not rule.get("normalizer") and not rule["model"].get("dropout")
            and before.get("type") == "ByteLevel" and before.get("use_regex", True)
            and not before.get("add_prefix_space")
        )
        added = [re.escape(t["content"]) for t in rule.get("added_tokens", [])]
        self.whole = re.compile("|".join([UNPLAIN.pattern, *added])) if added else UNPLAIN
        self.odd = re.compile("|".join([ODD.pattern, *added])) if added else ODD
        self.added = re.compile("|".join(added).encode()) if added else None
        self.known: dict[str, bytes] = {}
        ids = self.tokenizer.get_vocab()
        self.opening = np.zeros(max(ids.values()) + 1, bool)
        self.opening[[i for t, i in ids.items() if t.startswith(OPENING)]] = True

    def exact_by_piece(self, text: str) -> bool:
        return self.by_piece and not self.whole.search(text)

    def _encode(self, texts: list[str]) -> list[bytes]:
        return [
            array("I", e.ids).tobytes()
            for low in range(0, len(texts), ROWS)
            for e in self.tokenizer.encode_batch_fast(texts[low : low + ROWS], add_special_tokens=False)
        ]

    def learn(self, parts) -> None:
        """Encode the parts that are not known, each once.

        Those that begin with white space and have none behind it or at the end
        keep their ids side by side in a long text: an id whose token begins
        with white space begins a part.
        """
        known = self.known
        new = [p for p in dict.fromkeys(parts) if p not in known]
        if len(known) + len(new) > KEPT:
            known = self.known = {p: known[p] for p in parts if p in known}
        beside = [p for p in new if p[0] <= " " < p[-1] and p[1] > " "]
        if len(beside) < len(new):
            alone = list(set(new).difference(beside))
            known.update(zip(alone, self._encode(alone)))
        for low in range(0, len(beside), BESIDE):
            some = beside[low : low + BESIDE]
            found = self.tokenizer.encode_batch_fast(["".join(some)], add_special_tokens=False)[0].ids
            found = np.array(found, np.uint32)
            starts = np.flatnonzero(self.opening[found]) * 4
            data, begins = found.tobytes(), starts.tolist()
            known.update(zip(some, map(data.__getitem__, map(slice, begins, [*begins[1:], None])), strict=True))

    def _cuts(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, list[int]]:
        """Where the parts of all texts begin, and the numbers of the texts that are one part as a whole.

        Whatever the characters, a pre-token ends where white space begins, and
        between a letter or digit and a comma or full stop. Texts are cut there;
        a part may hold several pre-tokens. Texts with an added token, or where
        white space is in doubt, are not cut.
        """
        filled = np.diff(bounds) > 0
        white = WHITE[data]
        cuts = white.copy()
        cuts[1:] &= ~white[:-1]
        stops = np.flatnonzero((data == ord(".")) | (data == ord(",")))
        last, lead = data[np.maximum(stops - 1, 0)], data[np.maximum(stops - 2, 0)]
        # U+00C0 to U+023F, all letters but two.
        latin = (last >= 0x80) & (lead >= 0xC3) & (lead <= 0xC8)
        latin &= (lead > 0xC3) | (last != 0x97) & (last != 0xB7)
        cuts[stops[ALNUM[last] | latin]] = True
        cuts[bounds[:-1][filled]] = True
        places = [np.flatnonzero(HINTS[data])]
        if self.added:
            places += [np.arange(*found.span()) for found in self.added.finditer(memoryview(data))]
        whole = []
        for k in np.unique(np.searchsorted(bounds, np.concatenate(places), "right") - 1).tolist():
            low, high = bounds[k], bounds[k + 1]
            if self.odd.search(data[low:high].tobytes().decode()):
                cuts[low + 1 : high] = False
                whole.append(k)
        return np.flatnonzero(cuts), whole

    def _ids(self, parts: pa.Array, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All ids of different parts and of whole texts; where those of each begin, and how many they are.

        Parts that begin with white space and have none behind it or at the end
        are encoded side by side in a long text, as in ``learn``.
        """
        begins, data = _bytes(parts)
        second = data[np.minimum(begins[:-1] + 1, begins[1:] - 1)]
        beside = np.isin(data[begins[:-1]], list(b" \n")) & (second > 32) & (data[begins[1:] - 1] > 32)
        order = np.concatenate([np.flatnonzero(beside), np.flatnonzero(~beside), len(parts) + np.arange(len(texts))])
        alone = [p.decode() for p in parts.filter(pa.array(~beside)).to_pylist()] + texts
        begins, data = _bytes(parts.filter(pa.array(beside)))
        values, counts = [], []
        for low in range(0, len(begins) - 1, BESIDE):
            ends = begins[low : low + BESIDE + 1]
            text = data[ends[0] : ends[-1]].tobytes().decode()
            found = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids
            values.append(np.array(found, np.uint32))
            starts = np.flatnonzero(self.opening[values[-1]])
            if len(starts) != len(ends) - 1:
                raise ValueError("parts side by side can't be told apart")
            counts.append(np.diff(starts, append=len(found)))
        values += [np.frombuffer(found, np.uint32) for found in self._encode(alone)]
        counts.append(np.array([len(found) for found in values[len(values) - len(alone) :]], np.int64))
        sizes, places = np.zeros((2, len(order)), np.int64)
        sizes[order] = counts = np.concatenate(counts)
        places[order] = np.cumsum(counts) - counts
        return np.concatenate([np.zeros(0, np.uint32), *values]), places, sizes

    def arrays(self, texts: pa.Array, end: int | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Ids of texts without nulls, ``ROWS`` texts at a time: bounds of each text, and all ids.

        Every text is followed by the id ``end``, if there is one.
        """
        if not self.by_piece:
            last = b"" if end is None else np.uint32(end).tobytes()
            for low in range(0, len(texts), ROWS):
                found = [ids + last for ids in self._encode(texts.slice(low, ROWS).to_pylist())]
                yield np.cumsum([0, *map(len, found)]) // 4, np.frombuffer(b"".join(found), np.uint32)
            return
        bounds, data = _bytes(texts.cast(pa.large_binary()))
        cuts, whole = self._cuts(data, bounds)
        first = np.searchsorted(cuts, bounds)
        valid = np.ones(len(cuts), bool)
        valid[first[whole]] = False
        buffers = np.packbits(valid, bitorder="little"), np.append(cuts, len(data)), data
        parts = pa.Array.from_buffers(pa.large_binary(), len(cuts), list(map(pa.py_buffer, buffers)))
        parts = parts.dictionary_encode()
        numbers = parts.indices.fill_null(0).to_numpy().copy()
        numbers[first[whole]] = len(parts.dictionary) + np.arange(len(whole))
        values, places, sizes = self._ids(
            parts.dictionary, [data[bounds[k] : bounds[k + 1]].tobytes().decode() for k in whole]
        )
        if end is not None:
            places, sizes = np.append(places, len(values)), np.append(sizes, 1)
            values = np.append(values, np.uint32(end))
        for low in range(0, len(texts), ROWS):
            at = first[low : low + ROWS + 1]
            some, at = numbers[at[0] : at[-1]], at - at[0]
            if end is not None:
                some, at = np.insert(some, at[1:], len(sizes) - 1), at + np.arange(len(at))
            size = sizes[some]
            ends = np.cumsum(size)
            taken = np.repeat(places[some] - ends + size, size)
            taken += np.arange(len(taken))
            yield np.append(0, ends)[at], values[taken]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, as little-endian unsigned 32-bit integers."""
        return [
            values[low:high].astype("<u4").tobytes()
            for bounds, values in self.arrays(pa.array(texts, pa.large_string()))
            for low, high in zip(bounds[:-1], bounds[1:])
        ]

    def count(self, pieces: list[str]) -> list[int]:
        """Number of ids of each pre-token."""
        self.learn(pieces)
        return [len(self.known[p]) // 4 for p in pieces]


def _bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of the values of an array of large binaries without nulls, from 0 on, and their bytes."""
    _, offsets, data = texts.buffers()
    bounds = np.zeros(1, np.int64)
    if len(texts):
        bounds = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]] if bounds[-1] else np.zeros(0, np.uint8)
    return bounds - bounds[0], data


@functools.lru_cache(maxsize=1)
def _encoder(content: str) -> Encoder:
    return Encoder(content)


@contextlib.contextmanager
def encoder(content: str):
    """The Python worker's encoder, for one task: a worker outlives its tasks, what they keep doesn't."""
    held = _encoder(content)
    try:
        yield held
    finally:
        held.known = {}


def content(path: str) -> str:
    """The tokenizer's file, read by the driver and sent along with the tasks."""
    with open(path, encoding="utf-8") as file:
        return file.read()
