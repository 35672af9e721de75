"""Quality rules as a short-circuit cascade.

Counts that every document gets come first, and a base test on them. Documents
that pass it go through the rules one by one, until one rejects them. In what
order is learned while a task runs: the first documents, and then one in
``EVERY``, go through all rules with the clock running, and the rules are ordered by
rejections per cost. Each next rule is weighed on the sampled documents that the
rules before it leave, so two rules that reject the same documents don't both come
early. The order changes what is worked out, never the verdict: a document is
kept if no rule rejects it.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property, lru_cache
from time import perf_counter_ns

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from tidemark.llm.common import small_batches

SYMBOLS = b"#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
# Words in a repeated window, and the base test: fewest words, most per cent of repeated words.
WINDOW, FEWEST, REPEATED = 5, 10, 20
# The sample: one document in so many, and how many of the latest sampled ones are looked at.
EVERY, SAMPLED = 32, 512
ROWS = 512

LETTER, UPPER, SPACE = 1, 2, 4


@lru_cache(1)
def _classes() -> np.ndarray:
    """What each code point is; worked out once in a process."""
    kinds = [unicodedata.category(chr(c)) for c in range(0x110000)]
    out = np.array([LETTER * (k[0] == "L") + UPPER * (k == "Lu") for k in kinds], np.uint8)
    out[[ord(c) for c in SPACES]] |= SPACE
    return out


def _ranks(keys: np.ndarray) -> np.ndarray:
    return np.unique(keys, return_inverse=True)[1]


class Text:
    """A document and what is known of it; everything is worked out when it is first asked for."""

    def __init__(self, text: str):
        self.text = text
        self.data = text.encode()

    @cached_property
    def words(self) -> list[bytes]:
        return self.data.split()

    @cached_property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        return len(self.text) - sum(map(self.text.count, SPACES))

    @cached_property
    def n_symbols(self) -> int:
        return len(self.data) - len(self.data.translate(None, SYMBOLS))

    @cached_property
    def lines(self) -> list[bytes]:
        """Lines with a word."""
        return [line for line in self.data.split(b"\n") if line and not line.isspace()]

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def _numbered(self) -> tuple[np.ndarray, int]:
        """Number of each word, the same for equal words, and how many there are."""
        numbers = {w: n for n, w in enumerate(dict.fromkeys(self.words))}
        return np.fromiter(map(numbers.__getitem__, self.words), np.int64, self.n_words), len(numbers)

    @cached_property
    def kinds(self) -> np.ndarray:
        """What each code point is."""
        return _classes()[np.frombuffer(self.text.encode("utf-32-le"), np.uint32)]

    @cached_property
    def _bounds(self) -> tuple[np.ndarray, np.ndarray]:
        """Begin and end of each word in code points."""
        space = np.concatenate([[True], (self.kinds & SPACE) > 0, [True]])
        return np.flatnonzero(space[:-1] & ~space[1:]), np.flatnonzero(~space[:-1] & space[1:])

    @cached_property
    def word_sizes(self) -> np.ndarray:
        """Code points of each word."""
        begin, end = self._bounds
        return end - begin

    def grams(self, width: int) -> np.ndarray:
        """Equal numbers for equal runs of ``width`` words, one per place."""
        numbers, kinds = self._numbered
        if len(numbers) < width:
            return numbers[:0]
        size = len(numbers) - width + 1
        key, most = numbers[:size], kinds
        for k in range(1, width):
            if most * kinds >= 1 << 62:
                key, most = _ranks(key), size
            key, most = key * kinds + numbers[k : k + size], most * kinds
        return key

    @cached_property
    def n_repeat_words(self) -> int:
        if self.n_words <= WINDOW or self._numbered[1] == self.n_words:
            return 0
        _, where, often = np.unique(self.grams(WINDOW), return_inverse=True, return_counts=True)
        again = often[where] > 1
        edges = np.zeros(self.n_words + 1, np.int64)
        edges[:-WINDOW] += again
        edges[WINDOW:] -= again
        return int((np.cumsum(edges) > 0).sum())

    def top_gram(self, width: int) -> int:
        """Most code points that one run of ``width`` words, found twice or more, takes up."""
        grams = self.grams(width)
        if not len(grams):
            return 0
        _, first, often = np.unique(grams, return_index=True, return_counts=True)
        sums = np.concatenate([[0], np.cumsum(self.word_sizes)])
        size = sums[first + width] - sums[first]
        return int((often * size)[often > 1].max(initial=0))

    @cached_property
    def n_letters(self) -> int:
        return int(np.count_nonzero(self.kinds & LETTER))

    @cached_property
    def n_upper(self) -> int:
        return int(np.count_nonzero(self.kinds & UPPER))

    @cached_property
    def n_lettered(self) -> int:
        """Words with a letter."""
        begin, _ = self._bounds
        return int(np.count_nonzero(np.bitwise_or.reduceat(self.kinds, begin) & LETTER)) if len(begin) else 0


def base_failed(text: Text) -> bool:
    return text.n_words < FEWEST or 100 * text.n_repeat_words > REPEATED * text.n_words


@dataclass(frozen=True)
class Rule:
    """A named test of one document that says whether to reject it."""

    name: str
    rejects: Callable[[Text], bool]


# Shares in per cent, all compared as whole numbers.
RULES = (
    Rule("word_length", lambda t: t.word_chars < 2 * t.n_words or t.word_chars > 20 * t.n_words),
    Rule("symbols", lambda t: 100 * t.n_symbols > 10 * t.n_words),
    Rule("duplicate_lines", lambda t: 100 * t.n_dup_lines > 30 * len(t.lines)),
    Rule("lettered_words", lambda t: 100 * t.n_lettered < 70 * t.n_words),
    Rule("capitals", lambda t: 100 * t.n_upper > 50 * t.n_letters),
    Rule("bullets", lambda t: 100 * sum(l.lstrip().startswith((b"-", b"*", "•".encode())) for l in t.lines) > 90 * len(t.lines)),
    Rule("ellipses", lambda t: 100 * sum(l.rstrip().endswith((b"...", "…".encode())) for l in t.lines) > 30 * len(t.lines)),
    Rule("top_pair", lambda t: 100 * t.top_gram(2) > 20 * t.word_chars),
    Rule("top_triple", lambda t: 100 * t.top_gram(3) > 18 * t.word_chars),
    Rule("top_quadruple", lambda t: 100 * t.top_gram(4) > 16 * t.word_chars),
)


def by_rejection_per_cost(rejected: np.ndarray, cost: np.ndarray) -> list[int]:
    """The order of rules: next comes the one that rejects most per cost of the documents left.

    ``rejected`` has a row per sampled document and a column per rule, ``cost`` the
    mean cost of each rule. Rules that reject nothing more come last, the cheapest first.
    """
    left, rest, order = np.ones(len(rejected), bool), list(range(len(cost))), []
    while rest:
        gain = {r: rejected[left, r].sum() / max(float(cost[r]), 1.0) for r in rest}
        best = min(rest, key=lambda r: (-gain[r], cost[r], r))
        order.append(best)
        rest.remove(best)
        left &= ~rejected[:, best]
    return order


class Cascade:
    """Rules in the order that the documents seen so far suggest."""

    def __init__(self, rules: Sequence[Rule] = RULES, every: int = EVERY, sampled: int = SAMPLED):
        self.rules, self.every, self.most = tuple(rules), every, sampled
        self.order = list(range(len(self.rules)))
        self._rejected: list[list[bool]] = []
        self._spent = np.zeros(len(self.rules))
        self._timed = 0
        _classes()  # not to be timed with the first rule that needs it

    def _sampled(self, text: Text) -> bool:
        verdicts = []
        for k, rule in enumerate(self.rules):
            # What other rules have worked out must not make this one look cheap.
            fresh = Text(text.text)
            base_failed(fresh), fresh.word_chars, fresh.n_symbols, fresh.n_dup_lines  # noqa: B018
            started = perf_counter_ns()
            verdicts.append(bool(rule.rejects(fresh)))
            self._spent[k] += perf_counter_ns() - started
        self._timed += 1
        self._rejected = [*self._rejected[1 - self.most :], verdicts]
        return any(verdicts)

    def reorder(self) -> None:
        if self._timed:
            self.order = by_rejection_per_cost(np.array(self._rejected, bool), self._spent / self._timed)

    def rejects(self, text: Text) -> tuple[bool, int]:
        """Whether a rule rejects the document, and how many rules were asked."""
        chosen = xxhash.xxh64_intdigest(text.data) % self.every == 0
        if chosen or self._timed < self.every:
            rejected = self._sampled(text)
            if self._timed & (self._timed - 1) == 0 or self._timed % self.every == 0:
                self.reorder()
            return rejected, len(self.rules)
        for asked, k in enumerate(self.order, 1):
            if self.rules[k].rejects(text):
                return True, asked
        return False, len(self.rules)


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def judged(docs: DataFrame, rules: Sequence[Rule] = RULES, every: int = EVERY) -> DataFrame:
    """doc_id, the counts, base_failed, kept and rules_asked for every row of ``docs``.

    Null texts count as empty, and empty ones fail the base test for want of
    words. A row gives a row, also where doc_id is null or repeats; only doc_id
    and text are read, texts whole. ``rules_asked`` (0 where the base test
    failed) depends on the clock and may differ from run to run, the rest does not.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    counts = ", ".join(f"{c} long" for c in COUNTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cascade = Cascade(rules, every)
        for batch in (b.slice(low, ROWS) for b in batches for low in range(0, b.num_rows, ROWS)):
            found = {c: [] for c in (*COUNTS, "base_failed", "kept", "rules_asked")}
            for value in batch["text"]:
                text = Text(value.as_py() or "")
                for c in COUNTS:
                    found[c].append(getattr(text, c))
                failed = base_failed(text)
                rejected, asked = (True, 0) if failed else cascade.rejects(text)
                found["base_failed"].append(failed)
                found["kept"].append(not rejected)
                found["rules_asked"].append(asked)
            yield pa.record_batch(
                {"doc_id": batch["doc_id"]}
                | {c: pa.array(v, pa.bool_() if c in ("base_failed", "kept") else pa.int64()) for c, v in found.items()}
            )

    return small_batches(docs).select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, {counts}, base_failed boolean, kept boolean, rules_asked long"
    )
