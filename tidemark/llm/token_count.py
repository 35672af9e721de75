"""Token counts that follow edits: a segment tree of pre-tokens per document.

The leaves of a tree hold some dozens of pre-tokens each, with their text and
number of tokens; inner nodes hold the sums below them. An edit is located by
the sums of characters. Only the leaves it touches, one leaf before them and as
many after them as it takes until pre-tokens begin where they began before are
split and encoded again; then the sums on the way up are corrected.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import small_batches
from tidemark.llm.encoding import PIECE, Encoder, encoder

LEAF = 48
ROWS = 256


class Node:
    __slots__ = ("above", "left", "right", "text", "chars", "tokens", "before", "after")

    def __init__(self, text: str = "", tokens: int = 0):
        self.above = self.left = self.right = self.before = self.after = None
        self.text, self.chars, self.tokens = text, len(text), tokens


def _joined(leaves: list[Node]) -> Node:
    """A balanced tree over the leaves."""
    level = leaves
    while len(level) > 1:
        above = []
        for k in range(0, len(level) - 1, 2):
            node = Node()
            node.left, node.right = level[k], level[k + 1]
            node.chars, node.tokens = node.left.chars + node.right.chars, node.left.tokens + node.right.tokens
            node.left.above = node.right.above = node
            above.append(node)
        level = above + level[len(level) - len(level) % 2 :]
    return level[0]


class Tree:
    """Leaves of a text, chained in order, below one root."""

    def __init__(self, leaves: list[tuple[str, int]]):
        nodes = [Node(*leaf) for leaf in leaves] or [Node()]
        for a, b in zip(nodes, nodes[1:]):
            a.after, b.before = b, a
        self.first, self.root, self.encoded = nodes[0], _joined(nodes), 0

    @classmethod
    def of(cls, text: str, ids: Encoder) -> Tree:
        return cls(_leaves(PIECE.findall(text), ids))

    def leaves(self) -> Iterator[Node]:
        node = self.first
        while node:
            yield node
            node = node.after

    def leaf_at(self, place: int) -> tuple[Node, int]:
        """The leaf that holds a character, or the last one, and where that leaf begins."""
        node, begin = self.root, 0
        while node.left:
            if place < begin + node.left.chars:
                node = node.left
            else:
                begin += node.left.chars
                node = node.right
        return node, begin

    def edit(self, at: int, deleted: int, inserted: str, ids: Encoder) -> None:
        """Replace ``deleted`` characters from ``at`` on by ``inserted``."""
        at = max(0, min(at, self.root.chars))
        deleted = max(0, min(deleted, self.root.chars - at))
        low, begin = self.leaf_at(at)
        high, high_begin = self.leaf_at(at + deleted)
        while low.before:
            low = low.before
            begin -= low.chars
            if low.chars:
                break
        end = high_begin + high.chars
        region, node = [], low
        while True:
            region.append(node)
            if node is high:
                break
            node = node.after
        text = "".join(n.text for n in region)
        text = text[: at - begin] + inserted + text[at - begin + deleted :]
        touched = at - begin + len(inserted)
        while True:
            follow, context = region[-1].after, ""
            while follow and not context:
                context, follow = follow.text, follow.after
            pieces, reached = [], 0
            for piece in PIECE.findall(text + context):
                if reached >= len(text):
                    break
                pieces.append(piece)
                reached += len(piece)
            # A pre-token begins at the region's end, as before, after text that is as before.
            if not context or reached == len(text) > touched:
                break
            while region[-1].after:
                region.append(region[-1].after)
                text += region[-1].text
                if region[-1].text:
                    break
        self.encoded += len(text)
        self._replace(region, _leaves(pieces, ids))

    def _replace(self, region: list[Node], leaves: list[tuple[str, int]]) -> None:
        """Fill the region's leaves anew; what doesn't fit goes below its last one."""
        if len(leaves) < len(region):
            leaves = leaves + [("", 0)] * (len(region) - len(leaves))
        for node, (text, tokens) in zip(region[:-1], leaves):
            self._set(node, text, tokens)
        last, rest = region[-1], leaves[len(region) - 1 :]
        if len(rest) == 1:
            self._set(last, *rest[0])
            return
        nodes = [Node(*leaf) for leaf in rest]
        for a, b in zip([last.before, *nodes], [*nodes, last.after]):
            if a:
                a.after = b
            if b:
                b.before = a
        if self.first is last:
            self.first = nodes[0]
        top = _joined(nodes)
        chars, tokens = top.chars - last.chars, top.tokens - last.tokens
        top.above = last.above
        if not last.above:
            self.root = top
        elif last.above.left is last:
            last.above.left = top
        else:
            last.above.right = top
        self._add(top.above, chars, tokens)

    def _set(self, node: Node, text: str, tokens: int) -> None:
        chars, more = len(text) - node.chars, tokens - node.tokens
        node.text = text
        self._add(node, chars, more)

    @staticmethod
    def _add(node: Node | None, chars: int, tokens: int) -> None:
        while node:
            node.chars += chars
            node.tokens += tokens
            node = node.above


def _sums(pieces: list[str], ids: Encoder) -> tuple[np.ndarray, np.ndarray]:
    """Characters and tokens of the leaves that the pre-tokens fill."""
    found = list(map(ids.known.get, pieces))
    if None in found:
        ids.learn([p for p, f in zip(pieces, found) if f is None])
        found = [ids.known[p] if f is None else f for p, f in zip(pieces, found)]
    cuts = np.arange(0, len(pieces), LEAF)
    if not len(cuts):
        return cuts, cuts
    chars = np.fromiter(map(len, pieces), np.int64, len(pieces))
    size = np.fromiter(map(len, found), np.int64, len(pieces))
    return np.add.reduceat(chars, cuts), np.add.reduceat(size, cuts) // 4


def _leaves(pieces: list[str], ids: Encoder) -> list[tuple[str, int]]:
    _, tokens = _sums(pieces, ids)
    return [("".join(pieces[k * LEAF : (k + 1) * LEAF]), n) for k, n in enumerate(tokens.tolist())]


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    bounds = np.cumsum([0, *map(len, arrays)])
    values = np.concatenate([np.zeros(0, np.int64), *arrays]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values))


TREE = "leaf_chars array<int>, leaf_tokens array<int>"


def build(docs: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id, text, leaf_chars, leaf_tokens, n_tokens: the trees' leaves, to keep and to edit.

    ``tokenizer`` is the content of a tokenizer file. A null text counts as
    empty: no leaves, 0 tokens. Texts whose pre-tokens can't be told for sure
    are one leaf, encoded whole at every edit. Rows are taken one by one, so
    equal and null ids do no harm; other columns are left out.
    """
    shared = docs.sparkSession.sparkContext.broadcast(tokenizer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with encoder(shared.value) as ids:
            for part in (b.slice(low, ROWS) for b in batches for low in range(0, b.num_rows, ROWS)):
                sums = []
                for text in part["text"].to_pylist():
                    if ids.exact_by_piece(text):
                        sums.append(_sums(PIECE.findall(text), ids))
                    else:
                        sums.append((np.array([len(text)]), np.array([len(ids.encode([text])[0]) // 4])))
                yield pa.record_batch(
                    {
                        "doc_id": part["doc_id"],
                        "text": part["text"],
                        "leaf_chars": _lists([c for c, _ in sums]),
                        "leaf_tokens": _lists([n for _, n in sums]),
                        "n_tokens": pa.array([int(n.sum()) for _, n in sums], pa.int64()),
                    }
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return small_batches(docs).select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(
        run, f"doc_id {kind}, text string, {TREE}, n_tokens long"
    )


def edited(trees: DataFrame, tokenizer: str, edits: str = "edits") -> DataFrame:
    """Trees after their edits, and ``encoded``: the characters that were encoded again.

    ``trees`` has the columns that ``build`` gives and an array of (at, deleted,
    inserted) per row, applied one after the other; ``at`` counts characters of
    the text as the edit finds it. Places outside the text are moved to its
    ends, null numbers are 0, null texts are empty; a null array changes nothing.
    """
    shared = trees.sparkSession.sparkContext.broadcast(tokenizer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with encoder(shared.value) as ids:
            for part in (b.slice(low, ROWS) for b in batches for low in range(0, b.num_rows, ROWS)):
                done = [_edited(row, ids) for row in part.to_pylist()]
                texts, leaves, encoded = zip(*done)
                yield pa.record_batch(
                    {
                        "doc_id": part["doc_id"], "text": pa.array(texts, pa.string()),
                        "leaf_chars": pa.array([[c for c, _ in x] for x in leaves], pa.list_(pa.int32())),
                        "leaf_tokens": pa.array([[n for _, n in x] for x in leaves], pa.list_(pa.int32())),
                        "n_tokens_before": part["n_tokens"],
                        "n_tokens": pa.array([sum(n for _, n in x) for x in leaves], pa.int64()),
                        "encoded": pa.array(encoded, pa.int64()),
                    }
                )

    kind = trees.schema["doc_id"].dataType.simpleString()
    return small_batches(trees).select(
        "doc_id", "text", "leaf_chars", "leaf_tokens", "n_tokens", F.col(edits).alias("edits")
    ).mapInArrow(run, f"doc_id {kind}, text string, {TREE}, n_tokens_before long, n_tokens long, encoded long")


def _edited(row: dict, ids: Encoder) -> tuple[str, list[tuple[int, int]], int]:
    text, changes = row["text"] or "", row["edits"] or []
    changes = [(e["at"] or 0, e["deleted"] or 0, e["inserted"] or "") for e in changes if e]
    if not all(map(ids.exact_by_piece, [text, *(c[2] for c in changes)])):
        for at, deleted, inserted in changes:
            at = max(0, min(at, len(text)))
            text = text[:at] + inserted + text[at + max(0, deleted) :]
        return text, [(len(text), len(ids.encode([text])[0]) // 4)], len(text)
    leaves, begin = [], 0
    for chars, tokens in zip(row["leaf_chars"], row["leaf_tokens"]):
        leaves.append((text[begin : begin + chars], tokens))
        begin += chars
    tree = Tree(leaves)
    for change in changes:
        tree.edit(*change, ids)
    kept = [n for n in tree.leaves() if n.chars]
    return "".join(n.text for n in kept), [(n.chars, n.tokens) for n in kept], tree.encoded
