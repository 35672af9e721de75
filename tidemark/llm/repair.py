"""Conversation structure repair by alignment to a grammar of roles.

A conversation's rows, in order, are aligned to the strings ``(s?(ua)+)?`` of role
initials at the least cost: keep, rerole, delete, insert. The alternating string
of any length ends like any longer one, so one Wagner-Fischer table over (rows
left, symbols left) holds the alignments to every feasible length; a system row
that is kept leads into it. Its band follows Ukkonen: a quick repair gives the
incumbent cost, and a cell counts only if what the rows before it and behind it
cost at least does not exceed that. Of all cheapest alignments, of whatever
length, the one with the least audit (the initials of its edits) is traced back.

Rows are sorted and compared by Spark. The alignment sees one byte per row, and
texts stream past their conversation's audit, so a long conversation is never
held with its texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import small_batches, stored

REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
SPACES = " \t\n\x0b\x0c\r"
# Faults, in a row's code above its kind: the first that holds counts.
SOUND, BLANK, DUPLICATE, CUT = range(4)
USER, ASSISTANT, SYSTEM, OTHER = range(4)
LEGAL = {(SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER)}
NAMES = ("user", "assistant")
# Conversations of up to this many rows are remembered by their codes, so many at a time.
SHORT, REMEMBERED = 64, 50_000
NEVER = 1 << 40
ROWS = 2048


def placed(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, position (from 1) and code (kind + 4 * fault) of every row.

    Rows are ordered by turn (null first), role and text; a null role or text is one space.
    """
    space = F.lit(" ")
    rows = turns.select(
        "conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text")
    )
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    same = Window.partitionBy("conv_id", "role", "text").orderBy("position")
    last = F.right(F.rtrim("text", F.lit(SPACES)), F.lit(1))
    fault = (
        F.when(last == "", BLANK)
        .when(F.row_number().over(same) > 1, DUPLICATE)
        .when(~last.isin(".", "!", "?"), CUT)
        .otherwise(SOUND)
    )
    first = F.left("role", F.lit(1))
    kind = F.when(first == "u", USER).when(first == "a", ASSISTANT).when(first == "s", SYSTEM).otherwise(OTHER)
    ordered = rows.withColumn("position", F.row_number().over(order).cast("long"))
    return ordered.withColumn("code", (kind + 4 * fault).cast("int"))


def _incumbent(kind: list[int], fault: list[int]) -> int:
    """Cost of a repair that inserts what is missing between kept rows, or reroles in place, or deletes all."""
    n = len(kind)
    forced = sum(f in (BLANK, DUPLICATE) for f in fault)
    live = [k for k, f in zip(kind, fault) if f not in (BLANK, DUPLICATE)]
    base = DELETE * forced + TRUNCATED * sum(f == CUT for f in fault)
    if live and live[0] == SYSTEM and len(live) > 1:
        live = live[1:]
    extra, wanted, rerole = 0, USER, 0
    for at, k in enumerate(live):
        if k > ASSISTANT:
            extra += REROLE
        elif k != wanted:
            extra += INSERT
            wanted = k
        wanted = 1 - wanted
        rerole += REROLE * (k != at % 2)
    extra += INSERT * (wanted == ASSISTANT)
    rerole += INSERT * (len(live) % 2)
    return min(base + min(extra, rerole) if live else NEVER, DELETE * n)


class _Table:
    """Least costs of aligning rows i.. with the alternating string of l symbols that ends in an assistant turn."""

    def __init__(self, kind: np.ndarray, fault: np.ndarray, incumbent: int):
        self.n = n = len(kind)
        self.kind, self.cut = kind.tolist(), (fault == CUT).tolist()
        forced = (fault == BLANK) | (fault == DUPLICATE)
        self.forced = forced.tolist()
        behind = lambda flags: np.concatenate([np.cumsum(flags[::-1])[::-1], [0]])
        live, cut = behind(~forced), behind(fault == CUT)
        slack = max(0, incumbent - DELETE * int(forced.sum()) - TRUNCATED * int((fault == CUT).sum()))
        # A truncated row costs one more to delete than to keep.
        fewer = np.where(slack <= cut, slack, cut + (slack - np.minimum(cut, slack)) // DELETE)
        self.low = np.maximum(0, live - fewer).tolist()
        self.high = (live + slack // INSERT).tolist()
        # Rows are kept at the ends of blocks and worked out again within a block.
        self.step = n + 1 if n <= 512 else isqrt(n) + 1
        self.ends = {n: np.arange(self.low[n], self.high[n] + 1, dtype=np.int64) * INSERT}
        self.block, self.rows = None, {}
        self._system()

    def _taken(self, i: int, l: np.ndarray) -> np.ndarray:
        """Cost of row i as the symbol that begins a string of l: user where l is even."""
        if self.forced[i]:
            return np.full(len(l), NEVER)
        return TRUNCATED * self.cut[i] + np.where(l % 2 == self.kind[i], 0, REROLE)

    def _cut_out(self, i: int, row: np.ndarray, low: int, high: int) -> np.ndarray:
        """Values of row i for low..high, NEVER outside its band."""
        out = np.full(high - low + 1, NEVER)
        a, b = max(low, self.low[i]), min(high, self.high[i])
        if a <= b:
            out[a - low : b - low + 1] = row[a - self.low[i] : b - self.low[i] + 1]
        return out

    def _before(self, i: int, following: np.ndarray) -> np.ndarray:
        low, high = self.low[i], self.high[i]
        l = np.arange(low, high + 1)
        taken = self._cut_out(i + 1, following, low - 1, high - 1) + self._taken(i, l)
        row = np.minimum(self._cut_out(i + 1, following, low, high) + DELETE, np.where(l > 0, taken, NEVER))
        # Insertions add up along the row.
        return np.minimum(np.minimum.accumulate(row - INSERT * l) + INSERT * l, NEVER)

    def _system(self) -> None:
        """Fills ``ends``, and ``waiting[i]``: the cost from row i on while a system row is still to be kept."""
        self.waiting = [NEVER] * (self.n + 1)
        row = self.ends[self.n]
        for i in range(self.n - 1, -1, -1):
            here = NEVER
            if self.kind[i] == SYSTEM and not self.forced[i]:
                here = TRUNCATED * self.cut[i] + self._least_pairs(i + 1, row)
            self.waiting[i] = min(here, self.waiting[i + 1] + DELETE)
            row = self._before(i, row)
            if i % self.step == 0:
                self.ends[i] = row
            if self.step > self.n:
                self.rows[i] = row
        self.rows[self.n] = self.ends[self.n]

    def _least_pairs(self, i: int, row: np.ndarray) -> int:
        """Least cost over all strings of at least one pair."""
        l = np.arange(self.low[i], self.high[i] + 1)
        return int(np.where((l > 0) & (l % 2 == 0), row, NEVER).min(initial=NEVER))

    def row(self, i: int) -> np.ndarray:
        if self.step <= self.n and i not in self.rows:
            first = i - i % self.step
            last = min(first + self.step, self.n)
            self.rows = {last: self.ends[last]}
            for k in range(last - 1, first - 1, -1):
                self.rows[k] = self._before(k, self.rows[k + 1])
        return self.rows[i]

    def pair(self, i: int) -> tuple[np.ndarray, np.ndarray | None]:
        """Rows i and i + 1, the second one cut to the band of the first, from one symbol less on."""
        here = self.row(i)
        if i == self.n:
            return here, None
        low, high = self.low[i], self.high[i]
        return here, self._cut_out(i + 1, self.row(i + 1), low - 1, high)


def align(codes: bytes) -> tuple[int, str]:
    """Least cost and the least audit of cost; ``codes`` are those of the rows in order."""
    code = np.frombuffer(codes, np.uint8).astype(np.int64)
    kind, fault = code % 4, code // 4
    table = _Table(kind, fault, _incumbent(kind.tolist(), fault.tolist()))
    start = table.row(0)
    l = np.arange(table.low[0], table.high[0] + 1)
    feasible = np.where(l % 2 == 0, start, NEVER)
    cost = min(int(feasible.min(initial=NEVER)), table.waiting[0])
    # The strings that are still open: all have the same edits behind them, so the same i.
    open_, waits = l[feasible == cost], table.waiting[0] == cost
    audit, i = [], 0
    while i < table.n or (len(open_) and open_[0] > 0):
        here, below = table.pair(i)
        low = table.low[i]
        value = here[open_ - low]
        if i < table.n:
            deleted = open_[below[open_ - low + 1] + DELETE == value]
            waits_on = waits and table.waiting[i + 1] + DELETE == table.waiting[i]
            if len(deleted) or waits_on:
                audit.append("D")
                open_, waits, i = deleted, waits_on, i + 1
                continue
        shorter = np.where(open_ - 1 >= low, here[np.maximum(open_ - 1 - low, 0)], NEVER)
        inserted = open_[(open_ > 0) & (shorter + INSERT == value)]
        if len(inserted):
            audit.append("I")
            open_, waits = inserted - 1, False
            continue
        took = open_[(open_ > 0) & (below[open_ - low] + table._taken(i, open_) == value)]
        kept = took[took % 2 == kind[i]] - 1
        if waits and kind[i] == SYSTEM and not table.forced[i]:
            left = table.waiting[i] - TRUNCATED * table.cut[i]
            pairs = np.arange(table.low[i + 1], table.high[i + 1] + 1)
            led = pairs[(pairs > 0) & (pairs % 2 == 0) & (table.row(i + 1) == left)]
            kept = np.union1d(kept, led)
        if len(kept):
            audit.append("K")
            open_ = kept
        else:
            audit.append("R")
            open_ = took - 1
        waits, i = False, i + 1
    return cost, "".join(audit)


_remembered = lru_cache(REMEMBERED)(align)


def _told(conv, codes: bytearray, turns: tuple) -> dict:
    least, most, distinct = turns
    kinds = [c % 4 for c in codes]
    faults = [c // 4 for c in codes]
    cost, audit = (_remembered if len(codes) <= SHORT else align)(bytes(codes))
    return {
        "conv_id": conv,
        "gaps": 0 if least is None else min(most - least + 1 - distinct, 2**63 - 1),
        "blank": faults.count(BLANK),
        "duplicate": faults.count(DUPLICATE),
        "truncated": faults.count(CUT),
        "illegal": sum(pair not in LEGAL for pair in zip(kinds, kinds[1:])),
        "cost": cost,
        "audit": audit,
    }


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def audits(rows: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost and audit of each conversation of ``placed`` rows."""
    kind = rows.schema["conv_id"].dataType
    schema = T.StructType([T.StructField("conv_id", kind)])
    for c in COUNTS:
        schema = schema.add(c, "long")
    schema = schema.add("audit", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields, done = None, []
        conv, codes, turns = None, bytearray(), (None, None, 0)
        for batch in batches:
            fields = pa.schema([batch.schema.field("conv_id"), *[(c, pa.int64()) for c in COUNTS], ("audit", pa.string())])
            columns = (batch[c].to_pylist() for c in ("conv_id", "position", "turn", "code"))
            for of, position, turn, code in zip(*columns):
                if position == 1:
                    if codes:
                        done.append(_told(conv, codes, turns))
                    conv, codes, turns = of, bytearray(), (None, None, 0)
                codes.append(code)
                if turn is not None:
                    least, most, distinct = turns
                    # Turns come in order.
                    turns = (turn if least is None else least, turn, distinct + (turn != most))
            if len(done) >= ROWS:
                yield pa.RecordBatch.from_pylist(done, fields)
                done = []
        if codes:
            done.append(_told(conv, codes, turns))
        if done:
            yield pa.RecordBatch.from_pylist(done, fields)

    # A number of parts, for rows are a few bytes and their alignment is what costs: few large parts would be slow.
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.select("conv_id", "position", "turn", "code").repartition(parts, "conv_id")
    return ordered.sortWithinPartitions("conv_id", "position").mapInArrow(run, schema)


def _repaired(batches: Iterator[pa.RecordBatch]):
    """(conv_id, role, text, edit) of what stays, conversation by conversation, and (conv_id, None, None, None) first.

    The rows of a conversation follow its audit, which has position 0.
    """
    letters, conv, symbols, led = iter(""), None, 0, False

    def turn():
        nonlocal symbols
        symbols += 1
        return NAMES[(symbols - 1 - led) % 2]

    for batch in batches:
        columns = (batch[c].to_pylist() for c in ("conv_id", "position", "role", "text"))
        for of, position, role, text in zip(*columns):
            if position == 0:
                for _ in letters:
                    yield conv, turn(), "", "I"
                conv, letters, symbols, led = of, iter(text), 0, False
                yield conv, None, None, None
                continue
            for letter in letters:
                if letter != "I":
                    break
                yield conv, turn(), "", "I"
            if letter == "K":
                led = led or (symbols == 0 and role[:1] == "s")
                symbols += 1
                yield conv, role, text, "K"
            elif letter == "R":
                yield conv, turn(), text, "R"
    for _ in letters:
        yield conv, turn(), "", "I"


def _met(rows: DataFrame, told: DataFrame) -> DataFrame:
    """Each conversation's audit and behind it its rows, in order."""
    first = told.select("conv_id", F.lit(0).cast("long").alias("position"), F.lit("").alias("role"), F.col("audit").alias("text"))
    both = first.unionByName(small_batches(rows).select("conv_id", "position", "role", "text"))
    return both.repartition("conv_id").sortWithinPartitions("conv_id", "position")


def repaired(rows: DataFrame, told: DataFrame) -> DataFrame:
    """conv_id, place (from 1), role, text and edit (K, R or I) of every row of the repaired conversations."""
    kind = rows.schema["conv_id"].dataType
    schema = T.StructType([T.StructField("conv_id", kind)]).add("place", "long")
    for c in ("role", "text", "edit"):
        schema = schema.add(c, "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = None

        def seen():
            nonlocal fields
            for batch in batches:
                fields = fields or pa.schema(
                    [batch.schema.field("conv_id"), ("place", pa.int64()), *[(c, pa.string()) for c in ("role", "text", "edit")]]
                )
                yield batch

        done, place = [], 0
        for conv, role, text, edit in _repaired(seen()):
            place = 0 if edit is None else place + 1
            if edit:
                done.append({"conv_id": conv, "place": place, "role": role, "text": text, "edit": edit})
            if len(done) >= ROWS:
                yield pa.RecordBatch.from_pylist(done, fields)
                done = []
        if done:
            yield pa.RecordBatch.from_pylist(done, fields)

    return _met(rows, told).mapInArrow(run, schema)


def digests(rows: DataFrame, told: DataFrame) -> DataFrame:
    """conv_id and repaired_sha256, of the repaired rows as ``role:text``, newlines between; texts are hashed as they stream."""
    kind = rows.schema["conv_id"].dataType
    schema = T.StructType([T.StructField("conv_id", kind)]).add("repaired_sha256", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields, done = None, []

        def seen():
            nonlocal fields
            for batch in batches:
                fields = fields or pa.schema([batch.schema.field("conv_id"), ("repaired_sha256", pa.string())])
                yield batch

        conv, digest, between = None, None, b""
        for of, role, text, edit in _repaired(seen()):
            if edit is None:
                if digest:
                    done.append({"conv_id": conv, "repaired_sha256": digest.hexdigest()})
                conv, digest, between = of, hashlib.sha256(), b""
            else:
                digest.update(between + f"{role}:{text}".encode())
                between = b"\n"
            if len(done) >= ROWS:
                yield pa.RecordBatch.from_pylist(done, fields)
                done = []
        if digest:
            done.append({"conv_id": conv, "repaired_sha256": digest.hexdigest()})
            yield pa.RecordBatch.from_pylist(done, fields)

    return _met(rows, told).mapInArrow(run, schema)


def repair(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The placed rows of (conv_id, turn, role, text) and their conversations' audits, both stored.

    Blank, duplicate and truncated rows, the edits and their costs are as the
    module says. Rows without conv_id are one conversation, rows without turn
    come first in theirs, a null role or text is one space, and a role that
    begins with none of s, u, a can only be reroled or deleted. Rows that are
    alike in everything follow each other. Other columns are not read; an empty
    table has no conversations. The longest conversation bounds what a task
    holds, with one byte a row and the band's width times the root of its rows.
    """
    rows = stored(placed(turns), "placed-turns")
    return rows, stored(audits(rows), "audits")


def summary(turns: DataFrame) -> DataFrame:
    """The audit of each conversation with ``repaired_sha256``."""
    rows, told = repair(turns)
    hashed = digests(rows, told).withColumnRenamed("conv_id", "_conv")
    return told.join(hashed, F.col("conv_id").eqNullSafe(F.col("_conv"))).drop("_conv")
