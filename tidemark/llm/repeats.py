"""Removal of byte strings that documents with smaller ids hold, by sorted suffixes.

Only text that can be repeated is sorted. Every window of ``WIDTH`` bytes has an
anchor, the ``GRAM`` bytes in it with the smallest hash, at the same place
wherever the window occurs. So a window of two documents has an anchor of two
documents, and all its occurrences meet under that anchor. Documents are dealt
to blocks of bounded size:

1. Blocks send the hashes of their anchors to buckets; buckets report those
   that came from several blocks.
2. Blocks send the text around these anchors (once for equal text, with the
   smallest and largest id) to buckets. Buckets sort its suffixes in two
   stages, find equal windows by adjacent common prefixes and report, for each
   text, from which smaller ids its windows come.
3. Blocks remove what windows of smaller ids cover.

A block sends one row to a bucket, so a passage of a third of all documents is
at most as many rows as there are blocks. All three steps read one exchange of
the texts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import total_bytes
from tidemark.llm.hashing import BASE, mixed
from tidemark.llm.suffix import least_of_equal

WIDTH, GRAM = 50, 16
BLOCK_BYTES = 4 << 20
SLICE = 1 << 17
_LOW40 = np.uint64((1 << 40) - 1)
_LOW24 = np.uint64((1 << 24) - 1)
_NULL = -(2**63)


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hashes of the 16 bytes from every place on that has as many."""
    value = (data.astype(np.uint64) + np.uint64(1)) * np.uint64(BASE)
    for step in (1, 2, 4, 8):
        value = value[:-step] * np.uint64(pow(BASE, 2 * step + 1, 2**64)) + value[step:]
    return mixed(value)


class Block:
    """Documents of a block: their anchors, and the windows that belong to each anchor.

    For anchor k: ``hash[k]``, and windows begin at ``first[k]`` to ``last[k]``
    of ``data``, in document ``doc[k]``.
    """

    def __init__(self, table: pa.Table):
        rows = sorted(zip(table["rank"].to_pylist(), table["data"].to_pylist()))
        self.ranks = np.array([r for r, _ in rows], np.int64)
        self.texts = [t or b"" for _, t in rows]
        self.data = np.frombuffer(b"".join(self.texts), np.uint8)
        self.ends = np.cumsum([len(t) for t in self.texts])
        self.begins = np.concatenate([[0], self.ends[:-1]])
        valid = np.ones(len(self.data), bool)
        for begin, end in zip(self.begins, self.ends):
            valid[max(begin, end - WIDTH + 1) : end] = False
        reach = WIDTH - GRAM
        parts = []
        for low in range(0, len(self.data), SLICE):
            data = self.data[low : low + SLICE + WIDTH - 1]
            places = np.flatnonzero(valid[low : min(low + SLICE, len(self.data) - WIDTH + 1)])
            if not len(places):
                continue
            value = _gram_hashes(data)
            least = (value & ~_LOW24) | np.arange(len(value), dtype=np.uint64)
            span = 1
            while 2 * span <= reach + 1:
                least = np.minimum(least[:-span], least[span:])
                span *= 2
            rest = reach + 1 - span
            if rest:
                least = np.minimum(least[:-rest], least[rest:])
            anchor = (least[places] & _LOW24).astype(np.int64)
            fresh = np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (np.diff(places) > 1)])
            start = np.flatnonzero(fresh)
            stop = np.append(start[1:], len(places)) - 1
            parts.append((value[anchor[start]], places[start] + low, places[stop] + low))
        self.hash, self.first, self.last = (
            [np.concatenate(c) for c in zip(*parts)] if parts
            else [np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)]
        )
        self.doc = np.searchsorted(self.ends, self.first, "right")

    def anchors(self, buckets: int) -> list[tuple[int, np.ndarray]]:
        """Distinct anchor hashes by bucket, sorted."""
        found = np.unique(self.hash)
        bucket = _bucket(found, buckets)
        order = np.argsort(bucket, kind="stable")
        return _runs(bucket[order], found[order])

    def repeated(self, reported: list[np.ndarray]) -> None:
        """Keep the anchors that are reported or belong to several documents of the block."""
        values, where = np.unique(self.hash, return_inverse=True)
        rank = self.ranks[self.doc]
        low, high = np.full(len(values), 2**63 - 1), np.full(len(values), -(2**63))
        np.minimum.at(low, where, rank)
        np.maximum.at(high, where, rank)
        several = low < high
        several[np.searchsorted(values, np.concatenate([values[:0], *reported]))] = True
        keep = several[where]
        self.hash, self.first, self.last, self.doc = (
            c[keep] for c in (self.hash, self.first, self.last, self.doc)
        )

    def contexts(self, buckets: int):
        """Distinct texts around the anchors: bucket, first and end place, ranks; and each anchor's one."""
        end = self.last + WIDTH
        code = np.zeros((2, len(self.first)), np.uint64)
        for k, factor in enumerate((BASE, 0xD1342543DE82EF95)):
            for low in range(0, len(self.first), 1 << 16):
                part = slice(low, low + (1 << 16))
                code[k, part] = self._codes(self.first[part], end[part], factor)
        bucket = _bucket(self.hash, buckets)
        order = np.lexsort((code[1], code[0], self.hash, bucket))
        same = np.zeros(len(order), bool)
        for c in (bucket, self.hash, code[0], code[1]):
            same[1:] |= c[order][1:] != c[order][:-1]
        same[:1] = True
        number = np.cumsum(same) - 1
        mine = np.empty(len(order), np.int64)
        mine[order] = number
        start = order[same]
        rank = self.ranks[self.doc]
        low, high = np.full(len(start), 2**63 - 1), np.full(len(start), -(2**63))
        np.minimum.at(low, mine, rank)
        np.maximum.at(high, mine, rank)
        return bucket[start], self.first[start], end[start], low, high, mine

    def _codes(self, first: np.ndarray, end: np.ndarray, factor: int) -> np.ndarray:
        """A hash of the bytes of each range; ranges in ascending order, of at most some dozens of bytes."""
        code = (end - first).astype(np.uint64)
        length = end - first
        for k in range(0, int(length.max(initial=0)), 8):
            at = np.minimum(first + k, len(self.words) - 1)
            left = np.clip(length - k, 0, 8)
            shift = (8 * (8 - left)).astype(np.uint64)
            some = np.where(left > 0, self.words[at] >> np.minimum(shift, np.uint64(63)), np.uint64(0))
            code = mixed(code * np.uint64(factor) + some)
        return code

    @property
    def words(self) -> np.ndarray:
        if not hasattr(self, "_words"):
            from tidemark.llm.suffix import packed

            self._words = packed(self.data)
        return self._words


def _bucket(value: np.ndarray, buckets: int) -> np.ndarray:
    return ((value >> np.uint64(40)) % np.uint64(buckets)).astype(np.int32)


def _runs(keys: np.ndarray, *columns: np.ndarray):
    """(key, the columns' parts) for every run of equal keys."""
    start = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else keys
    for a, b in zip(start, np.append(start[1:], len(keys))):
        yield (int(keys[a]), *(c[a:b] for c in columns))


def _squeezed(data: bytes) -> bytes:
    return len(data).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True)


def _opened(data: bytes) -> bytes:
    return pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True)


def _send_anchors(buckets: int):
    def run(table: pa.Table) -> pa.Table:
        rows = [
            (bucket, found.view(np.uint8).reshape(-1, 8)[:, :5].tobytes())
            for bucket, found in Block(table).anchors(buckets)
        ]
        return pa.table(
            {
                "bucket": pa.array([b for b, _ in rows], pa.int32()),
                "block": pa.array([table["block"][0].as_py()] * len(rows), pa.int32()),
                "anchors": pa.array([d for _, d in rows], pa.binary()),
            }
        )

    return run


def _report_anchors(table: pa.Table) -> pa.Table:
    """Which anchors of each block other blocks have too, as bits."""
    sent = [np.frombuffer(d, np.uint8).reshape(-1, 5) for d in table["anchors"].to_pylist()]
    wide = np.zeros((sum(map(len, sent)), 8), np.uint8)
    wide[:, :5] = np.concatenate(sent)
    value = wide.view(np.uint64).ravel()
    _, where, often = np.unique(value, return_inverse=True, return_counts=True)
    several = often[where] > 1
    cuts = np.cumsum([len(s) for s in sent])[:-1]
    bits = [np.packbits(p).tobytes() for p in np.split(several, cuts)]
    return pa.table({"bucket": table["bucket"], "block": table["block"], "bits": pa.array(bits, pa.binary())})


def _repeated(block: Block, reports: pa.Table, buckets: int) -> None:
    bits = dict(zip(reports["bucket"].to_pylist(), reports["bits"].to_pylist()))
    block.repeated(
        [
            found[np.unpackbits(np.frombuffer(bits[bucket], np.uint8), count=len(found)).astype(bool)]
            for bucket, found in block.anchors(buckets)
            if bucket in bits
        ]
    )


def _send_contexts(buckets: int):
    def run(table: pa.Table, reports: pa.Table) -> pa.Table:
        if not table.num_rows:
            return pa.table({c: pa.array([], t) for c, t in _CONTEXTS.items()})
        block = Block(table)
        _repeated(block, reports, buckets)
        bucket, first, end, low, high, _ = block.contexts(buckets)
        rows = []
        data = block.data.tobytes()
        for b, a, z, x, y in _runs(bucket, first, end, low, high):
            text = b"".join(data[i : j + 1] if j < len(data) else data[i:j] + b"\0" for i, j in zip(a, z))
            rows.append((b, _squeezed(text), (z - a).astype(np.uint8).tobytes(), _squeezed(x.tobytes() + y.tobytes())))
        columns = list(zip(*rows)) or [[]] * 4
        return pa.table(
            {
                "bucket": pa.array(columns[0], pa.int32()),
                "block": pa.array([table["block"][0].as_py()] * len(rows), pa.int32()),
                "texts": pa.array(columns[1], pa.binary()),
                "lengths": pa.array(columns[2], pa.binary()),
                "ranks": pa.array(columns[3], pa.binary()),
            }
        )

    return run


_CONTEXTS = {
    "bucket": pa.int32(), "block": pa.int32(), "texts": pa.binary(), "lengths": pa.binary(), "ranks": pa.binary(),
}


def _report_windows(table: pa.Table) -> pa.Table:
    """Per block: for its texts, runs of windows with the smallest id that has them."""
    data = np.frombuffer(b"".join(map(_opened, table["texts"].to_pylist())), np.uint8)
    each = [np.frombuffer(d, np.uint8).astype(np.int64) for d in table["lengths"].to_pylist()]
    lengths = np.concatenate(each)
    ranks = [np.frombuffer(_opened(d), np.int64).reshape(2, -1) for d in table["ranks"].to_pylist()]
    low, high = np.concatenate(ranks, axis=1)
    begins = np.cumsum(lengths + 1) - lengths - 1
    # Equal texts are sorted once.
    raw = data.tobytes()
    place: dict[bytes, int] = {}
    one = np.array([place.setdefault(raw[a : a + n], len(place)) for a, n in zip(begins.tolist(), lengths.tolist())])
    least = np.full(len(place), 2**63 - 1)
    np.minimum.at(least, one, low)
    first = np.full(len(place), len(one))
    np.minimum.at(first, one, np.arange(len(one)))
    distinct = np.frombuffer(b"\0".join([*place, b""]), np.uint8)
    size = lengths[first]
    found = least_of_equal(distinct, size, least, WIDTH)
    start = np.cumsum(size + 1) - size - 1
    # Runs of windows with the same smallest id, within each distinct text.
    windows = size - WIDTH + 1
    owner = np.repeat(np.arange(len(size)), windows)
    offset = np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)
    value = found[start[owner] + offset]
    fresh = np.concatenate([[True], (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])])
    at = np.flatnonzero(fresh)
    count = np.diff(np.append(at, len(owner)))
    run_owner, run_offset, run_value = owner[at], offset[at], value[at]
    per = np.bincount(run_owner, minlength=len(size))
    run_first = np.cumsum(per) - per
    # Every text of every block gets the runs that come from smaller ids.
    copies = per[one]
    text = np.repeat(np.arange(len(one)), copies)
    run = np.arange(len(text)) - np.repeat(np.cumsum(copies) - copies, copies) + run_first[one[text]]
    keep = run_value[run] < high[text]
    text, run = text[keep], run[keep]
    rows = []
    bound = np.cumsum([len(e) for e in each])
    for k, (bucket, block) in enumerate(zip(table["bucket"].to_pylist(), table["block"].to_pylist())):
        a, b = np.searchsorted(text, [bound[k] - len(each[k]), bound[k]])
        if a < b:
            own = text[a:b] - (bound[k] - len(each[k]))
            some = run[a:b]
            packed = (own.astype(np.int32), run_value[some], run_offset[some].astype(np.uint8), count[some].astype(np.uint8))
            rows.append((bucket, block, b - a, _squeezed(b"".join(c.tobytes() for c in packed))))
    columns = list(zip(*rows)) or [[]] * 4
    kinds = {"bucket": pa.int32(), "block": pa.int32(), "n": pa.int64(), "runs": pa.binary()}
    return pa.table({c: pa.array(v, t) for (c, t), v in zip(kinds.items(), columns)})


def _remove(buckets: int):
    def run(table: pa.Table, reports: pa.Table) -> pa.Table:
        if not table.num_rows:
            return pa.table({c: pa.array([], t) for c, t in _REMOVED.items()})
        windows = reports.filter(reports["runs"].is_valid())
        block = Block(table)
        _repeated(block, reports.filter(reports["bits"].is_valid()), buckets)
        bucket, _, _, _, _, mine = block.contexts(buckets)
        cover = np.zeros(len(block.data) + 1, np.int32)
        base = np.searchsorted(bucket, np.arange(buckets))
        order = np.argsort(mine, kind="stable")
        numbers = mine[order]
        rank = block.ranks[block.doc]
        for b, n, data in zip(*(windows[c].to_pylist() for c in ("bucket", "n", "runs"))):
            data = _opened(data)
            own = np.frombuffer(data, np.int32, n) + base[b]
            least = np.frombuffer(data, np.int64, n, 4 * n)
            offset, count = np.frombuffer(data, np.uint8, n, 12 * n), np.frombuffer(data, np.uint8, n, 13 * n)
            low, high = np.searchsorted(numbers, own), np.searchsorted(numbers, own, "right")
            copies = high - low
            k = np.repeat(np.arange(n), copies)
            anchor = order[np.arange(len(k)) - np.repeat(np.cumsum(copies) - copies, copies) + low[k]]
            later = least[k] < rank[anchor]
            k, begin = k[later], block.first[anchor[later]] + offset[k[later]]
            np.add.at(cover, begin, 1)
            np.add.at(cover, begin + count[k] + (WIDTH - 1), -1)
        removed = np.cumsum(cover[:-1]) > 0
        opens = removed.copy()
        opens[1:] &= ~removed[:-1]
        inner = block.begins[block.begins < len(removed)]
        opens[inner] = removed[inner]
        many, spans = (np.concatenate([[0], np.cumsum(x)]) for x in (removed, opens))
        n_removed, n_spans = many[block.ends] - many[block.begins], spans[block.ends] - spans[block.begins]
        kept = [
            text if not n else block.data[a:b][~removed[a:b]].tobytes()
            for text, n, a, b in zip(block.texts, n_removed, block.begins, block.ends)
        ]
        columns = (block.ranks, block.ends - block.begins, n_removed, n_spans, kept)
        return pa.table({c: pa.array(v, t) for (c, t), v in zip(_REMOVED.items(), columns)})

    return run


_REMOVED = {
    "rank": pa.int64(), "n_bytes": pa.int64(), "n_removed": pa.int64(), "n_spans": pa.int64(), "kept": pa.binary(),
}


def without_repeats(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept for every row of ``docs``.

    Texts are UTF-8 bytes; null is empty. Every byte that lies in a string of
    ``WIDTH`` bytes which also begins in a document with a smaller doc_id is
    removed, judged on the texts as they came; strings do not cross documents.
    ``n_spans`` counts maximal removed runs, ``kept`` holds the remaining bytes
    in order. Strings that only repeat within a document, or between rows with
    one doc_id, stay; a row without doc_id counts as smaller than all others.
    Only doc_id and text are read.
    """
    count = max(1, -(-total_bytes(docs, "text") // (2 * block_bytes)))
    buckets = 2 * count
    rank = F.coalesce(F.col("doc_id").cast("long"), F.lit(_NULL))
    block = F.pmod(F.xxhash64("doc_id", F.length("text")), F.lit(buckets)).cast("int")
    blocks = docs.select(
        rank.alias("rank"), F.coalesce("text", F.lit("")).cast("binary").alias("data"), block.alias("block")
    ).repartition(count, "block")

    def dealt(df, key):
        return df.repartition(count, key)

    anchors = dealt(
        blocks.groupBy("block").applyInArrow(_send_anchors(buckets), "bucket int, block int, anchors binary"), "bucket"
    )
    reported = anchors.groupBy("bucket").applyInArrow(_report_anchors, "bucket int, block int, bits binary")
    reported = dealt(reported, "block")
    contexts = dealt(
        blocks.groupBy("block")
        .cogroup(reported.groupBy("block"))
        .applyInArrow(_send_contexts(buckets), "bucket int, block int, texts binary, lengths binary, ranks binary"),
        "bucket",
    )
    windows = contexts.groupBy("bucket").applyInArrow(
        _report_windows, "bucket int, block int, n long, runs binary"
    )
    nothing = [F.lit(None).cast("long").alias("n"), F.lit(None).cast("binary").alias("runs")]
    both = reported.select("bucket", "block", "bits", *nothing).union(
        windows.select("bucket", "block", F.lit(None).cast("binary").alias("bits"), "n", "runs")
    )
    done = (
        blocks.groupBy("block")
        .cogroup(dealt(both, "block").groupBy("block"))
        .applyInArrow(_remove(buckets), "rank long, n_bytes long, n_removed long, n_spans long, kept binary")
    )
    kind = docs.schema["doc_id"].dataType
    doc_id = F.when(F.col("rank") != _NULL, F.col("rank")).cast(kind).alias("doc_id")
    return done.select(doc_id, "n_bytes", "n_removed", "n_spans", "kept")
