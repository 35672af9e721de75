"""Near duplicates by an LSH forest, links confirmed on whole shingle sets.

Documents with equal sets form a class; classes are what is compared. Every
class has ``TREES`` signatures of ``DEPTH`` MinHash values. A tree is the sorted order
of one signature: classes whose signatures share a long prefix lie next to each
other. Neighbours are candidates if their common prefix is long enough: ``SHORT``
values, and more where the region is dense. Candidates that hang together are
compared, every pair, in tiles of bounded size on their whole sets; a tile
reports a spanning forest of the links it finds. What depth may have parted are
classes of a dense region; where these hang together, as a family of near copies
does, all their pairs have been compared. Where a region holds a family and
strays that hang together with others or none, the strays are compared with all of it. Only where
strays are more than a block, the classes of the region meet again in ``MORE`` trees of their own, where equal
signatures are candidates however many they are, and what is found there is compared as well.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import small_batches, stored
from tidemark.llm.components import components, forest
from tidemark.llm.hashing import BASE, mixed, word_hashes

SHINGLE, SIMILARITY = 5, 0.8
TREES, DEPTH, SHORT = 20, 8, 4
# Trees of dense regions: with TREES, (1 - J ** DEPTH) ** (TREES + MORE) is not above (1 - J ** SHORT) ** TREES from J = 0.8 on.
MORE = 38
# Neighbours this many rows apart with a common prefix make a region dense.
DENSE = 64
# Size of the blocks that tiles compare: sets and shingles.
BLOCK_SETS, BLOCK_SHINGLES = 512, 400_000
ROWS = 512
_RANDOM = np.random.Generator(np.random.PCG64(11))
_FACTORS = _RANDOM.integers(1, 2**63, TREES * DEPTH, np.uint64) | np.uint64(1)
_TERMS = _RANDOM.integers(0, 2**63, TREES * DEPTH, np.uint64)
_MORE_FACTORS = _RANDOM.integers(1, 2**63, MORE * DEPTH, np.uint64) | np.uint64(1)
_MORE_TERMS = _RANDOM.integers(0, 2**63, MORE * DEPTH, np.uint64)


def shingle_sets(texts: list[bytes], width: int = SHINGLE) -> list[np.ndarray]:
    """Sorted hashes of each text's distinct shingles; all words as one if they are fewer than ``width``."""
    codes, counts = word_hashes(texts)
    size = max(0, len(codes) - width + 1)
    value = np.zeros(size, np.uint64)
    for j in range(width):
        value = mixed(value * np.uint64(BASE) + codes[j : j + size])
    sets, begin = [], 0
    for n in counts:
        if n >= width:
            sets.append(np.unique(value[begin : begin + n - width + 1]))
        elif n:
            short = np.array([n], np.uint64)
            for j in range(n):
                short = mixed(short * np.uint64(BASE) + codes[begin + j : begin + j + 1])
            sets.append(short)
        else:
            sets.append(np.zeros(0, np.uint64))
        begin += n
    return sets


def signature(shingles: np.ndarray, factors: np.ndarray = _FACTORS, terms: np.ndarray = _TERMS) -> bytes:
    """16 bits of each MinHash value, big-endian, so that trees sort as bytes."""
    least = np.full(len(factors), np.uint64(2**64 - 1))
    for low in range(0, len(shingles), 4096):
        spread = shingles[low : low + 4096, None] * factors + terms
        least = np.minimum(least, (spread >> np.uint64(20)).min(0))
    return mixed(least).astype(">u2").tobytes()


def _key(shingles: np.ndarray) -> str:
    from xxhash import xxh3_128_hexdigest

    return xxh3_128_hexdigest(shingles.tobytes())


def _parts(batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        for low in range(0, batch.num_rows, ROWS):
            part = batch.slice(low, ROWS)
            yield part, [(t or "").encode() for t in part["text"].to_pylist()]


def sketches(docs: DataFrame, width: int = SHINGLE) -> DataFrame:
    """doc_id, n_shingles, key (of the set, null for an empty one), signature."""

    def run(batches):
        for part, texts in _parts(batches):
            sets = shingle_sets(texts, width)
            yield pa.record_batch(
                {
                    "doc_id": part["doc_id"],
                    "n_shingles": pa.array([len(s) for s in sets], pa.int64()),
                    "key": pa.array([_key(s) if len(s) else None for s in sets], pa.string()),
                    "signature": pa.array([signature(s) if len(s) else None for s in sets], pa.binary()),
                }
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return small_batches(docs).select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n_shingles long, key string, signature binary"
    )


def _prefix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common prefix of rows (tree, value, value, ...), 0 for different trees."""
    same = np.logical_and.accumulate(a == b, axis=1)
    return np.maximum(same.sum(1) - 1, 0)


def _neighbours(short: int):
    """Sorted rows (tree, sorted, key) to links of neighbours, the ends of the partition, and dense regions with their keys.

    Regions that begin or end a partition may be dense in the next one, so they count as dense.
    """

    def out(a, b, region, dense):
        columns = {"a": a, "b": b, "region": region, "dense": dense}
        return pa.record_batch({c: pa.array(v, pa.string()) for c, v in columns.items()})

    def region(row):
        return "-".join(map(str, row[: short + 1]))

    def members(rows, keys):
        first, number = np.unique(rows[:, : short + 1], axis=0, return_inverse=True)
        names = np.array([region(r) for r in first], object)
        none = [None] * len(keys)
        return out(none, none, names[number.ravel()] if len(keys) else none, keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, keys, first = np.zeros((0, DEPTH + 1), np.uint16), np.zeros(0, object), None
        for batch in batches:
            if not batch.num_rows:
                continue
            value = np.frombuffer(b"".join(batch["sorted"].to_pylist()), ">u2").reshape(-1, DEPTH)
            new = np.column_stack([batch["tree"].to_numpy().astype(np.uint16), value.astype(np.uint16)])
            if first is None:
                first = new[0, : short + 1]
                yield out([batch["key"][0].as_py()], [None], [region(new[0])], [None])
            old = len(rows)
            rows = np.concatenate([rows, new])
            keys = np.concatenate([keys, batch["key"].to_numpy(zero_copy_only=False)])
            at = np.arange(max(1, old), len(rows))
            common = _prefix(rows[at], rows[at - 1])
            back = at - DENSE
            far = np.where(back >= 0, _prefix(rows[at], rows[np.maximum(back, 0)]), 0)
            # Within a dense region, neighbours share two values more than the region does.
            wanted = np.where(far >= short, np.minimum(far + 2, DEPTH), short)
            chosen = at[common >= wanted]
            node, root = forest(keys[chosen], keys[chosen - 1])
            yield out(node, root, [None] * len(node), [None] * len(node))
            # A region turns dense DENSE rows after its first row, which is still held.
            nth = np.cumsum(np.concatenate([[True], (rows[1:, : short + 1] != rows[:-1, : short + 1]).any(1)]))
            dense = np.isin(nth, nth[at[far >= short]]) | (rows[:, : short + 1] == first).all(1)
            yield members(rows[dense], keys[dense])
            rows, keys = rows[-DENSE:], keys[-DENSE:]
        if first is not None:
            yield out([keys[-1]], [None], [region(rows[-1])], [None])
            last = (rows[:, : short + 1] == rows[-1, : short + 1]).all(1)
            yield members(rows[last], keys[last])

    return run


def candidates(classes: DataFrame, trees: int = TREES, short: int = SHORT) -> tuple[DataFrame, DataFrame]:
    """Links (a, b) between keys of classes (key, signature) that are neighbours in some tree; dense regions (region, key).

    The rows of a tree are range-partitioned in sorted order, so a region may
    lie in several partitions. Where it does, it is the first or the last of
    each, and the ends of the partitions are linked by region.
    """
    spark = classes.sparkSession
    count = int(spark.conf.get("spark.sql.shuffle.partitions"))
    trees = F.transform(
        F.sequence(F.lit(0), F.lit(trees - 1)),
        lambda t: F.struct(t.alias("tree"), F.substr("signature", t * 2 * DEPTH + 1, F.lit(2 * DEPTH)).alias("sorted")),
    )
    rows = classes.select("key", F.explode(trees).alias("t")).select("t.tree", "t.sorted", "key")
    found = stored(
        rows.repartitionByRange(count, "tree", "sorted", "key")
        .sortWithinPartitions("tree", "sorted", "key")
        .mapInArrow(_neighbours(short), "a string, b string, region string, dense string"),
        "neighbours",
    )
    ends = found.where("region IS NOT NULL AND dense IS NULL").select("region", "a")
    least = ends.groupBy("region").agg(F.min("a").alias("b"))
    links = found.where("b IS NOT NULL").select("a", "b").union(ends.join(least, "region").select("a", "b"))
    return links, found.where("dense IS NOT NULL").select("region", F.col("dense").alias("key"))


def tile_links(a: list[np.ndarray], b: list[np.ndarray] | None, percent: int):
    """Index pairs of linked sets: of ``a`` and ``b``, or among ``a``; counts are exact."""
    sets = a if b is None else a + b
    sizes = np.array([len(s) for s in sets], np.int64)
    values, where, often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(sets)), sizes)
    shared = often[where] > 1
    column = (np.cumsum(often > 1) - 1)[where[shared]]
    owner = owner[shared]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    cut = len(a) if b is not None else 0
    both = np.zeros((len(a), len(sets) - cut), np.int64)
    step = max(256, (1 << 22) // max(1, len(sets)))
    columns = int(column[-1]) + 1 if len(column) else 0
    for low in range(0, columns, step):
        x, y = np.searchsorted(column, [low, low + step])
        held = np.zeros((len(sets), step), np.float32)
        held[owner[x:y], column[x:y] - low] = 1
        both += (held[: len(a)] @ held[cut:].T).astype(np.int64)
    union = sizes[: len(a), None] + sizes[None, cut:] - both
    left, right = np.nonzero(100 * both >= percent * union)
    if b is None:
        keep = left < right
        return left[keep], right[keep]
    return left, right + cut


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY, width: int = SHINGLE) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs``.

    Two documents are linked if their sets of ``width``-word shingles (all words
    as one where there are fewer) have a Jaccard similarity of ``similarity`` or
    more, in whole per cent. ``component_id`` is the smallest doc_id that can be
    reached over links, ``kept`` says that this is the document's own. Null
    texts and texts without words have empty sets and are linked with nothing.
    Rows with one doc_id are kept or not together; rows without doc_id take part
    in links but never name a component that has a doc_id. Only doc_id and text
    are read.

    A group of equal sets, of whatever size, is one class. Hot regions of the
    trees are spread over partitions, large candidate groups over tiles. Strays of dense regions are
    compared with all of these; classes of regions with too many are read again for the signatures of their own trees.
    """
    percent = round(similarity * 100)
    sketched = stored(sketches(docs, width), "sketches")
    # One row per set: the smallest doc_id and the signature, which the key determines.
    classes = stored(
        sketched.where("key IS NOT NULL")
        .groupBy("key")
        .agg(F.min("doc_id").alias("doc_id"), F.first("signature").alias("signature"), F.first("n_shingles").alias("n")),
        "classes",
    )
    links, dense = candidates(classes)
    members = _members(links, classes)
    confirmed = stored(_confirmed(docs, _placed(members), percent, width), "links-confirmed")
    few, again = _parted(classes, dense, members)
    if not few.isEmpty():
        found = _confirmed(docs, _beside(few), percent, width)
        confirmed = confirmed.unionByName(stored(found, "links-confirmed"))
    if not again.isEmpty():
        more, _ = candidates(stored(_signed_again(docs, again, width), "signatures"), MORE, DEPTH)
        found = _confirmed(docs, _placed(_members(more, again)), percent, width)
        confirmed = confirmed.unionByName(stored(found, "links-confirmed"))
    links = components(confirmed)
    roots = links.withColumnRenamed("node", "key").join(classes.select("key", "doc_id"), "key")
    named = roots.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    linked = roots.select("key", "root").join(named, "root").select("key", "component_id")
    own = classes.select("key", F.col("doc_id").alias("_own")).join(linked, "key", "left")
    # Stored, so that the join below is one of two plain shuffles and a hot class can be split.
    ids = stored(own.select("key", F.coalesce("component_id", "_own").alias("component_id")), "components")
    found = sketched.drop("signature").join(ids, "key", "left")
    component = F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return found.select(
        "doc_id", "n_shingles", component.alias("component_id"), component.eqNullSafe(F.col("doc_id")).alias("kept")
    )


def _members(links: DataFrame, classes: DataFrame) -> DataFrame:
    """group, key, doc_id, n of the classes that candidate links hang together; those that were ``compared`` already are left out."""
    groups = components(links).withColumnRenamed("node", "key").withColumnRenamed("root", "group")
    members = stored(groups.join(classes.drop("signature"), "key"), "members")
    if "compared" not in classes.columns:
        return members
    mixed_ = members.groupBy("group").agg(F.min("compared").alias("_a"), F.max("compared").alias("_b")).where("_a <> _b")
    return stored(members.join(mixed_.select("group"), "group", "left_semi").drop("compared"), "members")


def _parted(classes: DataFrame, dense: DataFrame, members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Classes of dense regions that hold several candidate groups, the pairs of which may not have met.

    A region's family is its largest group, the others of it are strays. First family, stray, key, doc_id, n
    where all strays of a family fit a block; then key, doc_id, n and the group ``compared`` for the others.
    """
    rows = dense.distinct().join(members.select("key", "group"), "key", "left")
    rows = rows.withColumn("group", F.coalesce("group", "key"))
    sizes = rows.groupBy("region", "group").agg(F.struct(F.count("*").alias("n"), "group").alias("_size"))
    top = sizes.groupBy("region").agg(F.max("_size")["group"].alias("family"), F.count("*").alias("_groups"))
    several = rows.join(top.where("_groups > 1").select("region", "family"), "region")
    held = several.select("family", "group", "key").distinct().join(classes.select("key", "doc_id", "n"), "key")
    held = stored(held.withColumn("stray", F.col("group") != F.col("family")), "parted")
    strays = held.where("stray").groupBy("family").agg(F.count("*").alias("sets"), F.sum("n").alias("shingles"))
    crowded = strays.where((F.col("sets") > BLOCK_SETS) | (F.col("shingles") > BLOCK_SHINGLES)).select("family")
    again = held.join(crowded, "family", "left_semi").select("key", "doc_id", "n", F.col("group").alias("compared"))
    return held.join(crowded, "family", "left_anti").drop("group"), again.distinct()


def _with_texts(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """Classes with the texts of their doc_id, of which ``_own_sets`` takes the right ones."""
    return small_batches(docs).select(F.col("doc_id").alias("_doc"), "text").join(
        classes, F.col("_doc").eqNullSafe(F.col("doc_id"))
    )


def _own_sets(batches: Iterator[pa.RecordBatch], width: int):
    """Rows whose text has the set that their key names, with the sets."""
    for part, texts in _parts(batches):
        sets = shingle_sets(texts, width)
        right = [k for k, (s, key) in enumerate(zip(sets, part["key"].to_pylist())) if len(s) and _key(s) == key]
        yield part.take(pa.array(right, pa.int64())), [sets[k] for k in right]


def _signed_again(docs: DataFrame, classes: DataFrame, width: int) -> DataFrame:
    """key and the signature of ``MORE`` trees for the classes (key, doc_id)."""

    def run(batches):
        for taken, sets in _own_sets(batches, width):
            signed = pa.array([signature(s, _MORE_FACTORS, _MORE_TERMS) for s in sets], pa.binary())
            yield pa.record_batch({"key": taken["key"], "signature": signed})

    return _with_texts(docs, classes).select("key", "text").mapInArrow(run, "key string, signature binary")


def _blocks() -> Column:
    """How many blocks a group takes."""
    return F.greatest(F.ceil(F.count("*") / BLOCK_SETS), F.ceil(F.sum("n") / BLOCK_SHINGLES)).cast("int").alias("blocks")


def _block() -> Column:
    return F.pmod(F.xxhash64("key"), F.col("blocks").cast("long")).cast("int")


def _placed(members: DataFrame) -> DataFrame:
    """Members with their block and the last one that it meets, for every pair of a group."""
    placed = members.join(members.groupBy("group").agg(_blocks()), "group").withColumn("block", _block())
    return placed.withColumn("last", F.col("blocks") - 1).drop("blocks")


def _beside(few: DataFrame) -> DataFrame:
    """Strays as block 0, which meets itself and every block of the family; these meet no other."""
    blocks = few.where("NOT stray").groupBy("family").agg(_blocks())
    placed = few.join(blocks, "family").withColumnRenamed("family", "group")
    return placed.withColumns(
        {
            "block": F.when(F.col("stray"), 0).otherwise(_block() + 1),
            "last": F.when(F.col("stray"), F.col("blocks")).otherwise(0),
        }
    ).drop("blocks", "stray")


def _confirmed(docs: DataFrame, placed: DataFrame, percent: int, width: int) -> DataFrame:
    """Links (a, b) of keys, found in tiles of the placed members' whole sets."""

    def run(batches):
        for taken, sets in _own_sets(batches, width):
            yield pa.record_batch(
                {c: taken[c] for c in ("group", "key", "block", "last")}
                | {"set": pa.array([s.tobytes() for s in sets], pa.binary())}
            )

    sets = _with_texts(docs, placed).select("group", "key", "block", "last", "text").mapInArrow(
        run, "group string, key string, block int, last int, set binary"
    )
    # A tile compares block x with block y >= x; a block takes part in as many tiles as there are blocks it meets.
    tiles = F.transform(
        F.sequence(F.lit(0), F.col("last")),
        lambda other: F.struct(F.least("block", other).alias("x"), F.greatest("block", other).alias("y")),
    )
    spread = sets.withColumn("tile", F.explode(tiles)).select("group", "tile.x", "tile.y", "block", "key", "set")
    return spread.groupBy("group", "x", "y").applyInArrow(_tile(percent), "a string, b string")


def _tile(percent: int):
    def run(table: pa.Table) -> pa.Table:
        rows = {}
        for key, block, found in zip(*(table[c].to_pylist() for c in ("key", "block", "set"))):
            rows[key] = (block, np.frombuffer(found, np.uint64))
        x, y = table["x"][0].as_py(), table["y"][0].as_py()
        left = [k for k in rows if rows[k][0] == x]
        right = None if x == y else [k for k in rows if rows[k][0] == y]
        keys = np.array(left + (right or []), object)
        a, b = [], []
        if len(left) and (right is None or right):
            a, b = tile_links([rows[k][1] for k in left], right and [rows[k][1] for k in right], percent)
            a, b = forest(keys[a], keys[b])
        return pa.table({"a": pa.array(a, pa.string()), "b": pa.array(b, pa.string())})

    return run
