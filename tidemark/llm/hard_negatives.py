"""Hard negatives by rotated one-bit codes with intervals that hold for certain.

Every vector is turned by a fixed rotation and coded by the signs of its
components: one bit each, and the code vector's alignment, which is its inner
product with the vector. What the code leaves of the vector is coded in the same
way, ``LEVELS`` times. A code's inner product with an anchor, which is held in a few
bits per component, is a matter of popcounts. What it leaves out is a product with the
rest of the vector, and by Cauchy-Schwarz not greater than the lengths of the
rest and of the anchor's part across the last code. So every pair gets an
interval that holds its score, the narrower the more levels there are. Pairs whose interval
cannot be among those asked for are dropped, the others are scored in integers.

Anchors meet vectors in blocks and shards of bounded size; each such pair gives
its own best, and windows over the anchors give the best of all.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stored

SCALE, EVERY, POSITIVES, NEGATIVES = 256, 50, 5, 3
# A negative's score is in these per cent of the positive's.
LEAST, MOST = 50, 95
LEVELS, BITS, ROUNDS = 8, 8, 3
# Vectors and anchors that meet in a group, and pairs that are weighed at a time.
SHARD, BLOCK, PAIRS = 8_192, 4_096, 1 << 17
WORD = 64
LONG = 2**63 - 1


def rotated(vectors: np.ndarray) -> np.ndarray:
    """Rows turned by a fixed rotation, in as many dimensions as the next power of two (64 at least)."""
    size = max(WORD, 1 << max(0, vectors.shape[1] - 1).bit_length())
    out = np.zeros((len(vectors), size))
    out[:, : vectors.shape[1]] = vectors
    random = np.random.Generator(np.random.PCG64(23))
    for _ in range(ROUNDS):
        out *= np.where(random.random(size) < 0.5, -1.0, 1.0)
        width = 1
        while width < size:
            halves = out.reshape(len(out), -1, 2, width)
            out = np.stack([halves[:, :, 0] + halves[:, :, 1], halves[:, :, 0] - halves[:, :, 1]], 2).reshape(len(out), size)
            width *= 2
        out /= np.sqrt(size)
    return out


def _words(bits: np.ndarray) -> np.ndarray:
    """Rows of bits as rows of 64-bit words."""
    return np.packbits(bits, axis=1).view(np.uint64)


class Codes:
    """One-bit codes of turned vectors: per level the signs, the alignment, and the length of what is left."""

    @np.errstate(all="ignore")
    def __init__(self, vectors: np.ndarray, levels: int = LEVELS):
        rest = rotated(vectors)
        root = np.sqrt(rest.shape[1])
        self.signs, self.alignment, self.left = [], [], []
        self.length = np.sqrt((rest**2).sum(1))
        for _ in range(levels):
            up = rest >= 0
            alignment = np.abs(rest).sum(1) / root
            rest = rest - np.where(up, 1.0, -1.0) * (alignment / root)[:, None]
            self.signs.append(_words(up))
            self.alignment.append(alignment)
            self.left.append(np.sqrt((rest**2).sum(1)))


class Asked:
    """Turned anchors in ``BITS`` bits per component, as bit planes, with the length of what rounding left out."""

    @np.errstate(all="ignore")
    def __init__(self, vectors: np.ndarray):
        turned = rotated(vectors)
        self.size = turned.shape[1]
        self.length = np.sqrt((turned**2).sum(1))
        low = turned.min(1, initial=0)
        self.step = np.maximum((turned.max(1, initial=0) - low) / (2**BITS - 1), np.finfo(float).tiny)
        level = np.nan_to_num(np.rint((turned - low[:, None]) / self.step[:, None])).clip(0, 2**BITS - 1).astype(np.int64)
        self.low, self.sum = low, level.sum(1)
        self.error = np.sqrt(((turned - low[:, None] - self.step[:, None] * level) ** 2).sum(1))
        self.planes = [_words((level >> p & 1).astype(bool)) for p in range(BITS)]

    def above(self, a: slice, signs: np.ndarray) -> np.ndarray:
        """For anchors ``a`` and code vectors ``signs``: the sum of the anchor's levels where the sign is up."""
        size = (self.planes[0][a].shape[0], len(signs))
        total = np.zeros(size, np.uint16 if self.size << BITS <= 1 << 16 else np.int64)
        held = np.empty(size, np.uint64)
        # From the highest plane down: what is there doubles, and the next plane's count comes on top.
        for plane in reversed(self.planes):
            total <<= 1
            for w in range(signs.shape[1]):
                np.bitwise_and(plane[a, w][:, None], signs[:, w], out=held)
                total += np.bitwise_count(held)
        return total


@np.errstate(all="ignore")
def intervals(asked: Asked, codes: Codes, a: slice, levels: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The least and the greatest score that anchors ``a`` can have with each coded vector.

    A unit code vector has +-1 over the root of the size; an anchor is its lowest
    component plus its levels times a step. So their product is that of the
    levels, which ``above`` gives, and terms that depend on one of the two.
    """
    levels = len(codes.signs) if levels is None else levels
    root = np.sqrt(asked.size)
    step, low = asked.step[a, None] / root, asked.low[a, None] / root
    used, offset, levelled = 0.0, 0.0, 0.0
    for level in range(levels):
        above = asked.above(a, codes.signs[level])
        ups = 2 * np.bitwise_count(codes.signs[level]).sum(1).astype(np.float64) - asked.size
        levelled = levelled + above * (2 * codes.alignment[level])
        offset = offset + codes.alignment[level] * ups
        used = used + codes.alignment[level]
    estimate = step * levelled
    estimate += low * offset
    estimate -= step * asked.sum[a, None] * used
    # The rest is at right angles to the last code vector, so the anchor's part along that does not count.
    along = step * (2.0 * above) + (low * ups - step * asked.sum[a, None])
    along = np.maximum(np.abs(along) - asked.error[a, None], 0)
    reach = np.sqrt(np.maximum(asked.length[a, None] ** 2 - along * along, 0))
    # What is left of the anchor against the rest, its rounding error against all code vectors.
    reach *= codes.left[levels - 1]
    reach += asked.error[a, None] * used + 1e-9 * asked.length[a, None] * codes.length + 1e-6
    reach *= 1 + 1e-9
    return estimate - reach, estimate + reach


def beaten(least: np.ndarray, greatest: np.ndarray, row: np.ndarray, k: int, sure: np.ndarray) -> np.ndarray:
    """Which of some pairs' intervals lie below those of ``k`` pairs of their row that are ``sure`` to count.

    Pairs come row by row. Intervals that are no numbers are never beaten.
    """
    sure = np.flatnonzero(sure & np.isfinite(least))
    order = sure[np.lexsort((-least[sure], row[sure]))]
    nth = np.arange(len(order)) - np.searchsorted(row[order], row[order])
    floor = np.full(int(row[-1]) + 1 if len(row) else 0, -np.inf)
    last = order[nth == k - 1]
    floor[row[last]] = least[last]
    return greatest < floor[row]


def scores(left: np.ndarray, right: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact inner products of rows ``x`` and ``y`` (``x`` in order) of whole numbers.

    As doubles, which add up whole numbers exactly, where they are small enough, else as integers.
    """
    most = float(np.abs(left).max(initial=0)) * float(np.abs(right).max(initial=0)) * max(1, left.shape[1])
    if not most < 2**53:
        return np.array([sum(int(p) * int(q) for p, q in zip(left[i], right[j])) for i, j in zip(x, y)], object)
    out = np.empty(len(x), np.int64)
    cuts = np.searchsorted(x, np.arange(len(left) + 1))
    for i in np.unique(x):
        part = slice(cuts[i], cuts[i + 1])
        out[part] = right[y[part]] @ left[i]
    return out


def _matrix(lists: pa.ListArray) -> np.ndarray:
    """Rows of equal length, shorter ones filled up with 0."""
    n = pa.compute.list_value_length(lists).to_numpy()
    values = lists.flatten().to_numpy()
    out = np.zeros((len(n), int(n.max(initial=0))))
    row = np.repeat(np.arange(len(n)), n)
    out[row, np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)] = values
    return out


def _best(score: np.ndarray, ids: np.ndarray, group: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best of each group, ties to smaller ids."""
    order = sorted(range(len(score)), key=lambda i: (group[i], -score[i], ids[i])) if score.dtype == object else np.lexsort(
        (ids, -score, group)
    )
    order = np.asarray(order, np.int64)
    nth = np.arange(len(order)) - np.searchsorted(group[order], group[order])
    return order[nth < k]


def _clipped(score: np.ndarray) -> pa.Array:
    return pa.array([max(-LONG - 1, min(LONG, int(s))) for s in score], pa.int64())


def _meet(find, out: tuple[str, ...]):
    """A group's anchors and vectors, about ``PAIRS`` at a time, through ``find``."""

    def run(table: pa.Table) -> pa.Table:
        asks = table["asks"].to_numpy().astype(bool)
        sides = [table.filter(pa.array(mask)) for mask in (asks, ~asks)]
        found = {c: [] for c in out}
        if all(side.num_rows for side in sides):
            vectors = _matrix(table["v"].combine_chunks())
            left, right = vectors[asks], vectors[~asks]
            asked, codes = Asked(left), Codes(right)
            step = max(1, PAIRS // len(right))
            for low in range(0, len(left), step):
                a = slice(low, min(low + step, len(left)))
                for c, values in find(*sides, a, *intervals(asked, codes, a), left, right).items():
                    found[c].append(values)
        empty = pa.array([], pa.int64())
        parts = {c: [p for v in values for p in getattr(v, "chunks", [v])] for c, values in found.items()}
        return pa.table({c: pa.chunked_array(v or [empty], pa.int64()) for c, v in parts.items()})

    return run


def _positives(k: int):
    def find(anchors, others, a, least, greatest, left, right):
        ids, labels = (others[c].to_numpy() for c in ("vec_id", "label"))
        able = (anchors["label"].to_numpy()[a, None] == labels) & (anchors["vec_id"].to_numpy()[a, None] != ids)
        x, y = np.nonzero(able)
        least, greatest = least[x, y], greatest[x, y]
        kept = ~beaten(least, greatest, x, k, np.ones(len(x), bool))
        x, y = x[kept], y[kept]
        score = scores(left[a], right, x, y)
        best = _best(score, ids[y], x, k)
        anchor = pa.array(x[best] + a.start)
        return {
            "anchor_id": anchors["vec_id"].take(anchor),
            "anchor": anchors["anchor"].take(anchor),
            "vec_id": pa.array(ids[y[best]], pa.int64()),
            "score": _clipped(score[best]),
        }

    return _meet(find, ("anchor_id", "anchor", "vec_id", "score"))


def _negatives(k: int, least_share: int, most_share: int):
    def find(anchors, others, a, least, greatest, left, right):
        ids, labels = (others[c].to_numpy() for c in ("vec_id", "label"))
        aims = anchors["aims"].to_pylist()[a]
        # Windows of the positive scores, a little wider for what a double rounds; exact below.
        wide = np.array([[float(s[0]), float(s[-1])] for s in aims])
        wide += (1e-12 * np.abs(wide) + 1e-6) * [-1, 1]
        able = anchors["label"].to_numpy()[a, None] != labels
        able &= ~(greatest < wide[:, :1] * (least_share / 100)) & ~(least > wide[:, 1:] * (most_share / 100))
        x, y = np.nonzero(able)
        least, greatest = least[x, y], greatest[x, y]
        windows, wanted = [], np.zeros(len(x), bool)
        for nth in range(max(map(len, aims))):
            # One positive score of each anchor that has so many.
            has = np.array([len(s) > nth for s in aims])
            aim = [s[nth] if len(s) > nth else 0 for s in aims]
            goal = np.array(aim, np.float64)
            slack = 1e-12 * np.abs(goal) + 1e-6
            low, high = goal * (least_share / 100), goal * (most_share / 100)
            mask = has[x] & ~(greatest < (low - slack)[x]) & ~(least > (high + slack)[x])
            sure = mask & (least >= (low + slack)[x]) & (greatest <= (high - slack)[x])
            mask &= ~beaten(least, greatest, x, k, sure)
            windows.append((aim, mask))
            wanted |= mask
        # Each pair is scored once, for whichever windows it may be in.
        x, y = x[wanted], y[wanted]
        score = scores(left[a], right, x, y)
        if score.dtype != object and abs(score).max(initial=0) > LONG // 200:
            score = score.astype(object)
        found = {c: [] for c in ("anchor_id", "anchor", "positive_score", "negative_id", "negative_score")}
        for aim, mask in windows:
            at = np.flatnonzero(mask[wanted])
            goal = np.array(aim, object if max(map(abs, aim)) > LONG // 200 else np.int64)[x[at]]
            inside = (goal * least_share <= score[at] * 100) & (score[at] * 100 <= goal * most_share)
            at = at[inside.astype(bool)]
            best = at[_best(score[at], ids[y[at]], x[at], k)]
            anchor = pa.array(x[best] + a.start)
            found["anchor_id"] += anchors["vec_id"].take(anchor).chunks
            found["anchor"] += anchors["anchor"].take(anchor).chunks
            found["positive_score"].append(pa.array([aim[i] for i in x[best]], pa.int64()))
            found["negative_id"].append(pa.array(ids[y[best]], pa.int64()))
            found["negative_score"].append(_clipped(score[best]))
        return {c: pa.chunked_array(v, pa.int64()) for c, v in found.items()}

    return _meet(find, ("anchor_id", "anchor", "positive_score", "negative_id", "negative_score"))


def usable(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id, label and ``v``, floor(scale * x) of every component as whole doubles; unusable rows are left out."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    kept = vectors.where("vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL").where(finite)

    def whole(x: Column) -> Column:
        scaled = x.cast("double") * scale
        # Beyond 2^53 every double is whole.
        return F.when(F.abs(scaled) < 2.0**53, F.floor(scaled).cast("double")).otherwise(scaled)

    return kept.select(
        F.col("vec_id").cast("long"), F.col("label").cast("long"), F.transform("embedding", whole).alias("v")
    )


def _dealt(anchors: DataFrame, vectors: DataFrame, shards: int, blocks: int) -> DataFrame:
    """Both sides as rows of the groups (block, shard) in which they meet."""

    def every(n: int, name: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias(name)

    def part(n: int) -> Column:
        return F.pmod(F.xxhash64("vec_id", "v"), F.lit(n)).cast("int")

    vectors = vectors.select("vec_id", "label", "v")
    extra = [c for c in anchors.columns if c not in vectors.columns]
    left = anchors.withColumn("block", part(blocks)).select("*", every(shards, "shard"), F.lit(True).alias("asks"))
    right = vectors.withColumn("shard", part(shards)).select("*", every(blocks, "block"), F.lit(False).alias("asks"))
    both = left.unionByName(right, allowMissingColumns=True)
    return both.select("block", "shard", "asks", "vec_id", "label", "v", *extra).groupBy("block", "shard")


def hard_negatives(
    vectors: DataFrame,
    every: int = EVERY,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    least: int = LEAST,
    most: int = MOST,
    scale: int = SCALE,
    shard: int = SHARD,
    block: int = BLOCK,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Anchors are the rows of (vec_id, embedding, label) whose vec_id is divisible
    by ``every``. An anchor's positives are its ``positives`` best rows of the
    same label, its negatives for each of them the ``negatives`` best rows of
    another label whose score is between ``least`` and ``most`` per cent of the
    positive's. Scores are inner products of the components scaled and rounded
    down, ties go to smaller vec_ids. Rows without vec_id, label or vector, or with
    a component that is null or not finite, take no part. Rows with the anchor's own
    vec_id are no positives of it; rows that repeat are as many positives or
    negatives. An anchor that comes several times asks once, with different
    vectors or labels once with each. Shorter vectors count as filled up with 0. Scores beyond a long are
    given as the greatest or least long.
    """
    # More copies of a row than an anchor has places for change nothing.
    copies = usable(vectors, scale).groupBy("vec_id", "label", "v").agg(F.count(F.lit(1)).alias("_rows"))
    many = F.least(F.col("_rows"), F.lit(max(positives, negatives)))
    table = stored(copies.select("vec_id", "label", "v", F.explode(F.sequence(F.lit(1), many)).alias("copy")), "vectors")
    # A number for each different anchor row of an id, that its content determines.
    anchors = table.where((F.pmod("vec_id", F.lit(every)) == 0) & (F.col("copy") == 1)).drop("copy")
    anchors = stored(anchors.withColumn("anchor", F.xxhash64("label", "v")), "anchors")
    shards = max(1, -(-table.count() // shard))
    blocks = max(1, -(-anchors.count() // block))
    key = ["anchor_id", "anchor"]
    met = _dealt(anchors, table, shards, blocks).applyInArrow(
        _positives(positives), "anchor_id long, anchor long, vec_id long, score long"
    )
    best = Window.partitionBy(*key).orderBy(F.col("score").desc(), "vec_id")
    found = stored(met.withColumn("_nth", F.row_number().over(best)).where(F.col("_nth") <= positives), "positives")
    aims = found.groupBy(*key).agg(F.sort_array(F.collect_set("score")).alias("aims"))
    aiming = anchors.withColumnRenamed("vec_id", "anchor_id").join(aims, key).withColumnRenamed("anchor_id", "vec_id")
    met = _dealt(aiming, table, shards, blocks).applyInArrow(
        _negatives(negatives, least, most),
        "anchor_id long, anchor long, positive_score long, negative_id long, negative_score long",
    )
    key = [*key, "positive_score"]
    best = Window.partitionBy(*key).orderBy(F.col("negative_score").desc(), "negative_id")
    ranked = met.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= negatives)
    named = found.select("anchor_id", "anchor", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    return named.join(ranked, key).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
