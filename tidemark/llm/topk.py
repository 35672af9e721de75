"""Exact top-k search by inner product over an impact-ordered index.

Vectors are quantised to integers. A shard of the index holds postings (vector,
dimension, impact) in segments of equal impact class, the power of two of the
impact's size, largest first. A block of queries goes through a shard segment
by segment and adds each posting's share to the scores. After a segment, what
the rest of a vector can still add is at most the product of the query's length and
of the length of the vector's remaining postings. As soon as that proves that
few vectors can be among the best, those are scored exactly and the rest of
the segments is left out. If no proof comes, all segments are processed, and
the scores are exact anyhow.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import stored

SCALE = 64
# Vectors in a shard, queries that meet it in one group, and queries scored at a time.
SHARD, GROUP, BLOCK = 16_384, 2_048, 256
LONG = 2**63 - 1
# Rescoring pays if fewer than this share of a shard's vectors may be members.
FEW = 0.05


def integers(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id and ``v``: floor(scale * x) of every component, as whole doubles; unusable vectors are left out."""

    def whole(x):
        scaled = x.cast("double") * scale
        # Beyond 2^53 every double is whole.
        return F.when(F.abs(scaled) < 2.0**53, F.floor(scaled).cast("double")).otherwise(scaled)

    usable = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    return vectors.where(F.col("embedding").isNotNull() & usable).select(
        "vec_id", F.transform("embedding", whole).alias("v")
    )


def _whole(values: np.ndarray, kind) -> np.ndarray:
    return np.frompyfunc(int, 1, 1)(values) if kind is object else values.astype(kind)


def _segments(vectors: np.ndarray):
    """Postings by falling impact class, and the squared length of what comes after each."""
    size = np.abs(vectors)
    classes = np.where(size > 0, np.frexp(size.astype(np.float64))[1], 0)
    rest = (vectors.astype(np.float64) ** 2).sum(1)
    for level in np.unique(classes[classes > 0])[::-1]:
        segment = np.where(classes == level, vectors, 0)
        rest = rest - (segment.astype(np.float64) ** 2).sum(1)
        yield segment, np.maximum(rest, 0)


def search_shard(queries: np.ndarray, query_ids, vectors: np.ndarray, ids, k: int, segments=None):
    """Per query the k best of the shard: query number, vector number, score; ties to smaller ids."""
    most = float(np.abs(queries).max(initial=0)) * float(np.abs(vectors).max(initial=0)) * vectors.shape[1]
    # Sums of whole numbers are exact in these; integers of any size where nothing else is wide enough.
    kind = np.float32 if most < 2**23 else np.float64 if most < 2**52 else np.int64 if most < 2**62 else object
    floating = kind in (np.float32, np.float64)
    q, v = _whole(queries, kind), vectors
    score = np.zeros((len(q), len(v)), kind)
    length = np.sqrt((queries.astype(np.float64) ** 2).sum(1))
    own = np.asarray(query_ids)[:, None] == np.asarray(ids)[None, :]
    members = np.ones((len(q), len(v)), bool)
    for segment, rest in segments or list(_segments(v)):
        score += q @ _whole(segment, kind).T
        # The bound below is slightly more than it need be, for its own rounding.
        if not rest.any():
            break
        if len(v) > k + 1 and floating:
            bound = length[:, None] * np.sqrt(rest)[None, :] * (1 + 1e-6) + 1e-3
            sure = np.where(own, -np.inf, score - bound)
            floor = np.partition(sure, len(v) - k, axis=1)[:, len(v) - k]
            members = score + bound >= floor[:, None]
            if members.mean() < FEW:
                a, b = np.nonzero(members)
                for low in range(0, len(a), 1 << 16):
                    x, y = a[low : low + (1 << 16)], b[low : low + (1 << 16)]
                    score[x, y] = (queries[x].astype(kind) * v[y].astype(kind)).sum(1)
                break
            members[:] = True
    usable = members & ~own
    rows, columns, values = [], [], []
    for row in range(len(q)):
        at = np.flatnonzero(usable[row])
        if len(at) > k:
            found = score[row, at]
            edge = np.partition(found, len(at) - k)[len(at) - k]
            at = at[found >= edge]
        order = _order(score[row, at], np.asarray(ids)[at])[:k]
        rows += [row] * len(order)
        columns += at[order].tolist()
        values += [max(-LONG - 1, min(LONG, int(x))) for x in score[row, at[order]]]
    return rows, columns, values


def _order(score: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Places by falling score, ties by id."""
    if score.dtype == object:
        return np.array(sorted(range(len(score)), key=lambda i: (-score[i], ids[i])), np.int64)
    return np.lexsort((ids, -score))


def _matrix(lists: pa.ListArray) -> np.ndarray:
    """Rows of equal length, shorter ones filled up with 0."""
    begins, n = lists.offsets.to_numpy()[:-1], pa.compute.list_value_length(lists).to_numpy()
    values, wide = lists.values.to_numpy(), int(n.max(initial=0))
    out = np.zeros((len(n), wide))
    row = np.repeat(np.arange(len(n)), n)
    column = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    out[row, column] = values[begins[row] + column]
    return out


def top_k(vectors: DataFrame, k: int = 20, every: int = 20, scale: int = SCALE, shard: int = SHARD) -> DataFrame:
    """query_id, rank, vec_id, score: for every query its k best other vectors.

    Queries are the vectors whose vec_id is divisible by ``every``; they search
    all vectors but those with their own vec_id. Vectors that are null or hold
    null, not-a-number or infinite components take no part, nor do
    vectors without vec_id. Shorter vectors count as filled up with 0; empty
    ones score 0. Rows that repeat a vec_id are candidates as often as they
    come; a query id with several vectors asks with each and gets the k best of
    all. Ties go to smaller vec_ids. Scores beyond a long are given as the greatest or least long.

    Both sides are dealt in blocks of bounded size, and each block of queries
    meets each shard: that product is what is asked for.
    """
    usable = stored(integers(vectors.where("vec_id IS NOT NULL").select("vec_id", "embedding"), scale), "vectors")
    queries = usable.where(F.pmod("vec_id", F.lit(every)) == 0).distinct()
    shards = max(1, -(-usable.count() // shard))
    blocks = max(1, -(-queries.count() // GROUP))
    placed = usable.withColumn("shard", F.pmod(F.xxhash64("vec_id", "v"), F.lit(shards)).cast("int"))
    asked = queries.withColumn("block", F.pmod(F.xxhash64("vec_id", "v"), F.lit(blocks)).cast("int"))
    pair = lambda n, name: F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias(name)
    left = asked.select("block", pair(shards, "shard"), F.lit(True).alias("asks"), "vec_id", "v")
    right = placed.select(pair(blocks, "block"), "shard", F.lit(False).alias("asks"), "vec_id", "v")
    met = left.unionByName(right).groupBy("block", "shard").applyInArrow(
        _search(k), "query_id long, vec_id long, score long"
    )
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return met.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )


def _search(k: int):
    def run(table: pa.Table) -> pa.Table:
        asks = table["asks"].to_numpy().astype(bool)
        ids = table["vec_id"].to_numpy()
        rows = _matrix(table["v"].combine_chunks())
        a, b = np.flatnonzero(asks), np.flatnonzero(~asks)
        found, segments = [[], [], []], list(_segments(rows[b]))
        for low in range(0, len(a), BLOCK):
            some = a[low : low + BLOCK]
            x, y, score = search_shard(rows[some], ids[some], rows[b], ids[b], k, segments)
            found[0] += ids[some][x].tolist() if x else []
            found[1] += ids[b][y].tolist() if y else []
            found[2] += score
        return pa.table(
            {c: pa.array(v, pa.int64()) for c, v in zip(("query_id", "vec_id", "score"), found)}
        )

    return run
