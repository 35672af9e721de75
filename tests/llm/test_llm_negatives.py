"""Hard negatives against exact scores of all pairs."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import types as T

from tidemark.llm import hard_negatives as hard

SCHEMA = T.StructType(
    [
        T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
        T.StructField("label", T.IntegerType()),
        *[T.StructField(c, T.StringType()) for c in ("v", "anchor", "copy", "score", "rank", "aims")],
    ]
)


def plain(rows, every=50):
    """(anchor, positive, rank, negative, positive score, negative score) by sorting all rows for each anchor."""
    kept = []
    for i, x, label in rows:
        if i is None or label is None or x is None or any(c is None or not math.isfinite(c) for c in x):
            continue
        kept.append((i, label, [math.floor(256 * float(np.float32(c))) for c in x]))
    out = set()
    for anchor, label, v in {(i, l, tuple(v)) for i, l, v in kept if i % every == 0}:
        scored = [(-sum(p * q for p, q in zip(v, w)), i, l) for i, l, w in kept if i != anchor]
        for s, positive, _ in sorted(r for r in scored if r[2] == label)[:5]:
            near = sorted(r for r in scored if r[2] != label and -50 * s <= -100 * r[0] <= -95 * s)[:3]
            out |= {(anchor, positive, k, i, -s, -t) for k, (t, i, _) in enumerate(near, 1)}
    return out


def found(spark, rows, **options):
    df = spark.createDataFrame([(i, x, l, *["x"] * 6) for i, x, l in rows], SCHEMA).repartition(3)
    return [tuple(r) for r in hard.hard_negatives(df, **options).collect()]


def vectors(count, size, seed, labels=4, spread=0.6):
    pick = np.random.default_rng(seed)
    centres = pick.normal(size=(labels, size))
    shared = pick.normal(size=size)
    label = pick.integers(0, labels, count)
    x = centres[label] + shared + spread * pick.normal(size=(count, size))
    return [(i, [float(c) for c in v], int(l)) for i, (v, l) in enumerate(zip(x, label))]


@pytest.mark.parametrize("size", [3, 64, 100])
def test_against_exact_scores(spark, size):
    rows = vectors(420, size, size)
    got = found(spark, rows, shard=100, block=3)
    assert len(got) > 50 and set(got) == plain(rows) and len(got) == len(set(got))


def test_intervals_hold_and_drop_most():
    rows = vectors(2000, 64, 1, labels=10, spread=0.3)
    v = np.floor(256 * np.array([x for _, x, _ in rows]))
    asked, codes = hard.Asked(v[:20]), hard.Codes(v)
    exact, widths = v[:20] @ v.T, []
    for levels in range(1, hard.LEVELS + 1):
        least, greatest = hard.intervals(asked, codes, slice(0, 20), levels)
        assert (least <= exact).all() and (exact <= greatest).all()
        widths.append((greatest - least).mean())
    assert widths == sorted(widths, reverse=True) and widths[-1] < widths[0] / 3
    # The best five are never beaten, and most of the others are.
    x, y = np.nonzero(np.ones(exact.shape, bool))
    kept = ~hard.beaten(least[x, y], greatest[x, y], x, 5, np.ones(len(x), bool)).reshape(exact.shape)
    assert kept.mean() < 0.25 and np.take_along_axis(kept, np.argsort(-exact, 1, "stable")[:, :5], 1).all()


def test_rotation_keeps_products():
    v = np.random.default_rng(2).normal(size=(30, 70))
    turned = hard.rotated(v)
    assert turned.shape == (30, 128) and np.allclose(turned @ turned.T, v @ v.T)


def test_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = vectors(300, 6, 5, labels=3)
    rows += [(None, [1.0] * 6, 1), (350, None, 1), (351, [1.0] * 6, None), (400, [1.0, None] + [1.0] * 4, 0),
             (401, [nan] * 6, 0), (402, [inf] + [0.0] * 5, 0), (450, [], 1), (451, [2.0, 1.0], 1), (500, [0.0] * 6, 2)]
    rows += [rows[50], rows[50], rows[7], rows[7]]  # an anchor three times, a vector three times
    got = found(spark, rows)
    want = plain(rows)
    # Rows that repeat come as often as they are there, so ranks and positives may repeat ids.
    assert {g[0] for g in got} == {w[0] for w in want} and {g[:2] for g in got} <= {w[:2] for w in want} | {
        g[:2] for g in got if g[1] == 7
    }
    assert all(50 * g[4] <= 100 * g[5] <= 95 * g[4] for g in got)
    assert found(spark, []) == []
    assert found(spark, [(0, [1.0], 0)]) == [] and found(spark, [(0, [1.0], 0), (1, [1.0], 0)]) == []


def test_ties_go_to_smaller_ids(spark):
    rows = [(0, [1.0, 0.0], 0), *[(i, [1.0, 0.0], 0) for i in range(1, 9)], *[(i, [0.75, 0.5], 1) for i in range(30, 20, -1)]]
    got = sorted(found(spark, rows, shard=3))
    assert got == sorted((0, p, k, 20 + k, 65536, 49152) for p in range(1, 6) for k in (1, 2, 3))


def test_a_component_of_any_size(spark):
    rows = vectors(200, 4, 8, labels=2)
    rows += [(600, [300_000.0, 1.0, 0.0, 0.0], 0), (601, [3e8, 5.0, 0.0, 0.0], 0), (602, [2.0e8, 5.0, 1.0, 0.0], 1)]
    assert set(found(spark, rows)) == plain(rows)
    rows += [(650, [3e38, 3e38, 0.0, 0.0], 1), (651, [-3e38, 1.0, 0.0, 0.0], 0)]
    got = found(spark, rows)
    assert all(-(2**63) <= s < 2**63 for g in got for s in g[4:])
    pick = random.Random(1)
    left = np.array([[pick.choice([1e30, -3.0, 2.0**60])] * 3 for _ in range(5)])
    rows = np.arange(5)
    assert [int(s) for s in hard.scores(left, left, rows, rows)] == [sum(int(x) * int(x) for x in u) for u in left]


def test_a_hot_vector_is_not_carried_more_often_than_it_counts(spark):
    rows = vectors(120, 4, 3, labels=2)
    copy, other = [9 * c for c in rows[0][1]], [6.5 * c for c in rows[0][1]]
    rows += [(7, copy, rows[0][2])] * 3000 + [(130, other, 1 - rows[0][2])]
    got = found(spark, rows)
    assert set(got) == plain(rows) and {g[1] for g in got if g[0] == 0} == {7} and len(got) < 120
