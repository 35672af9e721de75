"""Snapshots compared by digest trees: the same result, and only what differs is read."""

import glob
import random

import pytest
from pyspark.sql import functions as F

from frames import as_set, same_rows
from tidemark.operators.digests import LEAF, Shape, differing, digest_diff, digest_tree, read_leaves, write_digested
from tidemark.operators.scd2 import snapshot_diff

SCHEMA = "k long, part string, v string, w double"
SHAPE = Shape(fan=4, levels=3, folders=1)


def snapshot(spark, rows):
    return spark.createDataFrame([(*k, *v) for k, v in rows.items()], SCHEMA)


@pytest.fixture
def pair(spark, folder):
    """Two snapshots of 2,000 keys that differ in few, stored; with their frames."""
    pick = random.Random(2)
    old = {(k, pick.choice(["a", "b"])): (pick.choice(["x", "y", None]), pick.choice([1.5, None])) for k in range(2000)}
    new = dict(old)
    for key in pick.sample(sorted(old), 3):
        new[key] = ("changed", None)
    for key in pick.sample(sorted(old), 2):
        del new[key]
    new[(5000, "a")] = (None, None)
    frames = [snapshot(spark, rows) for rows in (old, new)]
    for name, df in zip(("old", "new"), frames):
        write_digested(df.repartition(3), f"{folder}/{name}", ["k", "part"], ["v", "w"], SHAPE)
    return frames


def diff(spark, folder, old="old", new="new"):
    schema = spark.createDataFrame([], SCHEMA).schema
    return digest_diff(spark, f"{folder}/{old}", f"{folder}/{new}", schema, ["k", "part"], ["v", "w"], SHAPE)


def test_the_same_as_the_whole_diff(spark, folder, pair):
    want = snapshot_diff(*pair, ["k", "part"], ["v", "w"]).where("action <> 'same'")
    got = diff(spark, folder)
    assert 4 <= want.count() <= 6 and same_rows(got, want)
    back = {(r.k, r.action) for r in diff(spark, folder, "new", "old").collect()}
    turned = {"insert": "close", "close": "insert", "update": "update"}
    assert back == {(r.k, turned[r.action]) for r in want.collect()}


def test_only_differing_ranges_are_compared_and_read(spark, folder, pair):
    leaves, compared = differing(spark, f"{folder}/old", f"{folder}/new", SHAPE)
    assert 1 <= len(leaves) <= 6 and compared[0] == 1 and all(n <= 4 * 6 for n in compared)
    rows = read_leaves(spark, f"{folder}/old", pair[0].schema, leaves, SHAPE)
    assert 0 < rows.count() < 400
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "_folder" in plan.split("PartitionFilters: [")[1].split("]")[0] and f"In({LEAF}" in plan.replace("`", "")
    # A snapshot against itself: one row of each tree, and no rows at all.
    assert differing(spark, f"{folder}/old", f"{folder}/old", SHAPE) == ([], [1])
    same = diff(spark, folder, "old", "old")
    assert same.isEmpty() and "FileScan" not in same._jdf.queryExecution().optimizedPlan().toString()


def test_files_are_skipped_where_nothing_differs(spark, folder, pair):
    leaves, _ = differing(spark, f"{folder}/old", f"{folder}/new", SHAPE)
    one = read_leaves(spark, f"{folder}/old", pair[0].schema, leaves[:1], SHAPE)
    assert len(one.select(F.input_file_name()).distinct().collect()) == 1
    assert len(glob.glob(f"{folder}/old/rows/*/*.parquet")) >= 4


def test_empty_snapshots(spark, folder, pair):
    write_digested(snapshot(spark, {}), f"{folder}/none", ["k", "part"], ["v", "w"], SHAPE)
    got = diff(spark, folder, "none", "new")
    assert got.count() == pair[1].count() and got.where("action <> 'insert'").isEmpty()
    assert diff(spark, folder, "none", "none").isEmpty()


def test_digests_do_not_depend_on_order_but_on_every_value(spark):
    rows = [(k, None, "x", float(k)) for k in range(300)]
    leaf = F.pmod(F.col("k"), F.lit(64)).cast("int")
    columns = ["k", "part", "v", "w"]

    def tree(rows):
        return as_set(digest_tree(spark.createDataFrame(rows, SCHEMA).withColumn(LEAF, leaf).repartition(5), columns, SHAPE))

    whole = tree(rows)
    assert whole == tree(rows[::-1]) and {(n, c) for level, n, c, *_ in whole if level == 0} == {(0, 300)}
    # A value that moves to the next column, or is null instead of empty, is another row.
    assert len(whole ^ tree([*rows[:-1], (299, "x", None, 299.0)])) == 2 * 4
    assert len(tree([(1, None, "", 1.0)]) ^ tree([(1, None, None, 1.0)])) == 2 * 4


def test_a_hash_of_leaves_fits_the_shape(spark):
    shape = Shape(fan=16, levels=3)
    nodes = spark.range(shape.leaves).select(*[shape.node(F.col("id"), n).alias(f"n{n}") for n in range(4)])
    assert [nodes.select(f"n{n}").distinct().count() for n in range(4)] == [1, 16, 256, 4096]
