"""Differences of two stored snapshots by trees of digests, reading only what differs.

Keys are dealt by hash into leaves, the same ones in every snapshot. A snapshot is
stored leaf by leaf, with a tree over the leaves: each node has the number of its rows and
an order-free digest of them. Two trees are compared from the root down, only
below nodes that differ, and then the rows of differing leaves are read, no others.
A snapshot in which nothing changed costs one comparison of two rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.scd2 import snapshot_diff
from tidemark.sources.tables import WriteMetrics, read_table, write_table

# Children of a node and levels below the root: FAN ** LEVELS leaves. Leaves of one folder share their node on level FOLDERS.
FAN, LEVELS, FOLDERS = 16, 3, 1
LEAF, FOLDER = "_leaf", "_folder"
TREE = T.StructType().add("level", "integer").add("node", "integer").add("row_count", "long").add("low", "long").add("high", "long")


@dataclass(frozen=True)
class Shape:
    """How wide and deep the trees are; trees of one shape can be compared."""

    fan: int = FAN
    levels: int = LEVELS
    folders: int = FOLDERS

    @property
    def leaves(self) -> int:
        return self.fan**self.levels

    def node(self, leaf: Column, level: int) -> Column:
        """The node on ``level`` (the root is on 0) that a leaf is below."""
        return F.floor(leaf / self.fan ** (self.levels - level)).cast("int")


def row_digest(columns: Sequence[str], seed: int) -> Column:
    """A hash of a row's values; nulls count, so a value does not slip into the next column."""
    values = [v for c in columns for v in (F.col(c).isNull(), F.col(c))]
    return F.xxhash64(F.lit(seed), *values)


def digest_tree(leaves: DataFrame, columns: Sequence[str], shape: Shape = Shape()) -> DataFrame:
    """level, node, row_count, low, high of every node that has rows, from rows with their ``LEAF``.

    A digest is the exclusive or of two independent 64-bit hashes of its rows;
    rows differ, for keys come once. Rows are combined in their task, so a leaf's
    digest travels as one row per task, and upper levels are made of the leaves'.
    """
    low, high = (row_digest(columns, s).alias(n) for n, s in (("low", 1), ("high", 2)))
    rows = leaves.select(F.col(LEAF).alias("node"), F.lit(1).cast("long").alias("row_count"), low, high)
    sums = (F.sum("row_count").alias("row_count"), F.bit_xor("low").alias("low"), F.bit_xor("high").alias("high"))
    bottom = rows.groupBy("node").agg(*sums)
    levels = F.array(*[F.struct(F.lit(n).alias("level"), shape.node(F.col("node"), n).alias("node")) for n in range(shape.levels + 1)])
    every = bottom.select(F.explode(levels).alias("_at"), "row_count", "low", "high")
    return every.groupBy("_at.level", "_at.node").agg(*sums).select(*TREE.names)


def write_digested(
    df: DataFrame, path: str, keys: Sequence[str], tracked: Sequence[str], shape: Shape = Shape()
) -> list[WriteMetrics]:
    """Store a snapshot below ``path`` leaf by leaf, and its tree; two writes.

    Keys come once. The tree is made from what was stored, so it fits the rows also where a
    task ran twice. Leaves of a folder are sorted, so reading a leaf skips most of a file.
    """
    leaf = F.pmod(F.xxhash64(*[v for k in keys for v in (F.col(k).isNull(), F.col(k))]), F.lit(shape.leaves)).cast("int")
    placed = df.select(*keys, *[c for c in tracked if c not in keys]).withColumn(LEAF, leaf)
    placed = placed.withColumn(FOLDER, shape.node(F.col(LEAF), shape.folders))
    dealt = placed.repartition(FOLDER).sortWithinPartitions(FOLDER, LEAF)
    rows = write_table(dealt, f"{path}/rows", partition_by=[FOLDER], gather=False)
    stored = read_table(df.sparkSession, f"{path}/rows", schema=placed.schema)
    tree = digest_tree(stored, [c for c in placed.columns if c not in (LEAF, FOLDER)], shape)
    return [rows, write_table(tree, f"{path}/tree", partition_by=["level"])]


def differing(spark: SparkSession, old: str, new: str, shape: Shape = Shape()) -> tuple[list[int], list[int]]:
    """Leaves in which two stored snapshots differ, and how many nodes were compared on each level.

    Goes down from the root; a level is read as far as it is below nodes that
    differ. What comes to the driver is numbers of nodes, ``shape.leaves`` at most.
    """
    trees = [read_table(spark, f"{path}/tree", schema=TREE) for path in (old, new)]
    nodes, compared = [0], []
    for level in range(shape.levels + 1):
        if not nodes:
            break
        left, right = (t.where((F.col("level") == level) & F.col("node").isin(nodes)).drop("level") for t in trees)
        compared.append(len(nodes))
        pair = left.select("node", F.struct("row_count", "low", "high").alias("_old")).join(
            right.select("node", F.struct("row_count", "low", "high").alias("_new")), "node", "full_outer"
        )
        found = [r.node for r in pair.where(~F.col("_old").eqNullSafe(F.col("_new"))).select("node").collect()]
        nodes = sorted(found) if level == shape.levels else sorted(n * shape.fan + k for n in found for k in range(shape.fan))
    return nodes, compared


def read_leaves(
    spark: SparkSession, path: str, schema: T.StructType, leaves: Sequence[int], shape: Shape = Shape()
) -> DataFrame:
    """The rows of some leaves: other folders are not opened, other leaves of a file mostly skipped."""
    stored = T.StructType(list(schema)).add(LEAF, "integer").add(FOLDER, "integer")
    rows = read_table(spark, f"{path}/rows", schema=stored)
    folders = sorted({leaf // shape.fan ** (shape.levels - shape.folders) for leaf in leaves})
    wanted = F.lit(False)
    if len(leaves):
        wanted = F.col(FOLDER).isin(folders) & F.col(LEAF).isin(list(leaves))
    return rows.where(wanted).select(*schema.names)


def digest_diff(
    spark: SparkSession,
    old: str,
    new: str,
    schema: T.StructType,
    keys: Sequence[str],
    tracked: Sequence[str],
    shape: Shape = Shape(),
) -> DataFrame:
    """What ``snapshot_diff`` says of two stored snapshots, but for keys that are the ``same``.

    ``schema`` has the keys and tracked columns. Unlike rows escape with a chance of
    2^-128 for each pair of leaves.
    """
    leaves, _ = differing(spark, old, new, shape)
    sides = [read_leaves(spark, path, schema, leaves, shape) for path in (old, new)]
    return snapshot_diff(*sides, keys, tracked).where("action <> 'same'")
