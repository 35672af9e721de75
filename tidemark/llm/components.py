"""Connected components of a graph given as links, by repeated contraction to the smallest neighbour."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored

# Links that a task holds at a time while it contracts its own.
BATCH = 200_000


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (node, smallest node of its component) with the components of the given links."""
    nodes, where = np.unique(np.concatenate([a, b]), return_inverse=True)
    root = np.arange(len(nodes))
    left, right = where[: len(a)], where[len(a) :]
    while True:
        low = np.minimum(root[left], root[right])
        new = root.copy()
        np.minimum.at(new, root[left], low)
        np.minimum.at(new, root[right], low)
        while True:
            next_ = new[new]
            if (next_ == new).all():
                break
            new = next_
        if (new == root).all():
            break
        root = new
    far = root != np.arange(len(nodes))
    return nodes[far], nodes[root[far]]


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def links(a, b):
        node, root = forest(np.concatenate(a), np.concatenate(b))
        return pa.record_batch({"a": pa.array(node, pa.string()), "b": pa.array(root, pa.string())})

    a, b, held = [], [], 0
    for batch in batches:
        a.append(batch["a"].to_numpy(zero_copy_only=False))
        b.append(batch["b"].to_numpy(zero_copy_only=False))
        held += batch.num_rows
        if held >= BATCH:
            yield links(a, b)
            a, b, held = [], [], 0
    if held:
        yield links(a, b)


def _star(links: DataFrame) -> DataFrame:
    """Links (a, b), a > b, become (a, m) and (b, m), m the smallest b of a."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    joined = links.join(least, "a")
    return joined.select(F.explode(F.array(F.struct("a", "m"), F.struct(F.col("b").alias("a"), "m"))).alias("l")).select(
        F.col("l.a").alias("a"), F.col("l.m").alias("b")
    )


def _spread(links: DataFrame) -> DataFrame:
    """Each node's larger neighbours are linked to its smallest one."""
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def components(links: DataFrame) -> DataFrame:
    """node, root for every node of ``links`` (a, b: text); root is the component's smallest node.

    Tasks first contract the links they hold. Then, in turns, a node's larger
    neighbours and its smaller ones are linked to its smallest neighbour, until
    nothing changes; the number of turns grows with the logarithm of the size.
    Minima are combined before they are shuffled, and every turn is written to
    the shared folder. Links of a node to itself add nothing; nodes without
    links are not in the result.
    """
    links = links.where("a <> b").mapInArrow(_contract, "a string, b string")
    links = stored(links.where("a > b").distinct(), "links")
    mark = None
    while True:
        turned = _star(_spread(links)).where("a > b").distinct()
        links = stored(turned, "links")
        row = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if (row[0], row[1]) == mark:
            break
        mark = (row[0], row[1])
    roots = links.select("b").distinct().select(F.col("b").alias("node"), F.col("b").alias("root"))
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
