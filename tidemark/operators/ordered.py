"""Ordered scans per key that survive hot keys.

A window over one key sorts all rows of the key in one task. That is fine until
a key holds a large part of the table. Here the rows of such hot keys are cut
into ranges of the ordering column, each range is a window of its own, and what
a range needs from its neighbours is carried over: one row per range, not one
per input row. All rows take part and the results do not depend on the cuts.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RANGE = "_range"
COLD = -1  # range of all keys that are not hot

# Rows that a task may have of one key before the key is cut.
ROWS_PER_TASK = 1_000_000
# Steps of the quantiles that cuts are taken from, and rows looked at to place one cut.
MAX_CUTS = 4096
ROWS_PER_CUT = 100
_BLOCK = 64  # cuts are looked up block by block


@dataclass(frozen=True)
class Ranges:
    """The cuts of the hot keys, a local table of the keys and their sorted ``_cuts``."""

    keys: tuple[str, ...]
    cuts: DataFrame


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of each key by ``order``, which should be a total order.

    Spark keeps only the first-ranked row of a key on each side of the shuffle
    (a partial window group limit), so duplicates of a hot key are dropped
    before they travel.
    """
    last_first = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in order])
    ranked = df.withColumn("_rank", F.row_number().over(last_first))
    return ranked.where(F.col("_rank") == 1).drop("_rank")


def hot_keys(
    df: DataFrame, keys: Sequence[str], parts: int | None, min_rows: int
) -> DataFrame | None:
    """Keys with more rows than a task should have, as a local table, or None.

    That is ``min_rows``, or an equal share of all rows for each of ``parts``
    tasks if that is more. Fewer keys than all rows divided by it can qualify,
    which bounds what comes to the driver and what is broadcast later. Null
    keys never match anything and are left out. Runs one job: a count per key,
    combined before the shuffle.
    """
    counts = df.dropna(subset=list(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    most = F.lit(float(max(min_rows, 1)))
    if parts:
        most = F.greatest(most, F.lit(df.agg(F.count(F.lit(1))).scalar() / parts))
    hot = counts.where(F.col("_rows") > most).select(
        *keys, "_rows", F.least(F.ceil(F.col("_rows") / most), F.lit(MAX_CUTS)).alias("_wanted")
    )
    found = hot.toArrow()
    return df.sparkSession.createDataFrame(found, hot.schema) if found.num_rows else None


def default_parts(df: DataFrame) -> int:
    """As many parts as a shuffle has."""
    return max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def _place_cuts(df: DataFrame, keys: Sequence[str], order: str, hot: DataFrame) -> Ranges:
    """Quantiles of ``order`` for each hot key, as many as its weight asks for.

    Where a cut lies changes no result, so it is enough to look at some rows of
    each key, picked by a hash of the row: about ``ROWS_PER_CUT`` per cut, also
    where the key has few instants. An instant with many rows is several cuts.
    """
    one_in = F.greatest(F.floor(F.col("_rows") / (F.col("_wanted") * ROWS_PER_CUT)), F.lit(1))
    seen = df.join(F.broadcast(hot), list(keys)).where(
        F.pmod(F.xxhash64(*[df[c] for c in df.columns]), one_in) == 0
    )
    steps = [i / MAX_CUTS for i in range(1, MAX_CUTS)]
    every = F.ceil(F.lit(MAX_CUTS) / F.col("_wanted")).cast("int")
    cuts = (
        seen.groupBy(*keys, "_wanted")
        .agg(F.percentile_approx(order, steps).alias("_cuts"))
        .select(*keys, F.filter("_cuts", lambda _, i: (i + 1) % every == 0).alias("_cuts"))
    )
    return Ranges(tuple(keys), df.sparkSession.createDataFrame(cuts.toArrow(), cuts.schema))


def _below(cuts: Column, at: Column) -> Column:
    """How many of the sorted ``cuts`` are below ``at``."""
    block_ends = F.filter(cuts, lambda _, i: i % _BLOCK == _BLOCK - 1)
    below = F.size(F.filter(block_ends, lambda c: c < at)) * _BLOCK
    return below + F.size(F.filter(F.slice(cuts, below + 1, F.lit(_BLOCK)), lambda c: c < at))


def _range(cuts: Column, at: Column, spread: Column | None) -> Column:
    """The range of an instant: what lies below the cut at it, or the first one from it on.

    Several cuts at one instant are as many ranges, all of that instant; rows
    with a ``spread`` are dealt over them, others belong to the first.
    """
    below = _below(cuts, at)
    equal = F.array_position(F.slice(cuts, below + 1, F.size(cuts)), at) == 1
    if spread is None:
        return below + F.when(equal, 1).otherwise(0)
    many = F.size(F.filter(cuts, lambda c: c == at))
    part = F.when(spread.isNull(), 0).otherwise(F.pmod(spread, many).cast("int"))
    return below + F.when(equal, 1 + part).otherwise(0)


def split_hot_keys(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    parts: int | None = None,
    min_rows: int | None = None,
    weigh: DataFrame | None = None,
    spread: Column | None = None,
) -> tuple[DataFrame, Ranges | None]:
    """``df`` with a ``RANGE`` column, and the cuts (None if no key is hot).

    Keys are counted in ``weigh`` where given: the stored table that ``df`` is
    derived from, if counting there is cheaper and keys are as frequent.

    Rows of one instant are in one range, but for those with a ``spread``
    number: where an instant alone is heavy, these are dealt over ranges that
    all lie at it, behind the rows without one.

    The cuts are taken once and then fixed as a local table, so every branch of
    the plan sees the same ranges. Their number follows the weight of the keys.
    """
    least = ROWS_PER_TASK if min_rows is None else min_rows
    hot = hot_keys(df if weigh is None else weigh, keys, parts, least)
    if hot is None:
        return df.withColumn(RANGE, F.lit(COLD)), None
    ranges = _place_cuts(df, keys, order, hot)
    rows = df.join(F.broadcast(ranges.cuts), list(keys), "left").select(
        *[df[c] for c in df.columns],
        F.when(F.col("_cuts").isNull(), COLD)
        .otherwise(_range(F.col("_cuts"), F.col(order), spread))
        .alias(RANGE),
    )
    return rows, ranges


def within_ranges(keys: Sequence[str], *order: str | Column):
    """The window of one key, or of one range of a hot key."""
    return Window.partitionBy(*keys, RANGE).orderBy(*order)


def carry_forward(edges: DataFrame, ranges: Ranges, value: str) -> DataFrame:
    """For each range the ``value`` of the nearest earlier range in ``edges``."""
    keys = list(ranges.keys)
    last = ranges.cuts.select(*keys, F.size("_cuts").alias("_last"))
    following = F.lead(RANGE).over(Window.partitionBy(*keys).orderBy(RANGE))
    return (
        edges.withColumn("_following", following)
        .join(F.broadcast(last), keys)
        .withColumn("_until", F.coalesce("_following", "_last"))
        .where(F.col(RANGE) < F.col("_until"))
        .select(*keys, F.explode(F.sequence(F.col(RANGE) + 1, "_until")).alias(RANGE), value)
    )


def carry_backward(edges: DataFrame, ranges: Ranges, value: str) -> DataFrame:
    """For each range the ``value`` of the nearest later range in ``edges``."""
    keys = list(ranges.keys)
    previous = F.lag(RANGE).over(Window.partitionBy(*keys).orderBy(RANGE))
    return edges.withColumn("_from", F.coalesce(previous, F.lit(COLD))).select(
        *keys, F.explode(F.sequence("_from", F.col(RANGE) - 1)).alias(RANGE), value
    )
