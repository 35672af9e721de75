"""Point-in-time joins with small dimensions, as equi-joins on key and time bucket."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.scd2 import scd2_point_in_time
from tidemark.schema import VALID_FROM, VALID_TO

# A dimension that takes up more, spread over its buckets, is not sent to every task.
MOST_BYTES = 32 << 20
# A version's buckets on average, where the size allows; more make buckets that hold fewer versions.
SPANNED = 4


def _day(at: Column) -> Column:
    """Days since 1970: follows the order of instants, whatever the type of time and the zone."""
    return F.datediff(at.cast("date"), F.lit("1970-01-01").cast("date"))


def version_buckets(versions: DataFrame, days: int, first: int, last: int) -> DataFrame:
    """``versions`` once for every bucket of ``days`` days they span, of the buckets from day ``first`` to ``last``."""
    begin = F.greatest(_day(F.col(VALID_FROM)), F.lit(first))
    end = F.least(F.coalesce(_day(F.col(VALID_TO)), F.lit(last)), F.lit(last))
    within = versions.withColumns({"_begin": F.floor(begin / days), "_end": F.floor(end / days)})
    spans = F.sequence("_begin", "_end")
    return within.where(begin <= end).withColumn("_bucket", F.explode(spans)).drop("_begin", "_end")


def point_in_time(
    facts: DataFrame,
    versions: DataFrame,
    keys: Sequence[str],
    at: str,
    attributes: Sequence[str],
    how: str = "left",
    most_bytes: int = MOST_BYTES,
    **options,
) -> DataFrame:
    """``scd2_point_in_time``, without moving the facts where the dimension is small.

    Versions are put into each bucket of days they span, and facts meet them on
    key and bucket, in a broadcast join, where they stay. How wide a bucket is follows
    from the versions: wide enough for ``SPANNED`` buckets to each on average. The size of what would
    be sent is measured first, in one pass over the versions and one over the facts' times; a dimension
    beyond ``most_bytes`` goes through the ordered scan, with its ``options``.

    The history must be sound (``scd2_check``): of overlapping versions a fact meets each.
    Facts without a key, a time or a version get nulls, or go with ``how="inner"``.
    """
    if how not in ("left", "inner"):
        raise ValueError("how is 'left' or 'inner'")
    attributes = list(attributes)
    kept = list(dict.fromkeys([*keys, VALID_FROM, VALID_TO, *attributes]))
    held = versions.select(*kept)
    times = facts.agg(F.min(_day(F.col(at))).alias("first"), F.max(_day(F.col(at))).alias("last")).first()
    if times.first is None:
        first, last = 0, 0
    else:
        first, last = times.first, times.last
    begin = F.greatest(_day(F.col(VALID_FROM)), F.lit(first))
    end = F.least(F.coalesce(_day(F.col(VALID_TO)), F.lit(last)), F.lit(last))
    size = F.octet_length(F.to_json(F.struct(*kept))) + F.lit(64)
    totals = held.where(begin <= end).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(size).alias("bytes"), F.sum((end - begin).cast("long")).alias("days")
    ).first()
    days = max(1, (totals.days or 0) // max(1, totals.rows * (SPANNED - 1)))
    if (totals.bytes or 0) * (1 + (totals.days or 0) / (max(1, totals.rows) * days)) > most_bytes:
        return scd2_point_in_time(facts, versions, keys, at, attributes, how, **options)

    names = {c: f"_v_{c}" for c in kept}
    spread = version_buckets(held, days, first, last).withColumnsRenamed(names)
    facts_at = F.col(at)
    valid = F.floor(_day(facts_at) / days) == F.col("_bucket")
    valid = valid & (F.col(names[VALID_FROM]) <= facts_at)
    valid = valid & (F.col(names[VALID_TO]).isNull() | (facts_at < F.col(names[VALID_TO])))
    for k in keys:
        valid = valid & (F.col(k) == F.col(names[k]))
    joined = facts.join(F.broadcast(spread), valid, how)
    return joined.select(*[facts[c] for c in facts.columns], *[F.col(names[c]).alias(c) for c in attributes])
