"""Facts that keep the key of the dimension's version they belong to.

A fact gets, when it is loaded, the start of the version of its entity that was
valid at its time. With entity and start it names one row of the history, so the star
over history is an equi-join: what held then, not what holds now. When late runs
change the history, the facts of the entities they touched are looked at again, from the
first changed instant on, and those that now belong to another version are
written; the others stay as they are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.intervals import point_in_time
from tidemark.operators.scd2 import scd2_as_of
from tidemark.schema import VALID_FROM, VALID_TO
from tidemark.sources.changes import BUCKETS, ChangeLog, VersionLog
from tidemark.sources.tables import WriteMetrics

VERSION = "version_from"
# Runs of a fact table: facts that came, and batches of the history that were followed.
LOADED, FOLLOWED = "f.", "h."


def fact_table(
    spark: SparkSession,
    path: str,
    columns: T.StructType,
    fact_keys: tuple[str, ...],
    entity_keys: tuple[str, ...],
    time_type: T.DataType,
    buckets: int = BUCKETS,
) -> ChangeLog:
    """A stored fact with ``VERSION``, one row per ``fact_keys``, bucketed by entity."""
    return ChangeLog(spark, path, T.StructType(list(columns)).add(VERSION, time_type), fact_keys, entity_keys, buckets)


def _assigned(facts: DataFrame, history: DataFrame, keys: Sequence[str], at: str) -> DataFrame:
    versions = history.select(*keys, F.col(VALID_FROM), F.col(VALID_TO), F.col(VALID_FROM).alias(VERSION))
    return point_in_time(facts, versions, keys, at, [VERSION])


def load_facts(log: ChangeLog, run: str, facts: DataFrame, history: VersionLog, at: str) -> WriteMetrics | None:
    """Add facts, each with its version as the history has it now; once per run. None if it was taken before.

    A fact without a version yet (its entity is not known, or not at that time) gets null
    and is found again when the history learns of one.
    """
    columns = [c for c in log.columns.names if c != VERSION]
    return log.take(LOADED + run, lambda: _assigned(facts.select(*columns), history.read(), list(history.by), at))


def follow_history(log: ChangeLog, history: VersionLog, at: str) -> WriteMetrics | None:
    """Give the facts that changes of the history touch their version anew; None if there is no news.

    Per entity only facts from the first changed instant on are read on, and only those
    that change their version are written.
    """
    batches = history.batches()
    after = max((r.removeprefix(FOLLOWED) for r in log.runs() if r.startswith(FOLLOWED)), default="")
    if not batches or after == batches[-1]:
        return None
    keys = list(history.by)
    since = history.rows(batches[-1], after).groupBy(*keys).agg(F.min(VALID_FROM).alias("_since"))

    def moved() -> DataFrame:
        old = log.read().join(since, keys).where(F.col(at) >= F.col("_since")).drop("_since")
        # A version that was there before its change ends, or begins, no earlier than that.
        versions = history.read(batches[-1]).join(since, keys, "left_semi")
        columns = [c for c in log.columns.names if c != VERSION]
        again = _assigned(old.select(*columns, F.col(VERSION).alias("_was")), versions, keys, at)
        return again.where(~F.col(VERSION).eqNullSafe(F.col("_was"))).drop("_was")

    return log.take(FOLLOWED + batches[-1], moved)


def star_then(log: ChangeLog, history: VersionLog, attributes: Sequence[str]) -> DataFrame:
    """Every fact with the ``attributes`` its entity had at the fact's time; null where there was no version."""
    return _star(log, history.read(), list(history.by), attributes, True)


def star_as_of(log: ChangeLog, history: VersionLog, attributes: Sequence[str], at: str, instant) -> DataFrame:
    """The facts up to ``instant`` with the ``attributes`` their entities had at that instant, as if built that day."""
    then = scd2_as_of(history.read(), instant)
    return _star(log, then, list(history.by), attributes, False, F.col(at) <= instant)


def _star(
    log: ChangeLog, versions: DataFrame, keys: list[str], attributes: Sequence[str], exact: bool, when: Column | None = None
) -> DataFrame:
    facts = log.read() if when is None else log.read().where(when)
    on = [*keys, VERSION] if exact else keys
    rows = versions.select(*keys, *([F.col(VALID_FROM).alias(VERSION)] if exact else []), *attributes)
    return facts.join(rows, on, "left").select(*log.columns.names, *attributes)
