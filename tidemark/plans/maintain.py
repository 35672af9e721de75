"""Gold kept up by signed changes of the history, so that what is written follows what changed.

Each table of gold is a ``ChangeLog`` next to the history: the fact by entity,
dimension members with the number of current entities that have them, and the
rollup by group. A refresh takes what has happened to the open versions since a table's last one:
rows that went count -1, rows that came 1, with the columns that gold has. Dimensions and
rollup come from their counts by location and kind, summed in one pass. Members and groups without entities go. A group
that lost the row with its latest time has it looked up again, no other is.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.model import (
    KIND_SK,
    LOCATION_SK,
    fact_mapping,
    fact_sk,
    kind_dim_sk,
    location_columns,
    location_dim_sk,
    surrogate_key,
)
from tidemark.operators.ordered import latest_per_key
from tidemark.schema import DEFAULT_SPEC, EntitySpec
from tidemark.session import scratch_path
from tidemark.sources.changes import BUCKETS, GONE, SIGN, ChangeLog, VersionLog
from tidemark.sources.tables import WriteMetrics, read_table, write_table

GROUP_SK, MEMBERS = "group_sk", "member_count"
FACT, LOCATION, KIND, ROLLUP = "fact", "location", "kind", "rollup"


def gold_logs(
    spark: SparkSession, out: str, history: T.StructType, spec: EntitySpec = DEFAULT_SPEC, buckets: int = BUCKETS
) -> dict[str, ChangeLog]:
    """The four tables below ``out``, for a history with these columns."""
    empty = spark.createDataFrame([], history)
    groups = [f for f in history if f.name in _group(spec)]
    rollup = T.StructType([T.StructField(GROUP_SK, T.BinaryType()), *groups]).add(spec.count_column, "long")
    tables = {
        FACT: (fact_sk(empty, spec).schema, spec.id_column),
        LOCATION: (location_dim_sk(empty, spec).schema.add(MEMBERS, "long"), LOCATION_SK),
        KIND: (kind_dim_sk(empty, spec).schema.add(MEMBERS, "long"), KIND_SK),
        ROLLUP: (rollup.add("last_updated", history["updated_at"].dataType), GROUP_SK),
    }
    # Facts are as many as entities and lie as the history does. Members and groups are fewer.
    fewer = max(min(buckets, BUCKETS), buckets // BUCKETS)
    return {
        n: ChangeLog(spark, f"{out}/{n}", columns, (key,), buckets=buckets if n == FACT else fewer)
        for n, (columns, key) in tables.items()
    }


def _group(spec: EntitySpec) -> list[str]:
    return [*spec.location, spec.kind]


def _used(history: VersionLog, spec: EntitySpec) -> T.StructType:
    """The columns of the history that gold is made of."""
    names = {*fact_mapping(spec), *location_columns(spec), spec.kind, "updated_at", *history.keys}
    return T.StructType([f for f in history.columns if f.name in names])


def _cells(signed: DataFrame, spec: EntitySpec) -> DataFrame:
    """Location and kind with the net of entities (``_net``) and the latest time that came and went, stored."""
    at = F.col("updated_at")
    cells = signed.groupBy(*location_columns(spec), spec.kind).agg(
        F.sum(SIGN).alias("_net"),
        F.max(F.when(F.col(SIGN) > 0, at)).alias("_come"),
        F.max(F.when(F.col(SIGN) < 0, at)).alias("_went"),
    )
    written = write_table(cells, scratch_path(signed.sparkSession, "cells"))
    return read_table(signed.sparkSession, written.path, schema=cells.schema)


def refresh(history: VersionLog, logs: dict[str, ChangeLog], spec: EntitySpec = DEFAULT_SPEC) -> dict[str, WriteMetrics]:
    """Bring each table up to the newest batch of the history; what was written, by table.

    A table's batches are named after the history's, so one that failed half-way goes on
    from where it was, and a refresh without news writes nothing.
    """
    batches = history.batches()
    steps = {FACT: _facts, LOCATION: _locations, KIND: _kinds, ROLLUP: _rollup}
    written, signed, cells, stored = {}, {}, {}, []
    for name, log in logs.items():
        after = max(log.runs(), default="")
        if not batches or after == batches[-1]:
            continue
        if after not in signed:
            # Stored: all tables read it, and it is as small as the changes. It lies as the history does.
            used = _used(history, spec)
            path, columns = scratch_path(history.spark, "signed"), T.StructType(list(used)).add(SIGN, T.IntegerType())
            changes = ChangeLog(history.spark, path, columns, (*history.keys, SIGN), history.by, history.width())
            changes.take("all", lambda: history.signed(after, batches[-1], used.names), placed=True)
            stored.append(changes)
            signed[after] = changes.rows().select(*columns.names)
        if name != FACT and after not in cells:
            cells[after] = _cells(signed[after], spec)
        rows = signed[after] if name == FACT else cells[after]
        placed = name == FACT and log.width() == history.width()
        written[name] = log.take(batches[-1], lambda: steps[name](rows, log, history, batches[-1], spec), placed=placed)
    for changes in stored:
        changes.forget()
    return written


def _facts(signed: DataFrame, log: ChangeLog, history: VersionLog, upto: str, spec: EntitySpec) -> DataFrame:
    # What came counts before what went; an entity of which only something went is gone.
    last = latest_per_key(signed, [spec.id], [SIGN])
    return fact_sk(last.withColumn(GONE, F.col(SIGN) < 0), spec, GONE)


def _counted(cells: DataFrame, name: str, columns: dict[str, str], log: ChangeLog) -> DataFrame:
    """Each member that gained or lost entities: the net and times, and what the table has of it as ``_old``."""
    net = cells.groupBy(*[F.col(c).alias(n) for c, n in columns.items()]).agg(
        F.sum("_net").alias("_net"), F.max("_come").alias("_come"), F.max("_went").alias("_went")
    )
    net = net.withColumn(name, surrogate_key(net, list(columns.values())))
    old = log.read().select(name, F.struct(*log.columns.names).alias("_old"))
    return net.join(old, name, "left")


def _count(column: str) -> Column:
    total = F.coalesce(F.col("_old")[column], F.lit(0)) + F.col("_net")
    below = F.raise_error(F.lit("more entities went than there were"))
    return F.when(total < 0, below).otherwise(total).cast("long")


def _members(cells: DataFrame, log: ChangeLog, name: str, columns: dict[str, str]) -> DataFrame:
    found = _counted(cells, name, columns, log)
    count = _count(MEMBERS)
    return found.where(F.col("_net") != 0).select(
        name, *columns.values(), count.alias(MEMBERS), (count == 0).alias(GONE)
    )


def _locations(cells: DataFrame, log: ChangeLog, history: VersionLog, upto: str, spec: EntitySpec) -> DataFrame:
    return _members(cells, log, LOCATION_SK, {c: f"{c}_name" if c in spec.location else c for c in location_columns(spec)})


def _kinds(cells: DataFrame, log: ChangeLog, history: VersionLog, upto: str, spec: EntitySpec) -> DataFrame:
    return _members(cells, log, KIND_SK, {spec.kind: spec.kind_name})


def _rollup(cells: DataFrame, log: ChangeLog, history: VersionLog, upto: str, spec: EntitySpec) -> DataFrame:
    group = _group(spec)
    found = _counted(cells, GROUP_SK, {c: c for c in group}, log)
    count, last = _count(spec.count_column), F.col("_old")["last_updated"]
    # The latest row went and none as late came: the next to latest is not known.
    lost = (F.col("_went") >= last) & ~F.coalesce(F.col("_come") >= last, F.lit(False)) & (count > 0)
    latest = F.greatest(last, "_come")
    losers = found.where(F.coalesce(lost, F.lit(False))).select(GROUP_SK)
    if not losers.isEmpty():
        opened = history.opened(upto)
        keyed = opened.select(surrogate_key(opened, group).alias(GROUP_SK), "updated_at")
        again = keyed.join(losers, GROUP_SK, "left_semi").groupBy(GROUP_SK).agg(F.max("updated_at").alias("_again"))
        found = found.join(again, GROUP_SK, "left")
        latest = F.when(F.coalesce(lost, F.lit(False)), F.col("_again")).otherwise(latest)
    news = (F.col("_net") != 0) | ~latest.eqNullSafe(last)
    return found.where(news).select(
        GROUP_SK, *group, count.alias(spec.count_column), latest.alias("last_updated"), (count == 0).alias(GONE)
    )


def read_rollup(logs: dict[str, ChangeLog]) -> DataFrame:
    return logs[ROLLUP].read().drop(GROUP_SK)


def read_dimensions(logs: dict[str, ChangeLog]) -> tuple[DataFrame, DataFrame]:
    """Locations and kinds of current entities, with their surrogate keys."""
    return logs[LOCATION].read().drop(MEMBERS), logs[KIND].read().drop(MEMBERS)


def rows_written(written: dict[str, WriteMetrics]) -> int:
    return reduce(lambda n, m: n + m.rows, written.values(), 0)
