"""Finished snapshots picked up as they are announced, with Structured Streaming.

The unit of both streams is a finished run, never a file: the streamed lines say
that a run is complete, and the step for a line takes every finished run that
is not done yet, in run order and one at a time. What is done is read from the
output, so a replayed batch, a restart and any number of runs since the last
start give the same result. A run that finishes after a later one was taken is
taken then, and the result is that of the right order.
"""

from __future__ import annotations

from collections.abc import Callable, Collection, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.ordered import latest_per_key
from tidemark.operators.scd2 import scd2_extend, scd2_merge, scd2_splice, scd2_splice_log
from tidemark.plans.conform import conform
from tidemark.schema import DEFAULT_SPEC, ENTITY_SCHEMA, IS_CURRENT, VALID_FROM, EntitySpec
from tidemark.sources.changes import VersionLog
from tidemark.sources.files import entries, exists
from tidemark.sources.snapshot import (
    FINISHED,
    RUN_COLUMNS,
    Snapshot,
    finished_runs,
    open_runs,
    read_snapshot,
    union_pages,
)
from tidemark.sources.tables import write_table


def follow_runs(
    spark: SparkSession,
    base: str,
    checkpoint: str,
    done: Callable[[], Collection[str]],
    take: Callable[[Snapshot, list[Snapshot]], None],
) -> StreamingQuery:
    """``take`` every finished run that is not ``done``, with the later runs that are, then stop."""
    # The stream needs the folder to be there, runs or not.
    if not exists(spark, f"{base}/{FINISHED}"):
        spark.createDataFrame([], RUN_COLUMNS).write.mode("append").json(f"{base}/{FINISHED}")

    def apply(lines: DataFrame, batch_id: int) -> None:
        if not lines.isEmpty():
            for run, later in open_runs(finished_runs(spark, base), done()):
                take(run, later)

    return (
        spark.readStream.schema(RUN_COLUMNS)
        .json(f"{base}/{FINISHED}")
        .writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stream_silver(
    spark: SparkSession,
    base: str,
    out: str,
    checkpoint: str,
    schema: T.StructType = ENTITY_SCHEMA,
    spec: EntitySpec = DEFAULT_SPEC,
) -> StreamingQuery:
    """Conform every run that finished since the last start, each into a folder of its own.

    Read the result with ``read_silver``: only the latest run's rows are current.
    """

    def taken() -> list[str]:
        return sorted(n for n in entries(spark, out) if n.startswith("run=") and exists(spark, f"{out}/{n}/_SUCCESS"))

    def done() -> list[str]:
        return [n.removeprefix("run=") for n in taken()]

    def take(run: Snapshot, later: list[Snapshot]) -> None:
        write_table(conform(read_snapshot(spark, run, schema), spec), f"{out}/run={run.run}")

    return follow_runs(spark, base, checkpoint, done, take)


def read_silver(
    spark: SparkSession, out: str, schema: T.StructType = ENTITY_SCHEMA, spec: EntitySpec = DEFAULT_SPEC
) -> DataFrame:
    """All conformed runs with their ``run``; rows of the latest one are current, no others."""
    conformed = conform(spark.createDataFrame([], schema), spec).schema
    runs = sorted(n for n in entries(spark, out) if n.startswith("run=") and exists(spark, f"{out}/{n}/_SUCCESS"))
    kept = T.StructType(list(conformed)).add("run", T.StringType())
    if not runs:
        return spark.createDataFrame([], kept)
    rows = spark.read.schema(kept).option("basePath", out).parquet(*[f"{out}/{n}" for n in runs])
    return rows.withColumn(IS_CURRENT, F.col("run") == runs[-1].removeprefix("run="))


def stream_scd2(
    spark: SparkSession,
    base: str,
    table: VersionLog,
    checkpoint: str,
    keys: Sequence[str],
    tracked: Sequence[str],
    at: str,
    schema: T.StructType,
    order: Sequence[str] = (),
    on_missing: str = "keep",
    allow_empty: bool = False,
) -> StreamingQuery:
    """Carry the history on with every run that finished since the last start, then stop.

    With ``on_missing="keep"`` a run may hold a part of a snapshot, or rows of
    several instants: they extend the open versions in time order. ``"close"``
    reads absence as deletion: each run is one whole snapshot with a single
    ``at``. An empty run would close everything and is an error, unless
    ``allow_empty`` has it passed over. The run's name is recorded with the
    result, and only changes are written.

    A late run is spliced in: between its neighbours if runs are snapshots, else
    with what later runs, which must still be there, say of its keys.
    """
    order = list(order) or list(tracked)
    kind = table.columns[VALID_FROM].dataType

    def moment(rows: DataFrame):
        """The single instant of a run as text, None for an empty one."""
        ends = rows.agg(F.min(at).cast(kind).cast("string"), F.max(at).cast(kind).cast("string")).first()
        if ends[0] != ends[1]:
            raise ValueError("on_missing='close' needs one whole snapshot with a single time per run")
        return ends[0]

    def states(rows: DataFrame) -> DataFrame:
        return latest_per_key(rows, keys, order).select(*keys, *tracked)

    def log_changes(rows: DataFrame, later: list[Snapshot]) -> DataFrame:
        if not later:
            return scd2_extend(table.opened(), rows, keys, tracked, at, order, changes_only=True)
        taken = union_pages([read_snapshot(spark, run, schema) for run in later])
        return scd2_splice_log(table.read(), rows, taken, keys, tracked, at, order)

    def snapshot_changes(rows: DataFrame, later: list[Snapshot]) -> DataFrame:
        now = moment(rows)
        for run in later:
            following = read_snapshot(spark, run, schema)
            until = moment(following)
            if until is not None:
                return scd2_splice(table.read(), states(rows), keys, tracked, now, until, states(following))
        return scd2_merge(table.opened(), states(rows), keys, tracked, now, on_missing, changes_only=True)

    changes = log_changes if on_missing == "keep" else snapshot_changes

    def take(run: Snapshot, later: list[Snapshot]) -> None:
        rows = read_snapshot(spark, run, schema)
        if rows.isEmpty():
            if not allow_empty:
                raise ValueError(f"run {run.run} is finished but empty")
            table.take(run.run, lambda: table.opened().limit(0))
        else:
            table.take(run.run, lambda: changes(rows, later))

    return follow_runs(spark, base, checkpoint, table.runs, take)
