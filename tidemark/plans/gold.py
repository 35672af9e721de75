"""Stored gold tables, their views, and the whole way from a landed snapshot to them."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.times import instant
from tidemark.operators.model import (
    fact,
    kind_dim,
    location_dim,
    publish_view,
    star_view_sk,
    type_location_agg,
)
from tidemark.operators.scd2 import scd2_merge, scd2_splice
from tidemark.plans.conform import conform
from tidemark.plans.maintain import FACT, KIND, LOCATION, ROLLUP, gold_logs, read_dimensions, read_rollup, refresh
from tidemark.schema import DEFAULT_SPEC, ENTITY_SCHEMA, SCD2_COLUMNS, VALID_FROM, EntitySpec
from tidemark.sources.changes import BUCKETS, VersionLog, version_log
from tidemark.sources.snapshot import (
    RUN_FORMAT,
    Snapshot,
    finished_runs,
    open_runs,
    read_latest,
    read_snapshot,
    union_pages,
)
from tidemark.sources.tables import WriteMetrics, read_table, verify_write, write_table


# Rows of a run that a task sorts at once, history beside them.
ROWS_PER_BUCKET = 100_000


def gold_tables(silver: DataFrame, spec: EntitySpec = DEFAULT_SPEC) -> dict[str, DataFrame]:
    return {
        "dim_location": location_dim(silver, spec),
        spec.dim_kind_table: kind_dim(silver, spec),
        spec.fact_table: fact(silver, spec),
        spec.agg_table: type_location_agg(silver, spec),
    }


def write_gold(
    silver: DataFrame, out: str, spec: EntitySpec = DEFAULT_SPEC, fmt: str = "parquet"
) -> list[WriteMetrics]:
    """Write the four gold tables. ``silver`` should be a stored table: each reads it."""
    return [
        write_table(df, f"{out}/{name}", fmt=fmt)
        for name, df in gold_tables(silver, spec).items()
    ]


def star_view_text(gold: str, spec: EntitySpec = DEFAULT_SPEC, fmt: str = "parquet") -> str:
    """The star view as SQL over the stored tables."""
    on_location = " AND ".join(f"f.{c}_key = l.{c}_key" for c in spec.location)
    names = ", ".join(f"l.{c}_name" for c in spec.location)
    return f"""
        SELECT f.*, {names}, l.{spec.postal_code}, l.{spec.longitude}, l.{spec.latitude},
               t.{spec.kind_name}
        FROM {fmt}.`{gold}/{spec.fact_table}` f
        JOIN {fmt}.`{gold}/dim_location` l ON {on_location}
        JOIN {fmt}.`{gold}/{spec.dim_kind_table}` t ON f.{spec.kind_key} = t.{spec.kind_key}
    """


def agg_view_text(gold: str, spec: EntitySpec = DEFAULT_SPEC, fmt: str = "parquet") -> str:
    return f"SELECT * FROM {fmt}.`{gold}/{spec.agg_table}`"


def publish_gold_views(
    spark: SparkSession,
    gold: str,
    spec: EntitySpec = DEFAULT_SPEC,
    fmt: str = "parquet",
    persistent: bool = False,
) -> None:
    """The two views over stored gold tables; ``persistent`` ones are kept in the session's catalog."""
    publish_view(spark, star_view_text(gold, spec, fmt), spec.star_view, persistent)
    publish_view(spark, agg_view_text(gold, spec, fmt), spec.agg_view, persistent)


def snapshot_to_star(
    spark: SparkSession,
    base: str,
    out: str,
    spec: EntitySpec = DEFAULT_SPEC,
    schema: T.StructType = ENTITY_SCHEMA,
    partition_by: Sequence[str] = ("country",),
    fmt: str = "parquet",
) -> list[WriteMetrics]:
    """Latest landed snapshot to silver, gold and views; returns what was written.

    Silver is written first and read back, so the snapshot is parsed and
    cleaned once for all four gold tables.
    """
    conformed = conform(read_latest(spark, base, schema), spec)
    written = write_table(conformed, f"{out}/silver", partition_by, fmt=fmt)
    silver = verify_write(
        written, read_table(spark, written.path, fmt, conformed.schema), conformed.schema
    )
    metrics = [written, *write_gold(silver, f"{out}/gold", spec, fmt)]
    publish_gold_views(spark, f"{out}/gold", spec, fmt)
    return metrics


def history_table(
    spark: SparkSession,
    out: str,
    spec: EntitySpec = DEFAULT_SPEC,
    schema: T.StructType = ENTITY_SCHEMA,
    buckets: int = BUCKETS,
) -> VersionLog:
    """The stored history of conformed entities below ``out``; ``buckets`` are for a new one."""
    conformed = conform(spark.createDataFrame([], schema), spec).schema
    columns = T.StructType([f for f in conformed if f.name not in SCD2_COLUMNS])
    return version_log(spark, f"{out}/history", columns, (spec.id,), conformed[SCD2_COLUMNS[0]].dataType, buckets)


def runs_to_star(
    spark: SparkSession,
    base: str,
    out: str,
    spec: EntitySpec = DEFAULT_SPEC,
    schema: T.StructType = ENTITY_SCHEMA,
    on_missing: str = "close",
    buckets: int = BUCKETS,
) -> VersionLog:
    """Every finished run that is new into the history, then gold brought up to its current rows.

    Each run is conformed and merged at the time of its stamp: changed entities
    get a new version, absent ones are closed or kept as ``on_missing`` says. A
    changed ingest time alone is no change. A run that finishes late is spliced in
    where it belongs. Running it again changes nothing. What is written, history and
    gold, follows the changes. ``read_star`` and ``read_gold`` give the result.
    A new history gets ``buckets``, or as many as the first run has ``ROWS_PER_BUCKET`` rows, if that is more.
    """
    news = list(open_runs(finished_runs(spark, base), history_table(spark, out, spec, schema, buckets).runs()))
    if news:
        buckets = max(buckets, -(-read_snapshot(spark, news[0][0], schema).count() // ROWS_PER_BUCKET))
    table = history_table(spark, out, spec, schema, buckets)
    buckets = table.width()
    payload = [c for c in table.columns.names if c not in SCD2_COLUMNS]
    tracked = [c for c in payload if c not in (spec.id, "updated_at", "updated_date")]

    def entities(run: Snapshot) -> DataFrame:
        # Dealt out as the history is, before columns are added: this is all that moves.
        dealt = read_snapshot(spark, run, schema).repartition(buckets, spec.id)
        return conform(dealt, spec).select(*payload)

    def changes(run: Snapshot, later: list[Snapshot]) -> DataFrame:
        rows, at = entities(run), _time(run)
        if not later:
            return scd2_merge(table.opened(), rows, [spec.id], tracked, at, on_missing, changes_only=True)
        if on_missing == "close":
            return scd2_splice(table.read(), rows, [spec.id], tracked, at, _time(later[0]), entities(later[0]))
        # The next word on each entity of the run, from whichever later run has it.
        times = [entities(r).withColumn("_time", instant(_time(r), table.columns[VALID_FROM].dataType)) for r in later]
        known = union_pages(times).join(rows.select(spec.id), spec.id, "left_semi")
        row = F.struct(*[c for c in known.columns if c != spec.id])
        following = known.groupBy(spec.id).agg(F.min_by(row, "_time").alias("_row")).select(spec.id, "_row.*")
        return scd2_splice(table.read(), rows, [spec.id], tracked, at, "_time", following, "keep")

    for run, later in news:
        table.take(run.run, lambda: changes(run, later), placed=True)
    refresh(table, gold_logs(spark, out, table.columns, spec, buckets), spec)
    return table


def _time(run: Snapshot) -> datetime:
    return datetime.strptime(run.run, RUN_FORMAT)


def read_gold(
    spark: SparkSession, out: str, spec: EntitySpec = DEFAULT_SPEC, schema: T.StructType = ENTITY_SCHEMA
) -> dict[str, DataFrame]:
    """Fact, both dimensions and the rollup that ``runs_to_star`` keeps, of current entities."""
    logs = gold_logs(spark, out, history_table(spark, out, spec, schema).columns, spec)
    locations, kinds = read_dimensions(logs)
    return {FACT: logs[FACT].read(), LOCATION: locations, KIND: kinds, ROLLUP: read_rollup(logs)}


def read_star(
    spark: SparkSession, out: str, spec: EntitySpec = DEFAULT_SPEC, schema: T.StructType = ENTITY_SCHEMA
) -> DataFrame:
    """The star view over what ``runs_to_star`` keeps, one row per current entity."""
    tables = read_gold(spark, out, spec, schema)
    return star_view_sk(tables[FACT], tables[LOCATION], tables[KIND], spec)
