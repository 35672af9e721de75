"""Landing full snapshots, and finding and reading the latest one.

A landed snapshot is a folder of JSON lines,
``<base>/year=Y/month=M/day=D/run=<YYYYMMDD_HHMMSS>``; a re-run of a landing
replaces its own folder. Snapshots that other tools left as one JSON array per
file, ``.../day=D/<YYYYMMDD_HHMMSS>_<name>.json``, are found and read as well.
"""

from __future__ import annotations

import re
from collections.abc import Collection, Iterator, Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.functions.times import instant
from tidemark.schema import DEFAULT_SPEC, ENTITY_SCHEMA, EntitySpec
from tidemark.sources.files import entries, exists
from tidemark.sources.tables import WriteMetrics, write_table

# Time stamps keep their microseconds in JSON.
STAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
STAMP_FORMAT_NTZ = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
RUN_FORMAT = "%Y%m%d_%H%M%S"
# Folder below the base that gets a line for every finished run, and its columns.
FINISHED = "finished"
RUN_COLUMNS = "run string, path string, row_count long"
# A compressed file does not split, so it gets no more rows than a task should read.
COMPRESSION, ROWS_PER_FILE = "gzip", 250_000


def stamp(df: DataFrame, at, spec: EntitySpec = DEFAULT_SPEC) -> DataFrame:
    """``df`` with one ingest time for the whole run."""
    stamped = at if isinstance(at, Column) else instant(at)
    return df.withColumn(spec.stamp, stamped)


def union_pages(pages: Sequence[DataFrame]) -> DataFrame:
    """All pages on top of each other; a column a page lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), pages)


def read_pages(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: T.StructType = ENTITY_SCHEMA,
    multi_line: bool = True,
) -> DataFrame:
    """Page files read in parallel, the schema enforced, a broken page an error.

    ``multi_line`` is for files that hold one JSON array each; such a file is
    one task, so it is meant for pages. Large snapshots are landed as lines,
    which split.
    """
    return (
        spark.read.schema(schema)
        .option("multiLine", multi_line)
        .option("mode", "FAILFAST")
        .json(paths)
    )


def run_path(base: str, at: datetime) -> str:
    day = f"year={at.year}/month={at.month}/day={at.day}"
    return f"{base.rstrip('/')}/{day}/run={at.strftime(RUN_FORMAT)}"


def land_snapshot(df: DataFrame, base: str, at: datetime) -> WriteMetrics:
    """Write a snapshot as compressed JSON lines below ``base`` and announce it; returns path, rows and seconds."""
    written = write_table(
        df,
        run_path(base, at),
        fmt="json",
        compression=COMPRESSION,
        maxRecordsPerFile=ROWS_PER_FILE,
        timestampFormat=STAMP_FORMAT,
        timestampNTZFormat=STAMP_FORMAT_NTZ,
    )
    announce_run(df.sparkSession, base, at.strftime(RUN_FORMAT), written.path, written.rows)
    return written


def announce_run(spark: SparkSession, base: str, run: str, path: str, rows: int) -> None:
    """Tell streams below ``base`` that a run is complete; for runs that other tools landed, too."""
    line = spark.createDataFrame([(run, path, rows)], RUN_COLUMNS)
    line.coalesce(1).write.mode("append").json(f"{base.rstrip('/')}/{FINISHED}")


@dataclass(frozen=True)
class Snapshot:
    """One landed snapshot: its day, its run stamp and the path to read."""

    year: int
    month: int
    day: int
    run: str
    path: str
    multi_line: bool


def _newest_first(spark: SparkSession, path: str, part: str) -> list[tuple[int, str]]:
    found = [re.fullmatch(rf"{part}=(\d+)", name) for name in entries(spark, path)]
    return sorted(((int(m[1]), f"{path}/{m[0]}") for m in found if m), reverse=True)


def _runs_of_day(spark: SparkSession, path: str) -> list[tuple[str, str, bool]]:
    """Run stamp, name and whether it is a single file, the newest first."""
    runs = []
    for name in entries(spark, path):
        stamp_of = re.match(r"(?:run=)?(\d{8}_\d{6})", name)
        run = stamp_of[1] if stamp_of else name
        if name.startswith("run="):
            runs.append((run, name, False))
        elif ".json" in name and name[0] not in "._":
            runs.append((run, name, True))
    return sorted(runs, reverse=True)


def latest_snapshot(spark: SparkSession, base: str) -> Snapshot:
    """The newest snapshot below ``base`` by year, month, day and run, as numbers.

    Only the folders on the way to it are listed, however many snapshots there
    are. A landed run that is still being written, or whose writer died, is
    passed over, and so are empty days.
    """
    base = base.rstrip("/")
    for year, in_year in _newest_first(spark, base, "year"):
        for month, in_month in _newest_first(spark, in_year, "month"):
            for day, in_day in _newest_first(spark, in_month, "day"):
                for run, name, single in _runs_of_day(spark, in_day):
                    path = f"{in_day}/{name}"
                    if single or exists(spark, f"{path}/_SUCCESS"):
                        return Snapshot(year, month, day, run, path, single)
    raise FileNotFoundError(f"no snapshot below {base}")


def finished_runs(spark: SparkSession, base: str, after: str | None = None) -> list[Snapshot]:
    """Finished runs below ``base`` in run order, those later than ``after``.

    Folders of days before ``after`` are not listed. A run without its success
    marker is passed over, also where later ones are finished.
    """
    base, found = base.rstrip("/"), []
    since = (int(after[:4]), int(after[4:6]), int(after[6:8])) if after else (0, 0, 0)
    for year, in_year in _newest_first(spark, base, "year"):
        if year < since[0]:
            break
        for month, in_month in _newest_first(spark, in_year, "month"):
            if (year, month) < since[:2]:
                break
            for day, in_day in _newest_first(spark, in_month, "day"):
                if (year, month, day) < since:
                    break
                for run, name, single in _runs_of_day(spark, in_day):
                    path = f"{in_day}/{name}"
                    if run > (after or "") and (single or exists(spark, f"{path}/_SUCCESS")):
                        found.append(Snapshot(year, month, day, run, path, single))
    return sorted(found, key=lambda s: s.run)


def open_runs(finished: Sequence[Snapshot], done: Collection[str]) -> Iterator[tuple[Snapshot, list[Snapshot]]]:
    """Each finished run that is not ``done``, in run order, with the later ones that are."""
    done = set(done)
    for run in finished:
        if run.run not in done:
            yield run, [r for r in finished if r.run > run.run and r.run in done]


def read_snapshot(
    spark: SparkSession, snapshot: Snapshot, schema: T.StructType = ENTITY_SCHEMA
) -> DataFrame:
    return read_pages(spark, snapshot.path, schema, snapshot.multi_line)


def read_latest(
    spark: SparkSession, base: str, schema: T.StructType = ENTITY_SCHEMA
) -> DataFrame:
    """The rows of the newest snapshot below ``base``."""
    return read_snapshot(spark, latest_snapshot(spark, base), schema)
