"""Keyed tables kept as changes: one Parquet folder per run, bucketed by key.

A run adds the rows it changes, whole, with ``gone`` for a key it removes; the
latest row of a key counts. Rows written follow the changes, nothing that may be
read is overwritten, and a folder counts once Spark's writer has finished it
(its success marker), so a run that died is invisible and taken again. Runs
are numbered as they are taken, whatever their names say.

All folders are one table for Spark, partitioned by run and bucketed: scans of
it need no exchange to meet something by key, or to find the latest row of one.
The number of buckets belongs to the data and is part of the path. One writer at a time.
Old runs can be folded, and concurrent writers kept apart, by a table format with
transactions where the session has one; this is none.
"""

from __future__ import annotations

import hashlib
import time
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.ordered import latest_per_key
from tidemark.schema import IS_CURRENT, VALID_FROM, VALID_TO
from tidemark.sources.files import entries, exists, remove
from tidemark.sources.tables import NO_ROWS_COUNTED, WriteMetrics

BATCH, GONE, SIGN = "batch", "gone", "sign"
BUCKETS = 16


@dataclass(frozen=True)
class ChangeLog:
    """``keys`` name a row, rows are bucketed ``by`` some or (if not given) all of them.

    ``buckets`` is for a new table; later the data say how many there are.
    """

    spark: SparkSession
    path: str
    columns: T.StructType
    keys: tuple[str, ...]
    by: tuple[str, ...] = ()
    buckets: int = BUCKETS

    def width(self) -> int:
        """The number of buckets: of the data or, without any, for a new table."""
        found = [n for n in entries(self.spark, self.path) if n.startswith("buckets=")]
        return int(found[0].split("=")[1]) if found else self.buckets

    def _root(self) -> str:
        return f"{self.path}/buckets={self.width()}"

    def batches(self) -> list[str]:
        """The runs taken, each with its number in front, in the order they were taken in."""
        root = self._root()
        names = [n.split("=", 1)[1] for n in entries(self.spark, root) if n.startswith(f"{BATCH}=")]
        return sorted(n for n in names if exists(self.spark, f"{root}/{BATCH}={n}/_SUCCESS"))

    def runs(self) -> list[str]:
        """Names of the runs taken, in order of names."""
        return sorted(n.split("-", 1)[1] for n in self.batches())

    def _entry(self) -> tuple[str, str]:
        """The name of the table in the catalog, and its columns."""
        stored = T.StructType(list(self.columns)).add(GONE, T.BooleanType())
        listed = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in stored)
        return "changes_" + hashlib.md5(f"{self._root()} {listed} {self.by or self.keys}".encode()).hexdigest(), listed

    def forget(self) -> None:
        """Drop the catalog's entry; the files stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self._entry()[0]}")

    def rows(self, upto: str | None = None, after: str = "") -> DataFrame:
        """Every change with its ``batch``, of batches later than ``after``, up to ``upto``."""
        done = self.batches()
        wanted = [b for b in done if b > after and (upto is None or b <= upto)]
        stored = T.StructType(list(self.columns)).add(GONE, T.BooleanType())
        if not wanted:
            return self.spark.createDataFrame([], stored.add(BATCH, T.StringType()))
        by, n, root = self.by or self.keys, self.width(), self._root()
        name, listed = self._entry()
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({listed}, {BATCH} STRING) USING parquet PARTITIONED BY ({BATCH}) "
            f"CLUSTERED BY ({', '.join(f'`{c}`' for c in by)}) INTO {n} BUCKETS LOCATION '{root}'"
        )
        added = " ".join(f"PARTITION ({BATCH}='{b}')" for b in done)
        self.spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {added}")
        # The condition stays with the DataFrame when later runs are added.
        return self.spark.table(name).where(F.col(BATCH).isin(wanted))

    def read(self, upto: str | None = None) -> DataFrame:
        """The latest row of every key that is not gone."""
        rows = latest_per_key(self.rows(upto), list(self.keys), [BATCH])
        return rows.where(~F.col(GONE)).select(*self.columns.names)

    def take(self, run: str, changes: Callable[[], DataFrame], placed: bool = False) -> WriteMetrics | None:
        """Add the rows that a run changes, once; None if it was taken before.

        ``placed`` says that the rows of a bucket are in one task already, as they are where only
        tables with as many buckets met: they are written from there. Were they not, buckets would have more files.
        """
        done = self.batches()
        if run in {b.split("-", 1)[1] for b in done}:
            return None
        number = int(done[-1].split("-")[0]) + 1 if done else 0
        started, seen, n, by = time.monotonic(), Observation(), self.width(), self.by or self.keys
        rows = changes()
        if GONE not in rows.columns:
            rows = rows.withColumn(GONE, F.lit(False))
        # One task per bucket, so one file each.
        dealt = rows.select(*self.columns.names, GONE)
        dealt = dealt if placed else dealt.repartition(n, *by)
        folder, name = f"{self._root()}/{BATCH}={number:06d}-{run}", f"taken_{uuid.uuid4().hex}"
        remove(self.spark, folder)
        counted = dealt.observe(seen, F.count(F.lit(1)).alias("rows"))
        counted.write.format("parquet").bucketBy(n, *by).option("path", folder).saveAsTable(name)
        self.spark.sql(f"DROP TABLE {name}")  # the catalog's entry; the files stay
        return WriteMetrics(folder, seen.get.get("rows", NO_ROWS_COUNTED), time.monotonic() - started)


def version_log(
    spark: SparkSession,
    path: str,
    columns: T.StructType,
    keys: tuple[str, ...],
    time_type: T.DataType = T.TimestampType(),
    buckets: int = BUCKETS,
) -> VersionLog:
    """A history of entities: ``columns`` and the three version columns, one row per key and start."""
    full = T.StructType(list(columns)).add(VALID_FROM, time_type).add(VALID_TO, time_type)
    return VersionLog(spark, path, full.add(IS_CURRENT, T.BooleanType()), (*keys, VALID_FROM), keys, buckets)


@dataclass(frozen=True)
class VersionLog(ChangeLog):
    """Versions of entities, bucketed by entity."""

    def opened(self, upto: str | None = None) -> DataFrame:
        """The open versions."""
        return self.read(upto).where(IS_CURRENT)

    def signed(self, after: str = "", upto: str | None = None, columns: Sequence[str] | None = None) -> DataFrame:
        """What the batches later than ``after`` did to the open versions: rows gone (``sign`` -1) and come (1).

        Versions that were open before, and still are as they were in ``columns`` (all, if not given), are not among them.
        """
        names = list(columns or self.columns.names)
        if not after:
            return self.opened(upto).select(*names, F.lit(1).alias(SIGN))
        # The latest row of a key before and the latest since, side by side in one pass over the buckets.
        ends = latest_per_key(self.rows(upto).withColumn("_old", F.col(BATCH) <= after), [*self.keys, "_old"], [BATCH])
        open_row = F.when(F.col(IS_CURRENT) & ~F.col(GONE), F.struct(*names))
        pair = Window.partitionBy(*self.keys).orderBy("_old")
        ends = ends.select(*self.keys, "_old", open_row.alias("_row"))
        ends = ends.withColumns({"_since": F.lag("_old").over(pair).isNotNull(), "_before": F.lead("_row").over(pair), "_now": F.lag("_row").over(pair)})
        old = F.col("_old")
        kept = F.col("_row").isNotNull() & F.when(old, F.col("_since") & ~F.col("_row").eqNullSafe(F.col("_now"))).otherwise(
            ~F.col("_row").eqNullSafe(F.col("_before"))
        )
        return ends.where(kept).select("_row.*", F.when(old, -1).otherwise(1).alias(SIGN))
