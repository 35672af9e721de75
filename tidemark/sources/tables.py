"""Tables in a folder, and a history table that is safe to update.

Parquet by default; any format the session knows (``delta`` with its package)
can be named instead.
"""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

NO_ROWS_COUNTED = 0


@dataclass(frozen=True)
class WriteMetrics:
    """What one write did."""

    path: str
    rows: int
    seconds: float


def read_table(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    schema: T.StructType | None = None,
    merge_schema: bool = False,
) -> DataFrame:
    """A table by path.

    Give ``schema`` for partitioned tables, so partition values keep their type
    instead of being guessed from folder names.
    """
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    if merge_schema:
        reader = reader.option("mergeSchema", "true")
    return reader.load(path)


def write_table(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    mode: str = "overwrite",
    fmt: str = "parquet",
    dynamic: bool = False,
    evolve: bool = False,
    gather: bool = True,
    **options,
) -> WriteMetrics:
    """Write ``df`` and count its rows on the way.

    A partitioned write gathers the rows of each partition first; the
    rebalance lets adaptive execution split a partition value that holds much
    of the table over several files and merge the small ones. Turn ``gather``
    off where there are few partition values. ``dynamic`` overwrites only the
    partitions that occur in ``df``. ``evolve`` lets the schema change where
    the format tracks it (Parquet: read with ``merge_schema``). ``options`` go
    to the writer.
    """
    started = time.monotonic()
    seen = Observation()
    # Counted behind the exchange: map tasks that run again don't count twice.
    gathered = df.hint("rebalance", *partition_by) if partition_by and gather else df
    counted = gathered.observe(seen, F.count(F.lit(1)).alias("rows"))
    writer = counted.write.format(fmt).mode(mode).options(**options)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if dynamic:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    if evolve and fmt != "parquet":
        writer = writer.option("mergeSchema", "true")
        if mode == "overwrite" and not dynamic:
            writer = writer.option("overwriteSchema", "true")
    writer.save(path)
    rows = seen.get.get("rows", NO_ROWS_COUNTED)
    return WriteMetrics(path, rows, time.monotonic() - started)


def verify_write(written: WriteMetrics, stored: DataFrame, schema: T.StructType) -> DataFrame:
    """``stored`` if it has the rows and columns that were written, else an error."""
    want = {f.name: f.dataType.simpleString() for f in schema}
    have = {f.name: f.dataType.simpleString() for f in stored.schema}
    if want != have:
        raise ValueError(f"{written.path}: columns {have}, written {want}")
    rows = stored.count()
    if rows != written.rows:
        raise ValueError(f"{written.path}: {rows} rows, written {written.rows}")
    return stored


def metrics_frame(spark: SparkSession, metrics: Sequence[WriteMetrics]) -> DataFrame:
    """Run metrics as a table, one row per write."""
    return spark.createDataFrame(
        [(m.path.rsplit("/", 1)[-1], m.rows, m.seconds) for m in metrics],
        "table_name string, rows long, seconds double",
    )
