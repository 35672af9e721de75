"""Small helpers that the operators of this package share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.session import scratch_path

# A word is a maximal run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def stored(df: DataFrame, name: str, fmt: str = "parquet", **options) -> DataFrame:
    """``df`` written below the shared folder and read again: later jobs start from the files."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.options(**options).format(fmt).save(path)
    return spark.read.schema(df.schema).format(fmt).load(path)


def small_batches(df: DataFrame) -> DataFrame:
    """``df``, in a session whose Arrow batches hold few rows, as rows with whole texts ask for.

    The setting stays as it is where it was changed from Spark's default.
    """
    conf = df.sparkSession.conf
    if conf.get(BATCH_ROWS) == "10000":
        conf.set(BATCH_ROWS, "1000")
    return df


def word_count(text: str) -> Column:
    """Number of words, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def total_bytes(df: DataFrame, column: str) -> int:
    """UTF-8 bytes of a text column: one number, for choosing a partition count."""
    return df.agg(F.sum(F.octet_length(column))).first()[0] or 0


def prefix_sums(
    df: DataFrame, groups: list[str], bucket: str, order: list[str], value: str, out: str
) -> DataFrame:
    """``out``: the sum of ``value`` over the rows of the group before this row.

    Rows are ordered by ``bucket``, then ``order``. Buckets are summed apart, so
    that a group is scanned by as many tasks as it has buckets; only the bucket
    totals of a group meet in one task. Group and bucket columns hold no nulls.
    """
    keys = [*groups, bucket]
    totals = df.groupBy(*keys).agg(F.sum(value).alias("_total"))
    before = Window.partitionBy(*groups).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*keys, F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_offset"))
    within = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    inner = F.coalesce(F.sum(value).over(within), F.lit(0))
    return df.join(offsets, keys).withColumn(out, F.col("_offset") + inner).drop("_offset")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
