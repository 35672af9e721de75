"""Column profiles that can be merged, so that a trend over runs reads no old data.

A run's profile has one row per column: counts, which add up, and two sketches,
which merge: of the distinct values, and of the quantiles of what is a number (of the
lengths of texts otherwise). Sketches are a few kilobytes whatever a column holds. Profiles
of runs are stored next to each other; whole histories, weeks or months are merged from
them, and two runs are compared without opening either.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import NO_VALUE
from tidemark.schema import DEFAULT_SPEC
from tidemark.sources.tables import WriteMetrics, read_table, write_table

# Sizes of the sketches: distinct counts are off by 1.6 % (standard error), ranks of quantiles by 0.7 %.
LOG_BUCKETS, KLL = 12, 400
COUNTS = ("row_count", "null_count", "blank_count", "default_count", "number_count")
PROFILE = T.StructType().add("column_name", T.StringType())
for _name in COUNTS:
    PROFILE = PROFILE.add(_name, T.LongType())
PROFILE = PROFILE.add("values", T.BinaryType()).add("sizes", T.BinaryType())
NUMERIC = (T.NumericType,)


def profile(
    df: DataFrame, columns: Sequence[str], defaults: Sequence[str] = (DEFAULT_SPEC.default_country, NO_VALUE)
) -> DataFrame:
    """One row per column, in one pass; every task sends one row.

    ``values`` is a sketch of the distinct values as text, ``sizes`` one of the quantiles of
    numbers, or of the lengths of other values as text; NaN and infinite numbers are not in it
    (``number_count`` values are).
    """

    def one(c: str) -> Column:
        text = F.col(c).cast("string")
        if isinstance(df.schema[c].dataType, NUMERIC):
            size = F.col(c).cast("double")
            size = F.when(~F.isnan(size) & (F.abs(size) < float("inf")), size)
        else:
            size = F.length(text).cast("double")
        return F.struct(
            F.lit(c).alias("column_name"),
            F.count(F.lit(1)).alias("row_count"),
            F.count_if(text.isNull()).alias("null_count"),
            F.count_if(F.trim(text) == "").alias("blank_count"),
            F.count_if(text.isin(*defaults)).alias("default_count"),
            F.count(size).alias("number_count"),
            F.hll_sketch_agg(text, LOG_BUCKETS).alias("values"),
            F.kll_sketch_agg_double(size, KLL).alias("sizes"),
        )

    return df.agg(F.array(*[one(c) for c in columns]).alias("_rows")).select(F.inline("_rows"))


def write_profile(df: DataFrame, path: str, run: str, columns: Sequence[str], **options) -> WriteMetrics:
    """Profile a run and keep it below ``path``; again replaces it."""
    return write_table(profile(df, columns, **options).coalesce(1), f"{path}/run={run}")


def read_profiles(spark: SparkSession, path: str) -> DataFrame:
    """The stored profiles with their ``run``."""
    return read_table(spark, path, schema=T.StructType(list(PROFILE)).add("run", T.StringType()))


def merge_profiles(profiles: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Profiles of all runs, or of those alike in ``by``, as one row per column: as if their rows had been profiled together."""
    return profiles.groupBy("column_name", *by).agg(
        *[F.sum(c).alias(c) for c in COUNTS],
        F.hll_union_agg("values").alias("values"),
        F.kll_merge_agg_double("sizes").alias("sizes"),
    )


def measures(profiles: DataFrame, quantiles: Sequence[float] = (0.0, 0.5, 1.0)) -> DataFrame:
    """Counts as they are, ``distinct_count`` and quantiles (an array, null without numbers) from the sketches."""
    kept = [c for c in profiles.columns if c not in ("values", "sizes")]
    ranks = F.array(*[F.lit(float(q)) for q in quantiles])
    found = F.when(F.col("number_count") > 0, F.kll_sketch_get_quantile_double("sizes", ranks))
    return profiles.select(*kept, F.hll_sketch_estimate("values").alias("distinct_count"), found.alias("quantiles"))


def trend(profiles: DataFrame) -> DataFrame:
    """``measures`` of every run, with what changed since the run before: shares of nulls, blanks and
    defaults in per cent of rows, and the distinct count."""
    rows = measures(profiles)
    before = Window.partitionBy("column_name").orderBy("run")
    shares = {f"{c}_share": 100 * F.col(f"{c}_count") / F.col("row_count") for c in ("null", "blank", "default")}
    rows = rows.withColumns(shares)
    steps = {f"{c}_step": F.col(c) - F.lag(c).over(before) for c in (*shares, "distinct_count")}
    return rows.withColumns(steps)
