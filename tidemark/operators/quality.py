"""Data-quality profiles, each in one pass over the table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import (
    LATITUDE_BOUNDS,
    LONGITUDE_BOUNDS,
    NO_VALUE,
    valid_latitude,
    valid_longitude,
)
from tidemark.schema import DEFAULT_SPEC, EntitySpec


def null_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: how many values of each column are null."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])


def value_distribution(df: DataFrame, column: str) -> DataFrame:
    """Rows per value of one column."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("row_count"))


def value_distribution_sets(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows per value of each column, all columns in a single aggregation.

    Columns: ``column_name``, ``value`` (as text), ``row_count``.
    """
    long = df.select(*[F.col(c).cast("string").alias(c) for c in columns]).unpivot(
        [], list(columns), "column_name", "value"
    )
    return long.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("row_count"))


def quality_report(
    df: DataFrame,
    columns: Sequence[str],
    defaults: Sequence[str] = (DEFAULT_SPEC.default_country, NO_VALUE),
    bounds: Mapping[str, tuple[float, float]] | None = None,
) -> DataFrame:
    """One row per column: null, blank, default-filled, out-of-range and distinct counts.

    All counts but the distinct one come from one plain aggregation, a row per
    task before the shuffle. Only the exact distinct counts expand the columns;
    equal values meet in their task first, so a value that fills a third of a
    column travels as one row per task.
    """
    bounds = bounds or {}

    def counts(c: str) -> Column:
        value = F.col(c).cast("string")
        outside = F.lit(False)
        if c in bounds:
            low, high = bounds[c]
            outside = value.isNotNull() & ~F.coalesce(value.try_cast("double").between(low, high), F.lit(True))
        return F.struct(
            F.lit(c).alias("column_name"),
            F.count(F.lit(1)).alias("row_count"),
            F.count_if(value.isNull()).alias("null_count"),
            F.count_if(F.trim(value) == "").alias("blank_count"),
            F.count_if(value.isin(*defaults)).alias("default_count"),
            F.count_if(outside).alias("out_of_range_count"),
        )

    linear = df.agg(F.array(*[counts(c) for c in columns]).alias("_counts")).select(F.inline("_counts"))
    long = df.select(*[F.col(c).cast("string").alias(c) for c in columns]).unpivot(
        [], list(columns), "column_name", "value"
    )
    distinct = long.where("value IS NOT NULL").distinct().groupBy("column_name").agg(
        F.count(F.lit(1)).alias("distinct_count")
    )
    return linear.join(distinct, "column_name", "left").fillna(0, ["distinct_count"])


def coordinate_bounds(spec: EntitySpec = DEFAULT_SPEC) -> dict[str, tuple[float, float]]:
    return {spec.longitude: LONGITUDE_BOUNDS, spec.latitude: LATITUDE_BOUNDS}


def geo_quality(raw: DataFrame, by: Column, spec: EntitySpec = DEFAULT_SPEC) -> DataFrame:
    """Usable, missing and rejected coordinates per group of raw rows."""
    lon, lat = F.col(spec.longitude), F.col(spec.latitude)
    lon_ok, lat_ok = valid_longitude(lon).isNotNull(), valid_latitude(lat).isNotNull()
    return raw.groupBy(by.alias("country")).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(lon.isNull()).alias("longitude_missing"),
        F.count_if(lon.isNotNull() & ~lon_ok).alias("longitude_rejected"),
        F.count_if(lat.isNull()).alias("latitude_missing"),
        F.count_if(lat.isNotNull() & ~lat_ok).alias("latitude_rejected"),
        F.count_if(lon_ok & lat_ok).alias("both_usable"),
    )


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count of each table. On stored tables this reads file footers only."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, df in tables.items()
    ]
    result = counts[0]
    for other in counts[1:]:
        result = result.unionByName(other)
    return result
