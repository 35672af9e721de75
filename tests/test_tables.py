import glob
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from frames import as_set, same_rows
from tidemark.operators.scd2 import scd2_merge
from tidemark.session import scratch_path, shared_dir
from tidemark.sources.tables import (
    WriteMetrics,
    metrics_frame,
    read_table,
    verify_write,
    write_table,
)


@pytest.fixture
def df(spark):
    return spark.range(1000).select(
        "id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("0"), F.col("id") % 7)).alias("p")
    )


@pytest.mark.parametrize("fmt", ["parquet", "orc", "json"])
def test_round_trip(spark, df, folder, fmt):
    written = write_table(df, f"{folder}/t", fmt=fmt)
    assert written.rows == 1000 and written.seconds > 0
    assert same_rows(verify_write(written, read_table(spark, f"{folder}/t", fmt, df.schema), df.schema), df)


def test_partition_values_keep_their_type(spark, df, folder):
    write_table(df, f"{folder}/t", ["p"])
    assert dict(read_table(spark, f"{folder}/t", schema=df.schema).dtypes)["p"] == "string"
    assert same_rows(read_table(spark, f"{folder}/t", schema=df.schema), df)
    assert len(glob.glob(f"{folder}/t/p=*")) == 8


def test_rows_of_a_partition_value_come_together(spark, df, folder):
    write_table(df.repartition(16), f"{folder}/t", ["p"])
    assert len(glob.glob(f"{folder}/t/p=01/*.parquet")) == 1


def test_a_hot_partition_value_is_split(spark, folder):
    big = spark.range(400_000).select(
        F.sha2(F.col("id").cast("string"), 256).alias("v"),
        F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("c"), F.col("id") % 50)).alias("p"),
    ).repartition(8)
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        write_table(big, f"{folder}/t", ["p"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(glob.glob(f"{folder}/t/p=hot/*.parquet")) > 2
    assert read_table(spark, f"{folder}/t").count() == 400_000


def test_verify_finds_missing_rows_and_columns(spark, df, folder):
    write_table(df, f"{folder}/t")
    stored = read_table(spark, f"{folder}/t")
    with pytest.raises(ValueError, match="999"):
        verify_write(WriteMetrics("t", 999, 0.1), stored, df.schema)
    with pytest.raises(ValueError, match="columns"):
        verify_write(WriteMetrics("t", 1000, 0.1), stored.drop("p"), df.schema)


def test_empty_tables_are_counted(spark, df, folder):
    written = write_table(df.where("false"), f"{folder}/t")
    assert written.rows == 0
    assert [(r.table_name, r["rows"]) for r in metrics_frame(spark, [written]).collect()] == [("t", 0)]


def test_schema_evolution(spark, df, folder):
    write_table(df, f"{folder}/t")
    write_table(df.withColumn("more", F.lit(1)), f"{folder}/t", mode="append")
    both = read_table(spark, f"{folder}/t", merge_schema=True)
    assert both.where("more is null").count() == both.where("more = 1").count() == 1000


def test_dynamic_overwrite_leaves_other_partitions(spark, df, folder):
    write_table(df, f"{folder}/t", ["p"])
    write_table(spark.createDataFrame([(-1, "01")], df.schema), f"{folder}/t", ["p"], dynamic=True)
    stored = read_table(spark, f"{folder}/t", schema=df.schema)
    assert same_rows(stored.where("p <> '01'"), df.where("p <> '01'"))
    assert as_set(stored.where("p = '01'")) == {(-1, "01")}


def test_delta_where_available(spark, df, folder):
    pytest.importorskip("delta")
    write_table(df, f"{folder}/t", fmt="delta", evolve=True)
    assert same_rows(read_table(spark, f"{folder}/t", "delta"), df)


def test_scratch_paths_are_below_the_shared_folder(spark):
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(shared_dir(spark))
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
