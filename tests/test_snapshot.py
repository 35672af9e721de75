import json
import os
import time
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from frames import same_rows
from tidemark.functions import valid_longitude
from tidemark.functions.times import instant
from tidemark.operators.scd2 import scd2_merge
from tidemark.plans.conform import conform
from tidemark.schema import ENTITY_SCHEMA, EntitySpec, entity_schema
from tidemark.sources.snapshot import (
    land_snapshot,
    latest_snapshot,
    read_latest,
    read_pages,
    run_path,
    stamp,
    union_pages,
)

SMALL = T.StructType().add("id", T.StringType()).add("n", T.IntegerType())


def land_file(base, year, month, day, name, rows):
    path = f"{base}/year={year}/month={month}/day={day}"
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/{name}", "w") as out:
        json.dump(rows, out)


def test_schema_has_twenty_nullable_fields():
    assert len(ENTITY_SCHEMA) == 20 and all(f.nullable for f in ENTITY_SCHEMA)
    kinds = {f.name: f.dataType.typeName() for f in ENTITY_SCHEMA}
    assert kinds["longitude"] == kinds["latitude"] == "double"
    assert kinds["is_current"] == "boolean" and kinds["street"] == "string"
    named = entity_schema(EntitySpec(kind="shop_type"))
    assert "shop_type" in named.names and "entity_type" not in named.names


def test_pages_are_read_together_and_missing_fields_are_null(spark, folder):
    for page in range(3):
        with open(f"{folder}/{page}.json", "w") as out:
            json.dump([{"id": str(page * 2 + i), "longitude": 1.5, "extra": 1} for i in range(2)], out)
    df = read_pages(spark, f"{folder}/*.json")
    assert df.schema == ENTITY_SCHEMA
    assert {r.id for r in df.collect()} == {str(i) for i in range(6)}
    assert df.where("country is null and longitude = 1.5").count() == 6


def test_a_broken_page_fails_the_run(spark, folder):
    with open(f"{folder}/1.json", "w") as out:
        out.write('[{"id": "1"}, {"id": ')
    with pytest.raises(Exception, match="MALFORMED"):
        read_pages(spark, folder).collect()


def test_quoted_coordinates_can_be_declared(spark, folder):
    with open(f"{folder}/1.json", "w") as out:
        out.write('[{"id": "1", "longitude": "-122.67"}, {"id": "2", "longitude": 12.5}]')
    df = read_pages(spark, folder, entity_schema(coordinates=T.StringType()))
    assert [r[0] for r in df.sort("id").select(valid_longitude("longitude")).collect()] == [-122.67, 12.5]


def test_escaped_slashes_are_gone_after_parsing(spark, folder):
    with open(f"{folder}/1.json", "w") as out:
        out.write(r'[{"id": "1", "website_url": "http:\/\/a.example"}]')
    assert conform(read_pages(spark, folder)).first().website_url == "http://a.example"


def test_union_pages_fills_missing_columns(spark):
    a = spark.createDataFrame([("1", 1)], "id string, n int")
    b = spark.createDataFrame([("2", True)], "id string, flag boolean")
    assert {tuple(r) for r in union_pages([a, b, a]).collect()} == {("1", 1, None), ("2", None, True)}
    assert union_pages([a, b, a]).count() == 3


def test_one_stamp_per_run(spark):
    at = datetime(2024, 5, 1, 12)
    assert {r[0] for r in stamp(spark.range(5), at).select("ingested_date").collect()} == {at}


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_landing_keeps_every_value(spark, folder, kind):
    df = spark.range(20).select(
        F.col("id").cast("string").alias("id"),
        F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.lit('é "/\\')).alias("name"),
        F.lit("2024-05-01 12:00:00.123456").cast(kind).alias("ingested_date"),
    )
    written = land_snapshot(df, folder, datetime(2024, 5, 1, 12))
    assert written.rows == 20 and written.path == run_path(folder, datetime(2024, 5, 1, 12))
    assert same_rows(df, read_latest(spark, folder, df.schema))


def test_landing_again_replaces_the_run(spark, folder):
    for _ in range(2):
        land_snapshot(spark.range(5), folder, datetime(2024, 5, 1, 12))
    assert read_latest(spark, folder, spark.range(1).schema).count() == 5


def test_latest_goes_by_numbers_not_text(spark, folder):
    runs = [(2024, 9, 30), (2024, 12, 2), (2024, 12, 10), (2023, 12, 31)]
    for year, month, day in runs:
        land_snapshot(
            spark.createDataFrame([(f"{month}-{day}", 1)], SMALL), folder, datetime(year, month, day, 6)
        )
    assert read_latest(spark, folder, SMALL).first().id == "12-10"
    found = latest_snapshot(spark, folder)
    assert (found.year, found.month, found.day, found.run) == (2024, 12, 10, "20241210_060000")


def test_latest_of_one_day_is_the_later_run(spark, folder):
    for hour in (3, 21, 9):
        land_snapshot(spark.createDataFrame([(str(hour), 1)], SMALL), folder, datetime(2024, 1, 1, hour))
    assert read_latest(spark, folder, SMALL).first().id == "21"


def test_latest_of_single_file_snapshots(spark, folder):
    land_file(folder, 2024, 9, 10, "20240910_060000_x.json", [{"id": "a", "n": 1}])
    land_file(folder, 2024, 10, 2, "20241002_060000_x.json", [{"id": "b", "n": 1}])
    land_file(folder, 2024, 10, 2, "20241002_180000_x.json", [{"id": "c", "n": 1}, {"id": "d", "n": 2}])
    assert {r.id for r in read_latest(spark, folder, SMALL).collect()} == {"c", "d"}
    land_snapshot(spark.createDataFrame([("e", 1)], SMALL), folder, datetime(2024, 10, 2, 20))
    assert {r.id for r in read_latest(spark, folder, SMALL).collect()} == {"e"}


def test_latest_reads_the_whole_snapshot_of_many_files(spark, folder):
    land_snapshot(spark.range(100).repartition(7), folder, datetime(2024, 1, 1))
    assert read_latest(spark, folder, spark.range(1).schema).count() == 100


def test_unfinished_runs_and_empty_days_are_passed_over(spark, folder):
    land_snapshot(spark.createDataFrame([("done", 1)], SMALL), folder, datetime(2024, 1, 1))
    land_snapshot(spark.createDataFrame([("half", 1)], SMALL), folder, datetime(2024, 1, 2))
    os.remove(f"{folder}/year=2024/month=1/day=2/run=20240102_000000/_SUCCESS")
    os.makedirs(f"{folder}/year=2024/month=2/day=1")
    os.makedirs(f"{folder}/year=2025")
    assert read_latest(spark, folder, SMALL).first().id == "done"


def test_no_snapshot_is_an_error(spark, folder):
    with pytest.raises(FileNotFoundError):
        latest_snapshot(spark, folder)
    land_file(folder, 2024, 1, 1, "notes.txt", [])
    with pytest.raises(FileNotFoundError):
        latest_snapshot(spark, folder)


def test_times_without_a_zone_are_the_sessions_not_the_drivers(spark, monkeypatch):
    noon = datetime(2024, 7, 1, 12)
    monkeypatch.setenv("TZ", "America/New_York")
    time.tzset()
    try:
        df = spark.range(1).select(instant(noon).cast("string").alias("at"))
        stamped = stamp(df, noon).select(F.col("ingested_date").cast("string"))
        opened = spark.sql("SELECT 1 AS k, 'a' AS v, TIMESTAMP_NTZ'2024-06-01 00:00:00' AS valid_from, CAST(NULL AS TIMESTAMP_NTZ) AS valid_to, true AS is_current")
        merged = scd2_merge(opened, spark.sql("SELECT 1 AS k, 'b' AS v"), ["k"], ["v"], noon).selectExpr("CAST(valid_to AS STRING) AS t")
        seen = {df.first().at, stamped.first()[0], *[r.t for r in merged.where("t IS NOT NULL").collect()]}
    finally:
        monkeypatch.undo()
        time.tzset()
    assert seen == {"2024-07-01 12:00:00"}
