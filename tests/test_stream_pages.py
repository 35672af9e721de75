"""Pages as a stream: repeated ones, late ones, restarts and the state that is let go."""

from datetime import datetime, timedelta
from glob import glob
import os

import pytest
from pyspark.sql import types as T

from frames import as_set
from tidemark.streaming.pages import latest_entities, page_states, stream_pages

START = datetime(2024, 1, 1)
SCHEMA = T.StructType().add("page", T.IntegerType()).add("id", T.StringType()).add("v", T.IntegerType()).add("fetched", T.TimestampType())


def land(spark, folder, name, page, hour, ids, v=0):
    rows = [(page, i, v, START + timedelta(hours=hour)) for i in ids]
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.json(f"{folder}/in/{name}")


def run(spark, folder, **options):
    query = stream_pages(
        spark, f"{folder}/in/*", f"{folder}/out", f"{folder}/ckpt", SCHEMA, ["page", "id"], "fetched", "10 hours", files=1, **options
    )
    query.awaitTermination()
    return page_states(query)


def taken(spark, folder):
    return as_set(spark.read.schema(SCHEMA).parquet(f"{folder}/out").select("page", "id", "v"))


@pytest.fixture(autouse=True)
def few_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def test_a_page_fetched_twice_is_taken_once_over_restarts(spark, folder):
    land(spark, folder, "a", 0, 0, "abc")
    land(spark, folder, "b", 0, 1, "abcd", v=1)  # again, and one row more
    seen = run(spark, folder)
    assert (seen["read"], seen["repeated"], seen["held"]) == (7, 3, 4) and len(taken(spark, folder)) == 4
    assert run(spark, folder)["read"] == 0
    land(spark, folder, "c", 0, 2, "abcd", v=2)
    land(spark, folder, "d", 1, 2, "ab")
    seen = run(spark, folder)
    assert (seen["read"], seen["repeated"]) == (6, 4) and len(taken(spark, folder)) == 6


def test_a_batch_that_is_replayed_is_not_written_twice(spark, folder):
    land(spark, folder, "a", 0, 0, "abc")
    run(spark, folder)
    before = taken(spark, folder)
    for path in glob(f"{folder}/ckpt/commits/*") + glob(f"{folder}/ckpt/commits/.*crc"):
        os.remove(path)
    run(spark, folder)
    assert taken(spark, folder) == before


def test_state_is_let_go_behind_the_watermark_and_late_rows_are_counted(spark, folder):
    land(spark, folder, "a", 0, 0, "abc")
    run(spark, folder)
    land(spark, folder, "b", 1, 30, "xyz")
    run(spark, folder)
    land(spark, folder, "c", 2, 31, "pq")
    seen = run(spark, folder)
    # The keys of page 0 are 30 hours old.
    assert seen["held"] == 5
    land(spark, folder, "d", 0, 5, "abc")
    land(spark, folder, "e", 1, 29, "xyzw")
    seen = run(spark, folder)
    assert (seen["late"], seen["repeated"]) == (3, 3) and len(taken(spark, folder)) == 9


def test_the_latest_of_an_entity_counts(spark):
    rows = [(0, "a", 1, START), (1, "a", 2, START + timedelta(hours=1)), (0, "b", 1, START), (1, "b", 0, START)]
    got = latest_entities(spark.createDataFrame(rows, SCHEMA), ["id"], "fetched")
    assert as_set(got.select("page", "id", "v")) == {(1, "a", 2), (1, "b", 0)}
