import os
from datetime import datetime
from glob import glob

import pytest
from pyspark.sql import types as T

from frames import as_set, same_rows
from tidemark.operators.model import fact
from tidemark.operators.scd2 import scd2_check, scd2_from_history
from tidemark.plans.conform import conform
from tidemark.schema import ENTITY_SCHEMA, IS_CURRENT
from tidemark.sources.changes import version_log
from tidemark.sources.snapshot import announce_run, finished_runs, land_snapshot, run_path
from tidemark.streaming.jobs import read_silver, stream_scd2, stream_silver

DAY = [datetime(2024, 1, d) for d in range(1, 8)]
COLUMNS = T.StructType().add("k", T.IntegerType()).add("v", T.StringType())
LANDED = T.StructType(list(COLUMNS)).add("at", T.TimestampType())


def land(spark, base, rows, at):
    taken = spark.createDataFrame([(k, v, t) for k, v, t in rows], LANDED)
    land_snapshot(taken.repartition(3), base, at)


def run(spark, folder, table, **options):
    stream_scd2(
        spark, f"{folder}/in", table, f"{folder}/ckpt", ["k"], ["v"], "at", LANDED, **options
    ).awaitTermination()


@pytest.fixture
def table(spark, folder):
    return version_log(spark, f"{folder}/history", COLUMNS, ("k",), buckets=2)


def test_each_run_is_conformed_once_and_the_latest_is_current(spark, folder):
    def entities(ids, city):
        rows = [tuple({"id": i, "city": city, "phone": "+1 5"}.get(f) for f in ENTITY_SCHEMA.names) for i in ids]
        return spark.createDataFrame(rows, ENTITY_SCHEMA)

    def run_once():
        stream_silver(spark, f"{folder}/in", f"{folder}/out", f"{folder}/ckpt").awaitTermination()
        return read_silver(spark, f"{folder}/out").drop("run")

    assert run_once().isEmpty()
    first, second = entities("abc", "São Paulo"), entities("bcd", "München")
    land_snapshot(first.repartition(2), f"{folder}/in", DAY[0])
    assert same_rows(run_once(), conform(first))
    land_snapshot(second, f"{folder}/in", DAY[1])
    got = run_once()
    assert same_rows(got.where(IS_CURRENT), conform(second))
    assert same_rows(got.where(f"NOT {IS_CURRENT}").drop(IS_CURRENT), conform(first).drop(IS_CURRENT))
    assert run_once().count() == 6
    assert sorted(r.entity_id for r in fact(run_once()).collect()) == ["b", "c", "d"]


def test_history_follows_the_stream(spark, folder, table):
    log = [(k, "abc"[(k * d) % 3], DAY[d]) for d in range(1, 5) for k in range(10) if (k + d) % 4]
    for d in (1, 3):
        land(spark, f"{folder}/in", [r for r in log if DAY[d] <= r[2] <= DAY[d + 1]], DAY[d])
        run(spark, folder, table)
    want = scd2_from_history(spark.createDataFrame(log, LANDED), ["k"], ["v"], "at")
    assert same_rows(table.read(), want)
    assert scd2_check(table.read(), ["k"]).isEmpty()


@pytest.mark.parametrize("on_missing", ["keep", "close"])
def test_a_run_in_several_files_is_one_step(spark, folder, table, on_missing):
    for d in (0, 1):
        land(spark, f"{folder}/in", [(k, "a", DAY[d]) for k in range(9)], DAY[d])
        run(spark, folder, table, on_missing=on_missing)
    assert len(glob(f"{run_path(f'{folder}/in', DAY[0])}/part-*")) > 1
    assert as_set(table.read()) == {(k, "a", DAY[0], None, True) for k in range(9)}


@pytest.mark.parametrize("count", [2, 5])
def test_all_runs_since_the_last_start_are_taken_in_order(spark, folder, table, count):
    land(spark, f"{folder}/in", [(1, "v0", DAY[0]), (2, "x", DAY[0])], DAY[0])
    run(spark, folder, table, on_missing="close")
    for d in range(count, 0, -1):  # landed in another order
        land(spark, f"{folder}/in", [(1, f"v{d}", DAY[d])], DAY[d])
    run(spark, folder, table, on_missing="close")
    want = {(1, f"v{d}", DAY[d], DAY[d + 1], False) for d in range(count)}
    want |= {(1, f"v{count}", DAY[count], None, True), (2, "x", DAY[0], DAY[1], False)}
    assert as_set(table.read()) == want
    assert scd2_check(table.read(), ["k"]).isEmpty()


@pytest.mark.parametrize("on_missing", ["keep", "close"])
def test_a_run_that_finishes_late_is_spliced_in(spark, folder, table, on_missing):
    land(spark, f"{folder}/in", [(1, "a", DAY[0]), (2, "b", DAY[0])], DAY[0])
    land(spark, f"{folder}/in", [(1, "x", DAY[1])], DAY[1])
    marker = f"{run_path(f'{folder}/in', DAY[1])}/_SUCCESS"
    os.rename(marker, f"{folder}/held")
    assert [r.run for r in finished_runs(spark, f"{folder}/in")] == ["20240101_000000"]
    land(spark, f"{folder}/in", [(1, "a", DAY[2]), (2, "b", DAY[2])], DAY[2])
    run(spark, folder, table, on_missing=on_missing)
    assert as_set(table.read()) == {(1, "a", DAY[0], None, True), (2, "b", DAY[0], None, True)}
    os.rename(f"{folder}/held", marker)
    announce_run(spark, f"{folder}/in", "20240102_000000", run_path(f"{folder}/in", DAY[1]), 1)
    run(spark, folder, table, on_missing=on_missing)
    want = {(1, "a", DAY[0], DAY[1], False), (1, "x", DAY[1], DAY[2], False), (1, "a", DAY[2], None, True)}
    if on_missing == "close":
        want |= {(2, "b", DAY[0], DAY[1], False), (2, "b", DAY[2], None, True)}
    else:
        want |= {(2, "b", DAY[0], None, True)}
    assert as_set(table.read()) == want
    assert table.runs() == ["20240101_000000", "20240102_000000", "20240103_000000"]
    assert scd2_check(table.read(), ["k"]).isEmpty()


def test_a_late_run_is_conformed_but_not_current(spark, folder):
    def entities(i):
        return spark.createDataFrame([tuple({"id": i}.get(f) for f in ENTITY_SCHEMA.names)], ENTITY_SCHEMA)

    for d in (0, 2, 1):
        land_snapshot(entities(f"e{d}"), f"{folder}/in", DAY[d])
        stream_silver(spark, f"{folder}/in", f"{folder}/out", f"{folder}/ckpt").awaitTermination()
    assert {(r.id, r.is_current) for r in read_silver(spark, f"{folder}/out").collect()} == {
        ("e0", False), ("e1", False), ("e2", True),
    }


def test_an_empty_run_is_an_error_unless_allowed(spark, folder, table):
    land(spark, f"{folder}/in", [(1, "a", DAY[0])], DAY[0])
    run(spark, folder, table, on_missing="close")
    land(spark, f"{folder}/in", [], DAY[1])
    for _ in range(2):
        with pytest.raises(Exception, match="finished but empty"):
            run(spark, folder, table, on_missing="close")
    run(spark, folder, table, on_missing="close", allow_empty=True)
    assert as_set(table.read()) == {(1, "a", DAY[0], None, True)}


def test_a_restart_after_a_failure_goes_on(spark, folder, table):
    land(spark, f"{folder}/in", [(1, "a", DAY[0])], DAY[0])
    land(spark, f"{folder}/in", [(1, "b", DAY[1]), (1, "c", DAY[2])], DAY[1])
    land(spark, f"{folder}/in", [(1, "d", DAY[3])], DAY[3])
    with pytest.raises(Exception, match="single time per run"):
        run(spark, folder, table, on_missing="close")
    assert as_set(table.read()) == {(1, "a", DAY[0], None, True)}
    land(spark, f"{folder}/in", [(1, "b", DAY[1])], DAY[1])  # landed again, right this time
    run(spark, folder, table, on_missing="close")
    assert as_set(table.read()) == {
        (1, "a", DAY[0], DAY[1], False), (1, "b", DAY[1], DAY[3], False), (1, "d", DAY[3], None, True),
    }


def test_a_replayed_batch_changes_nothing(spark, folder, table):
    land(spark, f"{folder}/in", [(1, "a", DAY[0]), (2, "b", DAY[0])], DAY[0])
    run(spark, folder, table)
    before, taken = as_set(table.read()), table.batches()
    # The run was committed to the table, but the stream does not know it.
    for path in glob(f"{folder}/ckpt/commits/*") + glob(f"{folder}/ckpt/commits/.*crc"):
        os.remove(path)
    run(spark, folder, table)
    assert as_set(table.read()) == before and table.batches() == taken


def test_absence_closes_only_on_request(spark, folder, table):
    land(spark, f"{folder}/in", [(1, "a", DAY[0]), (2, "b", DAY[0])], DAY[0])
    run(spark, folder, table, on_missing="close")
    land(spark, f"{folder}/in", [(1, "a", DAY[1])], DAY[1])
    run(spark, folder, table, on_missing="close")
    assert as_set(table.read()) == {(1, "a", DAY[0], None, True), (2, "b", DAY[0], DAY[1], False)}
