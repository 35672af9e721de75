"""Tables kept as changes, late snapshots in any order, and gold kept up by signed changes."""

import glob
import itertools
import os
import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from frames import as_set, same_rows
from tidemark.operators.scd2 import (
    scd2_apply,
    scd2_check,
    scd2_from_history,
    scd2_merge,
    scd2_splice,
    scd2_splice_log,
)
from tidemark.sources.changes import ChangeLog, version_log

DAY = [datetime(2024, 1, d) for d in range(1, 20)]
COLUMNS = T.StructType().add("k", T.IntegerType()).add("v", T.StringType())


@pytest.fixture
def log(spark, folder):
    return version_log(spark, f"{folder}/h", COLUMNS, ("k",), buckets=4)


def merge(spark, log, run, rows, at):
    taken = spark.createDataFrame(rows, COLUMNS)
    return log.take(run, lambda: scd2_merge(log.opened(), taken, ["k"], ["v"], at, changes_only=True))


def test_versions_are_kept_by_their_changes(spark, log):
    assert log.batches() == [] and log.read().isEmpty() and log.opened().isEmpty()
    written = [
        merge(spark, log, "1", [(1, "a"), (2, "b")], DAY[0]).rows,
        merge(spark, log, "2", [(1, "a2"), (3, "c")], DAY[1]).rows,
        merge(spark, log, "3", [(1, "a2"), (3, "c3")], DAY[2]).rows,
        merge(spark, log, "4", [(1, "a2"), (3, "c3")], DAY[3]).rows,
    ]
    want = {
        (1, "a", DAY[0], DAY[1], False), (2, "b", DAY[0], DAY[1], False),
        (1, "a2", DAY[1], None, True), (3, "c", DAY[1], DAY[2], False), (3, "c3", DAY[2], None, True),
    }
    assert written == [2, 4, 2, 0]
    assert as_set(log.read()) == want and as_set(log.opened()) == {r for r in want if r[4]}
    assert log.runs() == ["1", "2", "3", "4"] and log.batches()[-1] == "000003-4"
    assert merge(spark, log, "3", [(9, "replayed")], DAY[3]) is None and as_set(log.read()) == want
    # Earlier states can be read, and what happened since.
    assert as_set(log.opened(upto="000000-1")) == {(1, "a", DAY[0], None, True), (2, "b", DAY[0], None, True)}
    signed = {(r.k, r.v, r.sign) for r in log.signed("000000-1", "000002-3").collect()}
    assert signed == {(1, "a", -1), (2, "b", -1), (1, "a2", 1), (3, "c3", 1)}
    assert log.signed("000002-3").isEmpty()


def test_a_frame_does_not_change_with_later_runs(spark, log):
    merge(spark, log, "1", [(1, "a")], DAY[0])
    before = log.read()
    merge(spark, log, "2", [(1, "b")], DAY[1])
    assert as_set(before) == {(1, "a", DAY[0], None, True)}


def test_a_run_that_died_is_invisible_and_repeatable(spark, log, folder):
    merge(spark, log, "1", [(1, "a")], DAY[0])
    merge(spark, log, "2", [(1, "b")], DAY[1])
    os.remove(f"{folder}/h/buckets=4/batch=000001-2/_SUCCESS")
    again = version_log(spark, f"{folder}/h", COLUMNS, ("k",), buckets=9)  # the data know better
    assert as_set(again.read()) == {(1, "a", DAY[0], None, True)}
    merge(spark, again, "2", [(1, "c")], DAY[1])
    want = {(1, "a", DAY[0], DAY[1], False), (1, "c", DAY[1], None, True)}
    assert as_set(again.read()) == as_set(log.read()) == want


def test_a_step_that_fails_leaves_the_table_as_it_was(spark, log):
    merge(spark, log, "1", [(1, "a")], DAY[1])
    before = as_set(log.read())
    with pytest.raises(Exception, match="not later"):
        merge(spark, log, "2", [(1, "b")], DAY[0])
    assert as_set(log.read()) == before and log.runs() == ["1"]


def test_another_session_reads_the_same_buckets(spark, log, folder):
    for i in range(3):
        merge(spark, log, str(i), [(k, f"v{i if k < 9 else 0}") for k in range(60)], DAY[i])
    other = version_log(spark.newSession(), f"{folder}/h", COLUMNS, ("k",))
    assert as_set(other.read()) == as_set(log.read()) and other.opened().count() == 60


def test_merging_shuffles_the_snapshot_and_nothing_of_the_history(spark, log):
    """No exchange above a scan of the history: not to find open rows, not to meet a snapshot."""
    for i in range(3):
        merge(spark, log, str(i), [(k, f"v{i if k < 9 else 0}") for k in range(60)], DAY[i])
    taken = spark.createDataFrame([(k, "new") for k in range(60)], COLUMNS)
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false",
        "spark.sql.maxMetadataStringLength": "10", "spark.sql.maxPlanStringLength": "1000000",
    }
    before = {c: spark.conf.get(c) for c in settings}
    for c, v in settings.items():
        spark.conf.set(c, v)
    try:
        merged = scd2_merge(log.opened(), taken, ["k"], ["v"], DAY[5], changes_only=True)
        splice = scd2_splice(log.read(), taken, ["k"], ["v"], DAY[5], DAY[6], taken)
        for df, joins in ((log.opened(), 0), (log.read(), 0), (merged, 1), (splice, 1)):
            plan, depth, scans = df._jdf.queryExecution().executedPlan().toString(), None, 0
            for line in plan.splitlines():
                at = len(line) - len(line.lstrip(" :+-"))
                if depth is not None and at <= depth:
                    depth = None
                if "Exchange" in line and depth is None:
                    depth = at
                if "FileScan" in line:
                    scans += 1
                    assert depth is None and "Bucketed: true" in line, plan
            # One pass over the history, and the snapshots are what is dealt out.
            assert scans == 1 and plan.count("SortMergeJoin") == joins and plan.count("Exchange") == joins, plan
    finally:
        for c, v in before.items():
            spark.conf.set(c, v)


def test_bucket_files_hold_their_keys_alone(spark, log, folder):
    merge(spark, log, "1", [(k, "v") for k in range(200)], DAY[0])
    files = glob.glob(f"{folder}/h/buckets=4/batch=000000-1/*.parquet")
    assert len(files) == 4
    per_file = spark.read.parquet(*files).select(F.input_file_name().alias("f"), F.expr("pmod(hash(k), 4)").alias("b"))
    assert per_file.distinct().count() == 4


def test_rows_can_go_and_come_back(spark, folder):
    log = ChangeLog(spark, f"{folder}/t", COLUMNS, ("k",), buckets=2)
    steps = ([(1, "a", False), (2, "b", False)], [(1, None, True)], [(1, "c", False)])
    seen = []
    for i, rows in enumerate(steps):
        changes = spark.createDataFrame(rows, T.StructType(list(COLUMNS)).add("gone", "boolean"))
        log.take(str(i), lambda: changes)
        seen.append(as_set(log.read()))
    assert seen == [{(1, "a"), (2, "b")}, {(2, "b")}, {(1, "c"), (2, "b")}]
    assert as_set(log.read(upto="000001-1")) == seen[1]


# Late snapshots

WIDE = "k int, v string, seen string"
HISTORY = WIDE + ", valid_from timestamp, valid_to timestamp, is_current boolean"


def plain_history(snapshots, on_missing):
    """Versions of (day, {k: (v, seen)}) merged in order, by loops."""
    open_, done = {}, set()
    for day, rows in sorted(snapshots.items()):
        for k in list(open_):
            if (k not in rows and on_missing == "close") or (k in rows and rows[k][0] != open_[k][1]):
                done.add((*open_[k][:3], open_[k][3], DAY[day], False))
                del open_[k]
        for k, (v, seen) in rows.items():
            open_.setdefault(k, (k, v, seen, DAY[day]))
    return done | {(*row, None, True) for row in open_.values()}


def snapshots_of(seed, days=5, keys=7, values=2):
    pick = random.Random(seed)
    return {
        d: {k: (pick.choice("abcdef"[:values]) if pick.random() < 0.9 else None, f"{d}{k}") for k in range(keys) if pick.random() < 0.7}
        for d in range(days)
    }


def frame(spark, rows, extra=""):
    return spark.createDataFrame(rows, WIDE + extra)


@pytest.mark.parametrize("on_missing, seed", [("close", 1), ("close", 2), ("keep", 3), ("keep", 4)])
def test_any_order_of_arrival_gives_the_history_of_the_right_order(spark, on_missing, seed):
    taken = snapshots_of(seed)
    orders = list(itertools.permutations(taken))
    for order in random.Random(seed).sample(orders, 3):
        versions, done = spark.createDataFrame([], HISTORY), []
        for day in order:
            rows = frame(spark, [(k, *s) for k, s in taken[day].items()])
            later = sorted(d for d in done if d > day)
            if not later:
                versions = scd2_merge(versions, rows, ["k"], ["v"], DAY[day], on_missing)
            else:
                if on_missing == "close":
                    following = frame(spark, [(k, *s) for k, s in taken[later[0]].items()])
                    changes = scd2_splice(versions, rows, ["k"], ["v"], DAY[day], DAY[later[0]], following)
                else:
                    words = {}
                    for d in reversed(later):
                        words |= {k: (k, *s, DAY[d]) for k, s in taken[d].items()}
                    following = frame(spark, list(words.values()), ", next timestamp")
                    changes = scd2_splice(versions, rows, ["k"], ["v"], DAY[day], "next", following, "keep")
                versions = scd2_apply(versions, changes, ["k"])
            done.append(day)
            # A frame of its own: the plan must not grow from step to step.
            versions = spark.createDataFrame(versions.collect(), HISTORY)
            assert as_set(versions) == plain_history({d: taken[d] for d in done}, on_missing), (order, day)
        assert scd2_check(versions, ["k"]).isEmpty()


def test_a_late_snapshot_that_says_nothing_new_changes_nothing(spark):
    versions = spark.createDataFrame([(1, "a", "x", DAY[0], None, True), (2, None, "y", DAY[0], DAY[4], False)], HISTORY)
    same = frame(spark, [(1, "a", "z"), (2, None, "z")])
    assert scd2_splice(versions, same, ["k"], ["v"], DAY[2], DAY[4]).isEmpty()


def test_splicing_fails_on_repeated_keys_and_taken_times(spark):
    versions = spark.createDataFrame([(1, "a", "x", DAY[2], None, True)], HISTORY)
    with pytest.raises(Exception, match="more than once"):
        scd2_splice(versions, frame(spark, [(1, "b", ""), (1, "c", "")]), ["k"], ["v"], DAY[3], DAY[4]).collect()
    with pytest.raises(Exception, match="begins at the time"):
        scd2_splice(versions, frame(spark, [(1, "b", "")]), ["k"], ["v"], DAY[2], DAY[4]).collect()
    with pytest.raises(Exception, match="must not be null"):
        scd2_splice(versions, frame(spark, [(None, "b", "")]), ["k"], ["v"], DAY[3], DAY[4]).collect()


def test_late_log_rows_last_until_the_next_word_on_their_key(spark):
    pick = random.Random(6)
    log = [(k, pick.choice("ab"), DAY[d]) for d in range(12) for k in range(6) if pick.random() < 0.6]
    parts = [[r for r in log if DAY[4 * n] <= r[2] < DAY[4 * n + 4]] for n in range(3)]
    schema = "k int, v string, at timestamp"
    a, b, c = (spark.createDataFrame(p, schema) for p in parts)
    versions = scd2_from_history(a.union(c), ["k"], ["v"], "at")
    late = scd2_splice_log(versions, b, c, ["k"], ["v"], "at")
    got = scd2_apply(versions, late, ["k"])
    assert same_rows(got, scd2_from_history(a.union(b).union(c), ["k"], ["v"], "at"))
    assert scd2_check(got, ["k"]).isEmpty()
    # Rows that are known already change nothing.
    assert scd2_splice_log(got, b, c, ["k"], ["v"], "at").isEmpty()
