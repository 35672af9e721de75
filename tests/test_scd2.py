import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from frames import as_set, same_rows
from tidemark.operators.ordered import hot_keys, latest_per_key, split_hot_keys
from tidemark.operators.scd2 import (
    scd2_as_of,
    scd2_check,
    scd2_current,
    scd2_extend,
    scd2_from_history,
    scd2_initial,
    scd2_merge,
    scd2_point_in_time,
    snapshot_diff,
)

S0, S1, S2 = (datetime(2024, 1, d) for d in (1, 2, 3))
TABLE = "k int, v string, valid_from timestamp, valid_to timestamp, is_current boolean"
LOG = "k int, v string, at timestamp, n int"


@pytest.fixture
def current(spark):
    rows = [(1, "A", S1, None, True), (2, "B", S1, None, True), (3, "C", S1, None, True),
            (1, "Z", S0, S1, False)]
    return spark.createDataFrame(rows, TABLE)


@pytest.fixture
def snapshot(spark):
    return spark.createDataFrame([(1, "A"), (2, "B2"), (4, "D")], "k int, v string")


MERGED = {
    (1, "A", S1, None, True), (2, "B2", S2, None, True), (4, "D", S2, None, True),
    (1, "Z", S0, S1, False), (2, "B", S1, S2, False), (3, "C", S1, S2, False),
}


def test_snapshot_diff(current, snapshot):
    assert as_set(snapshot_diff(scd2_current(current), snapshot, ["k"], ["v"])) == {
        (1, "same", "A", "A"), (2, "update", "B", "B2"), (3, "close", "C", None),
        (4, "insert", None, "D"),
    }


def test_diff_is_null_safe_and_tells_absence_from_null(spark):
    old = spark.createDataFrame([(1, None), (2, None), (3, "x")], "k int, v string")
    new = spark.createDataFrame([(1, None), (2, "y"), (4, None)], "k int, v string")
    got = {(r.k, r.action) for r in snapshot_diff(old, new, ["k"], ["v"]).collect()}
    assert got == {(1, "same"), (2, "update"), (3, "close"), (4, "insert")}


def test_merge(current, snapshot):
    assert as_set(scd2_merge(current, snapshot, ["k"], ["v"], S2)) == MERGED


def test_merge_again_changes_nothing(current, snapshot):
    once = scd2_merge(current, snapshot, ["k"], ["v"], S2)
    assert as_set(scd2_merge(once, snapshot, ["k"], ["v"], S2)) == MERGED


def test_merge_keeps_missing(current, snapshot):
    kept = scd2_merge(current, snapshot, ["k"], ["v"], S2, on_missing="keep")
    assert as_set(kept) == MERGED - {(3, "C", S1, S2, False)} | {(3, "C", S1, None, True)}
    with pytest.raises(ValueError):
        scd2_merge(current, snapshot, ["k"], ["v"], S2, on_missing="drop")


def test_key_that_returns_is_inserted(spark, current):
    gone = spark.createDataFrame([(1, "A")], "k int, v string")
    back = spark.createDataFrame([(1, "A"), (3, "C")], "k int, v string")
    closed = scd2_merge(current, gone, ["k"], ["v"], S2)
    later = S2 + timedelta(days=1)
    third = scd2_merge(closed, back, ["k"], ["v"], later).where("k = 3")
    assert as_set(third) == {(3, "C", S1, S2, False), (3, "C", later, None, True)}


def test_merge_picks_the_last_row_of_a_key(spark, current):
    pages = spark.createDataFrame([(1, "A", 1), (1, "A9", 2), (2, "B", 1), (3, "C", 1)], "k int, v string, n int")
    got = scd2_merge(current, pages, ["k"], ["v"], S2, order=["n"])
    assert {r.v for r in got.where("k = 1 and is_current").collect()} == {"A9"}


def test_merge_carries_untracked_columns(spark):
    table = spark.createDataFrame(
        [(1, "A", "old", S1, None, True), (2, "B", "old", S1, None, True)],
        "k int, v string, seen string, valid_from timestamp, valid_to timestamp, is_current boolean",
    )
    taken = spark.createDataFrame([(1, "A", "new"), (2, "B2", "new")], "k int, v string, seen string")
    open_rows = scd2_current(scd2_merge(table, taken, ["k"], ["v"], S2))
    assert {(r.k, r.seen) for r in open_rows.collect()} == {(1, "old"), (2, "new")}


def test_merge_refuses_late_snapshots_and_null_keys(spark, current, snapshot):
    with pytest.raises(Exception, match="not later"):
        scd2_merge(current, snapshot, ["k"], ["v"], S1).collect()
    broken = spark.createDataFrame([(None, "A")], "k int, v string")
    with pytest.raises(Exception, match="must not be null"):
        scd2_merge(current, broken, ["k"], ["v"], S2).collect()


def test_merge_refuses_duplicate_keys_and_a_null_time(spark, current):
    twice = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k int, v string")
    with pytest.raises(Exception, match="more than once"):
        scd2_merge(current, twice, ["k"], ["v"], S0 + timedelta(days=9)).collect()
    once = twice.where("k = 2")
    with pytest.raises(ValueError, match="time of the snapshot"):
        scd2_merge(current, once, ["k"], ["v"], None)
    with pytest.raises(Exception, match="time of the snapshot"):
        scd2_merge(current, once, ["k"], ["v"], F.lit(None).cast("timestamp")).collect()


@pytest.mark.parametrize("instants", [1, 3, 30])
def test_hot_key_with_few_instants_is_cut(spark, instants):
    """All rows of a hot key on few dates, or on one: no range keeps most of them, results stay."""
    from tidemark.operators.ordered import RANGE, split_hot_keys

    days = [S0 + timedelta(days=d) for d in range(instants)]
    facts = spark.createDataFrame(
        [(1, days[n % instants], n) for n in range(6000)] + [(2, days[0], -1), (None, days[0], -2)],
        "k int, at timestamp, n int",
    )
    versions = [(1, "before", S0 - timedelta(days=5), days[0]), (1, "on", days[0], None), (2, "x", days[-1], None)]
    versions = spark.createDataFrame(versions, "k int, v string, valid_from timestamp, valid_to timestamp")
    dealt, ranges = split_hot_keys(facts, ["k"], "at", 8, 100, spread=F.xxhash64("n"))
    assert ranges is not None
    largest = dealt.where("k = 1").groupBy(RANGE).count().agg(F.max("count")).first()[0]
    assert largest <= 6000 / 8 * 2 + 6000 / instants * (instants > 8)
    got = scd2_point_in_time(facts, versions, ["k"], "at", ["v"], parts=8, min_rows=100)
    want = {(n, "on") for n in range(6000)} | {(-1, "x" if instants == 1 else None), (-2, None)}
    assert {(r.n, r.v) for r in got.collect()} == want


def test_merge_does_not_shuffle_closed_history(spark, current, snapshot, folder):
    current.write.parquet(f"{folder}/t")
    stored = spark.read.parquet(f"{folder}/t")
    plan = scd2_merge(stored, snapshot, ["k"], ["v"], S2)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2
    assert "CartesianProduct" not in plan and "BroadcastNestedLoop" not in plan


def test_initial_current_as_of(current):
    first = scd2_initial(current.select("k", "v", F.lit(S0).alias("at")), "at")
    assert {(r.valid_from, r.valid_to, r.is_current) for r in first.collect()} == {(S0, None, True)}
    assert scd2_current(current).count() == 3
    assert {r.v for r in scd2_as_of(current, S0).collect()} == {"Z"}
    assert {r.v for r in scd2_as_of(current, S1).collect()} == {"A", "B", "C"}
    assert scd2_as_of(current, S0 - timedelta(days=1)).count() == 0


def test_latest_per_key_drops_duplicates_before_the_shuffle(spark, folder):
    rows = [(1, 5, "a"), (1, 7, "b"), (1, 7, "c"), (2, None, "d"), (2, 1, "e"), (3, None, "f")]
    spark.createDataFrame(rows, "k int, n int, v string").write.parquet(f"{folder}/t")
    df = latest_per_key(spark.read.parquet(f"{folder}/t"), ["k"], ["n", "v"])
    assert {(r.k, r.v) for r in df.collect()} == {(1, "c"), (2, "e"), (3, "f")}
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def skewed_log(seed, rows=600, keys=8, instants=60):
    """A log in which key 0 holds about half of all rows; ties and nulls included."""
    rnd = random.Random(seed)
    out = []
    for n in range(rows):
        k = 0 if rnd.random() < 0.5 else rnd.randrange(keys)
        at = S0 + timedelta(minutes=rnd.randrange(instants))
        out.append((k, rnd.choice(["a", "b", None]), at, n))
    return out


def versions_by_hand(log):
    """Versions per key from sorted rows, the plain way."""
    out, by_key = set(), {}
    for k, v, at, n in sorted(log, key=lambda r: (r[0], r[2], r[3])):
        by_key.setdefault(k, {})[at] = v
    for k, states in by_key.items():
        changes, before = [], object()
        for at, v in sorted(states.items()):
            if v != before:
                changes.append((at, v))
            before = v
        ends = [at for at, _ in changes[1:]] + [None]
        out |= {(k, v, at, end, end is None) for (at, v), end in zip(changes, ends)}
    return out


@pytest.mark.parametrize("limits", [{}, {"parts": 6, "min_rows": 0}, {"parts": 40, "min_rows": 0}])
@pytest.mark.parametrize("seed", [1, 2])
def test_from_history_by_brute_force(spark, seed, limits):
    log = skewed_log(seed)
    df = spark.createDataFrame(log, LOG)
    got = scd2_from_history(df, ["k"], ["v"], "at", ["n"], **limits)
    assert as_set(got) == versions_by_hand(log)
    assert scd2_check(got, ["k"]).isEmpty()


def test_cuts_of_naive_times_do_not_depend_on_the_zone(spark):
    log = [(k, v, datetime(2024, 3, 31) + (at - S0) * 4, n) for k, v, at, n in skewed_log(9)]
    df = spark.createDataFrame(log, LOG.replace("timestamp", "timestamp_ntz"))
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        got = scd2_from_history(df, ["k"], ["v"], "at", ["n"], parts=20, min_rows=0)
        assert as_set(got) == versions_by_hand(log)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_hot_keys_are_cut(spark):
    df = spark.createDataFrame(skewed_log(3), LOG)
    hot = hot_keys(df, ["k"], 10, 0)
    assert 0 in {r.k for r in hot.collect()} and hot.count() < 10
    assert hot_keys(df, ["k"], 10, 10_000) is None
    rows, ranges = split_hot_keys(df, ["k"], "at", 10, 0)
    assert rows.count() == df.count() and {r.k for r in ranges.cuts.collect()} >= {0}
    sizes = {r["_range"]: r["count"] for r in rows.where("k = 0").groupBy("_range").count().collect()}
    assert len(sizes) > 3 and max(sizes.values()) < 0.3 * df.count()


def test_many_cuts_are_looked_up_in_blocks(spark):
    rows = [(0, None, S0 + timedelta(seconds=n), n) for n in range(3000)]
    df = spark.createDataFrame(rows, LOG)
    cut, ranges = split_hot_keys(df, ["k"], "at", 500, 0)
    cuts = ranges.cuts.first()["_cuts"]
    assert len(cuts) > 200 and cuts == sorted(cuts)
    for r in cut.where("n % 7 = 0").collect():
        assert r["_range"] == sum(c <= r["at"] for c in cuts)
    assert cut.groupBy("_range").count().agg(F.max("count")).first()[0] < 60


def test_one_exchange_without_hot_keys(spark, folder):
    spark.createDataFrame(skewed_log(4), LOG).write.parquet(f"{folder}/t")
    df = scd2_from_history(spark.read.parquet(f"{folder}/t"), ["k"], ["v"], "at", ["n"])
    assert df._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1


def test_history_of_one_instant_keeps_the_last_row(spark):
    df = spark.createDataFrame([(1, "a", S0, 1), (1, "b", S0, 2), (1, "b", S1, 3)], LOG)
    assert as_set(scd2_from_history(df, ["k"], ["v"], "at", ["n"])) == {(1, "b", S0, None, True)}


@pytest.mark.parametrize("limits", [{}, {"parts": 6, "min_rows": 0}, {"parts": 30, "min_rows": 0}])
@pytest.mark.parametrize("how", ["left", "inner"])
def test_point_in_time_by_brute_force(spark, limits, how):
    versions = [v for v in versions_by_hand(skewed_log(5)) if v[0] != 3]
    # Leave gaps: every third version is missing.
    versions = [v for i, v in enumerate(sorted(versions, key=str)) if i % 3]
    facts = [(n, k, at) for k, _, at, n in skewed_log(6)] + [(9000, None, S1), (9001, 99, S1)]

    def find(k, at):
        return [v for v in versions if v[0] == k and v[2] <= at and (v[3] is None or at < v[3])]

    want = set()
    for n, k, at in facts:
        found = find(k, at)
        if found:
            want.add((n, k, at, found[0][1], found[0][2]))
        elif how == "left":
            want.add((n, k, at, None, None))
    got = scd2_point_in_time(
        spark.createDataFrame(facts, "n int, k int, at timestamp"),
        spark.createDataFrame(versions, TABLE),
        ["k"], "at", ["v", "valid_from"], how, **limits,
    )
    assert as_set(got) == want


def test_point_in_time_never_pairs_rows(spark):
    facts = spark.createDataFrame([(1, 1, S1)], "n int, k int, at timestamp")
    versions = spark.createDataFrame([(1, "a", S0, None, True)], TABLE)
    got = scd2_point_in_time(facts, versions, ["k"], "at", ["v"])
    assert "Join" not in got._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("limits", [{}, {"parts": 4, "min_rows": 0}])
def test_check_finds_each_violation(spark, limits):
    rows = [
        (1, "a", S0, S1, False), (1, "b", S1, None, True),                      # sound
        (2, "a", S0, S2, False), (2, "b", S1, None, True),                      # overlap
        (3, "a", S1, S1, False),                                                # empty
        (4, "a", S0, None, True), (4, "b", S1, None, True),                     # overlap, two open
        (5, "a", S0, None, False),                                              # flag
        (6, "a", S0, S2, False), (6, "b", S1, S1 + timedelta(hours=1), False), (6, "c", S2, None, True),
    ]
    got = as_set(scd2_check(spark.createDataFrame(rows, TABLE), ["k"], **limits))
    assert got == {
        (2, "overlap", 1), (3, "empty", 1), (4, "overlap", 1), (4, "open", 1), (5, "flag", 1),
        (6, "overlap", 1),
    }


@pytest.mark.parametrize("limits", [{}, {"parts": 5, "min_rows": 0}])
def test_check_of_overlaps_by_brute_force(spark, limits):
    rnd = random.Random(8)
    rows, want = [], {}
    for n in range(400):
        k = 0 if rnd.random() < 0.6 else rnd.randrange(1, 6)
        start = S0 + timedelta(minutes=n)
        rows.append((k, "x", start, start + timedelta(minutes=rnd.choice([1, 2, 3, 40])), False))
    for i, (k, _, start, _, _) in enumerate(rows):
        if any(r[0] == k and r[3] > start for r in rows[:i]):
            want[k] = want.get(k, 0) + 1
    got = scd2_check(spark.createDataFrame(rows, TABLE), ["k"], **limits)
    assert as_set(got) == {(k, "overlap", n) for k, n in want.items()}


def test_extend_equals_merging_one_snapshot_after_the_other(spark, current):
    log = spark.createDataFrame(
        [(1, "A", S2, 1), (2, "B2", S2, 2), (4, "D", S2, 3), (2, "B", S2 + timedelta(days=1), 4),
         (4, "D", S2 + timedelta(days=1), 5)], LOG,
    )
    opened = scd2_current(current)
    got = scd2_extend(opened, log, ["k"], ["v"], "at", ["n"])
    want = opened
    for at in (S2, S2 + timedelta(days=1)):
        want = scd2_merge(want, log.where(F.col("at") == at).select("k", "v"), ["k"], ["v"], at, "keep")
    assert same_rows(got, want)
    again = scd2_extend(scd2_current(got), log.where("at > '2024-01-03'"), ["k"], ["v"], "at", ["n"])
    assert same_rows(again, scd2_current(got))


def test_extend_refuses_rows_from_the_past(spark, current):
    log = spark.createDataFrame([(1, "Q", S0, 1)], LOG)
    with pytest.raises(Exception, match="older than the open version"):
        scd2_extend(scd2_current(current), log, ["k"], ["v"], "at").collect()


@pytest.mark.parametrize("seed", range(3))
def test_invariants_after_random_snapshots(spark, seed, folder):
    rnd = random.Random(seed)
    history = spark.createDataFrame([], TABLE)
    for step in range(4):
        taken = {k: rnd.choice(["a", "b", None]) for k in range(12) if rnd.random() < 0.7}
        taken[0] = "always"
        rows = spark.createDataFrame([Row(k=k, v=v) for k, v in taken.items()], "k int, v string")
        merged = scd2_merge(history, rows, ["k"], ["v"], S0 + timedelta(days=step))
        merged.write.parquet(f"{folder}/{step}")
        history = spark.read.parquet(f"{folder}/{step}")
        assert {(r.k, r.v) for r in scd2_current(history).collect()} == set(taken.items())
        assert scd2_check(history, ["k"]).isEmpty()
