"""Facts with version keys: equal to point-in-time joins, also after the history changed behind them."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from frames import same_rows
from tidemark.functions.times import instant
from tidemark.operators.scd2 import scd2_as_of, scd2_merge, scd2_point_in_time, scd2_splice
from tidemark.plans.versioned import VERSION, fact_table, follow_history, load_facts, star_as_of, star_then
from tidemark.sources.changes import version_log

DAY = [datetime(2024, 1, d) for d in range(1, 12)]
STATES = T.StructType().add("k", T.IntegerType()).add("v", T.StringType())
FACTS = T.StructType().add("n", T.IntegerType()).add("k", T.IntegerType()).add("seen", T.TimestampType())


@pytest.fixture
def tables(spark, folder):
    history = version_log(spark, f"{folder}/h", STATES, ("k",), buckets=2)
    return history, fact_table(spark, f"{folder}/f", FACTS, ("n",), ("k",), T.TimestampType(), buckets=2)


def snapshot(spark, day):
    pick = random.Random(day)
    return spark.createDataFrame([(k, pick.choice("ab")) for k in range(9) if pick.random() < 0.8], STATES)


def facts(spark, first, count, seed):
    pick = random.Random(seed)
    rows = [(first + n, pick.choice([None, *range(11)]), DAY[0] + timedelta(hours=pick.randrange(-30, 240))) for n in range(count)]
    return spark.createDataFrame(rows, FACTS)


def take(spark, history, day, until=None):
    rows = snapshot(spark, day)
    if until is None:
        step = lambda: scd2_merge(history.opened(), rows, ["k"], ["v"], DAY[day], changes_only=True)
    else:
        step = lambda: scd2_splice(history.read(), rows, ["k"], ["v"], DAY[day], DAY[until], snapshot(spark, until))
    history.take(f"{day:02}", step)


def test_facts_keep_their_version_and_follow_a_late_run(spark, tables):
    history, log = tables
    take(spark, history, 0)
    take(spark, history, 4)
    first, second = facts(spark, 0, 150, 1), facts(spark, 1000, 60, 2)
    assert load_facts(log, "a", first, history, "seen").rows == 150
    assert load_facts(log, "a", first, history, "seen") is None
    follow_history(log, history, "seen")
    assert follow_history(log, history, "seen") is None

    def expected(rows):
        return scd2_point_in_time(rows, history.read(), ["k"], "seen", ["v"])

    assert same_rows(star_then(log, history, ["v"]).drop(VERSION), expected(first))
    # A late run, and one more at the end; facts that come meanwhile see what there is.
    take(spark, history, 2, until=4)
    load_facts(log, "b", second, history, "seen")
    take(spark, history, 7)
    moved = follow_history(log, history, "seen")
    both = first.union(second)
    assert same_rows(star_then(log, history, ["v"]).drop(VERSION), expected(both))
    assert 0 < moved.rows < 120 and log.read().count() == 210
    touched = log.rows(after=log.batches()[2]).select("n").distinct().count()
    assert touched < 210
    keyed = log.read().where(F.col(VERSION).isNotNull())
    assert keyed.join(history.read(), "k").where(F.col(VERSION) == F.col("valid_from")).count() == keyed.count()


def test_as_of_an_instant_is_as_rebuilt_that_day(spark, tables):
    history, log = tables
    for day in (0, 4, 7):
        take(spark, history, day)
    rows = facts(spark, 0, 100, 3)
    load_facts(log, "a", rows, history, "seen")
    for day in (2, 5, 9):
        then = instant(DAY[day])
        states = scd2_as_of(history.read(), DAY[day]).select("k", "v")
        want = rows.where(F.col("seen") <= then).join(states, "k", "left").select("n", "k", "seen", "v")
        assert same_rows(star_as_of(log, history, ["v"], "seen", then).drop(VERSION), want)
