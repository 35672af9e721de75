"""Gold kept up by signed changes: equal to a rebuild after every run, and as little written as changed."""

import random
from datetime import datetime
from glob import glob

import pytest

from frames import as_set, same_rows
from tidemark.operators.model import fact_sk, kind_dim_sk, location_dim_sk, star_view_sk, type_location_agg
from tidemark.operators.scd2 import scd2_check
from tidemark.plans import gold
from tidemark.plans.gold import history_table, read_gold, read_star, runs_to_star
from tidemark.plans.maintain import gold_logs, refresh, rows_written
from tidemark.schema import ENTITY_SCHEMA, EntitySpec
from tidemark.sources.snapshot import land_snapshot

SPEC = EntitySpec()
DAY = [datetime(2024, 1, d) for d in range(1, 9)]


def land(spark, folder, entities, day):
    rows = [tuple({"id": i, "ingested_date": DAY[day], **e}.get(f) for f in ENTITY_SCHEMA.names) for i, e in entities.items()]
    land_snapshot(spark.createDataFrame(rows, ENTITY_SCHEMA), f"{folder}/in", DAY[day])


def rebuilt(table):
    """Gold from the open versions, all of it."""
    opened = table.opened()
    return {
        "fact": fact_sk(opened), "location": location_dim_sk(opened), "kind": kind_dim_sk(opened),
        "rollup": type_location_agg(opened),
    }


def some(pick, day, count=12):
    return {
        f"e{i}": {
            "name": pick.choice("ab"), "entity_type": pick.choice(["bar", "pub", None]), "city": pick.choice(["São", "Rio"]),
            "state": "S", "country": pick.choice([None, "B"]), "postal_code": pick.choice(["1", "2"]), "longitude": pick.choice([0.0, 1.0]),
        }
        for i in range(count) if pick.random() < 0.8
    }


@pytest.mark.parametrize("on_missing", ["close", "keep"])
def test_equal_to_a_rebuild_over_five_runs_one_of_them_late(spark, folder, on_missing):
    pick = random.Random(7)
    snapshots = {d: some(pick, d) for d in range(5)}
    for day in (0, 1, 3, 2, 4):
        land(spark, folder, snapshots[day], day)
        table = runs_to_star(spark, f"{folder}/in", f"{folder}/out", on_missing=on_missing, buckets=2)
        kept = read_gold(spark, f"{folder}/out")
        for name, want in rebuilt(table).items():
            assert same_rows(kept[name], want), (day, name)
        if on_missing == "close" and day == max(int(r[6:8]) - 1 for r in table.runs()):
            assert {r.id for r in table.opened().collect()} == set(snapshots[day])
    assert scd2_check(table.read(), ["id"]).isEmpty()
    want = star_view_sk(*[rebuilt(table)[n] for n in ("fact", "location", "kind")])
    assert same_rows(read_star(spark, f"{folder}/out"), want)


def test_what_is_written_follows_what_changed(spark, folder):
    base = {f"e{i:03}": {"name": "n", "entity_type": "t", "city": f"c{i % 5}", "country": "B", "postal_code": "1"} for i in range(300)}
    land(spark, folder, base, 0)
    table = history_table(spark, f"{folder}/out")
    logs = gold_logs(spark, f"{folder}/out", table.columns)
    runs_to_star(spark, f"{folder}/in", f"{folder}/out", buckets=2)
    assert refresh(table, logs) == {}
    # One moves to a new city, one is renamed, one goes.
    changed = {**base, "e000": {**base["e000"], "city": "new"}, "e001": {**base["e001"], "name": "m"}}
    del changed["e002"]
    land(spark, folder, changed, 1)
    runs_to_star(spark, f"{folder}/in", f"{folder}/out", buckets=2)
    wrote = {
        name: spark.read.parquet(f"{folder}/out/{name}/buckets=2/batch=000001-{table.batches()[-1]}").count() for name in logs
    }
    # Three entities; two cities lose, one comes; the kind loses one; three cities' groups.
    assert wrote == {"fact": 3, "location": 3, "kind": 1, "rollup": 4}
    assert spark.read.parquet(f"{folder}/out/history/buckets=2/batch={table.batches()[-1]}").count() == 5
    for name, want in rebuilt(table).items():
        assert same_rows(read_gold(spark, f"{folder}/out")[name], want)


def test_the_latest_time_of_a_group_is_looked_up_when_it_goes(spark, folder):
    one = {"name": "n", "entity_type": "t", "city": "c", "country": "B"}
    land(spark, folder, {"a": one}, 0)
    land(spark, folder, {"a": one, "b": one}, 1)
    land(spark, folder, {"a": one, "b": one, "c": one}, 2)
    runs_to_star(spark, f"{folder}/in", f"{folder}/out", buckets=2)
    rollup = lambda: {(r.entity_count, r.last_updated) for r in read_gold(spark, f"{folder}/out")["rollup"].collect()}
    assert rollup() == {(3, DAY[2])}
    land(spark, folder, {"a": one, "b": one}, 3)
    runs_to_star(spark, f"{folder}/in", f"{folder}/out", buckets=2)
    assert rollup() == {(2, DAY[1])}
    land(spark, folder, {"c": one}, 4)
    runs_to_star(spark, f"{folder}/in", f"{folder}/out", buckets=2)
    assert rollup() == {(1, DAY[4])}


def test_a_refresh_that_died_half_way_goes_on(spark, folder):
    one = {"name": "n", "entity_type": "t", "city": "c", "country": "B"}
    land(spark, folder, {"a": one}, 0)
    table = runs_to_star(spark, f"{folder}/in", f"{folder}/out", buckets=2)
    land(spark, folder, {"a": one, "b": {**one, "city": "d"}}, 1)
    land(spark, folder, {"b": {**one, "city": "d"}}, 2)
    logs = gold_logs(spark, f"{folder}/out", table.columns)

    # The first new run reaches the fact alone.
    from tidemark.operators.scd2 import scd2_merge
    from tidemark.plans.conform import conform
    from tidemark.sources.snapshot import finished_runs, read_snapshot

    run = finished_runs(spark, f"{folder}/in")[1]
    payload = [c for c in table.columns.names if not c.startswith("valid_") and c != "is_current"]
    rows = conform(read_snapshot(spark, run)).select(*payload)
    table.take(run.run, lambda: scd2_merge(table.opened(), rows, ["id"], ["name", "city"], DAY[1], changes_only=True))
    assert rows_written(refresh(table, {"fact": logs["fact"]})) == 1
    runs_to_star(spark, f"{folder}/in", f"{folder}/out", buckets=2)
    for name, want in rebuilt(table).items():
        assert same_rows(read_gold(spark, f"{folder}/out")[name], want)
    assert as_set(logs["location"].read().select("city_name", "member_count")) == {("d", 1)}


def test_buckets_follow_the_first_run_and_only_the_run_moves(spark, folder, monkeypatch):
    """With more partitions than buckets, too, the history stays where it is, and changes are written from there."""
    monkeypatch.setattr(gold, "ROWS_PER_BUCKET", 20)

    def taken(day, count, cities):
        land(spark, folder, {f"e{i}": {"city": f"c{i % cities}"} for i in range(count)}, day)
        return runs_to_star(spark, f"{folder}/in", f"{folder}/out", buckets=2)

    taken(1, 55, 3), taken(5, 50, 4)
    table = taken(3, 60, 5)  # late
    logs = gold_logs(spark, f"{folder}/out", table.columns)
    assert [log.width() for log in (table, *logs.values())] == [3] * 5
    for log in (table, logs["fact"]):
        for batch in log.batches():
            files = glob(f"{log.path}/buckets=3/batch={batch}/*.parquet")
            assert len(files) == len({name.rsplit("_", 1)[1] for name in files}) == 3
    for run in glob(f"{folder}/in/year=*/month=*/day=*/run=*"):
        assert glob(f"{run}/*.json.gz") and not glob(f"{run}/*.json")
    assert scd2_check(table.read(), ["id"]).isEmpty() and table.opened().count() == 50
    for name, want in rebuilt(table).items():
        kept = read_gold(spark, f"{folder}/out")[name]
        assert same_rows(kept, want), name


def test_signed_rows_are_as_wide_as_gold_and_summed_once(spark, folder):
    shared = spark.conf.get("spark.checkpoint.dir")
    before = set(glob(f"{shared}/*"))
    entity = {"name": "n", "entity_type": "bar", "address_1": "1 Way", "city": "Rio", "country": "B", "longitude": 0.0}
    land(spark, folder, {f"e{i}": {**entity, "longitude": float(i % 2)} for i in range(6)}, 0)
    table = runs_to_star(spark, f"{folder}/in", f"{folder}/out", buckets=2)
    scratch = {p.split("/")[-1].split("-")[0]: p for p in set(glob(f"{shared}/*")) - before}
    signed = spark.read.parquet(f"{scratch['signed']}/buckets=2").columns
    assert {"address_1", "full_address"} <= set(table.columns.names) and not {"address_1", "full_address"} & set(signed)
    assert {r["_net"] for r in spark.read.parquet(scratch["cells"]).collect()} == {3}
    kept = read_gold(spark, f"{folder}/out")
    assert all(same_rows(kept[name], want) for name, want in rebuilt(table).items())
