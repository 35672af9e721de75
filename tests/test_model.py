from datetime import datetime

import pytest
from pyspark.sql import functions as F

from frames import as_set, same_rows
from tidemark.operators.model import (
    build_dim,
    fact,
    fact_sk,
    kind_dim,
    kind_dim_sk,
    location_dim,
    location_dim_sk,
    star_view,
    star_view_sk,
    surrogate_key,
    type_location_agg,
)
from tidemark.operators.quality import (
    coordinate_bounds,
    geo_quality,
    null_profile,
    quality_report,
    table_counts,
    value_distribution,
    value_distribution_sets,
)
from tidemark.plans.conform import conform
from tidemark.operators.scd2 import scd2_check
from tidemark.plans.gold import publish_gold_views, read_star, runs_to_star, snapshot_to_star, write_gold
from tidemark.schema import ENTITY_SCHEMA, EntitySpec, entity_schema
from tidemark.sources.snapshot import land_snapshot

AT = [datetime(2024, 1, d) for d in (1, 2, 3)]


def raw(spark, rows, spec=EntitySpec()):
    """Raw rows from dicts over the declared fields."""
    schema = entity_schema(spec)
    base = {spec.country: "United States", spec.state: "Oregon", spec.city: "Portland", spec.stamp: AT[0]}
    return spark.createDataFrame(
        [tuple({**base, **row}.get(f) for f in schema.names) for row in rows], schema
    )


@pytest.fixture
def silver(spark):
    """One city in two postal codes, a row without a type, another city."""
    return conform(raw(spark, [
        {"id": "1", "name": "One", "entity_type": "micro", "postal_code": "97201", "longitude": -122.6, "latitude": 45.5},
        {"id": "2", "name": "Two", "entity_type": "pub", "postal_code": "97202", "longitude": -122.7, "latitude": 45.6,
         "ingested_date": AT[2]},
        {"id": "3", "name": "Three", "entity_type": None, "postal_code": "97201", "longitude": -122.6, "latitude": 45.5},
        {"id": "4", "name": "Four", "entity_type": "micro", "city": "São Paulo", "state": None, "country": None},
    ]))


def test_conform(spark, silver):
    row = silver.where("id = '4'").first()
    assert (row.country, row.state, row.city) == ("no_country", "no_value", "Sao_Paulo")
    assert row.valid_from == AT[0] and row.valid_to is None and row.is_current is True
    assert str(row.updated_date) == "2024-01-01" and row.full_address is None
    assert "street" not in silver.columns and len(silver.columns) == 20
    named = conform(raw(spark, [{"id": "1", "city": "São Paulo"}]), raw_names=True).first()
    assert (named.city, named.city_raw, named.country_raw) == ("Sao_Paulo", "São Paulo", "United States")


def test_null_and_empty_countries_differ(spark):
    got = conform(raw(spark, [{"id": "1", "country": None}, {"id": "2", "country": ""}]))
    assert [r.country for r in got.sort("id").collect()] == ["no_country", "no_value"]


def test_addresses_hold_the_values_as_they_arrived(spark):
    row = {"id": "1", "address_1": "1 Rua", "city": "São Paulo", "state": None, "state_province": "SP",
           "postal_code": "01", "country": None}
    assert conform(raw(spark, [row])).first().full_address == "1 Rua, São Paulo, SP 01, no_country"


def test_conform_is_one_projection(spark, folder):
    raw(spark, [{"id": "1"}]).write.parquet(f"{folder}/raw")
    df = conform(spark.read.parquet(f"{folder}/raw")).where("country = 'x'").select("id", "country")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan
    assert "ReadSchema: struct<id:string,country:string>" in plan


def test_dimensions(silver):
    assert location_dim(silver).count() == 3
    assert location_dim(silver).columns == [
        "country_key", "state_key", "city_key", "country_name", "state_name", "city_name",
        "postal_code", "longitude", "latitude",
    ]
    assert as_set(kind_dim(silver)) == {("micro", "micro"), ("pub", "pub"), (None, None)}


def test_dimension_shuffles_each_value_once(spark, silver, folder):
    silver.write.parquet(f"{folder}/s")
    df = build_dim(spark.read.parquet(f"{folder}/s"), {"country": ("k", "n")}, ["postal_code"])
    exchange = [l for l in df._jdf.queryExecution().executedPlan().toString().split("\n") if "Exchange" in l]
    assert len(exchange) == 1 and exchange[0].count("#") <= 4


def test_fact_and_rollup(silver):
    assert fact(silver).columns == [
        "entity_id", "entity_name", "entity_type_key", "country_key", "state_key", "city_key", "phone",
        "website_url", "updated_at", "updated_date", "valid_from", "valid_to", "is_current",
    ]
    assert as_set(type_location_agg(silver)) == {
        ("United_States", "Oregon", "Portland", "micro", 1, AT[0]),
        ("United_States", "Oregon", "Portland", "pub", 1, AT[2]),
        ("United_States", "Oregon", "Portland", None, 1, AT[0]),
        ("no_country", "no_value", "Sao_Paulo", "micro", 1, AT[0]),
    }


def test_rollup_takes_the_latest_update(spark):
    rows = [{"id": str(i), "entity_type": "a", "ingested_date": at} for i, at in enumerate((AT[1], AT[2], AT[0]))]
    agg = type_location_agg(conform(raw(spark, rows))).first()
    assert (agg.entity_count, agg.last_updated) == (3, AT[2])


def test_builders_take_current_rows_only(silver):
    history = silver.unionByName(silver.withColumn("is_current", F.lit(False)).withColumn("city", F.lit("Old")))
    for build in (fact, kind_dim, location_dim, type_location_agg):
        assert same_rows(build(history), build(silver))


def test_star_view_fans_out_and_drops_rows_without_type(silver):
    star = star_view(fact(silver), location_dim(silver), kind_dim(silver))
    counts = {r.entity_id: r["count"] for r in star.groupBy("entity_id").count().collect()}
    assert counts == {"1": 2, "2": 2, "4": 1}


def test_surrogate_star_has_one_row_per_fact(silver):
    star = star_view_sk(fact_sk(silver), location_dim_sk(silver), kind_dim_sk(silver))
    got = {(r.entity_id, r.postal_code, r.entity_type_name) for r in star.collect()}
    assert got == {("1", "97201", "micro"), ("2", "97202", "pub"), ("3", "97201", None), ("4", None, "micro")}
    assert star.count() == 4


def test_surrogate_keys_tell_rows_apart(spark):
    rows = [("a", None, 0.0), (None, "a", 0.0), ("a", "", 0.0), ("1:a", "", 0.0), ("a-", None, 0.0),
            ("a", "-", 0.0), ("a", None, None)]
    df = spark.createDataFrame(rows, "x string, y string, z double")
    keys = df.select(surrogate_key(df, ["x", "y", "z"]).alias("k"))
    assert keys.distinct().count() == len(rows) and keys.where("k is null").isEmpty()
    zeros = spark.createDataFrame([(0.0,), (-0.0,)], "z double")
    assert zeros.select(surrogate_key(zeros, ["z"])).distinct().count() == 1


def test_names_follow_the_spec(spark, folder):
    spec = EntitySpec(entity="shop", plural="shops", kind="shop_type")
    silver = conform(raw(spark, [{"id": "1", "shop_type": "book", "postal_code": "1"}], spec), spec)
    metrics = write_gold(silver, folder, spec)
    assert [m.path.rsplit("/", 1)[1] for m in metrics] == [
        "dim_location", "dim_shop_type", "fact_shops", "agg_shops_by_type_location",
    ]
    publish_gold_views(spark, folder, spec)
    star = spark.table("shops_star_schema")
    assert star.columns[0] == "shop_id" and star.columns[-1] == "shop_type_name" and star.count() == 1
    assert spark.table("shops_aggregated").first().shop_count == 1


def test_snapshot_to_star(spark, folder):
    rows = [{"id": str(i), "entity_type": "t", "postal_code": "1", "country": c}
            for i, c in enumerate(["A", "B", None, "A"])]
    land_snapshot(raw(spark, rows[:1]), f"{folder}/in", datetime(2024, 9, 1))
    land_snapshot(raw(spark, rows), f"{folder}/in", datetime(2024, 12, 1))
    metrics = snapshot_to_star(spark, f"{folder}/in", f"{folder}/out", schema=ENTITY_SCHEMA)
    assert [m.rows for m in metrics] == [4, 3, 1, 4, 3]
    assert spark.table("entities_star_schema").count() == 4
    assert snapshot_to_star(spark, f"{folder}/in", f"{folder}/out")[0].rows == 4


def test_runs_to_star_keeps_history(spark, folder):
    """Change, removal and return over three runs; running it again changes nothing."""
    day = [datetime(2024, m, 1) for m in (9, 10, 11)]

    def land(ids, run, **other):
        rows = [{"id": i, "entity_type": "t", "name": f"n{i}", "ingested_date": run, **other.get(f"_{i}", {})} for i in ids]
        land_snapshot(raw(spark, rows), f"{folder}/in", run)

    def again():
        table = runs_to_star(spark, f"{folder}/in", f"{folder}/out", schema=ENTITY_SCHEMA, buckets=2)
        got = {(r.id, r.name, r.valid_from, r.valid_to, r.is_current) for r in table.read().collect()}
        star = {(r.entity_id, r.entity_name) for r in read_star(spark, f"{folder}/out").collect()}
        assert scd2_check(table.read(), ["id"]).isEmpty()
        return got, star

    land("123", day[0])
    assert again()[1] == {("1", "n1"), ("2", "n2"), ("3", "n3")}
    land("13", day[1], _3={"name": "new"})
    land("123", day[2], _3={"name": "new"})
    got, star = again()
    assert got == {
        ("1", "n1", day[0], None, True), ("2", "n2", day[0], day[1], False), ("2", "n2", day[2], None, True),
        ("3", "n3", day[0], day[1], False), ("3", "new", day[1], None, True),
    }
    assert star == {("1", "n1"), ("2", "n2"), ("3", "new")}
    assert again() == (got, star)


def test_small_stored_dimensions_spare_the_fact_a_shuffle(spark, silver, folder):
    def stored(df, name):
        df.write.parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    entities = stored(silver, "silver")
    views = (
        star_view(fact(entities), stored(location_dim(entities), "l"), stored(kind_dim(entities), "k")),
        star_view_sk(fact_sk(entities), stored(location_dim_sk(entities), "ls"), stored(kind_dim_sk(entities), "ks")),
    )
    for view in views:
        plan = view._jdf.queryExecution().executedPlan().toString()
        assert plan.count("BroadcastHashJoin") == 2 and "Exchange hashpartitioning" not in plan


def test_views_can_be_kept_in_the_catalog(spark, silver, folder):
    write_gold(silver, folder)
    publish_gold_views(spark, folder, persistent=True)
    try:
        kept = {t.name for t in spark.catalog.listTables() if not t.isTemporary}
        assert {"entities_star_schema", "entities_aggregated"} <= kept
        assert spark.sql("SELECT * FROM default.entities_aggregated").count() > 0
    finally:
        for name in ("entities_star_schema", "entities_aggregated"):
            spark.sql(f"DROP VIEW IF EXISTS default.{name}")


def test_hot_join_keys_are_split_by_adaptive_execution(spark, folder):
    """Half of the facts share a location; the join splits that partition."""
    n = 60_000
    rows = spark.range(n).select(
        F.col("id").cast("string"),
        F.sha2(F.col("id").cast("string"), 512).alias("name"),
        F.lit("t").alias("entity_type"),
        F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("c"), F.col("id") % 500)).alias("city"),
        F.lit("s").alias("state"), F.lit("c").alias("country"), F.lit("1").alias("postal_code"),
        F.lit(1.0).alias("longitude"), F.lit(1.0).alias("latitude"),
        F.lit("p").alias("phone"), F.lit("u").alias("website_url"),
        F.lit(AT[0]).alias("updated_at"), F.lit(AT[0]).cast("date").alias("updated_date"),
        F.lit(AT[0]).alias("valid_from"), F.lit(None).cast("timestamp").alias("valid_to"),
        F.lit(True).alias("is_current"),
    ).repartition(8)
    rows.write.parquet(f"{folder}/silver")
    silver = spark.read.parquet(f"{folder}/silver")
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "200k",
        "spark.sql.shuffle.partitions": "20",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        joined = fact(silver).join(location_dim(silver), [f"{c}_key" for c in EntitySpec().location])
        assert len(joined.collect()) == n
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
        assert star_view(fact(silver), location_dim(silver), kind_dim(silver)).count() == n
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_quality(spark):
    df = raw(spark, [
        {"id": "1", "country": "no_country", "state": "", "longitude": 200.0, "latitude": 10.0},
        {"id": "2", "country": None, "state": " ", "longitude": None, "latitude": -95.0},
        {"id": "3", "country": "A", "state": "B", "longitude": 5.0, "latitude": 10.0},
    ])
    assert null_profile(df, ["country", "state", "longitude"]).first().asDict() == {
        "country": 1, "state": 0, "longitude": 1,
    }
    assert as_set(value_distribution(df, "country")) == {("no_country", 1), (None, 1), ("A", 1)}
    assert as_set(value_distribution_sets(df, ["country", "latitude"])) == {
        ("country", "no_country", 1), ("country", None, 1), ("country", "A", 1),
        ("latitude", "10.0", 2), ("latitude", "-95.0", 1),
    }
    report = quality_report(df, ["country", "state", "longitude", "latitude"], bounds=coordinate_bounds())
    assert as_set(report) == {
        ("country", 3, 1, 0, 1, 0, 2), ("state", 3, 0, 2, 0, 0, 3),
        ("longitude", 3, 1, 0, 0, 1, 2), ("latitude", 3, 0, 0, 0, 1, 2),
    }
    assert as_set(geo_quality(df, F.lit("all"))) == {("all", 3, 1, 1, 0, 1, 1)}
    assert as_set(table_counts({"a": df, "b": df.where("id = '1'")})) == {("a", 3), ("b", 1)}
