"""One query per operator, each over the whole of the given tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalogue.inputs import T0, T1, T2, daily_states, events, ntz, raw_entities, table, user_snapshot
from tidemark import functions as fn
from tidemark.operators import digests, intervals, model, ordered, profiles, quality, scd2
from tidemark.plans import gold, versioned
from tidemark.plans.conform import address_of, conform, country_of, state_of
from tidemark.schema import DEFAULT_SPEC, IS_CURRENT, VALID_FROM, VALID_TO
from tidemark.session import scratch_path
from tidemark.sources import drift, pages, snapshot, tables
from tidemark.sources.changes import VersionLog, version_log
from tidemark.streaming import jobs
from tidemark.streaming import pages as page_stream

Query = Callable[[SparkSession, str], DataFrame]

PHONE_PATTERN = r"\+?1? ?\(\d{3}\) \d{3}-\d{4}"
RUN_1 = datetime(2025, 9, 10, 6, 0, 0)
RUN_2 = datetime(2025, 12, 2, 6, 0, 0)
RUN_3 = datetime(2025, 12, 10, 6, 0, 0)
STATE_COLUMNS = T.StructType().add("user_id", T.LongType()).add("event_type", T.StringType())

AS_OF = datetime(2024, 1, 25)
# The tables given are small.
BUCKETS = 4

CATALOGUE: dict[str, Query] = {}


def query(function: Query) -> Query:
    CATALOGUE[function.__name__] = function
    return function


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform(raw_entities(spark, sf_dir))


# Column functions


@query
def fill_first_non_null(spark, sf_dir):
    return raw_entities(spark, sf_dir).select("id", state_of().alias("state"))


@query
def fill_default(spark, sf_dir):
    return raw_entities(spark, sf_dir).select("id", country_of().alias("country"))


@query
def clean_phone(spark, sf_dir):
    return raw_entities(spark, sf_dir).select("id", fn.clean_phone("phone").alias("phone"))


@query
def clean_phone_documents(spark, sf_dir):
    found = F.regexp_extract_all("text", F.lit(PHONE_PATTERN), F.lit(0))
    phones = table(spark, sf_dir, "documents").select("doc_id", F.explode(found).alias("found"))
    return phones.select("doc_id", "found", fn.clean_phone("found").alias("phone"))


@query
def clean_url(spark, sf_dir):
    return raw_entities(spark, sf_dir).select("id", fn.clean_url("website_url").alias("website_url"))


@query
def full_address(spark, sf_dir):
    return raw_entities(spark, sf_dir).select("id", address_of().alias("full_address"))


@query
def full_address_skip_nulls(spark, sf_dir):
    address = address_of(skip_nulls=True)
    return raw_entities(spark, sf_dir).select("id", address.alias("full_address"))


@query
def valid_longitude(spark, sf_dir):
    return raw_entities(spark, sf_dir).select("id", fn.valid_longitude("longitude").alias("longitude"))


@query
def valid_latitude(spark, sf_dir):
    # From text, as some sources quote their coordinates.
    quoted = F.col("latitude").cast("string")
    return raw_entities(spark, sf_dir).select("id", fn.valid_latitude(quoted).alias("latitude"))


@query
def date_of_timestamp(spark, sf_dir):
    return raw_entities(spark, sf_dir).select("id", fn.date_of("ingested_date").alias("updated_date"))


@query
def sanitize_text(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", fn.sanitize("text").alias("safe_text"))


@query
def silver_conform(spark, sf_dir):
    return silver(spark, sf_dir)


# Quality


@query
def null_profile(spark, sf_dir):
    columns = ["country", "state", "state_province", "city", "phone", "entity_type"]
    return quality.null_profile(raw_entities(spark, sf_dir), columns)


@query
def value_distribution(spark, sf_dir):
    return quality.value_distribution(silver(spark, sf_dir), "country")


@query
def value_distribution_sets(spark, sf_dir):
    return quality.value_distribution_sets(silver(spark, sf_dir), ["country", "state", "city"])


@query
def geo_quality(spark, sf_dir):
    return quality.geo_quality(raw_entities(spark, sf_dir), country_of())


@query
def quality_report(spark, sf_dir):
    filled = raw_entities(spark, sf_dir).withColumn("country", country_of())
    columns = ["id", "country", "state", "city", "phone", "full_address", "longitude", "latitude"]
    filled = filled.withColumn("full_address", address_of())
    return quality.quality_report(filled, columns, bounds=quality.coordinate_bounds())


PROFILED = ("country", "state", "phone", "longitude")


def _profiled(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Profiles of three runs, stored one by one, and the exact distinct counts of each."""
    raw = raw_entities(spark, sf_dir).withColumn("run", (F.col("id").cast("long") % 3).cast("string"))
    path = scratch_path(spark, "profiles")
    for run in ("0", "1", "2"):
        profiles.write_profile(raw.where(F.col("run") == run), path, run, PROFILED)
    long = raw.select("run", *[F.col(c).cast("string").alias(c) for c in PROFILED]).unpivot(
        ["run"], list(PROFILED), "column_name", "value"
    )
    return profiles.read_profiles(spark, path), long


def _near(measured: DataFrame, exact: DataFrame, by: list[str]) -> DataFrame:
    """Counts of profiles, and whether the estimated distinct counts are within 5 % of the exact ones."""
    near = F.abs(F.col("distinct_count") - F.col("_exact")) <= 0.05 * F.col("_exact")
    return measured.join(exact, by).select(*by, *profiles.COUNTS, near.alias("distinct_near"))


@query
def profile_runs(spark, sf_dir):
    """A profile per run and column, from sketches that are kept."""
    stored, long = _profiled(spark, sf_dir)
    exact = long.groupBy("run", "column_name").agg(F.count_distinct("value").alias("_exact"))
    return _near(profiles.measures(stored), exact, ["run", "column_name"])


@query
def profile_merged(spark, sf_dir):
    """The profile of all runs, merged from those of each without reading their rows."""
    stored, long = _profiled(spark, sf_dir)
    exact = long.groupBy("column_name").agg(F.count_distinct("value").alias("_exact"))
    return _near(profiles.measures(profiles.merge_profiles(stored)), exact, ["column_name"])


@query
def table_counts(spark, sf_dir):
    """Silver is stored first: cleaned once, not for each count."""
    return quality.table_counts(gold.gold_tables(_stored(spark, silver(spark, sf_dir), "silver")))


# Dimensions, fact, rollup, views


@query
def dim_location(spark, sf_dir):
    return model.location_dim(silver(spark, sf_dir))


@query
def dim_type(spark, sf_dir):
    return model.kind_dim(silver(spark, sf_dir))


@query
def fact_table(spark, sf_dir):
    return model.fact(silver(spark, sf_dir))


@query
def agg_by_type_location(spark, sf_dir):
    return model.type_location_agg(silver(spark, sf_dir))


def _stored(spark, df: DataFrame, name: str) -> DataFrame:
    """Written and read again, so that Spark knows its size."""
    written = tables.write_table(df, scratch_path(spark, name))
    return tables.read_table(spark, written.path, schema=df.schema)


@query
def star_view(spark, sf_dir):
    entities = _stored(spark, silver(spark, sf_dir), "silver")
    locations = _stored(spark, model.location_dim(entities), "locations")
    kinds = _stored(spark, model.kind_dim(entities), "kinds")
    return model.star_view(model.fact(entities), locations, kinds)


@query
def star_view_sk(spark, sf_dir):
    entities = _stored(spark, silver(spark, sf_dir), "silver")
    locations = _stored(spark, model.location_dim_sk(entities), "locations")
    kinds = _stored(spark, model.kind_dim_sk(entities), "kinds")
    return model.star_view_sk(model.fact_sk(entities), locations, kinds)


def _write_gold(spark, sf_dir, out: str) -> list[tables.WriteMetrics]:
    written = tables.write_table(silver(spark, sf_dir), f"{out}/silver")
    return [written, *gold.write_gold(tables.read_table(spark, written.path), out)]


def _stored_gold(spark, sf_dir) -> str:
    out = scratch_path(spark, "gold")
    _write_gold(spark, sf_dir, out)
    return out


@query
def run_metrics(spark, sf_dir):
    """What the writes counted; elapsed time only as whether there is some."""
    metrics = _write_gold(spark, sf_dir, scratch_path(spark, "gold"))
    return tables.metrics_frame(spark, metrics).select(
        "table_name", F.col("rows").alias("row_count"), (F.col("seconds") >= 0).alias("timed")
    )


@query
def star_view_sql(spark, sf_dir):
    gold.publish_gold_views(spark, _stored_gold(spark, sf_dir))
    return spark.table(DEFAULT_SPEC.star_view)


@query
def agg_view_sql(spark, sf_dir):
    gold.publish_gold_views(spark, _stored_gold(spark, sf_dir))
    return spark.table(DEFAULT_SPEC.agg_view)


# Pages, order, samples


@query
def union_pages(spark, sf_dir):
    raw = raw_entities(spark, sf_dir)
    known = F.coalesce("country", F.lit("none"))
    return snapshot.union_pages(
        [
            raw.where(known.isin("AMERICA", "ASIA")),
            raw.where(known.isin("AFRICA", "EUROPE")).drop("address_2", "phone"),
            raw.where(~known.isin("AMERICA", "ASIA", "AFRICA", "EUROPE")).drop("longitude"),
        ]
    )


@query
def ordered_listing(spark, sf_dir):
    listing = raw_entities(spark, sf_dir).select("entity_type", "name", "id", "city")
    return listing.orderBy("entity_type", "name", "id")


@query
def sample_rows(spark, sf_dir):
    shown = raw_entities(spark, sf_dir).select("id", "country", "state", "state_province", "city")
    return shown.orderBy("id").limit(20)


# History


@query
def latest_per_key(spark, sf_dir):
    rows = events(spark, sf_dir).select("user_id", "event_id", "ts", "event_type", "value")
    return ordered.latest_per_key(rows, ["user_id"], ["ts", "event_id"])


@query
def snapshot_diff(spark, sf_dir):
    log = events(spark, sf_dir)
    return scd2.snapshot_diff(
        user_snapshot(log, T0), user_snapshot(log, T2), ["user_id"], ["event_type"]
    )


@query
def snapshot_diff_digests(spark, sf_dir):
    """Two stored snapshots compared by their digest trees; only what is not the same."""
    log, paths = events(spark, sf_dir), []
    for at in (T0, T2):
        paths.append(scratch_path(spark, "digested"))
        digests.write_digested(user_snapshot(log, at), paths[-1], ["user_id"], ["event_type"])
    return digests.digest_diff(spark, *paths, STATE_COLUMNS, ["user_id"], ["event_type"])


def _initial(spark, sf_dir) -> DataFrame:
    first = user_snapshot(events(spark, sf_dir), T0).withColumn("taken_at", ntz(T0))
    return scd2.scd2_initial(first, "taken_at").drop("taken_at")


@query
def scd2_initial(spark, sf_dir):
    return _initial(spark, sf_dir)


def _merged(spark, sf_dir, on_missing, steps=(T1, T2)) -> DataFrame:
    log = events(spark, sf_dir)
    history = _initial(spark, sf_dir)
    for n, at in enumerate(steps):
        if n:
            # A merge reads its table twice, so every step starts from a stored one.
            written = tables.write_table(history, scratch_path(spark, "merged"))
            history = tables.read_table(spark, written.path, schema=history.schema)
        history = scd2.scd2_merge(
            history, user_snapshot(log, at), ["user_id"], ["event_type"], ntz(at), on_missing
        )
    return history


@query
def scd2_merge(spark, sf_dir):
    return _merged(spark, sf_dir, "close")


@query
def scd2_merge_keep(spark, sf_dir):
    return _merged(spark, sf_dir, "keep")


@query
def scd2_merge_replayed(spark, sf_dir):
    return _merged(spark, sf_dir, "close", (T1, T1, T2, T2))


def _history(spark, sf_dir) -> DataFrame:
    return scd2.scd2_from_history(
        events(spark, sf_dir), ["user_id"], ["event_type"], "ts", ["event_id"]
    )


@query
def scd2_from_history(spark, sf_dir):
    return _history(spark, sf_dir)


@query
def scd2_current(spark, sf_dir):
    return scd2.scd2_current(_history(spark, sf_dir))


@query
def scd2_as_of(spark, sf_dir):
    return scd2.scd2_as_of(_history(spark, sf_dir), ntz(datetime(2024, 1, 15)))


@query
def scd2_point_in_time(spark, sf_dir):
    log = events(spark, sf_dir)
    versions = scd2.scd2_from_history(
        daily_states(log), ["user_id"], ["event_type"], "known_at", weigh=log
    ).withColumnRenamed("event_type", "known_state")
    facts = log.select("event_id", "user_id", "ts", "event_type", "value")
    return scd2.scd2_point_in_time(
        facts, versions, ["user_id"], "ts", ["known_state", VALID_FROM], weigh=log
    )


@query
def scd2_point_in_time_small(spark, sf_dir):
    """The same join where the versions are few enough to be sent to the facts."""
    log = events(spark, sf_dir)
    versions = scd2.scd2_from_history(
        daily_states(log), ["user_id"], ["event_type"], "known_at", weigh=log
    ).withColumnRenamed("event_type", "known_state")
    facts = log.select("event_id", "user_id", "ts", "event_type", "value")
    stored = _stored(spark, versions, "versions")
    return intervals.point_in_time(facts, stored, ["user_id"], "ts", ["known_state", VALID_FROM], weigh=log)


@query
def scd2_point_in_time_cut(spark, sf_dir):
    """Facts and versions by day, so that keys are cut on few instants."""
    log = events(spark, sf_dir)
    versions = scd2.scd2_from_history(
        daily_states(log), ["user_id"], ["event_type"], "known_at", parts=64, min_rows=4
    ).withColumnRenamed("event_type", "known_state")
    day = F.date_trunc("day", "ts").cast("timestamp_ntz")
    facts = log.select("event_id", "user_id", day.alias("day"), "event_type")
    return scd2.scd2_point_in_time(
        facts, versions, ["user_id"], "day", ["known_state", VALID_FROM], parts=64, min_rows=4
    )


@query
def scd2_check_cut(spark, sf_dir):
    return scd2.scd2_check(_broken(spark, sf_dir), ["user_id"], parts=64, min_rows=4)


@query
def scd2_check(spark, sf_dir):
    return scd2.scd2_check(_broken(spark, sf_dir), ["user_id"])


def _broken(spark, sf_dir) -> DataFrame:
    """A log read as versions in the wrong way, so that every rule is broken somewhere."""
    log = events(spark, sf_dir)
    return log.select(
        "user_id",
        F.col("ts").alias(VALID_FROM),
        F.when(F.col("event_type") == "signup", F.col("ts"))
        .when(F.col("event_type") != "view", F.col("ts") + F.expr("INTERVAL 12 HOURS"))
        .alias(VALID_TO),
        F.col("event_type").isin("view", "click").alias(IS_CURRENT),
    )


# Landing, tables, streams


@query
def snapshot_pages(spark, sf_dir):
    """Pages of up to 100 rows, each a JSON array on a line, as an API returns them."""
    raw = raw_entities(spark, sf_dir)
    page = F.floor(F.col("id").cast("long") / 100)
    fields = [
        F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias(c) if c == DEFAULT_SPEC.stamp else c
        for c in raw.columns
    ]
    bodies = raw.groupBy(page.alias("page")).agg(
        F.to_json(F.collect_list(F.struct(*fields))).alias("value")
    )
    path = scratch_path(spark, "pages")
    bodies.select("value").write.text(path)
    return snapshot.read_pages(spark, path, raw.schema, multi_line=False)


@query
def stream_pages(spark, sf_dir):
    """Pages as a stream that is started twice; the second time half of them have come again."""
    raw = raw_entities(spark, sf_dir)
    page = F.floor(F.col("id").cast("long") / PAGE_SIZE).cast("int")
    fetched = F.timestamp_seconds(F.lit(1_735_700_000) + F.col("page"))
    rows = raw.withColumn("page", page).withColumn("fetched", fetched)
    stamp = F.date_format(DEFAULT_SPEC.stamp, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    base, out, checkpoint = (scratch_path(spark, n) for n in ("paged", "taken", "stream"))
    for name, some in (("first", rows.where("page % 2 = 0")), ("second", rows)):
        tables.write_table(some.withColumn(DEFAULT_SPEC.stamp, stamp), f"{base}/{name}", fmt="json", timestampFormat=snapshot.STAMP_FORMAT)
        page_stream.stream_pages(spark, f"{base}/*", out, checkpoint, rows.schema, ["page", "id"], "fetched").awaitTermination()
    taken = tables.read_table(spark, out, schema=rows.schema)
    return page_stream.latest_entities(taken, ["id"], "fetched").select(*raw.columns)


DRIFT_SCHEMA = T.StructType().add("id", T.StringType()).add("name", T.StringType()).add("longitude", T.DoubleType())


def _drifting(spark, sf_dir) -> DataFrame:
    """Landed entities of which some have a field more, and some a text where a number should be."""
    raw = raw_entities(spark, sf_dir)
    number = F.col("id").cast("long")
    line = F.to_json(
        F.struct(
            "id", "name",
            F.when(number % 5 == 0, "unknown").otherwise(F.col("longitude").cast("string")).alias("longitude"),
            F.when(number % 3 == 0, number % 7).alias("rating"),
        )
    )
    path = scratch_path(spark, "drifting")
    raw.select(line.alias("value")).write.text(path)
    return drift.read_drifting(spark, path, DRIFT_SCHEMA)


@query
def drift_rows(spark, sf_dir):
    """What fits is typed, the new field is promoted, and what does not fit is still there."""
    rows = drift.promote(_drifting(spark, sf_dir), "rating", T.LongType())
    kept = F.try_variant_get(drift.REST, "$.longitude", "string")
    rating = F.coalesce("rating", F.lit(-1)).alias("rating")
    return rows.select("id", "name", "longitude", rating, kept.alias("longitude_as_it_came"))


@query
def drift_report(spark, sf_dir):
    return drift.drift_report(_drifting(spark, sf_dir), DRIFT_SCHEMA)


PAGE_SIZE = 250


def _numbered_pages(spark, sf_dir) -> tuple[DataFrame, int]:
    """Entities landed page by page in order of their number, which are all from 0 on, and read again; their total."""
    raw = raw_entities(spark, sf_dir)
    stamp = F.date_format(DEFAULT_SPEC.stamp, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    page = F.floor(F.col("id").cast("long") / PAGE_SIZE).cast("int")
    landed = raw.withColumn(DEFAULT_SPEC.stamp, stamp).withColumn("page", page)
    path = scratch_path(spark, "pages")
    written = pages.write_pages(landed, path)
    return pages.read_numbered(spark, path, raw.schema), written.rows


@query
def paged_snapshot(spark, sf_dir):
    """Numbered pages held against the announced total."""
    landed, total = _numbered_pages(spark, sf_dir)
    return pages.complete_snapshot(landed, total, PAGE_SIZE, ["id"])


@query
def page_report(spark, sf_dir):
    """What is said of pages of which one is missing, one lost rows and one repeats another's entities."""
    landed, total = _numbered_pages(spark, sf_dir)
    number = F.col("id").cast("long")
    shifted = landed.where("page = 2").where(number % 3 == 0).withColumn("page", F.lit(3))
    found = landed.where("page <> 1").where((F.col("page") != 4) | (number % 2 == 0)).unionByName(shifted)
    return pages.page_report(found, total, PAGE_SIZE, ["id"])


@query
def snapshot_arrays(spark, sf_dir):
    """Pages of up to 500 rows, each a file with one JSON array over several lines."""
    raw = raw_entities(spark, sf_dir)
    page = F.floor(F.col("id").cast("long") / 500)
    fields = [
        F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias(c) if c == DEFAULT_SPEC.stamp else c
        for c in raw.columns
    ]
    rows = F.collect_list(F.struct(*fields))
    bodies = raw.groupBy(page.alias("page")).agg(F.to_json(rows, {"pretty": "true"}).alias("value"))
    path = scratch_path(spark, "pages")
    bodies.select("value").write.option("maxRecordsPerFile", 1).text(path)
    return snapshot.read_pages(spark, path, raw.schema, multi_line=True)


@query
def land_snapshot(spark, sf_dir):
    raw = snapshot.stamp(raw_entities(spark, sf_dir), ntz(T2))
    base = scratch_path(spark, "landed")
    landed = snapshot.land_snapshot(raw, base, RUN_1)
    return snapshot.read_pages(spark, landed.path, raw.schema, multi_line=False)


@query
def latest_snapshot(spark, sf_dir):
    raw = raw_entities(spark, sf_dir)
    base = scratch_path(spark, "landed")
    for run, at in ((RUN_2, T0), (RUN_3, T2), (RUN_1, T1)):
        snapshot.land_snapshot(snapshot.stamp(raw, ntz(at)), base, run)
    return snapshot.read_latest(spark, base, raw.schema)


@query
def roundtrip_partitioned(spark, sf_dir):
    entities = silver(spark, sf_dir)
    written = tables.write_table(entities, scratch_path(spark, "silver"), ["country"])
    stored = tables.read_table(spark, written.path, schema=entities.schema)
    return tables.verify_write(written, stored, entities.schema)


@query
def roundtrip_gold(spark, sf_dir):
    return tables.read_table(spark, f"{_stored_gold(spark, sf_dir)}/{DEFAULT_SPEC.fact_table}")


@query
def schema_evolution(spark, sf_dir):
    raw = raw_entities(spark, sf_dir)
    path = scratch_path(spark, "evolving")
    before = F.col("ingested_date") < F.lit("1998-01-01").cast("timestamp_ntz")
    tables.write_table(raw.where(before).drop("phone", "latitude"), path)
    tables.write_table(raw.where(~before), path, mode="append")
    return tables.read_table(spark, path, merge_schema=True)


@query
def dynamic_overwrite(spark, sf_dir):
    entities = silver(spark, sf_dir)
    path = scratch_path(spark, "partial")
    tables.write_table(entities, path, ["country"])
    corrected = entities.where("country = 'ASIA'").withColumn("name", F.upper("name"))
    tables.write_table(corrected, path, ["country"], dynamic=True)
    return tables.read_table(spark, path, schema=entities.schema)


def _streamed_silver(spark, sf_dir) -> DataFrame:
    """Two snapshots picked up by two runs of the stream."""
    raw = raw_entities(spark, sf_dir)
    base, out = scratch_path(spark, "landed"), scratch_path(spark, "silver")
    checkpoint = scratch_path(spark, "stream")
    for run, at in ((RUN_1, T1), (RUN_2, T2)):
        snapshot.land_snapshot(snapshot.stamp(raw, ntz(at)), base, run)
        jobs.stream_silver(spark, base, out, checkpoint, raw.schema).awaitTermination()
    return jobs.read_silver(spark, out, raw.schema).drop("run")


@query
def stream_silver(spark, sf_dir):
    return _streamed_silver(spark, sf_dir)


@query
def stream_silver_fact(spark, sf_dir):
    """One fact row per entity, however many snapshots came."""
    return model.fact(_streamed_silver(spark, sf_dir))


def _history_table(spark) -> VersionLog:
    return version_log(spark, scratch_path(spark, "history"), STATE_COLUMNS, ("user_id",), T.TimestampNTZType(), BUCKETS)


@query
def stream_scd2(spark, sf_dir):
    """Daily states landed in two portions, carried into one history."""
    states = daily_states(events(spark, sf_dir))
    base, checkpoint = scratch_path(spark, "landed"), scratch_path(spark, "stream")
    history = _history_table(spark)
    first = F.col("known_at") <= ntz(T1)
    for run, portion in ((RUN_1, first), (RUN_2, ~first)):
        snapshot.land_snapshot(states.where(portion), base, run)
        jobs.stream_scd2(
            spark, base, history, checkpoint, ["user_id"], ["event_type"], "known_at",
            states.schema,
        ).awaitTermination()
    return history.read()


def _streamed_snapshots(spark, sf_dir, starts) -> DataFrame:
    """Whole snapshots landed in the order given, the stream started after some of them."""
    log = events(spark, sf_dir)
    base, checkpoint = scratch_path(spark, "landed"), scratch_path(spark, "stream")
    history = _history_table(spark)
    for run, at, start in starts:
        taken = user_snapshot(log, at).withColumn("taken_at", ntz(at))
        snapshot.land_snapshot(taken, base, run)
        if start:
            jobs.stream_scd2(
                spark, base, history, checkpoint, ["user_id"], ["event_type"], "taken_at",
                taken.schema, on_missing="close",
            ).awaitTermination()
    return history.read()


@query
def stream_scd2_close(spark, sf_dir):
    """Three whole snapshots, the last two picked up by one run of the stream."""
    return _streamed_snapshots(spark, sf_dir, ((RUN_1, T0, True), (RUN_2, T1, False), (RUN_3, T2, True)))


@query
def stream_scd2_late(spark, sf_dir):
    """The middle one of three snapshots lands last and is spliced in."""
    return _streamed_snapshots(spark, sf_dir, ((RUN_1, T0, False), (RUN_3, T2, True), (RUN_2, T1, True)))


@query
def stream_scd2_late_log(spark, sf_dir):
    """Daily states in three portions, the middle one last; a key's silence lasts until its next row."""
    states = daily_states(events(spark, sf_dir))
    base, checkpoint = scratch_path(spark, "landed"), scratch_path(spark, "stream")
    history = _history_table(spark)
    day = F.col("known_at")
    portions = {RUN_1: day <= ntz(T0), RUN_2: (day > ntz(T0)) & (day <= ntz(T1)), RUN_3: day > ntz(T1)}
    for run, start in ((RUN_1, False), (RUN_3, True), (RUN_2, True)):
        snapshot.land_snapshot(states.where(portions[run]), base, run)
        if start:
            jobs.stream_scd2(
                spark, base, history, checkpoint, ["user_id"], ["event_type"], "known_at", states.schema
            ).awaitTermination()
    return history.read()


@query
def scd2_history_table(spark, sf_dir):
    """Three snapshots merged into a stored history, the second one twice."""
    log = events(spark, sf_dir)
    history = _history_table(spark)
    for at in (T0, T1, T1, T2):
        history.take(
            f"{at:%Y%m%d}",
            lambda: scd2.scd2_merge(
                history.opened(), user_snapshot(log, at), ["user_id"], ["event_type"], ntz(at), "close", changes_only=True
            ),
        )
    return history.read()


@query
def scd2_splice(spark, sf_dir):
    """The snapshot between two merged ones comes last."""
    log = events(spark, sf_dir)
    merged = _merged(spark, sf_dir, "close", (T2,))
    late = scd2.scd2_splice(
        merged, user_snapshot(log, T1), ["user_id"], ["event_type"], ntz(T1), ntz(T2), user_snapshot(log, T2)
    )
    return scd2.scd2_apply(merged, late, ["user_id"])


FACT_COLUMNS = (
    T.StructType().add("event_id", T.LongType()).add("user_id", T.LongType()).add("ts", T.TimestampNTZType())
    .add("value", T.DoubleType())
)


def _versioned_facts(spark, sf_dir):
    """Events keyed to versions of their users, of which the middle snapshot came after the events."""
    log = events(spark, sf_dir)
    history = _history_table(spark)
    facts = versioned.fact_table(
        spark, scratch_path(spark, "facts"), FACT_COLUMNS, ("event_id",), ("user_id",), T.TimestampNTZType(), BUCKETS
    )
    keys, tracked = ["user_id"], ["event_type"]
    for at in (T0, T2):
        history.take(
            f"{at:%Y%m%d}",
            lambda: scd2.scd2_merge(history.opened(), user_snapshot(log, at), keys, tracked, ntz(at), changes_only=True),
        )
    versioned.load_facts(facts, "all", log, history, "ts")
    late = lambda: scd2.scd2_splice(
        history.read(), user_snapshot(log, T1), keys, tracked, ntz(T1), ntz(T2), user_snapshot(log, T2)
    )
    history.take(f"{T1:%Y%m%d}", late)
    versioned.follow_history(facts, history, "ts")
    return facts, history


@query
def star_versions(spark, sf_dir):
    """Each event with what was known of its user then, by the version key that it keeps."""
    facts, history = _versioned_facts(spark, sf_dir)
    return versioned.star_then(facts, history, ["event_type"])


@query
def star_as_of(spark, sf_dir):
    """The same star as it stood at one instant."""
    facts, history = _versioned_facts(spark, sf_dir)
    return versioned.star_as_of(facts, history, ["event_type"], "ts", ntz(AS_OF)).drop(versioned.VERSION)


def _three_runs(spark, sf_dir, order=((RUN_1,), (RUN_2, RUN_3))) -> tuple[str, VersionLog, T.StructType]:
    """Entities that change, go and come back over three runs, carried into gold in the steps given."""
    raw = raw_entities(spark, sf_dir)
    number = F.col("id").cast("long")
    renamed = F.when(number % 7 == 0, F.upper("name")).otherwise(F.col("name"))
    base, out = scratch_path(spark, "landed"), scratch_path(spark, "tables")
    runs = {
        RUN_1: raw.where(number % 5 != 1),
        RUN_2: raw.where(number % 11 != 0).withColumn("name", renamed),
        RUN_3: raw,
    }
    for step in order:
        for run in step:
            snapshot.land_snapshot(runs[run], base, run)
        history = gold.runs_to_star(spark, base, out, schema=raw.schema, buckets=BUCKETS)
    return out, history, raw.schema


LATE = ((RUN_1, RUN_3), (RUN_2,))


@query
def runs_to_star_history(spark, sf_dir):
    return _three_runs(spark, sf_dir)[1].read()


@query
def runs_to_star_late(spark, sf_dir):
    """The second run finishes after the third was taken."""
    return _three_runs(spark, sf_dir, LATE)[1].read()


@query
def runs_to_star_view(spark, sf_dir):
    out, _, schema = _three_runs(spark, sf_dir)
    return gold.read_star(spark, out, schema=schema)


@query
def runs_to_star_rollup(spark, sf_dir):
    """The rollup after two whole runs and one that takes entities away again, by changes alone."""
    out, _, schema = _three_runs(spark, sf_dir, ((RUN_1,), (RUN_2,)))
    return gold.read_gold(spark, out, schema=schema)["rollup"]


@query
def runs_to_star_dimensions(spark, sf_dir):
    """Members of both dimensions that the second run's entities have, with and without names."""
    out, _, schema = _three_runs(spark, sf_dir, ((RUN_1,), (RUN_2,)))
    tables = gold.read_gold(spark, out, schema=schema)
    locations = tables["location"].drop("location_sk")
    return locations.unionByName(tables["kind"].drop("type_sk"), allowMissingColumns=True)


@query
def snapshot_to_star(spark, sf_dir):
    raw = raw_entities(spark, sf_dir)
    base, out = scratch_path(spark, "landed"), scratch_path(spark, "tables")
    snapshot.land_snapshot(raw, base, RUN_3)
    gold.snapshot_to_star(spark, base, out, schema=raw.schema)
    return spark.table(DEFAULT_SPEC.star_view)
