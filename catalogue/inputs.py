"""The given tables in the shapes the operators work on.

The SQL texts below are filled with table names and run unchanged in Spark and
in the checking engine.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.ordered import latest_per_key

# Orders with their customers as entity snapshots: nulls, accents, special
# characters, escaped URLs and coordinates out of range included.
RAW_ENTITIES = """
SELECT CAST(o_orderkey AS STRING) AS id,
       c_name AS name,
       CASE WHEN o_orderkey % 17 <> 0 THEN o_orderpriority END AS entity_type,
       CASE WHEN o_orderkey % 19 <> 0
            THEN concat(CAST(o_orderkey % 900 AS STRING), ' 51st Ave') END AS address_1,
       CASE WHEN o_orderkey % 5 = 0
            THEN concat('Suite ', CAST(o_orderkey % 40 AS STRING)) END AS address_2,
       CASE WHEN o_orderkey % 10 = 0 THEN 'Rear' END AS address_3,
       concat('Citý #', CAST(o_orderkey % 7 AS STRING)) AS city,
       n_name AS state_province,
       CASE WHEN o_orderkey % 2 = 0 THEN '97201' ELSE '97202-5879' END AS postal_code,
       CASE WHEN o_orderkey % 13 <> 0 THEN r_name END AS country,
       CAST(((n_nationkey * 7 + o_orderkey % 7) * 29) % 400 AS DOUBLE) - 200.5 AS longitude,
       CAST(((n_nationkey * 7 + o_orderkey % 7) * 17) % 200 AS DOUBLE) - 100.25 AS latitude,
       CASE WHEN o_orderkey % 6 <> 0
            THEN concat('+1 (', lpad(CAST(o_orderkey % 1000 AS STRING), 3, '0'),
                        ') 555-', lpad(CAST(o_custkey % 10000 AS STRING), 4, '0')) END AS phone,
       concat('http:', chr(92), '/', chr(92), '/www.e', CAST(o_custkey AS STRING),
              '.example') AS website_url,
       CASE WHEN o_orderkey % 11 <> 0 THEN n_name END AS state,
       o_orderdate AS ingested_date
FROM {orders}
JOIN {customer} ON o_custkey = c_custkey
JOIN {nation} ON c_nationkey = n_nationkey
JOIN {region} ON n_regionkey = r_regionkey
"""

# Column types of the given tables; reading with a schema spares a look into the
# files before every query.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, "
    "props string",
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
}

# Instants between which the event log is read as snapshots.
T0 = datetime(2024, 1, 11)
T1 = datetime(2024, 1, 21)
T2 = datetime(2024, 2, 1)

# A user whose last event is of this type has left.
LEFT = "error"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def raw_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ("orders", "customer", "nation", "region")
    return spark.sql(RAW_ENTITIES, **{n: table(spark, sf_dir, n) for n in names})


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


def ntz(at: datetime):
    """A time constant of the type the event log has."""
    return F.lit(at.isoformat(sep=" ")).cast("timestamp_ntz")


def user_snapshot(log: DataFrame, until: datetime) -> DataFrame:
    """The state of every user still there at ``until``, from all events before it."""
    last = latest_per_key(
        log.where(F.col("ts") < ntz(until)).select("user_id", "event_type", "ts", "event_id"),
        ["user_id"],
        ["ts", "event_id"],
    )
    return last.where(F.col("event_type") != LEFT).select("user_id", "event_type")


def daily_states(log: DataFrame) -> DataFrame:
    """The last state of each user on each day, known from the next midnight on."""
    day = (F.to_date("ts") + F.expr("INTERVAL 1 DAY")).cast("timestamp_ntz")
    return latest_per_key(
        log.select("user_id", "event_type", "ts", "event_id", day.alias("known_at")),
        ["user_id", "known_at"],
        ["ts", "event_id"],
    ).select("user_id", "event_type", "known_at")
