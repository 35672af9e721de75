"""Dimensions, fact, rollup and star views.

The builders take current rows only, so they may be pointed at a full history
table. Joins carry no hints: Spark broadcasts a side whose size it knows to be
small, and otherwise shuffles both and lets adaptive execution split the
partitions of hot keys.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.scd2 import scd2_current
from tidemark.schema import DEFAULT_SPEC, IS_CURRENT, SCD2_COLUMNS, EntitySpec

LOCATION_SK, KIND_SK = "location_sk", "type_sk"


def _current(df: DataFrame) -> DataFrame:
    return scd2_current(df) if IS_CURRENT in df.columns else df


def build_dim(
    df: DataFrame, keys: Mapping[str, tuple[str, str]], attributes: Sequence[str] = ()
) -> DataFrame:
    """Distinct members of a dimension.

    ``keys`` maps a source column to the names of its key and its display
    column, which hold the same value. Distinctness is decided before the
    columns are doubled, so the shuffle carries each value once.
    """
    members = _current(df).select(*keys, *attributes).distinct()
    return members.select(
        *[F.col(c).alias(key) for c, (key, _) in keys.items()],
        *[F.col(c).alias(name) for c, (_, name) in keys.items()],
        *attributes,
    )


def location_dim(silver: DataFrame, spec: EntitySpec = DEFAULT_SPEC) -> DataFrame:
    keys = {c: (f"{c}_key", f"{c}_name") for c in spec.location}
    return build_dim(silver, keys, [spec.postal_code, spec.longitude, spec.latitude])


def kind_dim(silver: DataFrame, spec: EntitySpec = DEFAULT_SPEC) -> DataFrame:
    return build_dim(silver, {spec.kind: (spec.kind_key, spec.kind_name)})


def fact_mapping(spec: EntitySpec = DEFAULT_SPEC) -> dict[str, str]:
    return {
        spec.id: spec.id_column,
        spec.name: spec.name_column,
        spec.kind: spec.kind_key,
        **{c: f"{c}_key" for c in spec.location},
        **{c: c for c in (spec.phone, spec.url, "updated_at", "updated_date")},
        **{c: c for c in SCD2_COLUMNS},
    }


def build_fact(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """A projection of current rows, ``{source column: fact column}``."""
    return _current(df).select(*[F.col(c).alias(name) for c, name in mapping.items()])


def fact(silver: DataFrame, spec: EntitySpec = DEFAULT_SPEC) -> DataFrame:
    return build_fact(silver, fact_mapping(spec))


def build_agg(df: DataFrame, keys: Sequence[str], spec: EntitySpec = DEFAULT_SPEC) -> DataFrame:
    """Current entities per key combination, and when the latest was updated."""
    return (
        _current(df)
        .groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias(spec.count_column),
            F.max("updated_at").alias("last_updated"),
        )
    )


def type_location_agg(silver: DataFrame, spec: EntitySpec = DEFAULT_SPEC) -> DataFrame:
    return build_agg(silver, [*spec.location, spec.kind], spec)


def star_view(
    fact: DataFrame, locations: DataFrame, kinds: DataFrame, spec: EntitySpec = DEFAULT_SPEC
) -> DataFrame:
    """Fact joined to both dimensions on the natural keys.

    A location is identified by country, state and city alone, so a fact row
    comes once per postal code and coordinate pair known for its city, and rows
    without a type are left out. ``star_view_sk`` does neither.
    """
    return (
        fact.join(locations, [f"{c}_key" for c in spec.location])
        .join(kinds, spec.kind_key)
        .select(
            *[fact[c] for c in fact.columns],
            *[f"{c}_name" for c in spec.location],
            *[spec.postal_code, spec.longitude, spec.latitude],
            spec.kind_name,
        )
    )


def surrogate_key(df: DataFrame, columns: Sequence[str]) -> Column:
    """A null-safe key over ``columns``: equal values, nulls included, equal keys.

    Every value is written with its length in front, so different rows never
    give the same text, and the text is hashed.
    """
    values = []
    for c in columns:
        value = F.col(c)
        if df.schema[c].dataType.typeName() in ("double", "float"):
            value = value + F.lit(0.0)  # minus zero and zero are one value
        value = value.cast("string")
        values.append(F.coalesce(F.concat(F.length(value), F.lit(":"), value), F.lit("-")))
    # As bytes: half the width of the hexadecimal text. Never null, and told so:
    # joins on the key need no null filter, which would compute it a second time.
    return F.coalesce(F.unhex(F.sha2(F.concat(*values), 256)), F.lit(b""))


def location_columns(spec: EntitySpec) -> list[str]:
    return [*spec.location, spec.postal_code, spec.longitude, spec.latitude]


def location_dim_sk(silver: DataFrame, spec: EntitySpec = DEFAULT_SPEC) -> DataFrame:
    columns = location_columns(spec)
    members = _current(silver).select(*columns).distinct()
    return members.select(
        surrogate_key(silver, columns).alias(LOCATION_SK),
        *[F.col(c).alias(f"{c}_name") for c in spec.location],
        *columns[len(spec.location):],
    )


def kind_dim_sk(silver: DataFrame, spec: EntitySpec = DEFAULT_SPEC) -> DataFrame:
    members = _current(silver).select(spec.kind).distinct()
    return members.select(
        surrogate_key(silver, [spec.kind]).alias(KIND_SK), F.col(spec.kind).alias(spec.kind_name)
    )


def fact_sk(silver: DataFrame, spec: EntitySpec = DEFAULT_SPEC, *more: str) -> DataFrame:
    """The fact with a surrogate key per dimension next to the natural keys, and ``more`` columns as they are."""
    keyed = _current(silver).withColumns(
        {
            LOCATION_SK: surrogate_key(silver, location_columns(spec)),
            KIND_SK: surrogate_key(silver, [spec.kind]),
        }
    )
    return build_fact(
        keyed, {**fact_mapping(spec), LOCATION_SK: LOCATION_SK, KIND_SK: KIND_SK, **{c: c for c in more}}
    )


def star_view_sk(
    fact: DataFrame, locations: DataFrame, kinds: DataFrame, spec: EntitySpec = DEFAULT_SPEC
) -> DataFrame:
    """Exactly one row per fact row, rows without a type included."""
    return (
        fact.join(locations, LOCATION_SK)
        .join(kinds, KIND_SK)
        .select(
            *[c for c in fact.columns if c not in (LOCATION_SK, KIND_SK)],
            *[f"{c}_name" for c in spec.location],
            *[spec.postal_code, spec.longitude, spec.latitude],
            spec.kind_name,
        )
    )


def publish_view(spark: SparkSession, text: str, name: str, persistent: bool = False) -> None:
    """A view over stored tables, given by its SQL text.

    A temporary one lives as long as the session. A persistent one goes into
    the session's catalog, and outlives the session where that is a metastore.
    """
    kind = "VIEW" if persistent else "TEMPORARY VIEW"
    spark.sql(f"CREATE OR REPLACE {kind} `{name}` AS {text}")
