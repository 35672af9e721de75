"""Raw snapshot to silver: one projection, no shuffle, no Python."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import (
    clean_phone,
    clean_url,
    date_of,
    fill_default,
    first_non_null,
    full_address,
    sanitize,
    valid_latitude,
    valid_longitude,
)
from tidemark.schema import DEFAULT_SPEC, IS_CURRENT, VALID_FROM, VALID_TO, EntitySpec


def state_of(spec: EntitySpec = DEFAULT_SPEC) -> Column:
    return first_non_null(spec.state, spec.state_fallback)


def country_of(spec: EntitySpec = DEFAULT_SPEC) -> Column:
    return fill_default(spec.country, spec.default_country)


def address_of(spec: EntitySpec = DEFAULT_SPEC, skip_nulls: bool = False) -> Column:
    """The one-line address, from the values as they arrived."""
    return full_address(
        spec.address_1, spec.address_2, spec.address_3, spec.city,
        state_of(spec), spec.postal_code, country_of(spec), skip_nulls=skip_nulls,
    )


def conform(
    raw: DataFrame,
    spec: EntitySpec = DEFAULT_SPEC,
    raw_names: bool = False,
    skip_null_address: bool = False,
) -> DataFrame:
    """The silver table: cleaned fields, ASCII-safe location, first version columns.

    ``raw_names`` adds the location values before they are made ASCII-safe, as
    ``country_raw``, ``state_raw`` and ``city_raw``.
    """
    country, state, city = country_of(spec), state_of(spec), F.col(spec.city)
    stamp = F.col(spec.stamp)
    extra = []
    if raw_names:
        extra = [country.alias("country_raw"), state.alias("state_raw"), city.alias("city_raw")]
    return raw.select(
        F.col(spec.id),
        F.col(spec.name),
        F.col(spec.kind),
        F.col(spec.address_1),
        F.col(spec.address_2),
        F.col(spec.address_3),
        sanitize(city).alias("city"),
        sanitize(state).alias("state"),
        F.col(spec.postal_code),
        sanitize(country).alias("country"),
        clean_phone(spec.phone).alias(spec.phone),
        clean_url(spec.url).alias(spec.url),
        address_of(spec, skip_null_address).alias("full_address"),
        valid_longitude(spec.longitude).alias(spec.longitude),
        valid_latitude(spec.latitude).alias(spec.latitude),
        stamp.alias("updated_at"),
        date_of(stamp).alias("updated_date"),
        stamp.alias(VALID_FROM),
        F.lit(None).cast(raw.schema[spec.stamp].dataType).alias(VALID_TO),
        F.lit(True).alias(IS_CURRENT),
        *extra,
    )
