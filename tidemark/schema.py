"""What an entity snapshot looks like, and under which names its columns go.

Nothing in this package is tied to one kind of entity: every function takes an
``EntitySpec`` that says how the columns are called.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class EntitySpec:
    """Column names of a raw snapshot, and the words used to name gold columns.

    ``entity`` and ``plural`` name the gold tables and columns
    (``<entity>_id``, ``fact_<plural>``, ``<plural>_star_schema``), ``kind`` is
    the raw column that classifies an entity.
    """

    entity: str = "entity"
    plural: str = "entities"

    id: str = "id"
    name: str = "name"
    kind: str = "entity_type"
    address_1: str = "address_1"
    address_2: str = "address_2"
    address_3: str = "address_3"
    city: str = "city"
    state: str = "state"
    state_fallback: str = "state_province"
    postal_code: str = "postal_code"
    country: str = "country"
    longitude: str = "longitude"
    latitude: str = "latitude"
    phone: str = "phone"
    url: str = "website_url"
    street: str = "street"
    stamp: str = "ingested_date"

    default_country: str = "no_country"

    # Gold names derived from the two words above.
    @property
    def id_column(self) -> str:
        return f"{self.entity}_id"

    @property
    def name_column(self) -> str:
        return f"{self.entity}_name"

    @property
    def kind_key(self) -> str:
        return f"{self.entity}_type_key"

    @property
    def kind_name(self) -> str:
        return f"{self.entity}_type_name"

    @property
    def count_column(self) -> str:
        return f"{self.entity}_count"

    @property
    def dim_kind_table(self) -> str:
        return f"dim_{self.entity}_type"

    @property
    def fact_table(self) -> str:
        return f"fact_{self.plural}"

    @property
    def agg_table(self) -> str:
        return f"agg_{self.plural}_by_type_location"

    @property
    def star_view(self) -> str:
        return f"{self.plural}_star_schema"

    @property
    def agg_view(self) -> str:
        return f"{self.plural}_aggregated"

    @property
    def location(self) -> tuple[str, str, str]:
        """Silver location columns, coarsest first."""
        return ("country", "state", "city")


DEFAULT_SPEC = EntitySpec()

VALID_FROM, VALID_TO, IS_CURRENT = "valid_from", "valid_to", "is_current"
SCD2_COLUMNS = (VALID_FROM, VALID_TO, IS_CURRENT)


def entity_schema(
    spec: EntitySpec = DEFAULT_SPEC,
    coordinates: T.DataType = T.DoubleType(),
    stamp: T.DataType = T.TimestampType(),
) -> T.StructType:
    """The declared schema of a raw snapshot: 20 fields, all nullable.

    A field that a snapshot lacks is read as null. Pass
    ``coordinates=StringType()`` for sources that quote their coordinates; the
    cleaning functions accept either.
    """
    # The fields of a raw snapshot, in its order.
    text = (
        spec.id, spec.name, spec.kind, spec.address_1, spec.address_2,
        spec.address_3, spec.city, spec.state_fallback, spec.postal_code, spec.country,
    )
    fields = [(c, T.StringType()) for c in text]
    fields += [(spec.longitude, coordinates), (spec.latitude, coordinates)]
    fields += [(c, T.StringType()) for c in (spec.phone, spec.url, spec.state, spec.street)]
    fields += [
        (spec.stamp, stamp),
        (VALID_FROM, stamp),
        (VALID_TO, stamp),
        (IS_CURRENT, T.BooleanType()),
    ]
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


ENTITY_SCHEMA = entity_schema()
