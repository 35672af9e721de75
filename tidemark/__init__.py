"""Periodic full snapshots of an entity, turned into history and star-schema tables.

``sources``    landing and reading snapshots, tables by path, the history table
``functions``  cleaning rules as column expressions
``operators``  version history, dimensional model, data quality, ordered scans
``plans``      raw to silver, silver to gold and views, snapshot to star
``streaming``  the same work for snapshots picked up as they land
"""

from tidemark.schema import DEFAULT_SPEC, ENTITY_SCHEMA, EntitySpec, entity_schema

__all__ = ["DEFAULT_SPEC", "ENTITY_SCHEMA", "EntitySpec", "entity_schema"]
