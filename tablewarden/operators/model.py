"""Schemas of the governance tables."""

from __future__ import annotations

# States of an entity.
ACTIVE, DELETED = "ACTIVE", "DELETED"

ENTITIES = (
    "guid STRING, type_name STRING, qualified_name STRING, name STRING, owner STRING, "
    "description STRING, status STRING, create_time TIMESTAMP_NTZ, "
    "attributes MAP<STRING,STRING>"
)
ENTITY_COLUMNS = [
    "guid",
    "type_name",
    "qualified_name",
    "name",
    "owner",
    "description",
    "status",
    "create_time",
    "attributes",
]
TYPE_DEFS = (
    "type_name STRING, category STRING, super_types ARRAY<STRING>, attr_name STRING, "
    "attr_type STRING, is_optional BOOLEAN, cardinality STRING, min_count INT, "
    "max_count INT, is_unique BOOLEAN, enum_values ARRAY<STRING>"
)
RELATIONSHIP_DEFS = (
    "rel_type STRING, end1_type STRING, end1_name STRING, end1_cardinality STRING, "
    "end2_type STRING, end2_name STRING, end2_cardinality STRING"
)
CLASSIFICATIONS = (
    "guid STRING, classification STRING, attributes MAP<STRING,STRING>, propagated BOOLEAN"
)
PROCESS_IO = "process_guid STRING, direction STRING, dataset_guid STRING"
EDGES = "src_guid STRING, dst_guid STRING"
RELATIONSHIPS = "rel_type STRING, end1_guid STRING, end2_guid STRING"
COLUMN_RULES = "column_name STRING, column_type STRING"
