"""Entity documents as JSON text, default texts, tag sets and column mappings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tablewarden.functions.naming import as_column

# Text put before the name when an entity of this kind has no description.
DEFAULT_DESCRIPTIONS = {
    "database": "Database for ETL processing: ",
    "table": "Table created by ETL process: ",
    "process": "ETL process transforming data: ",
}

ENTITY_DOCUMENT = (
    "typeName STRING, attributes MAP<STRING,STRING>, classifications ARRAY<STRING>"
)


def default_description(
    description: Column | str, name: Column | str, kind: str
) -> Column:
    """The description, or the default text of its kind when it is missing or empty."""
    given = F.nullif(as_column(description), F.lit(""))
    return F.coalesce(given, F.concat(F.lit(DEFAULT_DESCRIPTIONS[kind]), as_column(name)))


def encode_document(
    type_name: Column | str, attributes: Column | str, tags: Column | str
) -> Column:
    """Entity as JSON text with typeName, attributes and classifications."""
    return F.to_json(
        F.struct(
            as_column(type_name).alias("typeName"),
            as_column(attributes).alias("attributes"),
            as_column(tags).alias("classifications"),
        )
    )


def decode_document(text: Column | str) -> Column:
    """Struct of an entity document; text that is not JSON gives NULL fields."""
    return F.from_json(as_column(text), ENTITY_DOCUMENT)


def tag_set(tags: Column | str) -> Column:
    """Array of tags without repeats, in name order."""
    return F.array_sort(F.array_distinct(as_column(tags)))


def column_mapping(pairs: Column | str) -> Column:
    """Array of (source, target) structs as a map."""
    return F.map_from_entries(as_column(pairs))
