"""Tags, PII rules and business metadata."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewarden.operators.model import COLUMN_RULES
from tablewarden.operators.rules import rules_frame

# Fixed value: tag of columns that identify a person.
PII = "PII"


def apply_classification(
    entities: DataFrame,
    selector: Column,
    tag: str,
    attributes: dict[str, str] | None = None,
    classifications: DataFrame | None = None,
) -> DataFrame:
    """New tag rows for the entities the selector picks, one row per entity row.

    Entities that already carry the tag in ``classifications`` are left out, so applying
    a tag twice changes nothing.
    """
    pairs = [F.lit(part) for pair in (attributes or {}).items() for part in pair]
    values = F.create_map(*pairs) if pairs else F.expr("map()")
    picked = entities.filter(selector).select("guid")
    if classifications is not None:
        tagged = classifications.filter(F.col("classification") == tag)
        tagged = tagged.select("guid").distinct()
        picked = picked.join(tagged, "guid", "left_anti")
    return picked.select(
        "guid",
        F.lit(tag).alias("classification"),
        values.cast("map<string,string>").alias("attributes"),
        F.lit(False).alias("propagated"),
    )


def tag_pii(columns: DataFrame, rules: list[tuple[str, str | None]], tag: str = PII) -> DataFrame:
    """Tag rows of the columns (guid, name, data_type) that match a rule.

    A rule is a column name and a type; the type None stands for any. Names are compared
    without regard to case.
    """
    rule = rules_frame(columns.sparkSession, rules, COLUMN_RULES)
    same_name = F.lower(columns["name"]) == F.lower(rule["column_name"])
    same_type = rule["column_type"].isNull() | (rule["column_type"] == columns["data_type"])
    return columns.join(rule, same_name & same_type, "left_semi").select(
        "guid",
        F.lit(tag).alias("classification"),
        F.expr("CAST(map() AS MAP<STRING,STRING>)").alias("attributes"),
        F.lit(False).alias("propagated"),
    )


def tag_sets(classifications: DataFrame) -> DataFrame:
    """The tags of each entity as an array in name order.

    Repeats are removed first, so an array never holds more than the number of tags.
    """
    return (
        classifications.select("guid", "classification")
        .distinct()
        .groupBy("guid")
        .agg(F.array_sort(F.collect_list("classification")).alias("tags"))
    )


def apply_business_metadata(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Last write per entity and group (guid, bm_name, attributes, written_at, seq) wins.

    Rank 1 is kept per task before the shuffle, as in ``first_by_key``.
    """
    last = Window.partitionBy("guid", "bm_name").orderBy(F.desc("written_at"), F.desc("seq"))
    return (
        existing.unionByName(incoming, allowMissingColumns=True)
        .withColumn("_rank", F.row_number().over(last))
        .filter("_rank = 1")
        .drop("_rank")
    )
