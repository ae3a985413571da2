"""Checking entities and relationships against their type definitions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewarden.functions.casts import lenient_cast
from tablewarden.materialize import materialize

# Attribute types and the Spark types their text is cast to.
_SPARK_TYPES = {"int": "int", "long": "bigint", "float": "float", "double": "double", "boolean": "boolean", "date": "date"}


class TypeCycleError(ValueError):
    """A type is its own ancestor."""


# Pairs of type and parent that the driver follows by itself; more of them are joined.
DRIVER_PARENTS = 100_000
ANCESTORS = "type_name STRING, ancestor STRING, distance INT"


def ancestors(type_defs: DataFrame) -> DataFrame:
    """(type_name, ancestor, distance) over parents to any depth.

    Parents that are not defined here have no attributes and end the way up. Type definitions
    are written by people: up to ``DRIVER_PARENTS`` parents, counted first, are followed on
    the driver, which takes one job; more are joined level by level.
    """
    step = type_defs.select("type_name", F.explode("super_types").alias("ancestor")).distinct()
    pairs = step.limit(DRIVER_PARENTS + 1).collect()
    if len(pairs) > DRIVER_PARENTS:
        return _joined_ancestors(step)
    parents: dict[str, list[str]] = {}
    for pair in pairs:
        parents.setdefault(pair["type_name"], []).append(pair["ancestor"])
    rows = []
    for name in parents:
        level, found, distance = set(parents[name]), {}, 1
        while level:
            if name in level:
                raise TypeCycleError(f"{name} is its own ancestor")
            found.update(dict.fromkeys(level, distance))
            level = {p for t in level for p in parents.get(t, ())} - found.keys()
            distance += 1
        rows += [(name, above, far) for above, far in found.items()]
    return type_defs.sparkSession.createDataFrame(rows, ANCESTORS)


def _joined_ancestors(step: DataFrame) -> DataFrame:
    up = materialize(step, "parents").frame
    parent = up.select(F.col("type_name").alias("below"), F.col("ancestor").alias("above"))
    found, distance = [materialize(up.withColumn("distance", F.lit(1)), "ancestors")], 1
    while found[-1].rows:
        level = found[-1].frame
        circle = level.filter("type_name = ancestor").first()
        if circle is not None:
            raise TypeCycleError(f"{circle['type_name']} is its own ancestor")
        distance += 1
        higher = level.join(parent, F.col("ancestor") == F.col("below"))
        higher = higher.select("type_name", F.col("above").alias("ancestor")).distinct()
        found.append(materialize(higher.withColumn("distance", F.lit(distance)), "ancestors"))
    every = reduce(DataFrame.unionByName, [f.frame for f in found])
    return every.groupBy("type_name", "ancestor").agg(F.min("distance").alias("distance"))


def with_inherited(type_defs: DataFrame) -> DataFrame:
    """The definitions with the attributes of all ancestors; the nearest definition counts."""
    above = ancestors(type_defs).withColumnRenamed("type_name", "heir")
    own = type_defs.withColumn("distance", F.lit(0))
    inherited = (
        type_defs.join(above, F.col("type_name") == F.col("ancestor"))
        .filter("attr_name IS NOT NULL")
        .withColumn("type_name", F.col("heir"))
        .select(*own.columns)
    )
    nearest = Window.partitionBy("type_name", "attr_name").orderBy("distance", "attr_type")
    every = own.unionByName(inherited).withColumn("_rank", F.row_number().over(nearest))
    return every.filter("_rank = 1").select(*type_defs.columns)


def _type_rows(type_defs: DataFrame) -> DataFrame:
    """One row per type with its attribute definitions as an array."""
    attr = F.struct(
        F.col("attr_name").alias("attribute"),
        "attr_type",
        "is_optional",
        "min_count",
        "max_count",
        "enum_values",
        "is_unique",
    )
    return type_defs.groupBy("type_name").agg(
        F.collect_list(F.when(F.col("attr_name").isNotNull(), attr)).alias("attrs")
    )


def _is_castable() -> Column:
    """Whether ``value`` can be read as its attribute type; unknown types accept any."""
    value, kind = F.col("value"), F.col("attr_type")
    ok = F.when(kind == "string", True).when(kind == "array<string>", F.col("members").isNotNull())
    for name, spark_type in _SPARK_TYPES.items():
        ok = ok.when(kind == name, lenient_cast(value, T.StringType(), spark_type).isNotNull())
    return ok.otherwise(True)


def _kinds() -> Column:
    """All rules that an attribute breaks, as an array.

    An array, because unfolding it evaluates the rules once. A filter on a plain name would
    be pushed below and evaluate them a second time.
    """
    value, enum, members = F.col("value"), F.col("enum_values"), F.col("members")
    outside = F.when(members.isNotNull(), F.size(F.array_except(members, enum)) > 0).otherwise(
        ~F.array_contains(enum, value)
    )
    miscounted = (F.size(members) > F.col("max_count")) | (F.size(members) < F.col("min_count"))
    known, declared = F.col("known"), F.col("attr_type").isNotNull()
    filled = known & declared & value.isNotNull()
    readable = _is_castable()
    broken = {
        "unknown_type": ~known,
        "undeclared_attribute": known & ~declared & F.col("attribute").isNotNull(),
        "missing_required": known & declared & value.isNull() & ~F.col("is_optional"),
        "wrong_type": filled & ~readable,
        "not_in_enum": filled & readable & enum.isNotNull() & outside,
        "cardinality": filled & members.isNotNull() & miscounted,
    }
    return F.array_compact(F.array(*[F.when(rule, F.lit(kind)) for kind, rule in broken.items()]))


def validate_entities(entities: DataFrame, type_defs: DataFrame) -> DataFrame:
    """Violations of the type definitions: guid, type_name, attribute, kind, value, n.

    Kinds: ``unknown_type``, ``undeclared_attribute``, ``missing_required``,
    ``not_in_enum``, ``wrong_type``, ``cardinality`` and ``duplicate_unique``. Attributes of
    parents apply to any depth. All but the last are found row by row: each entity is joined
    with the one row of its type, unfolded into the attributes it should have and those it
    has, and only violations leave the task; an attribute that breaks several rules gives a
    row for each. Array attributes are JSON text. Unique values are counted per value before
    the shuffle, and a repeated value gives one row with the number of entities that hold it.

    The rows of the types are written first. Their size on disk decides whether they are
    broadcast; if not, the partition of a type with most of the entities can be split.
    """
    types = materialize(_type_rows(with_inherited(type_defs)), "types").frame
    typed = entities.select("guid", "type_name", "attributes").join(types, "type_name", "left")
    rule = "struct<attribute:string,attr_type:string,is_optional:boolean,min_count:int,max_count:int,enum_values:array<string>,is_unique:boolean>"
    none = F.array().cast(f"array<{rule}>")
    names = F.transform(F.coalesce("attrs", none), lambda a: a["attribute"])
    undeclared = F.transform(
        F.array_except(F.coalesce(F.map_keys("attributes"), F.array().cast("array<string>")), names),
        lambda name: F.struct(
            name.alias("attribute"),
            *[F.lit(None).cast(t).alias(n) for n, t in (
                ("attr_type", "string"), ("is_optional", "boolean"), ("min_count", "int"),
                ("max_count", "int"), ("enum_values", "array<string>"), ("is_unique", "boolean"),
            )],
        ),
    )
    known = F.col("attrs").isNotNull()
    rules = F.when(known, F.concat("attrs", undeclared)).otherwise(none)
    value = F.col("attributes")[F.col("attribute")]
    is_array = F.col("attr_type") == "array<string>"
    by_row = (
        typed.select("guid", "type_name", "attributes", known.alias("known"), F.inline_outer(rules))
        .withColumn("value", value)
        .withColumn("members", F.when(is_array, F.from_json("value", "array<string>")))
        .select("guid", "type_name", "attribute", F.explode(_kinds()).alias("kind"), "value")
        .withColumn("n", F.lit(1).cast("long"))
    )
    unique_attrs = F.transform(F.filter("attrs", lambda a: a["is_unique"]), lambda a: a["attribute"])
    unique_types = types.select("type_name", unique_attrs.alias("names")).filter("size(names) > 0")
    values = entities.select("type_name", "attributes").join(
        materialize(unique_types, "unique").frame, "type_name"
    )
    values = values.select("type_name", "attributes", F.explode("names").alias("attribute")).select(
        "type_name", "attribute", F.col("attributes")[F.col("attribute")].alias("value")
    )
    repeated = (
        values.filter("value IS NOT NULL")
        .groupBy("type_name", "attribute", "value")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .select(
            F.lit(None).cast("string").alias("guid"),
            "type_name",
            "attribute",
            F.lit("duplicate_unique").alias("kind"),
            "value",
            "n",
        )
    )
    return by_row.unionByName(repeated)


def cardinality_violations(relationships: DataFrame, rel_defs: DataFrame) -> DataFrame:
    """Entities linked to several partners over an end that allows a single one.

    Types without such an end are dropped first. Repeated links count once. Both steps
    aggregate before they shuffle.
    """
    ends = F.array(
        F.struct(
            F.lit("end1").alias("rel_end"),
            F.col("end1_guid").alias("guid"),
            F.col("end1_cardinality").alias("cardinality"),
        ),
        F.struct(
            F.lit("end2").alias("rel_end"),
            F.col("end2_guid").alias("guid"),
            F.col("end2_cardinality").alias("cardinality"),
        ),
    )
    limited = rel_defs.filter("end1_cardinality = 'SINGLE' OR end2_cardinality = 'SINGLE'")
    return (
        relationships.join(materialize(limited, "limited").frame, "rel_type")
        .select("rel_type", "end1_guid", "end2_guid", "end1_cardinality", "end2_cardinality")
        .distinct()
        .select("rel_type", F.inline(ends))
        .filter("cardinality = 'SINGLE'")
        .groupBy("rel_type", "rel_end", "guid")
        .agg(F.count(F.lit(1)).alias("n_partners"))
        .filter("n_partners > 1")
    )
