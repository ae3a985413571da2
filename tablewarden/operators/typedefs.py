"""Type definitions as rows, and listing them."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from tablewarden.operators.model import RELATIONSHIP_DEFS, TYPE_DEFS

ENTITY, CLASSIFICATION, BUSINESS_METADATA = "ENTITY", "CLASSIFICATION", "BUSINESS_METADATA"


@dataclass(frozen=True)
class Attr:
    """One attribute of a type."""

    name: str
    kind: str = "string"
    required: bool = False
    unique: bool = False
    cardinality: str = "SINGLE"
    max_count: int = 1
    enum: tuple[str, ...] | None = None


@dataclass(frozen=True)
class TypeDef:
    """A type: its category, its parents and its attributes."""

    name: str
    category: str
    supers: tuple[str, ...] = ()
    attrs: tuple[Attr, ...] = field(default_factory=tuple)


# The entity types, the tags and attribute groups, and the relationship
# types of the data model, each with its attributes.
ENTITY_TYPES = [
    TypeDef("etl_process", ENTITY, ("Process",), (Attr("owner"), Attr("process_type"))),
    TypeDef(
        "DataPipeline",
        ENTITY,
        ("Process",),
        (
            Attr("pipelineId", required=True, unique=True),
            Attr("pipelineType"),
            Attr("schedule"),
            Attr("pipelineOwner"),
            Attr("executionPlatform"),
        ),
    ),
    TypeDef(
        "DataQualityCheck",
        ENTITY,
        ("Process",),
        (
            Attr("checkId", required=True, unique=True),
            Attr("checkType"),
            Attr("checkExpression"),
            Attr("threshold", "float"),
            Attr("lastResult", "boolean"),
            Attr("lastRunTime", "long"),
        ),
    ),
    TypeDef(
        "BusinessKPI",
        ENTITY,
        ("DataSet",),
        (
            Attr("kpiId", required=True, unique=True),
            Attr("kpiName", required=True),
            Attr("description"),
            Attr("formula"),
            Attr("kpiOwner"),
            Attr("targetValue", "float"),
            Attr("currentValue", "float"),
            Attr("lastUpdated", "long"),
        ),
    ),
    TypeDef(
        "ETLDataTransformation",
        ENTITY,
        ("Process",),
        (
            Attr("transformationType", required=True),
            Attr("dataQualityScore", "float"),
            Attr("columnMappings", "map<string,string>"),
        ),
    ),
]
TAG_TYPES = [
    TypeDef("employee_data", CLASSIFICATION),
    TypeDef("PII", CLASSIFICATION),
    TypeDef(
        "DataSensitivity",
        CLASSIFICATION,
        (),
        (
            Attr("level", required=True, enum=("Public", "Internal", "Confidential", "Restricted")),
            Attr("justification"),
        ),
    ),
    TypeDef(
        "DataQuality",
        CLASSIFICATION,
        (),
        (Attr("completeness", "float"), Attr("accuracy", "float"), Attr("lastValidated", "date")),
    ),
    TypeDef(
        "Compliance",
        CLASSIFICATION,
        (),
        (
            Attr(
                "regulations",
                "array<string>",
                cardinality="SET",
                max_count=100,
                enum=("GDPR", "CCPA", "HIPAA", "PCI-DSS", "SOX"),
            ),
            Attr("dataRetentionPeriod", "int"),
        ),
    ),
    TypeDef(
        "BusinessContext",
        CLASSIFICATION,
        (),
        (
            Attr("businessDomain"),
            Attr("businessOwner"),
            Attr("criticality", enum=("Low", "Medium", "High", "Critical")),
        ),
    ),
    TypeDef(
        "DataQualityIssue",
        CLASSIFICATION,
        (),
        (
            Attr("issueType", required=True),
            Attr("severity", required=True),
            Attr("affectedRecords", "int"),
        ),
    ),
]
METADATA_GROUPS = [
    TypeDef(
        "ETLPipelineMetadata",
        BUSINESS_METADATA,
        (),
        (
            Attr("pipelineId"),
            Attr("pipelineType"),
            Attr("schedule"),
            Attr("pipelineOwner"),
            Attr("executionPlatform"),
        ),
    ),
    TypeDef(
        "DataQualityMetadata",
        BUSINESS_METADATA,
        (),
        (
            Attr("completeness", "float"),
            Attr("accuracy", "float"),
            Attr("validationRules"),
            Attr("lastValidated"),
        ),
    ),
    TypeDef(
        "BusinessContextMetadata",
        BUSINESS_METADATA,
        (),
        (
            Attr("businessDomain"),
            Attr("businessFunction"),
            Attr("businessValue"),
            Attr("businessOwner"),
            Attr("criticality"),
        ),
    ),
]
RELATIONSHIP_TYPES = [
    ("DataQualityAssessment", "DataQualityCheck", "checks", "SINGLE", "DataSet", "assessedBy", "SET"),
    ("KPIDependency", "BusinessKPI", "dependsOn", "SET", "DataSet", "usedInKPIs", "SET"),
    ("PipelineExecution", "DataPipeline", "executes", "SET", "Process", "executedBy", "SINGLE"),
]


def register_types(spark: SparkSession, defs: list[TypeDef]) -> DataFrame:
    """One row per type and attribute; a type without attributes gets one row."""
    rows = []
    for type_def in defs:
        head = (type_def.name, type_def.category, list(type_def.supers))
        for a in type_def.attrs:
            rows.append(
                head
                + (a.name, a.kind, not a.required, a.cardinality, int(a.required))
                + (a.max_count, a.unique, list(a.enum) if a.enum else None)
            )
        if not type_def.attrs:
            rows.append(head + (None,) * 8)
    return spark.createDataFrame(rows, TYPE_DEFS)


def default_types(spark: SparkSession) -> DataFrame:
    """All entity types, tags and attribute groups of the data model."""
    return register_types(spark, ENTITY_TYPES + TAG_TYPES + METADATA_GROUPS)


def default_relationships(spark: SparkSession) -> DataFrame:
    """The relationship types with the cardinality of their ends."""
    return spark.createDataFrame(RELATIONSHIP_TYPES, RELATIONSHIP_DEFS)


def list_types(type_defs: DataFrame, category: str | None = None) -> DataFrame:
    """Names of the defined types, or of those of one category."""
    chosen = type_defs if category is None else type_defs.filter(type_defs.category == category)
    return chosen.select("type_name").distinct()
