"""Column mapping of a job, taken from the analysed plan of the DataFrame that it returns.

Nobody has to write down which column comes from which: Spark has resolved every column of the
plan to the columns below it, and the mapping follows these from the result to the sources. A
plan has as many steps as the job's code, so it is read in the driver, whatever the tables hold.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from functools import reduce

from py4j.java_gateway import JavaObject
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewarden.operators.quality import column_stats

SCHEMA = "src_table string, src_column string, dst_table string, dst_column string, dependency string"
SIMPLE, EXPRESSION = "SIMPLE", "EXPRESSION"

# Steps that hand the columns of their only input on as they are, place by place.
SAME_COLUMNS = {
    "CollectMetrics", "Deduplicate", "DeduplicateWithinWatermark", "Distinct", "EventTimeWatermark",
    "Filter", "GlobalLimit", "LocalLimit", "Offset", "RebalancePartitions", "Repartition",
    "RepartitionByExpression", "ResolvedHint", "Sample", "Sort", "SubqueryAlias", "Tail", "View",
}
# Steps that compute columns, and what they call them.
COMPUTED = {"Project": "projectList", "Aggregate": "aggregateExpressions", "Window": "windowExpressions"}
# Steps over rows of several inputs with the same columns.
STACKED = {"Union", "Intersect", "Except"}

# (table, column) -> whether the value is handed on unchanged.
Sources = dict[tuple[str, str], bool]


def _each(found: JavaObject) -> Iterator[JavaObject]:
    return (found.apply(i) for i in range(found.size()))


def _kind(found: JavaObject) -> str:
    return found.getClass().getSimpleName()


def _key(attribute: JavaObject) -> int:
    return attribute.exprId().id()


def _merged(parts: list[Sources]) -> Sources:
    """All sources; one that is computed with anywhere counts as computed with."""
    out: Sources = {}
    for part in parts:
        for source, simple in part.items():
            out[source] = out.get(source, True) and simple
    return out


class _Walk:
    """The sources of each column of a plan, from the leaves up."""

    def __init__(self, spark: SparkSession, sources: Mapping[str, DataFrame]) -> None:
        self._subquery = spark._jvm.org.apache.spark.sql.catalyst.expressions.SubqueryExpression
        self._named = {name: _analysed(df) for name, df in sources.items()}
        names = list(self._named)
        for i, name in enumerate(names):
            for other in names[:i]:
                if self._named[name].sameResult(self._named[other]):
                    raise ValueError(f"{other} and {name} are the same rows")

    def _of(self, expression: JavaObject, known: dict[int, Sources]) -> Sources:
        """The sources of an expression over columns that are known."""
        if _kind(expression) == "Alias":
            return self._of(expression.child(), known)
        if self._subquery.hasSubquery(expression):
            raise ValueError(f"no column mapping through the subquery in {expression.toString()}")
        if _kind(expression) == "AttributeReference":
            return known[_key(expression)]
        used = [known[_key(a)] for a in _each(expression.references().toSeq())]
        return {source: False for part in used for source in part}

    def _leaf(self, plan: JavaObject) -> str:
        """A catalog table by its name, files by their folder."""
        kind = _kind(plan)
        if kind == "HiveTableRelation":
            return plan.tableMeta().identifier().unquotedString()
        if kind == "LogicalRelation":
            if plan.catalogTable().isDefined():
                return plan.catalogTable().get().identifier().unquotedString()
            if _kind(plan.relation()) == "HadoopFsRelation":
                return ",".join(sorted(p.toString() for p in _each(plan.relation().location().rootPaths().toSeq())))
        raise ValueError(f"no name for the rows of {kind}: pass them among the sources")

    def columns(self, plan: JavaObject) -> list[Sources]:
        """The sources of the plan's columns, in their order."""
        output = list(_each(plan.output()))
        for name, source in self._named.items():
            if plan.sameResult(source):
                return [{(name, a.name()): True} for a in _each(source.output())]
        inputs = list(_each(plan.children()))
        if not inputs:
            name = self._leaf(plan)
            return [{(name, a.name()): True} for a in output]
        kind = _kind(plan)
        below = [self.columns(i) for i in inputs]
        if kind in SAME_COLUMNS:
            return below[0]
        if kind in STACKED:
            # Rows of a difference come from its first input alone.
            return below[0] if kind == "Except" else [_merged(list(parts)) for parts in zip(*below)]
        known = {_key(a): s for i, part in zip(inputs, below) for a, s in zip(_each(i.output()), part)}
        if kind in COMPUTED:
            named = _each(getattr(plan, COMPUTED[kind])())
            known |= {_key(e.toAttribute()): self._of(e, known) for e in list(named)}
        elif kind == "Generate":
            made = self._of(plan.generator(), known)
            known |= {_key(a): made for a in _each(plan.generatorOutput())}
        elif kind == "Expand":
            rows = [[self._of(e, known) for e in _each(row)] for row in _each(plan.projections())]
            return [_merged(list(parts)) for parts in zip(*rows)]
        elif kind != "Join":
            raise ValueError(f"no column mapping through {kind}")
        return [known[_key(a)] for a in output]


def _analysed(df: DataFrame) -> JavaObject:
    return df._jdf.queryExecution().analyzed()


def plan_mapping(df: DataFrame, target: str, sources: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """Pairs of source and target columns: src_table, src_column, dst_table, dst_column, dependency.

    ``target`` names the table that ``df`` is written to. ``sources`` names tables that the job
    reads; the walk ends at a step that gives the same rows as one of them. Other tables are
    named by the catalog or by their folder, and rows without either are refused. The first four
    columns are a mapping as ``column_lineage`` takes it.

    A column depends on those that its value is computed from, on the ordering and the groups of
    a window too. Conditions of filters and joins, sort orders and grouping columns choose rows
    and are no source. ``SIMPLE`` is a value handed on as it is, also under another name,
    ``EXPRESSION`` one that is computed anywhere on its way. A column made of constants has no
    row. A step that is not known here (rows through a Python function, say) raises ValueError,
    as its columns may come from anywhere; so does a subquery in a value.
    """
    spark = df.sparkSession
    walked = _Walk(spark, sources or {}).columns(_analysed(df))
    rows = [
        (table, column, target, name, SIMPLE if simple else EXPRESSION)
        for name, found in zip(df.columns, walked)
        for (table, column), simple in sorted(found.items())
    ]
    return spark.createDataFrame(rows, SCHEMA)


def mapping_fill(mapping: DataFrame, tables: Mapping[str, DataFrame]) -> DataFrame:
    """``mapping`` with ``src_filled`` and ``dst_filled``: how many rows have a value there.

    A target with fewer than its source says where values are lost on their way. Each table is
    read once, its named columns only. A table that is not given has NULL counts.
    """
    sides = [mapping.select(F.col(f"{s}_table").alias("t"), F.col(f"{s}_column").alias("c")) for s in ("src", "dst")]
    # One row per column of a schema, never per row of a table.
    used = {(r.t, r.c) for r in sides[0].union(sides[1]).distinct().collect()}
    parts = []
    for name, df in tables.items():
        wanted = [c for c in df.columns if (name, c) in used]
        if wanted:
            counts = column_stats(df.select(*[F.col(f"`{c}`") for c in wanted]), bounds=False, distinct=False)
            parts.append(counts.select(F.lit(name).alias("t"), F.col("column_name").alias("c"), (F.col("n_rows") - F.col("n_nulls")).alias("n")))
    none = mapping.sparkSession.createDataFrame([], "t string, c string, n long")
    filled = reduce(DataFrame.unionByName, parts, none)
    for side in ("src", "dst"):
        names = filled.toDF(f"{side}_table", f"{side}_column", f"{side}_filled")
        mapping = mapping.join(names, [f"{side}_table", f"{side}_column"], "left")
    return mapping.select(*[c.split()[0] for c in SCHEMA.split(", ")], "src_filled", "dst_filled")
