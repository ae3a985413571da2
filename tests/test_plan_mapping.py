"""Column mappings read from plans: known pairs, every kind of step, refusals, filled rows."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tablewarden.operators import columns, plan_mapping, transforms


@pytest.fixture
def staff(spark):
    rows = [(1, "a", 30, "x", 10.0), (2, "b", None, "y", None), (3, "c", 50, "x", 5.0)]
    return spark.createDataFrame(rows, "id int, name string, age int, dep string, salary double")


@pytest.fixture
def deps(spark):
    return spark.createDataFrame([("x", "North", [1, 2]), ("z", None, [3])], "code string, site string, rooms array<int>")


def pairs(df, **sources):
    """Target column -> sources as table.column, those that are computed with marked by *."""
    out = {}
    for r in plan_mapping.plan_mapping(df, "out", sources).collect():
        assert r.dst_table == "out"
        mark = "*" if r.dependency == "EXPRESSION" else ""
        out.setdefault(r.dst_column, set()).add(f"{r.src_table}.{r.src_column}{mark}")
    return out


def test_mapping_of_the_employee_job(spark, staff):
    job = transforms.transform_employees(staff.withColumnRenamed("dep", "department"), "2024-01-31")
    found = pairs(job, staff=staff)
    assert found == {
        "id": {"staff.id"}, "name": {"staff.name"}, "department": {"staff.dep"}, "age": {"staff.age*"},
        "salary": {"staff.salary*"}, "employee_category": {"staff.age*"}, "salary_band": {"staff.salary*"},
    }


def test_joins_aggregates_and_windows(staff, deps):
    joined = staff.filter("age > 1").join(deps, staff["dep"] == deps["code"], "left")
    grouped = joined.groupBy("site").agg(F.max("salary").alias("top"), F.count(F.lit(1)).alias("n"))
    place = F.rank().over(Window.partitionBy("site").orderBy("top"))
    found = pairs(grouped.withColumn("place", place).orderBy("n").limit(5), staff=staff, deps=deps)
    # A count of rows depends on no column.
    assert found == {"site": {"deps.site"}, "top": {"staff.salary*"}, "place": {"deps.site*", "staff.salary*"}}
    assert pairs(staff.join(deps, staff["dep"] == deps["code"], "semi").select("id"), staff=staff, deps=deps) == {"id": {"staff.id"}}


def test_a_table_joined_with_itself_keeps_its_name(staff):
    boss = staff.select(F.col("id").alias("boss"), F.col("name").alias("boss_name"))
    found = pairs(staff.alias("l").join(boss, F.col("l.age") == boss["boss"]).select("l.name", "boss_name"), staff=staff)
    assert found == {"name": {"staff.name"}, "boss_name": {"staff.name"}}
    twice = staff.alias("l").join(staff.alias("r"), F.expr("l.id = r.age"))
    assert pairs(twice.select(F.expr("concat(l.name, r.dep)").alias("v")), staff=staff) == {"v": {"staff.name*", "staff.dep*"}}


def test_stacked_rows_rollups_and_arrays(staff, deps):
    both = staff.select("id", F.upper("name").alias("t")).union(deps.select(F.size("rooms"), "site")).distinct()
    assert pairs(both, staff=staff, deps=deps) == {"id": {"staff.id", "deps.rooms*"}, "t": {"staff.name*", "deps.site"}}
    less = staff.select("dep").exceptAll(deps.select("code"))
    assert pairs(less, staff=staff, deps=deps) == {"dep": {"staff.dep"}}
    rolled = staff.rollup("dep", "name").agg(F.sum("age").alias("age"))
    assert pairs(rolled, staff=staff) == {"dep": {"staff.dep"}, "name": {"staff.name"}, "age": {"staff.age*"}}
    rooms = deps.select("code", F.explode("rooms").alias("room"))
    assert pairs(rooms, deps=deps) == {"code": {"deps.code"}, "room": {"deps.rooms*"}}


def test_a_step_may_be_a_source_and_files_are_named_by_folder(spark, staff, tmp_path):
    clean = staff.filter("age IS NOT NULL").withColumn("age2", F.col("age") * 2)
    assert pairs(clean.select(F.col("age2").alias("a")), clean=clean) == {"a": {"clean.age2"}}
    staff.write.parquet(str(tmp_path / "staff"))
    read = spark.read.parquet(str(tmp_path / "staff"))
    read.createOrReplaceTempView("staff_view")
    found = pairs(spark.sql("SELECT id AS k, s.* EXCEPT (id) FROM staff_view s"))
    assert found["k"] == {f"file:{tmp_path}/staff.id"} and len(found) == 5
    staff.write.saveAsTable("staff_table")
    assert pairs(spark.table("staff_table").select("id"))["id"] == {"spark_catalog.default.staff_table.id"}


def test_unknown_steps_are_refused(spark, staff, deps):
    with pytest.raises(ValueError, match="MapInArrow"):
        pairs(staff.mapInArrow(lambda batches: batches, staff.schema), staff=staff)
    with pytest.raises(ValueError, match="no name for the rows"):
        pairs(staff)
    with pytest.raises(ValueError, match="same rows"):
        pairs(staff, one=staff, two=staff)
    staff.createOrReplaceTempView("staff_rows")
    with pytest.raises(ValueError, match="subquery"):
        pairs(spark.sql("SELECT id, (SELECT max(age) FROM staff_rows) AS m FROM staff_rows"), staff=staff)


def test_filled_rows_and_lineage_from_a_mapping(spark, staff, deps):
    job = staff.join(deps, staff["dep"] == deps["code"], "left").select("id", "site", (F.col("salary") * 2).alias("pay"))
    mapping = plan_mapping.plan_mapping(job, "out", {"staff": staff, "deps": deps})
    filled = plan_mapping.mapping_fill(mapping, {"staff": staff, "out": job}).collect()
    assert sorted((r.src_column, r.dst_column, r.src_filled, r.dst_filled) for r in filled) == [
        ("id", "id", 3, 3), ("salary", "pay", 2, 2), ("site", "site", None, 2),
    ]
    known = spark.createDataFrame([("staff", "id", "g1"), ("out", "id", "g2")], "table_name string, name string, guid string")
    assert [(r.src_guid, r.dst_guid) for r in columns.column_lineage(known, mapping).collect()] == [("g1", "g2")]
    empty = plan_mapping.plan_mapping(spark.range(3).select(F.lit(1).alias("one")), "out", {"r": spark.range(3)})
    assert empty.count() == 0 and plan_mapping.mapping_fill(empty, {"out": job}).count() == 0
