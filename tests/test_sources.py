"""Readers, writers and tables: what goes in comes out."""

import glob

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import types as T

from test_records import SAMPLE, SAMPLE_DDL
from tablewarden.materialize import materialize
from tablewarden.operators.model import ENTITIES
from tablewarden.operators.quality import DataQualityError
from tablewarden.operators.search import search
from tablewarden.session import scratch_root
from tablewarden.sources import files, jdbc, tables
from tablewarden.sources.schemas import EMPLOYEE_SCHEMA, SAMPLE_SCHEMA


@pytest.fixture(scope="module")
def sample(spark):
    return spark.createDataFrame(SAMPLE, SAMPLE_DDL)


def same(a, b):
    return sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_csv_round_trip(spark, sample, tmp_path):
    path = str(tmp_path / "csv")
    files.write_csv(sample, path)
    back = files.read_csv(spark, path, SAMPLE_SCHEMA)
    assert back.schema == SAMPLE_SCHEMA and same(back, sample)
    assert same(files.read_csv(spark, path), sample)


def test_csv_binds_by_name(spark, tmp_path):
    path = tmp_path / "employees.csv"
    path.write_text("id,name,age,salary,department\n1,John Doe,32,75000,IT\n2,Jane,x,82000,HR\n")
    got = files.read_csv(spark, str(path), SAMPLE_SCHEMA).collect()
    assert [tuple(r) for r in got] == [
        (1, "John Doe", 32, "IT", 75000),
        (2, "Jane", None, "HR", 82000),
    ]
    assert files.read_csv(spark, str(path), EMPLOYEE_SCHEMA).columns == EMPLOYEE_SCHEMA.names


def test_csv_of_quotes_commas_and_nulls(spark, tmp_path):
    rows = [(1, 'say "hi", now'), (2, None), (3, "a,b"), (4, 'back\\slash')]
    df = spark.createDataFrame(rows, "id INT, name STRING")
    files.write_csv(df, str(tmp_path / "q"))
    assert same(files.read_csv(spark, str(tmp_path / "q"), df.schema).na.fill("-"), df.na.fill("-"))
    text = "".join(open(f).read() for f in glob.glob(str(tmp_path / "q" / "part-*")))
    assert '"say ""hi"", now"' in text


def test_csv_files_of_differing_order_are_refused(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,name\n1,x\n")
    (tmp_path / "b.csv").write_text("name,id\ny,2\n")
    with pytest.raises(Exception, match="CSV header does not conform"):
        files.read_csv(spark, str(tmp_path), T.StructType.fromDDL("id INT, name STRING")).collect()


def test_missing_source_is_an_error(spark, tmp_path):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        files.read_csv(spark, str(tmp_path / "none.csv"), SAMPLE_SCHEMA)


def test_parquet_and_json(spark, sample, tmp_path):
    files.write_parquet(sample, str(tmp_path / "p"))
    files.write_parquet(sample.limit(3), str(tmp_path / "p"))
    assert files.read_parquet(spark, str(tmp_path / "p")).count() == 3
    files.write_json(sample, str(tmp_path / "j"))
    assert same(spark.read.schema(SAMPLE_SCHEMA).json(str(tmp_path / "j")), sample)


def test_preview(sample):
    assert [r.id for r in files.preview(sample, ["salary", "id"], 3).collect()] == [7, 3, 5]


def test_managed_table_is_replaced(spark, sample):
    assert tables.load_table(sample, "wh.records").count() == 10
    assert same(tables.load_table(sample.filter("age > 30"), "wh.records"), sample.filter("age > 30"))
    assert spark.catalog.databaseExists("wh")


def test_text_table(spark, sample, tmp_path):
    tables.ensure_database(spark, "txt")
    place = str(tmp_path / "text")
    ddl = "id INT, name STRING, department STRING, adjusted_salary DOUBLE"
    made = tables.create_text_table(spark, "txt.transformed", ddl, location=place)
    assert made.count() == 0
    sample.selectExpr("id", "name", "department", "double(salary)").write.insertInto(
        "txt.transformed"
    )
    assert spark.table("txt.transformed").count() == 10
    lines = [line for f in glob.glob(f"{place}/part-*") for line in open(f).read().splitlines()]
    assert "1,John Doe,Engineering,85000.0" in lines
    assert tables.create_text_table(spark, "txt.transformed", ddl, location=place).count() == 10


def test_seeded_table_does_not_grow(spark):
    tables.ensure_database(spark, "seed")
    ddl = "id INT, name STRING, age INT, department STRING, salary DOUBLE"
    rows = [(*row[:4], float(row[4])) for row in SAMPLE]
    for _ in range(2):
        seeded = tables.seed_table(spark, "seed.employees", ddl, rows, "Employees' data")
    assert seeded.count() == 10
    described = spark.sql("DESCRIBE TABLE EXTENDED seed.employees").collect()
    assert "Employees' data" in {r.data_type for r in described}


def test_published_version_may_read_the_old_one(spark, sample):
    tables.ensure_database(spark, "ver")
    tables.publish_version(sample, "ver.entities", "1")
    old = spark.table("ver.entities")
    newer = tables.publish_version(old.unionByName(old), "ver.entities", "2")
    assert newer.count() == 20 and spark.table("ver.entities__1").count() == 10


def test_catalog_is_split_by_type(spark, tmp_path):
    items = [(str(i), f"t{i % 3}", f"q{i}", "n", None, None, "ACTIVE", None, {}) for i in range(30)]
    catalog = spark.createDataFrame(items, ENTITIES)
    tables.write_catalog(catalog, str(tmp_path / "c"))
    back = tables.read_catalog(spark, str(tmp_path / "c"))
    assert back.columns == catalog.columns and back.count() == 30
    found = search(back, type_name="t1")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "type_name" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert found.count() == 10


def test_jdbc_options_and_key_check(spark, sample):
    options = jdbc.jdbc_options("jdbc:x:y", "employees", "a.b.Driver", "name VARCHAR(255)")
    assert options["truncate"] == "true" and options["dbtable"] == "employees"
    assert options["createTableColumnTypes"] == "name VARCHAR(255)"
    twice = sample.unionByName(sample)
    with pytest.raises(DataQualityError):
        jdbc.load_jdbc(twice, "jdbc:x:y", "employees", "a.b.Driver", keys=["id"])


def test_materialize_counts_and_empty(spark, sample):
    written = materialize(sample.filter("age > 18"), "t")
    assert written.rows == written.frame.count() == 8
    assert written.paths[0].startswith(scratch_root(spark))
    nothing = materialize(sample.filter("age > 1000"), "t")
    assert nothing.rows == nothing.frame.count() == 0
    folded = materialize(sample.filter("false"), "t")
    assert folded.rows == folded.frame.count() == 0


def test_scratch_root_is_the_configured_folder(spark):
    assert scratch_root(spark) == spark.conf.get("spark.checkpoint.dir")


def test_schema_names():
    assert T.StructType(EMPLOYEE_SCHEMA.fields).names == ["id", "name", "age", "salary", "department"]


def test_stream_takes_a_file_and_a_folder(spark, tmp_path):
    from tablewarden.streaming.ingest import ingest_new_files

    rows = spark.range(100).withColumnRenamed("id", "k")
    rows.repartition(4).write.parquet(str(tmp_path / "folder" / "t.parquet"))
    rows.coalesce(1).write.parquet(str(tmp_path / "made"))
    (tmp_path / "single").mkdir()
    part = next((tmp_path / "made").glob("part-*"))
    (tmp_path / "single" / "t.parquet").write_bytes(part.read_bytes())
    for kind in ("folder", "single"):
        out, marks = str(tmp_path / f"{kind}-out"), str(tmp_path / f"{kind}-marks")
        source = f"{tmp_path}/{kind}/t.parque[t]"
        got = ingest_new_files(spark, source, rows.schema, out, marks, lambda df: df)
        assert got.count() == 100, kind


def test_scratch_tables_are_released(spark):
    from tablewarden.materialize import materialize, release
    from tablewarden.session import scratch_root

    path = materialize(spark.range(5), "gone").paths[0]
    assert path.startswith(scratch_root(spark))
    release(spark)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)
