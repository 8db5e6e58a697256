import pytest
from pyspark.sql import types as T

from tidemark.sinks import parquet, tables
from tidemark.sources.tables import jdbc_catalog_settings, jdbc_options
from tidemark.specs import SpecError, TableSpec


def test_parquet_keeps_nulls_and_appends(spark, tmp_path, rows):
    path = str(tmp_path / "out")
    df = spark.createDataFrame([(1, "alice"), (2, "bob"), (3, None)], "id int, name string")
    assert parquet.write_parquet(df, path) == 3
    assert rows(spark.read.parquet(path)) == [(1, "alice"), (2, "bob"), (3, None)]
    assert parquet.write_parquet(df, path) == 3
    assert spark.read.parquet(path).count() == 6
    assert all(".snappy." in f for f in spark.read.parquet(path).inputFiles())


def test_jdbc_reader_options():
    spec = TableSpec("users", schema="sales")
    options = jdbc_options("jdbc:postgresql://h/db", spec, {"user": "u"}, ("id", "1", "100", 8))
    assert options["dbtable"] == '"sales"."users"'
    assert (options["pushDownLimit"], options["pushDownPredicate"]) == ("false", "true")
    assert (options["partitionColumn"], options["numPartitions"]) == ("id", "8")
    assert options["user"] == "u"
    assert "partitionColumn" not in jdbc_options("u", TableSpec("t"))


def test_jdbc_catalog_settings():
    settings = jdbc_catalog_settings("shop", "jdbc:postgresql://h/db", {"user": "u"})
    assert settings["spark.sql.catalog.shop"].endswith("JDBCTableCatalog")
    assert settings["spark.sql.catalog.shop.pushDownAggregate"] == "true"
    assert settings["spark.sql.catalog.shop.pushDownLimit"] == "false"
    assert settings["spark.sql.catalog.shop.user"] == "u"


def test_jdbc_writer_options():
    options = tables.jdbc_write_options("jdbc:x", "public", "users", {"user": "u"}, 500, 4)
    assert options["dbtable"] == '"public"."users"'
    assert (options["batchsize"], options["numPartitions"], options["user"]) == ("500", "4", "u")


def test_conflict_statements():
    sql = tables.conflict_statement("public", "users", "users_staging", ["id", "name", "email"], ["id"])
    assert sql == (
        'INSERT INTO "public"."users" ("id", "name", "email") '
        'SELECT "id", "name", "email" FROM "public"."users_staging" '
        'ON CONFLICT ("id") DO UPDATE SET "name" = EXCLUDED."name", "email" = EXCLUDED."email"'
    )
    assert tables.conflict_statement("p", "t", "s", ["id"], ["id"]).endswith("DO NOTHING")
    both = tables.conflict_statement("p", "t", "s", ["a", "b", "q"], ["a", "b"])
    assert both.endswith('ON CONFLICT ("a", "b") DO UPDATE SET "q" = EXCLUDED."q"')
    with pytest.raises(SpecError):
        tables.conflict_statement("p", "t", "s", ["id"], [])
    assert tables.quote('od"d') == '"od""d"'


def test_formats_on_the_classpath(spark):
    assert tables.has_catalog_format(spark, "parquet")
    assert not tables.has_catalog_format(spark, "no_such_format")


def test_create_table_text():
    columns = T.StructType([T.StructField('a"b', T.LongType(), False), T.StructField("t", T.StringType())])
    assert tables.create_statement("s", "x", columns, ['a"b']) == (
        'CREATE TABLE IF NOT EXISTS "s"."x" ("a""b" BIGINT NOT NULL, "t" TEXT, PRIMARY KEY ("a""b"))'
    )


def test_runs_with_an_added_column_read_back_whole(spark, tmp_path):
    spec, base = TableSpec("users"), str(tmp_path)
    for i, frame in enumerate((spark.sql("SELECT 1 AS id"), spark.sql("SELECT 2 AS id, 'x' AS extra"))):
        parquet.write_parquet(frame, f"{parquet.table_folder(base, spec)}/{parquet.RUN_COLUMN}=r{i}")
    found = parquet.read_output(spark, base, spec)
    assert {tuple(r) for r in found.select("id", "extra").collect()} == {(1, None), (2, "x")}
