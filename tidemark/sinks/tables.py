"""Catalog tables and relational tables as outputs."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.contracts import target_columns
from tidemark.specs import SpecError


def has_catalog_format(spark: SparkSession, table_format: str) -> bool:
    """Whether a table format's data source is on the classpath."""
    try:
        spark._jvm.org.apache.spark.sql.execution.datasources.DataSource.lookupDataSource(
            table_format, spark._jsparkSession.sessionState().conf()
        )
    except Exception:  # noqa: BLE001 - a Py4J error means the class is missing
        return False
    return True


class MissingFormat(RuntimeError):
    """A table format whose runtime is not on the classpath."""


def append_table(
    df: DataFrame, name: str, table_format: str = "iceberg", fallback: str | None = None
) -> int:
    """Append to a catalog table in one commit; create it from the schema if missing.

    Without the format's runtime it is an error, unless ``fallback="parquet"`` asks for
    a Parquet table of the session catalog. Returns the row count of the same pass.
    """
    spark = df.sparkSession
    found = has_catalog_format(spark, table_format)
    if not found and fallback != "parquet":
        raise MissingFormat(f"{name}: the runtime of {table_format} is not on the classpath")
    seen = Observation()
    df = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    schema = name.rpartition(".")[0]
    if schema:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}")
    if found:
        if spark.catalog.tableExists(name):
            df.writeTo(name).append()
        else:
            df.writeTo(name).using(table_format).create()
    else:
        df.write.mode("append").format("parquet").saveAsTable(name)
    return int(seen.get["rows"])


def merge_table(df: DataFrame, name: str, keys: Sequence[str]) -> None:
    """Upsert into a catalog table whose format supports row-level merges."""
    condition = reduce(
        lambda a, b: a & b, [F.col(f"{name}.`{k}`") == F.col(f"b.`{k}`") for k in keys]
    )
    updated = {c: F.col(f"b.`{c}`") for c in df.columns if c not in keys}
    inserted = {c: F.col(f"b.`{c}`") for c in df.columns}
    merge = df.alias("b").mergeInto(name, condition)
    if updated:
        merge = merge.whenMatched().update(updated)
    merge.whenNotMatched().insert(inserted).merge()


def quote(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def jdbc_write_options(
    url: str,
    schema: str,
    table: str,
    properties: dict[str, str] | None = None,
    batch_size: int = 5000,
    partitions: int | None = None,
) -> dict[str, str]:
    """Writer options for a relational table."""
    options = {
        "url": url,
        "dbtable": f"{quote(schema)}.{quote(table)}",
        "batchsize": str(batch_size),
        "reWriteBatchedInserts": "true",
        **(properties or {}),
    }
    if partitions:
        options["numPartitions"] = str(partitions)
    return options


def create_statement(schema: str, table: str, columns: T.StructType, keys: Sequence[str] = ()) -> str:
    """CREATE TABLE with quoted names, target types, NOT NULL and a primary key."""
    parts = [
        f"{quote(name)} {kind}" + ("" if nullable else " NOT NULL")
        for _, name, kind, nullable in target_columns(columns)
    ]
    if keys:
        parts.append(f"PRIMARY KEY ({', '.join(quote(k) for k in keys)})")
    return f"CREATE TABLE IF NOT EXISTS {quote(schema)}.{quote(table)} ({', '.join(parts)})"


def conflict_statement(
    schema: str, table: str, staging: str, columns: Sequence[str], keys: Sequence[str]
) -> str:
    """One statement that merges a staging table into its target."""
    if not keys:
        raise SpecError("upsert needs key columns")
    names = ", ".join(quote(c) for c in columns)
    values = [c for c in columns if c not in keys]
    action = (
        "UPDATE SET " + ", ".join(f"{quote(c)} = EXCLUDED.{quote(c)}" for c in values)
        if values
        else "NOTHING"
    )
    return (
        f"INSERT INTO {quote(schema)}.{quote(table)} ({names}) "
        f"SELECT {names} FROM {quote(schema)}.{quote(staging)} "
        f"ON CONFLICT ({', '.join(quote(k) for k in keys)}) DO {action}"
    )


def run_statement(spark: SparkSession, url: str, sql: str, properties: dict[str, str]) -> None:
    """Run one statement on the database, from the driver's JVM."""
    jvm = spark._jvm
    settings = jvm.java.util.Properties()
    for key, value in properties.items():
        settings.setProperty(key, value)
    connection = jvm.java.sql.DriverManager.getConnection(url, settings)
    try:
        connection.createStatement().execute(sql)
    finally:
        connection.close()


class JdbcTargets:
    """Relational tables: create, insert, replace, upsert. ``Ingest`` does not drive them.

    Needs the database's driver on the classpath. Batches are already reduced to
    one row per key. Every write is its own transaction, so a failed run may
    leave rows of files that are not recorded yet, and loads them again.
    """

    def __init__(
        self,
        spark: SparkSession,
        url: str,
        properties: dict[str, str] | None = None,
        schema: str = "public",
        batch_size: int = 5000,
        partitions: int | None = None,
    ) -> None:
        self.spark, self.url, self.schema = spark, url, schema
        self.properties = dict(properties or {})
        self.batch_size, self.partitions = batch_size, partitions

    def _options(self, table: str) -> dict[str, str]:
        return jdbc_write_options(
            self.url, self.schema, table, self.properties, self.batch_size, self.partitions
        )

    def read(self, table: str) -> DataFrame:
        return self.spark.read.format("jdbc").options(**self._options(table)).load()

    def exists(self, table: str) -> bool:
        query = (
            "SELECT 1 AS found FROM information_schema.tables "
            f"WHERE table_schema = '{self.schema}' AND table_name = '{table}'"
        )
        options = {"url": self.url, "query": query, **self.properties}
        return not self.spark.read.format("jdbc").options(**options).load().isEmpty()

    def create(self, table: str, columns: T.StructType, keys: Sequence[str] = ()) -> None:
        self._run(create_statement(self.schema, table, columns, keys))

    def _run(self, sql: str) -> None:
        run_statement(self.spark, self.url, sql, self.properties)

    def insert(self, table: str, df: DataFrame) -> None:
        df.write.format("jdbc").options(**self._options(table)).mode("append").save()

    def replace(self, table: str, df: DataFrame) -> None:
        writer = df.write.format("jdbc").options(**self._options(table))
        writer.option("truncate", "true").mode("overwrite").save()

    def upsert(self, table: str, df: DataFrame, keys: Sequence[str]) -> None:
        """Merge through a staging table of this call's own, which is dropped after."""
        staging = f"{table}_{uuid.uuid4().hex}"
        try:
            df.write.format("jdbc").options(**self._options(staging)).mode("errorifexists").save()
            self._run(conflict_statement(self.schema, table, staging, df.columns, keys))
        finally:
            self._run(f"DROP TABLE IF EXISTS {quote(self.schema)}.{quote(staging)}")
