"""Table scans, table discovery and column introspection."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.contracts import source_type, target_type
from tidemark.operators import splits
from tidemark.specs import TableSpec

# A source turns a spec into a lazy DataFrame.
Source = Callable[[TableSpec], DataFrame]


class MissingTable(ValueError):
    """The table does not exist or shows no columns."""


def project(df: DataFrame, columns: Sequence[str] | None) -> DataFrame:
    """Selected columns in source order; unknown names are ignored."""
    if columns is None:
        return df
    wanted = set(columns)
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c in wanted])


def parquet_source(spark: SparkSession, base: str) -> Source:
    """Tables kept as ``<base>/<name>.parquet`` (a file or a folder)."""

    def scan(spec: TableSpec) -> DataFrame:
        return spark.read.parquet(f"{base.rstrip('/')}/{spec.name}.parquet")

    return scan


def catalog_source(spark: SparkSession) -> Source:
    """Tables and views of the session catalog.

    A bare name may also be a temporary view, so it is looked up as written.
    """

    def scan(spec: TableSpec) -> DataFrame:
        name = f"`{spec.schema}`.`{spec.name}`" if spec.schema else f"`{spec.name}`"
        if not spark.catalog.tableExists(name):
            raise MissingTable(
                f"{spec.full_name} has no visible columns: it is missing or may not be read"
            )
        return spark.table(name)

    return scan


def jdbc_options(
    url: str,
    spec: TableSpec,
    properties: dict[str, str] | None = None,
    split: tuple[str, str, str, int] | None = None,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    """Reader options for a relational table.

    ``split`` is (column, lower bound, upper bound, partitions): the bounds
    only set the stride, so rows outside them are still read. Limits are never
    pushed down, since a pushed sort and limit may return extra rows.
    """
    options = {
        "url": url,
        "dbtable": f'"{spec.lookup_schema}"."{spec.name}"',
        "fetchsize": str(fetch_size),
        "pushDownPredicate": "true",
        "pushDownAggregate": "true",
        "pushDownLimit": "false",
        "pushDownOffset": "false",
        "preferTimestampNTZ": "true",
        **(properties or {}),
    }
    if split is not None:
        column, lower, upper, partitions = split
        options.update(
            partitionColumn=column,
            lowerBound=str(lower),
            upperBound=str(upper),
            numPartitions=str(partitions),
        )
    return options


def jdbc_source(
    spark: SparkSession,
    url: str,
    properties: dict[str, str] | None = None,
    splits: dict[str, tuple[str, str, str, int]] | None = None,
) -> Source:
    """Tables of a relational database, read in parallel where a split is given."""

    def scan(spec: TableSpec) -> DataFrame:
        split = (splits or {}).get(spec.qualified_name)
        options = jdbc_options(url, spec, properties, split)
        return spark.read.format("jdbc").options(**options).load()

    return scan


def jdbc_range_source(
    spark: SparkSession,
    url: str,
    relational: Source,
    columns: dict[str, str],
    parts: int = 64,
    properties: dict[str, str] | None = None,
) -> Source:
    """Tables of a relational database, read by ranges of a column that need no bounds by hand.

    ``columns`` names a table's column to cut. ``relational`` is a source that computes
    the column's least and greatest value itself, as ``jdbc_catalog_source``. Tables
    without a column are read as ``jdbc_source`` does.
    """
    plain = jdbc_source(spark, url, properties)

    def scan(spec: TableSpec) -> DataFrame:
        column = columns.get(spec.qualified_name)
        if column is None:
            return plain(spec)
        found = splits.ranges_of_equal_width(relational(spec), column, parts)
        options = jdbc_options(url, spec, properties)
        name = options.pop("dbtable")
        return spark.read.jdbc(options.pop("url"), name, predicates=[r.sql() for r in found], properties=options)

    return scan


def jdbc_catalog_settings(
    name: str, url: str, properties: dict[str, str] | None = None
) -> dict[str, str]:
    """Session settings that show a relational database as a catalog.

    Unlike the plain reader a catalog lets the database compute maxima itself,
    which is how the end of an increment is found.
    """
    root = f"spark.sql.catalog.{name}"
    options = {
        "url": url,
        "pushDownPredicate": "true",
        "pushDownAggregate": "true",
        "pushDownLimit": "false",
        "pushDownOffset": "false",
        **(properties or {}),
    }
    return {
        root: "org.apache.spark.sql.execution.datasources.v2.jdbc.JDBCTableCatalog",
        **{f"{root}.{key}": value for key, value in options.items()},
    }


def jdbc_catalog_source(spark: SparkSession, name: str) -> Source:
    """Tables of a database shown as a catalog."""

    def scan(spec: TableSpec) -> DataFrame:
        table = f"`{name}`.`{spec.lookup_schema}`.`{spec.name}`"
        if not spark.catalog.tableExists(table):
            raise MissingTable(f"{spec.full_name} has no visible columns: it is missing or may not be read")
        return spark.table(table)

    return scan


def catalog_listing(spark: SparkSession) -> DataFrame:
    """All tables of all schemas of the session catalog."""
    rows = [
        (schema.name, table.name)
        for schema in spark.catalog.listDatabases()
        for table in spark.catalog.listTables(schema.name)
        if not table.isTemporary
    ]
    return spark.createDataFrame(rows, "schema_name string, table_name string")


def jdbc_listing(spark: SparkSession, url: str, properties: dict[str, str] | None = None) -> DataFrame:
    """All tables of a Postgres database, from its own catalog view."""
    return (
        spark.read.format("jdbc")
        .options(url=url, dbtable="pg_catalog.pg_tables", **(properties or {}))
        .load()
        .select(F.col("schemaname").alias("schema_name"), F.col("tablename").alias("table_name"))
    )


def discover_tables(listing: DataFrame, schema: str | None = None) -> DataFrame:
    """Tables of one schema, or of all, in name order."""
    tables = listing.select("schema_name", "table_name").distinct()
    if schema is not None:
        tables = tables.where(F.col("schema_name") == schema)
    return tables.orderBy("schema_name", "table_name")


def resolve_tables(listing: DataFrame, schema: str, exclude: Sequence[str] = ()) -> DataFrame:
    """Discovered tables of a schema without the excluded ones."""
    tables = discover_tables(listing, schema)
    return tables.where(~F.col("table_name").isin(*exclude)) if exclude else tables


def introspect(name: str, df: DataFrame, count_rows: bool = False) -> DataFrame:
    """Columns of a table in ordinal order with source, lake and target types.

    From the schema alone; with ``count_rows`` the non-NULL rows of every column are
    counted in one pass, else their number is NULL.
    """
    fields = df.schema.fields
    if count_rows:
        counts = df.agg(*[F.count(F.col(f"`{f.name}`")).alias(f"n{i}") for i, f in enumerate(fields)])
    else:
        counts = df.sparkSession.sql("SELECT 1").select(
            *[F.lit(None).cast("bigint").alias(f"n{i}") for i in range(len(fields))]
        )
    rows = [
        F.struct(
            F.lit(name).alias("table_name"),
            F.lit(i + 1).alias("ordinal"),
            F.lit(f.name).alias("column_name"),
            F.lit(source_type(f)).alias("source_type"),
            F.lit(f.dataType.simpleString()).alias("lake_type"),
            F.lit(target_type(f.dataType)).alias("target_type"),
            F.lit(f.nullable).alias("is_nullable"),
            F.col(f"n{i}").alias("non_null_rows"),
        )
        for i, f in enumerate(fields)
    ]
    return counts.select(F.inline(F.array(*rows)))


def column_info(schema: T.StructType) -> list[tuple[int, str, str, bool]]:
    """(ordinal, name, source type, nullable) of each column, from the schema alone."""
    return [
        (i, f.name, source_type(f), f.nullable) for i, f in enumerate(schema.fields, start=1)
    ]
