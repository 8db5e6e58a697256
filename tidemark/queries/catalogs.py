"""Discovery, references, introspection and the sync dry run."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.routing import resolve_refs
from tidemark.plans.sync import sync_plan as plan_tables
from tidemark.queries.common import Check, table
from tidemark.sources import tables as sources
from tidemark.specs import TableSpec

PLANNED = (
    TableSpec("customer", schema="public", partition_by="date"),
    TableSpec(
        "orders",
        incremental_column="o_orderdate",
        incremental_tiebreaker_column="o_orderkey",
        partition_by="month",
    ),
    TableSpec("events", incremental_column="ts", incremental_column_is_unique=True),
    TableSpec("lineitem", columns=("l_shipdate", "l_orderkey"), incremental_column="l_shipdate"),
    TableSpec("documents", partition_by="year"),
)
INTROSPECTED = ("orders", "customer", "events", "documents")


def _listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A listing of tables: a schema per source, a table per language and id width."""
    return table(spark, sf_dir, "documents").select(
        F.col("source").alias("schema_name"),
        F.concat("lang", F.lit("_"), F.length(F.col("doc_id").cast("string")).cast("string")).alias(
            "table_name"
        ),
    )


def discover_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sources.discover_tables(_listing(spark, sf_dir))


def resolve_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sources.resolve_tables(_listing(spark, sf_dir), "src3", ("en_1", "fr_3"))


def resolve_table_refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """References of every form against tables named by language or by source."""
    documents = table(spark, sf_dir, "documents")
    lang, source = F.col("lang"), F.col("source")
    name = F.when(lang == "es", F.concat(source, F.lit("_es"))).otherwise(lang)
    tables = documents.select(
        F.when(lang != "es", source).alias("schema_name"), name.alias("table_name")
    )
    refs = documents.select(
        F.when(lang == "es", F.concat(source, F.lit("_es")))
        .when(lang == "en", lang)
        .when(lang == "fr", F.concat_ws(".", source, lang))
        .otherwise(F.concat(source, F.lit("x."), lang))
        .alias("table_ref")
    )
    return resolve_refs(refs, tables)


def introspect_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = [sources.introspect(t, table(spark, sf_dir, t), count_rows=True) for t in INTROSPECTED]
    columns = reduce(DataFrame.unionByName, found)
    return columns.select(
        "table_name", "ordinal", "column_name", "target_type", "is_nullable", "non_null_rows"
    )


def sync_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = sources.parquet_source(spark, sf_dir)
    return plan_tables(spark, source, PLANNED, count_rows=True)


_COLUMNS = {
    "orders": [
        ("o_orderkey", "BIGINT"), ("o_custkey", "BIGINT"), ("o_orderstatus", "TEXT"),
        ("o_totalprice", "DOUBLE PRECISION"), ("o_orderdate", "TIMESTAMP"),
        ("o_orderpriority", "TEXT"),
    ],
    "customer": [
        ("c_custkey", "BIGINT"), ("c_name", "TEXT"), ("c_nationkey", "INTEGER"),
        ("c_acctbal", "DOUBLE PRECISION"), ("c_mktsegment", "TEXT"),
    ],
    "events": [
        ("event_id", "BIGINT"), ("ts", "TIMESTAMP"), ("user_id", "BIGINT"), ("event_type", "TEXT"),
        ("value", "DOUBLE PRECISION"), ("props", "TEXT"),
    ],
    "documents": [
        ("doc_id", "BIGINT"), ("text", "TEXT"), ("lang", "TEXT"), ("source", "TEXT"),
        ("n_chars", "BIGINT"),
    ],
}

CHECKS: dict[str, Check] = {
    "discover_tables": (
        discover_tables,
        """
        SELECT DISTINCT source AS schema_name,
               lang || '_' || length(CAST(doc_id AS VARCHAR)) AS table_name
        FROM documents ORDER BY 1, 2
        """,
    ),
    "resolve_tables": (
        resolve_tables,
        """
        SELECT DISTINCT source AS schema_name,
               lang || '_' || length(CAST(doc_id AS VARCHAR)) AS table_name
        FROM documents
        WHERE source = 'src3'
          AND lang || '_' || length(CAST(doc_id AS VARCHAR)) NOT IN ('en_1', 'fr_3')
        ORDER BY 2
        """,
    ),
    "resolve_table_refs": (
        resolve_table_refs,
        """
        WITH known AS (
          SELECT DISTINCT CASE WHEN lang <> 'es' THEN source ELSE 'public' END AS s,
                 CASE WHEN lang = 'es' THEN source || '_es' ELSE lang END AS n
          FROM documents),
        refs AS (
          SELECT DISTINCT CASE lang WHEN 'es' THEN source || '_es' WHEN 'en' THEN lang
                   WHEN 'fr' THEN source || '.' || lang ELSE source || 'x.' || lang END AS table_ref
          FROM documents),
        split AS (
          SELECT table_ref,
                 CASE WHEN contains(table_ref, '.') THEN split_part(table_ref, '.', 1) END AS rs,
                 CASE WHEN contains(table_ref, '.') THEN split_part(table_ref, '.', 2)
                      ELSE table_ref END AS rn
          FROM refs),
        hits AS (
          SELECT table_ref, rs, rn, count(n) AS c, min(s) AS only_s
          FROM split LEFT JOIN known ON n = rn AND (rs IS NULL OR rs = s)
          GROUP BY 1, 2, 3)
        SELECT table_ref, CASE WHEN rs IS NOT NULL THEN rs WHEN c = 1 THEN only_s END AS schema_name,
               rn AS table_name,
               CASE WHEN c > 1 THEN 'ambiguous' WHEN c = 1 THEN 'configured' ELSE 'minimal' END
                 AS outcome
        FROM hits
        """,
    ),
    "introspect_columns": (
        introspect_columns,
        " UNION ALL ".join(
            f"SELECT '{t}' AS table_name, {i} AS ordinal, '{c}' AS column_name, "
            f"'{k}' AS target_type, TRUE AS is_nullable, count({c}) AS non_null_rows FROM {t}"
            for t, columns in _COLUMNS.items()
            for i, (c, k) in enumerate(columns, start=1)
        ),
    ),
    "sync_plan": (
        sync_plan,
        """
        SELECT 'public.customer' AS table_name, 'full' AS mode, 'date' AS partition_by,
               5 AS n_columns, 'c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment' AS columns,
               CAST(NULL AS VARCHAR) AS watermark, CAST(NULL AS VARCHAR) AS cursor,
               count(*) AS source_rows FROM customer
        UNION ALL
        SELECT 'orders', 'incremental (cursor)', 'month', 6,
               'o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority',
               'o_orderdate', 'o_orderkey', count(o_orderdate) FROM orders
        UNION ALL
        SELECT 'events', 'incremental (unique watermark)', NULL, 6,
               'event_id, ts, user_id, event_type, value, props', 'ts', NULL, count(ts) FROM events
        UNION ALL
        SELECT 'lineitem', 'incremental (invalid config: missing tiebreaker)', NULL, 2,
               'l_orderkey, l_shipdate', 'l_shipdate', NULL, count(l_shipdate) FROM lineitem
        UNION ALL
        SELECT 'documents', 'full', 'year', 5, 'doc_id, text, lang, source, n_chars', NULL, NULL,
               count(*) FROM documents
        """,
    ),
}
