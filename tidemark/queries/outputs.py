"""Parquet output and the quality profile of an output."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import quality
from tidemark.queries.common import Check, money, table
from tidemark.session import scratch_dir
from tidemark.sinks import parquet
from tidemark.specs import TableSpec

RUN_TIME = datetime(2026, 2, 3, 4, 5, 6, tzinfo=timezone.utc)


def parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "parquet")
    parquet.write_parquet(table(spark, sf_dir, "lineitem"), path, rows_per_file=50_000)
    return spark.read.parquet(path)


def run_date_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows written below the folders of the run's date, read back with them."""
    base = scratch_dir(spark, "dates")
    spec = TableSpec("orders", schema="sales", partition_by="date")
    path = parquet.run_folder(base, spec, RUN_TIME, "first")
    parquet.write_parquet(table(spark, sf_dir, "orders"), path, "overwrite")
    return parquet.read_output(spark, base, spec)


def run_date_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parquet.with_run_date(table(spark, sf_dir, "customer"), RUN_TIME, "month")


def dq_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("o_custkey"),
        "o_orderstatus",
        money("o_totalprice").alias("o_totalprice"),
        "o_orderdate",
        "o_orderpriority",
    )
    exact = ("o_orderstatus", "o_orderpriority")
    return quality.profile(orders, distinct="none", exact_distinct=exact)


RULES = {
    "quantity_positive": ("l_quantity > 0", "critical"),
    "discount_small": ("l_discount <= 0.08", "warning"),
    "flag_known": ("l_returnflag IN ('A', 'N')", "info"),
}


def dq_severity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.severity(table(spark, sf_dir, "lineitem"), RULES)


def _profile_sql(column: str, text: str, distinct: str, source: str = "o") -> str:
    low, high = text.format(f"min({column})"), text.format(f"max({column})")
    return (
        f"SELECT '{column}' AS column_name, count(*) AS row_count, "
        f"count(*) - count({column}) AS null_count, CAST({distinct} AS BIGINT) AS distinct_count, "
        f"{low} AS min_value, {high} AS max_value FROM {source}"
    )


_PROFILED = [
    ("o_orderkey", "CAST({} AS VARCHAR)", "NULL"),
    ("o_custkey", "CAST({} AS VARCHAR)", "NULL"),
    ("o_orderstatus", "{}", "count(DISTINCT o_orderstatus)"),
    ("o_totalprice", "CAST({} AS VARCHAR)", "NULL"),
    ("o_orderdate", "strftime({}, '%Y-%m-%d %H:%M:%S.%f')", "NULL"),
    ("o_orderpriority", "{}", "count(DISTINCT o_orderpriority)"),
]

CHECKS: dict[str, Check] = {
    "parquet_roundtrip": (parquet_roundtrip, "SELECT * FROM lineitem"),
    "run_date_partitions": (
        run_date_partitions,
        "SELECT *, '2026' AS year, '02' AS month, '03' AS day FROM orders",
    ),
    "run_date_columns": (
        run_date_columns,
        "SELECT *, '2026' AS year, '02' AS month FROM customer",
    ),
    "dq_profile": (
        dq_profile,
        "WITH o AS (SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS o_custkey, "
        "o_orderstatus, CAST(o_totalprice AS DECIMAL(18,2)) AS o_totalprice, o_orderdate, "
        "o_orderpriority FROM orders) " + " UNION ALL ".join(_profile_sql(*p) for p in _PROFILED),
    ),
    "dq_severity": (
        dq_severity,
        """
        WITH c AS (
          SELECT count(*) AS n, count(*) FILTER (NOT l_quantity > 0) AS a,
                 count(*) FILTER (NOT l_discount <= 0.08) AS b,
                 count(*) FILTER (l_returnflag NOT IN ('A', 'N')) AS d
          FROM lineitem)
        SELECT n AS row_count,
               CASE WHEN a > 0 THEN 'critical' WHEN b > 0 THEN 'warning'
                    WHEN d > 0 THEN 'info' ELSE 'ok' END AS severity,
               '{"rows":' || n || ',"quantity_positive":' || a || ',"discount_small":' || b
                 || ',"flag_known":' || d || '}' AS metrics_json
        FROM c
        """,
    ),
}
