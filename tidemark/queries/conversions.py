"""Type contracts and value conversions, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.contracts import for_target, to_lake
from tidemark.functions.conversions import as_text, from_epoch, from_epoch_day
from tidemark.queries.common import Check, money, table
from tidemark.session import scratch_dir
from tidemark.sinks.parquet import write_parquet
from tidemark.sources.tables import introspect

# Source types the columns of the contract query are declared with.
ORDER_TYPES = {
    "o_orderkey": "bigserial",
    "o_custkey": "integer",
    "o_orderstatus": "character",
    "o_totalprice": "numeric",
    "rounded_price": "real",
    "o_orderdate": "timestamp without time zone",
    "order_day": "date",
    "o_orderpriority": "citext",
    "is_open": "boolean",
    "line_key": "uuid",
    "parts": "_int8",
}


def _typed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_custkey",
        "o_orderstatus",
        money("o_totalprice").alias("o_totalprice"),
        F.floor("o_totalprice").alias("rounded_price"),
        "o_orderdate",
        F.col("o_orderdate").alias("order_day"),
        "o_orderpriority",
        (F.col("o_orderstatus") == "O").alias("is_open"),
        F.md5(F.col("o_orderkey").cast("string")).alias("line_key"),
        F.array("o_orderkey", "o_custkey").alias("parts"),
    )


def lake_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = to_lake(_typed_orders(spark, sf_dir), ORDER_TYPES)
    return rows.withColumn("rounded_price", F.col("rounded_price").cast("double"))


def target_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target column types of the line items, with the rows each column fills."""
    lines = table(spark, sf_dir, "lineitem").withColumn("price", money("l_extendedprice"))
    lines = lines.withColumn("keys", F.array("l_orderkey", "l_partkey"))
    columns = introspect("lineitem", for_target(lines), count_rows=True)
    return columns.select("ordinal", "column_name", "target_type", "is_nullable", "non_null_rows")


def typed_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "typed")
    rows = to_lake(_typed_orders(spark, sf_dir), ORDER_TYPES)
    write_parquet(rows, path)
    back = spark.read.parquet(path)
    return back.withColumn("rounded_price", F.col("rounded_price").cast("double"))


def timestamp_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event times as epoch numbers in four units and days, and back."""
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    events = table(spark, sf_dir, "events").select(
        "event_id",
        F.unix_seconds(F.col("ts").cast("timestamp")).alias("s"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("ms"),
        micros.alias("us"),
        (micros * 1000 + 999).alias("ns"),
        F.unix_date(F.col("ts").cast("date")).alias("d"),
    )
    return events.select(
        "event_id",
        *[from_epoch(F.col(u), u).alias(f"from_{u}") for u in ("s", "ms", "us", "ns")],
        as_text(from_epoch(F.col("us"), "us", zoned=True), T.TimestampType()).alias("zoned_text"),
        from_epoch_day(F.col("d")).alias("from_day"),
    )


def numeric_as_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    prices = table(spark, sf_dir, "orders").select(
        "o_orderkey", money("o_totalprice").alias("o_totalprice")
    )
    return to_lake(prices, {"o_totalprice": "numeric"})


def json_passthrough(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "props")
    return to_lake(events, {"props": "jsonb"})


def array_as_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    keys = lines.select(
        "l_orderkey",
        F.array("l_orderkey", "l_partkey", F.col("l_linenumber").cast("bigint")).alias("keys"),
        F.array("l_returnflag", "l_linestatus").alias("flags"),
    )
    return to_lake(keys, {"keys": "bigint[]", "flags": "_text"})


def text_rendering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone-free and zoned timestamps, dates and booleans as text."""
    ts = F.col("ts")
    cut = F.when(F.col("event_type") == "view", F.date_trunc("second", ts).cast("timestamp_ntz"))
    cut = cut.when(
        F.col("event_type") == "click", F.date_trunc("millisecond", ts).cast("timestamp_ntz")
    ).otherwise(ts)
    events = table(spark, sf_dir, "events").select(
        "event_id",
        cut.alias("plain"),
        cut.cast("timestamp").alias("zoned"),
        cut.cast("date").alias("day"),
        (F.col("event_type") == "view").alias("flag"),
    )
    return to_lake(
        events, {"plain": "text", "zoned": "text", "day": "text", "flag": "text"}
    )


CONTRACT_SQL = """
SELECT o_orderkey, CAST(o_custkey AS INTEGER) AS o_custkey, o_orderstatus,
       CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS o_totalprice,
       CAST(CAST(floor(o_totalprice) AS REAL) AS DOUBLE) AS rounded_price,
       o_orderdate, CAST(o_orderdate AS DATE) AS order_day, o_orderpriority,
       o_orderstatus = 'O' AS is_open, md5(CAST(o_orderkey AS VARCHAR)) AS line_key,
       '[' || o_orderkey || ',' || o_custkey || ']' AS parts
FROM orders
"""

CHECKS: dict[str, Check] = {
    "lake_contract": (lake_contract, CONTRACT_SQL),
    "typed_roundtrip": (typed_roundtrip, CONTRACT_SQL),
    "target_contract": (
        target_contract,
        """
        SELECT c.ordinal, c.column_name, c.target_type, TRUE AS is_nullable, c.non_null_rows
        FROM (
          SELECT 1 AS ordinal, 'l_orderkey' AS column_name, 'BIGINT' AS target_type,
                 count(l_orderkey) AS non_null_rows FROM lineitem
          UNION ALL SELECT 2, 'l_partkey', 'BIGINT', count(l_partkey) FROM lineitem
          UNION ALL SELECT 3, 'l_suppkey', 'BIGINT', count(l_suppkey) FROM lineitem
          UNION ALL SELECT 4, 'l_linenumber', 'INTEGER', count(l_linenumber) FROM lineitem
          UNION ALL SELECT 5, 'l_quantity', 'DOUBLE PRECISION', count(l_quantity) FROM lineitem
          UNION ALL SELECT 6, 'l_extendedprice', 'DOUBLE PRECISION', count(l_extendedprice) FROM lineitem
          UNION ALL SELECT 7, 'l_discount', 'DOUBLE PRECISION', count(l_discount) FROM lineitem
          UNION ALL SELECT 8, 'l_tax', 'DOUBLE PRECISION', count(l_tax) FROM lineitem
          UNION ALL SELECT 9, 'l_returnflag', 'TEXT', count(l_returnflag) FROM lineitem
          UNION ALL SELECT 10, 'l_linestatus', 'TEXT', count(l_linestatus) FROM lineitem
          UNION ALL SELECT 11, 'l_shipdate', 'TIMESTAMP', count(l_shipdate) FROM lineitem
          UNION ALL SELECT 12, 'price', 'TEXT', count(l_extendedprice) FROM lineitem
          UNION ALL SELECT 13, 'keys', 'TEXT', count(*) FROM lineitem) c
        """,
    ),
    "timestamp_units": (
        timestamp_units,
        """
        SELECT event_id, date_trunc('second', ts) AS from_s,
               date_trunc('millisecond', ts) AS from_ms, ts AS from_us, ts AS from_ns,
               strftime(ts, '%Y-%m-%dT%H:%M:%S')
                 || CASE WHEN strftime(ts, '%f') = '000000' THEN ''
                         WHEN strftime(ts, '%f') LIKE '%000' THEN '.' || left(strftime(ts, '%f'), 3)
                         ELSE '.' || strftime(ts, '%f') END || '+00:00' AS zoned_text,
               CAST(ts AS DATE) AS from_day
        FROM events
        """,
    ),
    "numeric_as_text": (
        numeric_as_text,
        """
        SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS o_totalprice
        FROM orders
        """,
    ),
    "json_passthrough": (json_passthrough, "SELECT event_id, props FROM events"),
    "array_as_json": (
        array_as_json,
        """
        SELECT l_orderkey,
               '[' || l_orderkey || ',' || l_partkey || ',' || l_linenumber || ']' AS keys,
               '["' || l_returnflag || '","' || l_linestatus || '"]' AS flags
        FROM lineitem
        """,
    ),
    "text_rendering": (
        text_rendering,
        """
        WITH e AS (
          SELECT event_id, event_type, CASE event_type
                   WHEN 'view' THEN date_trunc('second', ts)
                   WHEN 'click' THEN date_trunc('millisecond', ts) ELSE ts END AS t
          FROM events),
        f AS (
          SELECT *, CASE WHEN strftime(t, '%f') = '000000' THEN ''
                         WHEN strftime(t, '%f') LIKE '%000' THEN '.' || left(strftime(t, '%f'), 3)
                         ELSE '.' || strftime(t, '%f') END AS fraction
          FROM e)
        SELECT event_id, strftime(t, '%Y-%m-%d %H:%M:%S') || fraction AS plain,
               strftime(t, '%Y-%m-%dT%H:%M:%S') || fraction || '+00:00' AS zoned,
               strftime(t, '%Y-%m-%d') AS day,
               CASE WHEN event_type = 'view' THEN 'true' ELSE 'false' END AS flag
        FROM f
        """,
    ),
}
