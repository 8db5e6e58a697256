"""Inserts, upserts and replacements of whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import merge
from tidemark.queries.common import Check, table

ORDER_OF_ORDERS = ("o_orderdate", "o_orderkey")


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")


def _order_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch from all orders: many rows per key, half of the keys new."""
    return table(spark, sf_dir, "orders").select(
        (F.col("o_custkey") * 2).alias("c_custkey"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("c_acctbal"),
        F.col("o_orderpriority").alias("c_mktsegment"),
        *ORDER_OF_ORDERS,
    )


def upsert_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    batch = _order_batch(spark, sf_dir)
    return merge.upsert(_customers(spark, sf_dir), batch, ["c_custkey"], ORDER_OF_ORDERS)


def upsert_some_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch has no segment: known keys keep theirs, new keys get NULL."""
    batch = _order_batch(spark, sf_dir).drop("c_mktsegment")
    return merge.upsert(_customers(spark, sf_dir), batch, ["c_custkey"], ORDER_OF_ORDERS)


def upsert_composite_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    batch = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("conv_id"),
        F.lit(0).cast("bigint").alias("turn"),
        F.col("lang").alias("role"),
        "text",
    )
    return merge.upsert(turns, batch, ["conv_id", "turn"])


def upsert_do_nothing(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = table(spark, sf_dir, "orders").select("o_orderkey")
    batch = table(spark, sf_dir, "lineitem").select((F.col("l_orderkey") * 3).alias("o_orderkey"))
    return merge.upsert(known, batch, ["o_orderkey"])


def duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


def last_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last order of every customer."""
    return merge.last_per_key(table(spark, sf_dir, "orders"), ["o_custkey"], ORDER_OF_ORDERS)


def ingest_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers appended to customers; the column they lack is NULL."""
    batch = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("c_custkey"), F.col("s_acctbal").alias("c_acctbal")
    )
    return merge.insert(_customers(spark, sf_dir), batch)


def _document_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        "doc_id", "lang", F.concat_ws("/", "source", "lang").alias("file_key"), "text"
    )


def truncate_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.truncate_insert(
        _document_batch(spark, sf_dir), ["doc_id", "lang", "text", "file_key"]
    )


def truncate_insert_per_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.truncate_insert(
        _document_batch(spark, sf_dir), ["doc_id", "lang", "text"], file_column="file_key"
    )


_LAST_ORDER = """
    SELECT o_custkey * 2 AS c_custkey,
           CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS c_acctbal,
           o_orderpriority AS c_mktsegment
    FROM orders
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1
"""

CHECKS: dict[str, Check] = {
    "upsert_update": (
        upsert_update,
        f"""
        WITH batch AS ({_LAST_ORDER})
        SELECT c_custkey, c_acctbal, c_mktsegment FROM batch
        UNION ALL
        SELECT c_custkey, c_acctbal, c_mktsegment FROM customer
        WHERE c_custkey NOT IN (SELECT c_custkey FROM batch)
        """,
    ),
    "upsert_some_columns": (
        upsert_some_columns,
        f"""
        WITH batch AS ({_LAST_ORDER})
        SELECT coalesce(c.c_custkey, b.c_custkey) AS c_custkey,
               CASE WHEN b.c_custkey IS NOT NULL THEN b.c_acctbal ELSE c.c_acctbal END AS c_acctbal,
               c.c_mktsegment AS c_mktsegment
        FROM customer c FULL JOIN batch b ON c.c_custkey = b.c_custkey
        """,
    ),
    "upsert_composite_key": (
        upsert_composite_key,
        """
        SELECT doc_id AS conv_id, CAST(0 AS BIGINT) AS turn, lang AS role, text FROM documents
        UNION ALL
        SELECT conv_id, turn, role, text FROM conversations
        WHERE NOT (turn = 0 AND conv_id IN (SELECT doc_id FROM documents))
        """,
    ),
    "upsert_do_nothing": (
        upsert_do_nothing,
        "SELECT o_orderkey FROM orders UNION SELECT l_orderkey * 3 FROM lineitem",
    ),
    "duplicate_keys": (
        duplicate_keys,
        """
        SELECT l_orderkey, l_linenumber, count(*) AS occurrences
        FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1
        """,
    ),
    "last_per_key": (
        last_per_key,
        """
        SELECT o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders
        QUALIFY row_number() OVER (
          PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1
        """,
    ),
    "ingest_insert": (
        ingest_insert,
        """
        SELECT c_custkey, c_acctbal, c_mktsegment FROM customer
        UNION ALL SELECT s_suppkey, s_acctbal, NULL FROM supplier
        """,
    ),
    "truncate_insert": (
        truncate_insert,
        "SELECT doc_id, lang, text, source || '/' || lang AS file_key FROM documents",
    ),
    "truncate_insert_per_file": (
        truncate_insert_per_file,
        """
        SELECT doc_id, lang, text FROM documents
        WHERE source || '/' || lang = (SELECT max(source || '/' || lang) FROM documents)
        """,
    ),
}
