"""Extracts: full copies, slices after a saved position, positions themselves."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.literals import fits, parse_as
from tidemark.operators import increments, splits
from tidemark.operators.increments import Position
from tidemark.plans.sync import Sync, snapshot
from tidemark.queries.common import Check, money, table
from tidemark.session import scratch_dir
from tidemark.sinks.ledger import Ledger
from tidemark.sinks.parquet import read_output
from tidemark.sources.zoned import ZonedSource
from tidemark.specs import Location, SyncSpec, TableSpec

ORDERS = TableSpec(
    "orders", incremental_column="o_orderdate", incremental_tiebreaker_column="o_orderkey"
)
EVENTS = TableSpec("events", incremental_column="ts", incremental_column_is_unique=True)
SAVED_ORDER = Position("1998-01-01 00:00:00.000000", "5000")
LATER_ORDER = Position("2000-06-30 00:00:00.000000", "9000")
SAVED_EVENT = Position("2024-01-15 12:00:00.000000")


def full_sync_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    types = {"l_linenumber": "smallint", "l_shipdate": "date", "l_returnflag": "char"}
    return snapshot(lines, TableSpec("lineitem"), types)


def projected_sync(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = TableSpec("lineitem", columns=("l_extendedprice", "l_orderkey", "no_such_column"))
    return snapshot(table(spark, sf_dir, "lineitem"), spec)


def first_increment(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return increments.in_order(increments.increment(events, EVENTS), EVENTS)


def watermark_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshot(table(spark, sf_dir, "events"), EVENTS, lo=SAVED_EVENT)


def keyset_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshot(table(spark, sf_dir, "orders"), ORDERS, lo=SAVED_ORDER)


def keyset_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshot(table(spark, sf_dir, "orders"), ORDERS, lo=SAVED_ORDER, hi=LATER_ORDER)


def bounded_increment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return increments.first_rows(table(spark, sf_dir, "orders"), ORDERS, SAVED_ORDER, 1000)


def high_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return increments.high_watermark(table(spark, sf_dir, "orders"), ORDERS)


def null_key_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders whose date is unknown while pending, and whose key is while open."""
    orders = table(spark, sf_dir, "orders").select(
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate")).alias("o_orderdate"),
        F.when(F.col("o_orderstatus") != "O", F.col("o_orderkey")).alias("o_orderkey"),
    )
    return increments.null_key_rows(orders, ORDERS, SAVED_ORDER)


def progress_literals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values of every order saved as text and read back as typed values."""
    orders = table(spark, sf_dir, "orders")
    text = orders.select(
        "o_orderkey",
        F.col("o_custkey").cast("string").alias("key_text"),
        money("o_totalprice").cast("string").alias("price_text"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("time_text"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("date_text"),
        (F.col("o_orderstatus") == "O").cast("string").alias("flag_text"),
        "o_orderpriority",
    )
    wanted = {
        "key_text": T.LongType(),
        "price_text": T.DoubleType(),
        "time_text": T.TimestampNTZType(),
        "date_text": T.DateType(),
        "flag_text": T.BooleanType(),
        "o_orderpriority": T.IntegerType(),
    }
    return text.select(
        "o_orderkey", *[parse_as(F.col(c), t).alias(f"{c}_value") for c, t in wanted.items()]
    )


def stale_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which column types a saved text still fits, for a text of every event."""
    kind = F.col("event_type")
    saved = (
        F.when(kind == "click", F.col("event_id").cast("string"))
        .when(kind == "view", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
        .when(kind == "error", F.concat(F.lit("v"), F.col("user_id").cast("string")))
        .when(kind == "purchase", money("value").cast("string"))
        .otherwise(F.date_format("ts", "yyyy-MM-dd"))
    )
    rows = table(spark, sf_dir, "events").select("event_id", saved.alias("saved"))
    wanted = {
        "bigint": T.LongType(),
        "double": T.DoubleType(),
        "timestamp": T.TimestampNTZType(),
        "date": T.DateType(),
        "boolean": T.BooleanType(),
        "text": T.StringType(),
        "missing": None,
    }
    flags = [fits(F.col("saved"), t).alias(f"fits_{n}") for n, t in wanted.items()]
    uuid = fits(F.col("saved"), T.StringType(), "uuid").alias("fits_uuid")
    return rows.select("event_id", "saved", *flags, uuid)


def incremental_sync_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs over a table that grows in between; together they hold it once."""
    orders = table(spark, sf_dir, "orders")
    root = scratch_dir(spark, "sync")
    ledger = Ledger(spark, f"{root}/ledger")
    plan = SyncSpec(output=Location(path=f"{root}/out"), tables=(ORDERS,))
    early = increments.increment(orders, ORDERS, hi=SAVED_ORDER)
    for seen in (early, orders):
        Sync(spark, plan, lambda _, seen=seen: seen, ledger).run()
    return read_output(spark, plan.output.uri, ORDERS)


def pruned_increment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders in many files, a second lot coming between two runs, by zone map."""
    orders = table(spark, sf_dir, "orders")
    root = scratch_dir(spark, "zones")
    ledger = Ledger(spark, f"{root}/ledger")
    plan = SyncSpec(output=Location(path=f"{root}/out"), tables=(ORDERS,))
    middle = increments.after(orders.schema, ORDERS, SAVED_ORDER)
    for lot in (orders.where(~middle), orders.where(middle)):
        lot.repartitionByRange(8, "o_orderdate").write.mode("append").parquet(f"{root}/in/orders.parquet")
        Sync(spark, plan, ZonedSource(spark, f"{root}/in", ledger), ledger).run()
    return read_output(spark, plan.output.uri, ORDERS)


# Ranges that a table is cut into.
PARTS = 16


def split_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranges of equal width of two tables with their exact rows, one key with NULLs."""
    plans = []
    for name, column in (("orders", "o_orderkey"), ("lineitem", "l_orderkey"), ("events", "user_id")):
        key = F.col(column)
        rows = table(spark, sf_dir, name).select((F.when(key % 7 != 0, key) if name == "events" else key).alias(column))
        found = splits.ranges_of_equal_width(rows, column, PARTS)
        plans.append(splits.rows_per_range(rows, found).select(F.lit(name).alias("table_name"), "*"))
    return reduce(DataFrame.unionByName, plans)


def split_depths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranges of equal depth: all rows once, and none with over an eighth more than its share."""
    plans = []
    for name, column in (("orders", "o_orderkey"), ("lineitem", "l_shipdate"), ("lineitem", "l_orderkey")):
        rows = table(spark, sf_dir, name).select(column)
        counted = splits.rows_per_range(rows, splits.ranges_of_equal_depth(rows, column, PARTS))
        total = F.sum("n_rows")
        even = F.max("n_rows") * PARTS * 8 <= total * 9
        plans.append(counted.agg(total.alias("rows"), even.alias("even")).select(F.lit(name).alias("table_name"), F.lit(column).alias("column"), "*"))
    return reduce(DataFrame.unionByName, plans)


def _widths(name: str, value: str) -> str:
    """Ranges between the distinct bounds of equal width, counted one by one."""
    return f"""
        SELECT '{name}' AS table_name, part::INTEGER AS part, lo::VARCHAR AS lower_bound, hi::VARCHAR AS upper_bound,
               count(v) FILTER ((lo IS NULL OR v >= lo) AND (hi IS NULL OR v < hi)) AS n_rows
        FROM (
            SELECT row_number() OVER (ORDER BY lo NULLS FIRST) - 1 AS part, lo, lead(lo) OVER (ORDER BY lo NULLS FIRST) AS hi
            FROM (
                SELECT DISTINCT CASE WHEN width * i // {PARTS} > 0 THEN least + width * i // {PARTS} END AS lo
                FROM (SELECT min({value}) AS least, max({value}) - min({value}) + 1 AS width FROM {name}), range({PARTS}) t(i)
            )
        ), (SELECT {value} AS v FROM {name})
        GROUP BY ALL
        UNION ALL
        SELECT '{name}', (
            SELECT count(DISTINCT width * i // {PARTS})
            FROM (SELECT max({value}) - min({value}) + 1 AS width FROM {name}), range({PARTS}) t(i)
        )::INTEGER, NULL, NULL, count(*) FILTER ({value} IS NULL) FROM {name}
    """


CHECKS: dict[str, Check] = {
    "full_sync_snapshot": (
        full_sync_snapshot,
        """
        SELECT l_orderkey, l_partkey, l_suppkey, CAST(l_linenumber AS SMALLINT) AS l_linenumber,
               l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus,
               CAST(l_shipdate AS DATE) AS l_shipdate
        FROM lineitem
        """,
    ),
    "projected_sync": (projected_sync, "SELECT l_orderkey, l_extendedprice FROM lineitem"),
    "first_increment": (first_increment, "SELECT * FROM events ORDER BY ts"),
    "watermark_slice": (
        watermark_slice,
        "SELECT * FROM events WHERE ts > TIMESTAMP '2024-01-15 12:00:00'",
    ),
    "keyset_slice": (
        keyset_slice,
        """
        SELECT * FROM orders
        WHERE o_orderdate > TIMESTAMP '1998-01-01'
           OR (o_orderdate = TIMESTAMP '1998-01-01' AND o_orderkey > 5000)
        """,
    ),
    "keyset_range": (
        keyset_range,
        """
        SELECT * FROM orders
        WHERE (o_orderdate > TIMESTAMP '1998-01-01'
               OR (o_orderdate = TIMESTAMP '1998-01-01' AND o_orderkey > 5000))
          AND (o_orderdate < TIMESTAMP '2000-06-30'
               OR (o_orderdate = TIMESTAMP '2000-06-30' AND o_orderkey <= 9000))
        """,
    ),
    "bounded_increment": (
        bounded_increment,
        """
        SELECT * FROM orders
        WHERE o_orderdate > TIMESTAMP '1998-01-01'
           OR (o_orderdate = TIMESTAMP '1998-01-01' AND o_orderkey > 5000)
        ORDER BY o_orderdate, o_orderkey LIMIT 1000
        """,
    ),
    "high_watermark": (
        high_watermark,
        """
        SELECT strftime(o_orderdate, '%Y-%m-%d %H:%M:%S.%f') AS watermark_value,
               CAST(o_orderkey AS VARCHAR) AS cursor_value
        FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 1
        """,
    ),
    "null_key_rows": (
        null_key_rows,
        """
        WITH o AS (
          SELECT CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END AS wm,
                 CASE WHEN o_orderstatus <> 'O' THEN o_orderkey END AS cur
          FROM orders)
        SELECT count(*) FILTER (wm IS NULL) AS null_watermarks,
               count(*) FILTER (cur IS NULL) AS null_cursors,
               count(*) AS null_key_rows
        FROM o WHERE wm IS NULL OR (cur IS NULL AND wm >= TIMESTAMP '1998-01-01')
        """,
    ),
    "progress_literals": (
        progress_literals,
        """
        SELECT o_orderkey, o_custkey AS key_text_value,
               CAST(CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS DOUBLE) AS price_text_value,
               o_orderdate AS time_text_value, CAST(o_orderdate AS DATE) AS date_text_value,
               o_orderstatus = 'O' AS flag_text_value,
               CAST(NULL AS INTEGER) AS o_orderpriority_value
        FROM orders
        """,
    ),
    "stale_progress": (
        stale_progress,
        r"""
        WITH s AS (
          SELECT event_id, CASE event_type
              WHEN 'click' THEN CAST(event_id AS VARCHAR)
              WHEN 'view' THEN strftime(ts, '%Y-%m-%d %H:%M:%S.%f')
              WHEN 'error' THEN 'v' || CAST(user_id AS VARCHAR)
              WHEN 'purchase' THEN CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR)
              ELSE strftime(ts, '%Y-%m-%d') END AS saved
          FROM events)
        SELECT event_id, saved,
               regexp_matches(saved, '^[+-]?\d+$') AND try_cast(saved AS BIGINT) IS NOT NULL
                 AS fits_bigint,
               try_cast(saved AS DOUBLE) IS NOT NULL AS fits_double,
               contains(saved, ' ') AND try_cast(saved AS TIMESTAMP) IS NOT NULL AS fits_timestamp,
               NOT contains(saved, ' ') AND try_cast(saved AS DATE) IS NOT NULL AS fits_date,
               lower(saved) IN ('true', 'false') AS fits_boolean,
               saved IS NOT NULL AS fits_text,
               FALSE AS fits_missing,
               try_cast(saved AS UUID) IS NOT NULL AS fits_uuid
        FROM s
        """,
    ),
    "incremental_sync_runs": (incremental_sync_runs, "SELECT * FROM orders"),
    "split_plan": (
        split_plan,
        " UNION ALL ".join(
            _widths(*t)
            for t in (
                ("orders", "o_orderkey"),
                ("lineitem", "l_orderkey"),
                ("events", "CASE WHEN user_id % 7 <> 0 THEN user_id END"),
            )
        ),
    ),
    "split_depths": (
        split_depths,
        """
        SELECT 'orders' AS table_name, 'o_orderkey' AS "column", count(*) AS rows, true AS even FROM orders
        UNION ALL SELECT 'lineitem', 'l_shipdate', count(*), true FROM lineitem
        UNION ALL SELECT 'lineitem', 'l_orderkey', count(*), true FROM lineitem
        """,
    ),
    "pruned_increment": (pruned_increment, "SELECT * FROM orders"),
}
