"""Ledger questions, asked of ledgers that Spark derives from the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import history
from tidemark.queries.common import Check, money, table


def _runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run per event: its user is the table, its value the seconds it took."""
    kind = F.col("event_type")
    status = (
        F.when(kind == "click", "succeeded")
        .when(kind == "view", "running")
        .when(kind == "error", "FAILED")
        .when(kind == "purchase", "Pending")
        .otherwise("skipped")
    )
    micros = (money("value") * 1000000).cast("bigint") + F.lit(500)
    finished = F.timestamp_add("MICROSECOND", micros, F.col("ts"))
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("run_id"),
        F.concat(F.lit("t"), F.col("user_id").cast("string")).alias("table_name"),
        F.col("ts").alias("started_at"),
        F.when(kind != "view", finished).alias("finished_at"),
        status.alias("status"),
    )


def _progress_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A progress entry per event; errors clear the table's progress."""
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("t"), F.col("user_id").cast("string")).alias("table_name"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("watermark_value"),
        F.col("event_id").cast("string").alias("cursor_value"),
        F.col("event_id").alias("seq"),
        F.when(F.col("event_type") == "error", "clear").otherwise("set").alias("op"),
    )


def latest_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = history.latest(_progress_log(spark, sf_dir), "table_name")
    return rows.select("table_name", "watermark_value", "cursor_value")


def reset_by_ref(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Progress of tables named after sources and languages, reset by a bare name."""
    names = F.when(F.col("source") == "src3", F.col("lang")).otherwise(
        F.concat_ws(".", "source", "lang")
    )
    progress = table(spark, sf_dir, "documents").groupBy(names.alias("table_name")).agg(
        F.max("doc_id").cast("string").alias("watermark_value")
    )
    return history.reset_by_ref(progress, "en")


def run_durations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.with_durations(_runs(spark, sf_dir)).select("run_id", "status", "duration_ms")


def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.run_summary(_runs(spark, sf_dir))


def run_status_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.run_status_list(_runs(spark, sf_dir))


def recent_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.recent_runs(_runs(spark, sf_dir), 5000)


def runs_by_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.runs_by_status(_runs(spark, sf_dir), "failed")


def last_finished(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.last_finished(_runs(spark, sf_dir))


_RUNS = """
    SELECT event_id AS run_id, 't' || user_id AS table_name, ts AS started_at,
           CASE WHEN event_type <> 'view' THEN ts + to_microseconds(
             CAST(CAST(value AS DECIMAL(18,2)) * 1000000 AS BIGINT) + 500) END AS finished_at,
           CASE event_type WHEN 'click' THEN 'succeeded' WHEN 'view' THEN 'running'
                           WHEN 'error' THEN 'FAILED' WHEN 'purchase' THEN 'Pending'
                           ELSE 'skipped' END AS status
    FROM events
"""
_LATEST = """
    SELECT * FROM runs
    QUALIFY row_number() OVER (PARTITION BY table_name ORDER BY started_at DESC, run_id DESC) = 1
"""

CHECKS: dict[str, Check] = {
    "latest_progress": (
        latest_progress,
        """
        SELECT 't' || user_id AS table_name, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS watermark_value,
               CAST(event_id AS VARCHAR) AS cursor_value
        FROM (SELECT * FROM events
              QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1) e
        WHERE event_type <> 'error'
        """,
    ),
    "reset_by_ref": (
        reset_by_ref,
        """
        SELECT table_name, watermark_value, table_name = 'en' OR table_name LIKE '%.en' AS cleared
        FROM (SELECT CASE WHEN source = 'src3' THEN lang ELSE source || '.' || lang END AS table_name,
                     CAST(max(doc_id) AS VARCHAR) AS watermark_value
              FROM documents GROUP BY 1) p
        """,
    ),
    "run_durations": (
        run_durations,
        f"""
        SELECT run_id, status,
               CAST(round((epoch_us(finished_at) - epoch_us(started_at)) / 1000) AS BIGINT) AS duration_ms
        FROM ({_RUNS}) r
        """,
    ),
    "run_summary": (
        run_summary,
        f"""
        WITH runs AS ({_RUNS}), latest AS ({_LATEST})
        SELECT count(*) FILTER (lower(status) = 'pending') AS pending,
               count(*) FILTER (lower(status) = 'running') AS running,
               count(*) FILTER (lower(status) = 'failed') AS failed,
               count(*) AS total
        FROM latest
        """,
    ),
    "run_status_list": (run_status_list, f"WITH runs AS ({_RUNS}) {_LATEST}"),
    "recent_runs": (
        recent_runs,
        f"SELECT * FROM ({_RUNS}) r ORDER BY started_at DESC, run_id DESC LIMIT 1000",
    ),
    "runs_by_status": (
        runs_by_status,
        f"SELECT * FROM ({_RUNS}) r WHERE lower(status) = 'failed'",
    ),
    "last_finished": (
        last_finished,
        f"SELECT max(finished_at) AS last_finished FROM ({_RUNS}) r",
    ),
}
