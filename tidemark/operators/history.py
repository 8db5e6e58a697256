"""Questions to the ledgers: progress, loaded files and past runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RUN_LIMIT_DEFAULT, RUN_LIMIT_MOST = 50, 1000


def latest(log: DataFrame, key: str, live_only: bool = True) -> DataFrame:
    """Latest row of every key of an append-only log; cleared keys drop out."""
    values = [c for c in log.columns if c != key]
    last = F.max_by(F.struct(*[F.col(f"`{c}`") for c in values]), F.col("seq"))
    rows = log.groupBy(key).agg(last.alias("_last")).select(key, "_last.*")
    return rows.where(F.col("op") != "clear") if live_only else rows


def unseen_files(files: DataFrame, ledger: DataFrame, track_changes: bool = False) -> DataFrame:
    """Files the ledger does not hold yet.

    With ``track_changes`` a file counts as seen only in the version that was
    loaded, so a rewritten file is read again.
    """
    keys = ["file_key", "modified_at"] if track_changes else ["file_key"]
    return files.join(ledger.select(*keys).distinct(), keys, "left_anti")


def matches_ref(name: Column, ref: str) -> Column:
    """Names a reset reference means: itself, and for a bare name any schema's."""
    exact = name == F.lit(ref)
    return exact if "." in ref else exact | name.endswith("." + ref)


def reset_by_ref(progress: DataFrame, ref: str) -> DataFrame:
    """Progress rows with a flag for those a reset by reference clears."""
    return progress.withColumn("cleared", matches_ref(F.col("table_name"), ref))


def duration_ms(started: Column, finished: Column) -> Column:
    """Run time in whole milliseconds, rounded; NULL while running.

    Exact for zoned and zone-free timestamps alike.
    """
    micros = F.timestamp_diff("MICROSECOND", started, finished)
    return F.round(micros / F.lit(1000)).cast("bigint")


def with_durations(runs: DataFrame) -> DataFrame:
    return runs.withColumn("duration_ms", duration_ms(F.col("started_at"), F.col("finished_at")))


def latest_runs(runs: DataFrame) -> DataFrame:
    """Latest run of every table by start; the run id breaks ties."""
    values = [c for c in runs.columns if c != "table_name"]
    last = F.max_by(
        F.struct(*[F.col(f"`{c}`") for c in values]), F.struct("started_at", "run_id")
    )
    return runs.groupBy("table_name").agg(last.alias("_last")).select("table_name", "_last.*")


def run_status_list(runs: DataFrame) -> DataFrame:
    """Latest run per table by finish time, unfinished ones last."""
    return latest_runs(runs).orderBy(F.col("finished_at").asc_nulls_last(), "table_name")


def run_summary(runs: DataFrame) -> DataFrame:
    """Tables by the status of their latest run; other statuses count in total only."""
    status = F.lower("status")
    return latest_runs(runs.select("table_name", "run_id", "started_at", "status")).agg(
        *[F.count_if(status == s).alias(s) for s in ("pending", "running", "failed")],
        F.count(F.lit(1)).alias("total"),
    )


def recent_runs(runs: DataFrame, limit: int | None = None) -> DataFrame:
    """Latest runs first, 50 unless asked otherwise, 1 to 1000."""
    n = RUN_LIMIT_DEFAULT if limit is None else max(1, min(limit, RUN_LIMIT_MOST))
    return runs.orderBy(F.col("started_at").desc(), F.col("run_id").desc()).limit(n)


def runs_by_status(runs: DataFrame, status: str | None) -> DataFrame:
    """Runs of one status, in any letter case; all runs without one."""
    return runs if status is None else runs.where(F.lower("status") == status.lower())


def last_finished(runs: DataFrame) -> DataFrame:
    return runs.agg(F.max("finished_at").alias("last_finished"))
