"""The ledgers: append-only Parquet logs, read by latest row per key.

Every append goes to a folder of its own, so appends of different tables never
share a staging folder; the folder is named by the append's sequence number, so
the next number comes from a listing. A log lives in epochs; a reset or a compaction starts a
new one, and the highest finished epoch is the current one. One process at a
time may write about a given table.
"""

from __future__ import annotations

import threading
import uuid
from dataclasses import dataclass
from datetime import datetime, timezone
from functools import cache

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.history import latest, matches_ref
from tidemark.operators.increments import Position
from tidemark.sources.files import child_names, path_exists
from tidemark.specs import TableSpec

# The columns of each log. Files written before a column existed
# load with NULL there.
SCHEMAS = {
    "progress": "table_name string, watermark_value string, cursor_value string, "
    "updated_at timestamp, seq bigint, op string, run_id string",
    "intents": "table_name string, run_id string, lo_watermark string, lo_cursor string, "
    "hi_watermark string, hi_cursor string, run_ts timestamp, seq bigint, op string",
    "files": "file_key string, target_table string, rows_ingested bigint, ingested_at timestamp, "
    "modified_at timestamp, commit_id string, seq bigint, op string",
    "runs": "run_id string, table_name string, started_at timestamp, finished_at timestamp, "
    "duration_ms bigint, status string, error string, severity string, metrics_json string, "
    "rows bigint, seq bigint, op string",
    "commits": "table_name string, commit_id string, kind string, folders array<string>, "
    "buckets array<int>, keys array<string>, n_buckets int, schema_json string, "
    "committed_at timestamp, seq bigint, op string, manifest string",
    "zones": "table_name string, watermark_column string, cursor_column string, uri string, "
    "length bigint, modified_at timestamp, first_watermark string, first_cursor string, "
    "last_watermark string, last_cursor string, n_rows bigint, null_keys bigint, "
    "seq bigint, op string",
}


SNAPSHOT = "snapshot"


@cache
def _schema(log: str) -> T.StructType:
    return T._parse_datatype_string(SCHEMAS[log])


@dataclass(frozen=True)
class Intent:
    """A range that a run has set out to write."""

    run_id: str
    run_ts: datetime
    lo: Position | None
    hi: Position | None


def utc_now() -> datetime:
    return datetime.now(timezone.utc)


class Ledger:
    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        self._lock = threading.Lock()

    # logs

    def _epochs(self, log: str) -> list[int]:
        names = child_names(self.spark, f"{self.root}/{log}")
        return sorted(int(n.split("=")[1]) for n in names if n.startswith("epoch="))

    def _epoch_path(self, log: str, epoch: int) -> str:
        return f"{self.root}/{log}/epoch={epoch}"

    def _current_epoch(self, log: str) -> int:
        """Highest epoch whose opening snapshot is complete; 0 needs none."""
        for epoch in reversed(self._epochs(log)):
            path = self._epoch_path(log, epoch)
            done = [n for n in child_names(self.spark, path) if n.endswith(SNAPSHOT)]
            if epoch == 0 or any(path_exists(self.spark, f"{path}/{n}/_SUCCESS") for n in done):
                return epoch
        return 0

    def read(self, log: str) -> DataFrame:
        """All rows of the current epoch of a log."""
        schema = _schema(log)
        path = self._epoch_path(log, self._current_epoch(log))
        if not path_exists(self.spark, path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(path)

    def next_seq(self, log: str) -> int:
        """One more than any append of the current epoch, a failed one included."""
        names = child_names(self.spark, self._epoch_path(log, self._current_epoch(log)))
        numbers = [n.split("-")[0] for n in names]
        return 1 + max((int(n) for n in numbers if n.isdigit()), default=0)

    def _last(self, log: str, table: str, where: str = "true"):
        """Last row about a table, or None."""
        rows = self.read(log).where(F.col("table_name") == table).where(where)
        return rows.orderBy(F.desc("seq")).first()

    def append(self, log: str, rows: DataFrame, *watched: Column) -> dict:
        """Add rows; the sequence number is set here, one per append.

        Returns the watched aggregates of the rows, from the same pass.
        """
        with self._lock:
            seq = self.next_seq(log)
            path = self._epoch_path(log, self._current_epoch(log))
            schema = _schema(log)
            out = rows.withColumn("seq", F.lit(seq)).select(
                *[
                    (F.col(f.name) if f.name in (*rows.columns, "seq") else F.lit(None))
                    .cast(f.dataType)
                    .alias(f.name)
                    for f in schema.fields
                ]
            )
            seen = Observation()
            if watched:
                out = out.observe(seen, *watched)
            # One small file per append; batches of files are bounded upstream.
            out.coalesce(1).write.parquet(f"{path}/{seq:012d}-{uuid.uuid4().hex}")
            return seen.get if watched else {}

    def append_row(self, log: str, **values: object) -> None:
        schema = _schema(log)
        fields = [f for f in schema.fields if f.name in values]
        columns = [F.lit(values[f.name]).cast(f.dataType).alias(f.name) for f in fields]
        self.append(log, self.spark.range(0, 1, 1, 1).select(*columns))

    def _start_epoch(self, log: str, rows: DataFrame) -> None:
        epoch, seq = max(self._epochs(log), default=0) + 1, self.next_seq(log)
        rows.write.parquet(f"{self._epoch_path(log, epoch)}/{seq:012d}-{SNAPSHOT}")

    def compact(self) -> None:
        """Rewrite all logs to what still counts, in new epochs; no load may run beside.

        Loaded files let go of their commits first, so that commits a later
        replacement has made void can be dropped.
        """
        self._start_epoch("files", self.files().withColumn("commit_id", F.lit(None).cast("string")))
        ended = self.read("progress").select("run_id").where("run_id IS NOT NULL").distinct()
        intents = latest(self.read("intents"), "table_name")
        self._start_epoch("intents", intents.join(ended, "run_id", "left_anti"))
        self._start_epoch("progress", self.progress())
        self._start_epoch("runs", latest(self.read("runs"), "run_id"))
        commits = self.read("commits")
        start = commits.where("kind IN ('create', 'replace')").groupBy("table_name").agg(
            F.max("seq").alias("start")
        )
        live = commits.join(start, "table_name").where("seq >= start").drop("start")
        self._start_epoch("commits", live)
        # Of a file only its latest version counts.
        zones = self.read("zones")
        file = ("table_name", "watermark_column", "cursor_column", "uri")
        values = [c for c in zones.columns if c not in file]
        last = zones.groupBy(*file).agg(F.max_by(F.struct(*values), "seq").alias("last"))
        self._start_epoch("zones", last.select(*file, "last.*"))

    # progress

    def progress(self) -> DataFrame:
        """Live progress, one row per table; full copies leave it alone."""
        return latest(self.read("progress").where("op <> 'done'"), "table_name")

    def get_progress(self, table: str) -> Position | None:
        row = self._last("progress", table, "op <> 'done'")
        if row is None or row["op"] == "clear":
            return None
        return Position(row["watermark_value"], row["cursor_value"])

    def set_progress(self, table: str, position: Position, run_id: str | None = None) -> None:
        self.append_row(
            "progress",
            table_name=table,
            watermark_value=position.watermark,
            cursor_value=position.cursor,
            updated_at=utc_now(),
            op="set",
            run_id=run_id,
        )

    def finish(self, table: str, intent: Intent) -> None:
        """Mark an intent as done and save where it ended, in one row."""
        self.append_row(
            "progress",
            table_name=table,
            watermark_value=intent.hi.watermark if intent.hi else None,
            cursor_value=intent.hi.cursor if intent.hi else None,
            updated_at=utc_now(),
            op="set" if intent.hi else "done",
            run_id=intent.run_id,
        )

    def _clear(self, names: DataFrame) -> None:
        gone = names.select("table_name", F.lit("clear").alias("op"))
        self.append("progress", gone.withColumn("updated_at", F.lit(utc_now())))
        self.append("intents", gone)

    def clear_progress(self, table: str) -> None:
        """Forget one table, an unfinished intent included."""
        self._clear(self.spark.createDataFrame([(table,)], "table_name string"))

    def clear_progress_by_ref(self, ref: str) -> int:
        """Forget the tables a reference means; returns how many were known."""
        names = self.progress().where(matches_ref(F.col("table_name"), ref)).select("table_name")
        found = names.count()
        if found:
            self._clear(names)
        return found

    def clear_all_progress(self) -> None:
        """Forget all tables; the ledger of loaded files stays."""
        names = self.progress().select("table_name")
        if not names.isEmpty():
            self._clear(names)

    def reset(self) -> None:
        """Forget progress and loaded files both, ahead of a run."""
        for log in ("progress", "intents", "files"):
            self._start_epoch(log, self.spark.createDataFrame([], _schema(log)))

    # intents

    def pending_intent(self, table: str) -> Intent | None:
        """The last intent of a table if its run did not finish."""
        row = self._last("intents", table)
        if row is None or row["op"] != "intent":
            return None
        ends = self.read("progress").where(F.col("run_id") == row["run_id"])
        if not ends.isEmpty():
            return None
        lo, hi = (
            Position(row[f"{end}_watermark"], row[f"{end}_cursor"])
            if row[f"{end}_watermark"] is not None
            else None
            for end in ("lo", "hi")
        )
        return Intent(row["run_id"], row["run_ts"].astimezone(timezone.utc), lo, hi)

    def start_intent(self, table: str, intent: Intent) -> None:
        self.append_row(
            "intents",
            table_name=table,
            run_id=intent.run_id,
            lo_watermark=intent.lo.watermark if intent.lo else None,
            lo_cursor=intent.lo.cursor if intent.lo else None,
            hi_watermark=intent.hi.watermark if intent.hi else None,
            hi_cursor=intent.hi.cursor if intent.hi else None,
            run_ts=intent.run_ts,
            op="intent",
        )

    # files

    def files(self) -> DataFrame:
        """Files that count as loaded, latest row per key.

        A row that names a commit counts once that commit is in the log.
        """
        log = self.read("files")
        done = self.read("commits").select("commit_id").distinct()
        free = log.where(F.col("commit_id").isNull())
        tied = log.where(F.col("commit_id").isNotNull()).join(done, "commit_id", "left_semi")
        return latest(free.unionByName(tied), "file_key")

    def is_file_ingested(self, key: str) -> bool:
        return not self.files().where(F.col("file_key") == key).isEmpty()

    def mark_files(self, rows: DataFrame) -> dict:
        """Record files: ``file_key, target_table, rows_ingested`` and more.

        Returns how many files and rows there were and the last file key.
        """
        marked = rows.withColumn("ingested_at", F.lit(utc_now())).withColumn("op", F.lit("set"))
        return self.append(
            "files",
            marked,
            F.count(F.lit(1)).alias("files"),
            F.coalesce(F.sum("rows_ingested"), F.lit(0)).alias("rows"),
            F.max("file_key").alias("last"),
        )

    def mark_file(self, key: str, table: str, rows: int) -> None:
        row = self.spark.createDataFrame(
            [(key, table, rows)], "file_key string, target_table string, rows_ingested bigint"
        )
        self.mark_files(row)

    # zones

    def zones(self, spec: TableSpec) -> DataFrame:
        """Zone map of a table for its present key columns, one entry for each file version."""
        log = self.read("zones").where(
            (F.col("table_name") == spec.qualified_name)
            & (F.col("watermark_column") == spec.watermark)
            & F.col("cursor_column").eqNullSafe(spec.cursor)
        )
        return log.dropDuplicates(["uri", "length", "modified_at"])

    def mark_zones(self, spec: TableSpec, entries: DataFrame) -> None:
        named = {"table_name": spec.qualified_name, "watermark_column": spec.watermark, "cursor_column": spec.cursor, "op": "set"}
        self.append("zones", entries.withColumns({k: F.lit(v) for k, v in named.items()}))

    # runs

    def runs(self) -> DataFrame:
        """Run history, one row per run."""
        return latest(self.read("runs"), "run_id").drop("seq", "op")

    def start_run(self, run_id: str, table: str, started_at: datetime) -> None:
        self.append_row(
            "runs", run_id=run_id, table_name=table, started_at=started_at, status="running", op="set"
        )

    def finish_run(
        self,
        run_id: str,
        table: str,
        started_at: datetime,
        status: str,
        rows: int | None = None,
        error: str | None = None,
        severity: str | None = None,
        metrics_json: str | None = None,
    ) -> None:
        finished = utc_now()
        self.append_row(
            "runs",
            run_id=run_id,
            table_name=table,
            started_at=started_at,
            finished_at=finished,
            duration_ms=round((finished - started_at).total_seconds() * 1000),
            status=status,
            error=error,
            severity=severity,
            metrics_json=metrics_json,
            rows=rows,
            op="set",
        )

    # commits

    def last_commit(self, table: str):
        """The last commit of a target table, or None."""
        return self._last("commits", table)

    def commits(self, table: str) -> list:
        """Commits of one target table in order, from its last replacement on."""
        found = self.read("commits").where(F.col("table_name") == table)
        rows = sorted(found.collect(), key=lambda r: r["seq"])
        starts = [i for i, r in enumerate(rows) if r["kind"] in ("create", "replace")]
        return rows[starts[-1]:] if starts else []

    def is_committed(self, commit_id: str) -> bool:
        return not self.read("commits").where(F.col("commit_id") == commit_id).isEmpty()

