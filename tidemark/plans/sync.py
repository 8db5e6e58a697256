"""Extracting tables: full copies and increments, one table or many."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.contracts import to_lake
from tidemark.operators import increments, quality
from tidemark.operators.increments import Frontier, Position
from tidemark.session import configure
from tidemark.sinks import parquet
from tidemark.sinks.ledger import Intent, Ledger, utc_now
from tidemark.sinks.tables import append_table
from tidemark.sources.files import apply_hadoop_options, delete_except
from tidemark.sources.tables import MissingTable, Source, project, resolve_tables
from tidemark.sources.zoned import ZonedSource
from tidemark.specs import SyncSpec, TableSpec, check_incremental


class SyncFailed(RuntimeError):
    """Some tables of a run failed; the others are done."""

    def __init__(self, failures: Sequence[tuple[str, BaseException]]) -> None:
        self.failures = list(failures)
        text = " | ".join(f"{name}: {error}" for name, error in failures)
        super().__init__(f"sync failed for {len(self.failures)} table(s): {text}")


@dataclass(frozen=True)
class SyncOutcome:
    table: str
    rows: int
    position: Position | None
    path: str | None
    skipped: bool = False


def snapshot(
    df: DataFrame,
    spec: TableSpec,
    source_types: Mapping[str, str] | None = None,
    lo: Position | None = None,
    hi: Position | None = None,
) -> DataFrame:
    """Rows of a table, or of an increment of it, in lake types.

    The range is cut on the source's own columns, before any cast, so that it
    reaches the scan.
    """
    rows = increments.increment(project(df, spec.columns), spec, lo, hi)
    types = {k: v for k, v in (source_types or {}).items() if k in rows.columns}
    return to_lake(rows, types)


def open_table(source: Source, spec: TableSpec) -> DataFrame:
    """The selected columns of a source table; missing tables raise."""
    df = project(source(spec), spec.columns)
    if not df.columns:
        raise MissingTable(
            f"{spec.full_name} has no visible columns: it is missing or may not be read"
        )
    return df


class Sync:
    """Runs sync specs against a source and keeps their progress in a ledger."""

    def __init__(
        self,
        spark: SparkSession,
        spec: SyncSpec,
        source: Source,
        ledger: Ledger,
        source_types: Mapping[str, Mapping[str, str]] | None = None,
        rules: Mapping[str, Mapping[str, tuple[str, str]]] | None = None,
        relational: Source | None = None,
    ) -> None:
        """``relational`` is a source that can compute maxima by itself, for positions."""
        self.spark, self.spec, self.source, self.ledger = configure(spark), spec, source, ledger
        self.source_types = dict(source_types or {})
        self.rules = dict(rules or {})
        self.relational = relational
        if spec.output is not None:
            apply_hadoop_options(spark, spec.output)

    # many tables

    def tables(self, listing: DataFrame | None = None) -> list[TableSpec]:
        """The named tables, or those discovered in the schema."""
        if self.spec.tables is not None:
            return list(self.spec.tables)
        if listing is None:
            raise MissingTable("no tables are named and no listing is given to discover them")
        found = resolve_tables(listing, self.spec.schema, self.spec.exclude)
        # One name per table of one schema.
        return [TableSpec(r["table_name"], self.spec.schema) for r in found.toLocalIterator()]

    def run(
        self,
        listing: DataFrame | None = None,
        run_ts: datetime | None = None,
        concurrency: int = 4,
    ) -> list[SyncOutcome]:
        """Sync all tables; a failing one does not stop the others.

        Tables run side by side so that small ones fill the gaps large ones leave.
        """
        run_ts = run_ts or utc_now()
        tables = self.tables(listing)
        outcomes: list[SyncOutcome] = []
        failures: list[tuple[str, BaseException]] = []
        with ThreadPoolExecutor(max_workers=max(1, concurrency)) as pool:
            jobs = [(t, pool.submit(self.sync_table, t, run_ts)) for t in tables]
            for table, job in jobs:
                try:
                    outcomes.append(job.result())
                except Exception as error:  # noqa: BLE001 - reported together below
                    failures.append((table.full_name, error))
        if failures:
            raise SyncFailed(failures)
        return outcomes

    # one table

    def sync_table(self, spec: TableSpec, run_ts: datetime | None = None) -> SyncOutcome:
        started, run_id = utc_now(), uuid.uuid4().hex
        run_ts = run_ts or started
        name = spec.qualified_name
        self.ledger.start_run(run_id, name, started)
        try:
            outcome = self._sync(spec, run_id, run_ts)
            severity, metrics = self._grade(spec, outcome)
        except Exception as error:
            self.ledger.finish_run(run_id, name, started, "failed", error=str(error))
            raise
        self.ledger.finish_run(
            run_id,
            name,
            started,
            "skipped" if outcome.skipped else "succeeded",
            rows=outcome.rows,
            severity=severity,
            metrics_json=metrics,
        )
        return outcome

    def _sync(self, spec: TableSpec, run_id: str, run_ts: datetime) -> SyncOutcome:
        name = spec.qualified_name
        try:
            df = open_table(self.source, spec)
        except MissingTable:
            if self.spec.tables is not None:
                raise
            return SyncOutcome(name, 0, None, None, skipped=True)
        check_incremental(spec, df.columns)
        intent = self.ledger.pending_intent(name)
        if intent is None:
            lo = self._saved(df, spec)
            hi = None
            if spec.watermark is not None:
                end = self._frontier(df, spec, lo)  # frozen: later rows wait for the next run
                increments.guard_null_keys(spec, end.null_keys, self.spec.null_keys)
                hi = end.position
                if hi is None:
                    return SyncOutcome(name, 0, lo, None)
            elif df.isEmpty():
                return SyncOutcome(name, 0, None, None)
            intent = Intent(run_id, run_ts, lo, hi)
            self.ledger.start_intent(name, intent)
        return self._write(df, spec, intent)

    def _saved(self, df: DataFrame, spec: TableSpec) -> Position | None:
        """Saved progress; a value that no longer fits its column is cleared."""
        if spec.watermark is None:
            return None
        saved = self.ledger.get_progress(spec.qualified_name)
        increments.check_position(spec, saved)
        if saved is not None and not increments.position_fits(df, spec, saved):
            self.ledger.clear_progress(spec.qualified_name)
            return None
        return saved

    def _narrowed(self, df: DataFrame, spec: TableSpec, lo: Position | None, hi: Position | None) -> DataFrame:
        """The table, or the part of its files that can have rows of the range."""
        if spec.watermark is None or not isinstance(self.source, ZonedSource):
            return df
        return project(self.source.between(spec, lo, hi), spec.columns)

    def _frontier(self, df: DataFrame, spec: TableSpec, lo: Position | None) -> Frontier:
        if self.relational is None:
            return increments.frontier(self._narrowed(df, spec, lo, None), spec, lo)
        return increments.frontier_by_aggregates(self.relational(spec), spec, lo)

    def _write(self, df: DataFrame, spec: TableSpec, intent: Intent) -> SyncOutcome:
        """Write an intent's range, then save its end; a replay writes the same folder."""
        name = spec.qualified_name
        types = self.source_types.get(name, {})
        df = self._narrowed(df, spec, intent.lo, intent.hi)
        rows = snapshot(df, spec, types, intent.lo, intent.hi)
        if self.spec.format == "iceberg":
            path, count = None, append_table(rows, name, fallback=self.spec.lake_fallback)
        else:
            base = self.spec.output.uri
            path = parquet.run_folder(base, spec, intent.run_ts, intent.run_id)
            count = parquet.write_parquet(rows, path, "overwrite", self.spec.batch_size)
            if self.spec.write_mode == "overwrite" and spec.watermark is None:
                # The new copy is whole before the old ones go.
                delete_except(self.spark, parquet.run_folders(base, spec), path)
        self.ledger.finish(name, intent)
        return SyncOutcome(name, count, intent.hi, path)

    def _grade(self, spec: TableSpec, outcome: SyncOutcome) -> tuple[str | None, str | None]:
        """Severity and metrics of what the run wrote."""
        rules = self.rules.get(spec.qualified_name)
        if not rules or outcome.path is None:
            return None, None
        written = self.spark.read.parquet(outcome.path)
        row = quality.severity(written, rules).first()
        return row["severity"], row["metrics_json"]


PLAN_SCHEMA = (
    "table_name string, mode string, partition_by string, n_columns int, columns string, "
    "watermark string, cursor string"
)


def plan_row(spec: TableSpec, schema: T.StructType) -> tuple:
    names = [f.name for f in schema.fields if spec.columns is None or f.name in spec.columns]
    return (
        spec.full_name, spec.mode, spec.partition_by, len(names), ", ".join(names),
        spec.watermark, spec.cursor,
    )


def sync_plan(
    spark: SparkSession, source: Source, tables: Sequence[TableSpec], count_rows: bool = False
) -> DataFrame:
    """What a sync would do, one row per table, without writing anything.

    With ``count_rows`` the rows of every table are counted too, and for
    incremental tables those that have a watermark.
    """
    plans = []
    for spec in tables:
        df = source(spec)
        fields = T._parse_datatype_string(PLAN_SCHEMA).fields
        values = zip(fields, plan_row(spec, df.schema))
        columns = [F.lit(v).cast(f.dataType).alias(f.name) for f, v in values]
        if count_rows:
            seen = F.count(F.lit(1) if spec.watermark is None else F.col(f"`{spec.watermark}`"))
            plans.append(df.agg(seen.alias("source_rows")).select(*columns, "source_rows"))
        else:
            plans.append(spark.range(0, 1, 1, 1).select(*columns))
    out = plans[0]
    for plan in plans[1:]:
        out = out.unionByName(plan)
    return out
