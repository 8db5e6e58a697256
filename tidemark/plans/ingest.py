"""Loading files into target tables."""

from __future__ import annotations

import itertools
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.contracts import conform, for_target
from tidemark.operators import history
from tidemark.operators.routing import route_files
from tidemark.session import scratch_dir
from tidemark.sinks.lake import LakeTargets
from tidemark.sinks.ledger import Ledger
from tidemark.sources import csv_splits
from tidemark.sources import files as sources
from tidemark.sources.files import FILE_PATH, ROW_ORDER
from tidemark.sources.tables import MissingTable
from tidemark.specs import IngestRoute, IngestSpec, SpecError

FILE_RANK = "_file_rank"


@dataclass(frozen=True)
class IngestOutcome:
    files: int
    rows: int
    tables: tuple[str, ...]


def ingest_plan(files: DataFrame, spec: IngestSpec, loaded: DataFrame | None = None) -> DataFrame:
    """File, target table and create flag for files not loaded yet, unsorted."""
    if loaded is not None:
        files = history.unseen_files(files, loaded, spec.track_changes)
    return route_files(files, spec.tables)


def _chunks(rows: Iterator, size: int) -> Iterator[list]:
    while chunk := list(itertools.islice(rows, size)):
        yield chunk


class Ingest:
    """Loads the files an ingest spec finds, each one once.

    Files are taken per target table, in key order, in batches of bounded
    number; only the names of one batch are on the driver at a time. A batch is
    one Spark read per column set and one merge, whatever its number of files.
    """

    def __init__(
        self, spark: SparkSession, spec: IngestSpec, targets: LakeTargets, ledger: Ledger
    ) -> None:
        self.spark, self.spec, self.targets, self.ledger = spark, spec, targets, ledger
        self._schemas: dict[str, T.StructType] = {}
        self._fits: dict[str, dict[str, tuple[bool, ...]]] = {}
        self._line_breaks: dict[tuple[str, ...], tuple[list[str], list[str]]] = {}
        self._plan: DataFrame | None = None
        self._scratch: list[str] = []

    def plan(self) -> DataFrame:
        """Dry run: what would be loaded where."""
        found = sources.discover_files(self.spark, self.spec.input, self.spec.pattern)
        return ingest_plan(found, self.spec, self.ledger.files())

    def _name(self, table: str) -> str:
        return f"{self.spec.target_schema}.{table}"

    def run(self) -> IngestOutcome:
        self._plan = self._planned()
        planned = self._plan.orderBy("target_table", "file_key")
        total_files = total_rows = 0
        tables = []
        rows = planned.toLocalIterator()
        for table, group in itertools.groupby(rows, key=lambda r: r["target_table"]):
            tables.append(table)
            load = self._replace if self.spec.write_mode == "truncate_insert" else self._merge
            n_files, n_rows = load(table, group)
            while len(self._scratch) > 1:
                sources.delete_folder(self.spark, self._scratch.pop())
            total_files, total_rows = total_files + n_files, total_rows + n_rows
        sources.delete_folder(self.spark, self._scratch.pop())
        return IngestOutcome(total_files, total_rows, tuple(tables))

    def _planned(self) -> DataFrame:
        """The plan with column sets, written down once.

        Sorting samples its input first; from the written plan that does not
        open every file a second time.
        """
        probed = sources.with_column_sets(
            self.spark, self.plan(), self.spec.file_format, self.spec.input
        )
        path = scratch_dir(self.spark, "ingest-plan")
        self._scratch.append(path)
        probed.hint("rebalance").write.parquet(path)
        return self.spark.read.schema(probed.schema).parquet(path)

    # reading

    def _scans(self, chunk: Sequence) -> list[DataFrame]:
        """The files of a chunk as one scan per column set, in order of their first files."""
        fmt = self.spec.file_format
        scans = []
        for group in sources.group_by_columns(self.spark, chunk, fmt):
            paths = [r["path"] for r in group]
            if fmt == "parquet":
                scan = sources.with_row_order(sources.read_files(self.spark, paths, fmt), fmt)
                scans.append(sources.stored_values(scan, group[0]["column_set"]))
            else:
                scans.append(self._as_parquet(self._text(paths)))
        return scans

    def _text(self, paths: Sequence[str]) -> DataFrame:
        """Text cells of files; whether they have line breaks in quotes is looked up once."""
        scratch = scratch_dir(self.spark, "csv-records")
        self._scratch.append(scratch)
        if not self.spec.csv_line_breaks:
            return sources.csv_rows(self.spark, paths, line_breaks=False)
        files = tuple(paths)
        if files not in self._line_breaks:
            # Types and rows are read from the same batch, one after the other.
            self._line_breaks = {files: csv_splits.by_line_breaks(self.spark, paths)}
        return sources.csv_rows(self.spark, paths, scratch=scratch, known=self._line_breaks[files])

    def _text_types(self, table: str) -> dict[str, T.DataType]:
        """Types that the cells of all planned files of a table fit, whatever the batches.

        The names of one batch are on the driver at a time.
        """
        if table not in self._fits:
            known: dict[str, tuple[bool, ...]] = {}
            rows = self._plan.where(F.col("target_table") == table).orderBy("file_key").toLocalIterator()
            for chunk in _chunks(rows, self.spec.files_per_batch):
                for group in sources.group_by_columns(self.spark, chunk, self.spec.file_format):
                    text = self._text([r["path"] for r in group]).drop(FILE_PATH, ROW_ORDER)
                    if text.columns:
                        known = sources.combined_fits(known, sources.text_fits(text))
            self._fits[table] = known
        return {name: sources.fitting_type(facts) for name, facts in self._fits[table].items()}

    def _as_parquet(self, scan: DataFrame) -> DataFrame:
        """Text parsed once: counting and merging then read columns, not lines."""
        path = scratch_dir(self.spark, "ingest-text")
        self._scratch.append(path)
        scan.write.parquet(path)
        return self.spark.read.schema(scan.schema).parquet(path)

    def _ranked(self, batch: DataFrame, chunk: Sequence) -> DataFrame:
        """Replace the file URI by the file's place in key order.

        The chunk bounds what is broadcast. A number per row instead of a path
        keeps the shuffle that follows small.
        """
        places = self.spark.createDataFrame(
            [(r["uri"], i) for i, r in enumerate(chunk)], f"{FILE_PATH} string, {FILE_RANK} int"
        )
        return batch.join(F.broadcast(places), FILE_PATH, "left").drop(FILE_PATH)

    def _typed(self, scan: DataFrame, name: str) -> DataFrame:
        return conform_keeping(scan, self._schemas[name], (FILE_PATH, ROW_ORDER))

    def _counts(self, scans: Sequence[DataFrame], table: str, chunk: Sequence, commit_id: str):
        """Ledger rows of a chunk; files without rows get none."""
        counted = None
        for scan in scans:
            part = sources.count_by_path(scan)
            counted = part if counted is None else counted.unionByName(part)
        known = self.spark.createDataFrame(
            [(r["uri"], r["file_key"], r["modified_at"]) for r in chunk],
            f"{FILE_PATH} string, file_key string, modified_at timestamp",
        )
        return counted.join(F.broadcast(known), FILE_PATH).select(
            "file_key",
            F.lit(table).alias("target_table"),
            "rows_ingested",
            "modified_at",
            F.lit(commit_id).alias("commit_id"),
        )

    def _record(self, scans, table: str, chunk: Sequence, commit_id: str) -> dict:
        """Write the ledger rows, which count once the commit is made."""
        return self.ledger.mark_files(self._counts(scans, table, chunk, commit_id))

    # writing

    def _route(self, row) -> IngestRoute | None:
        return self.spec.tables[row["route"]] if row["route"] >= 0 else None

    def _ensure(self, name: str, table: str, route: IngestRoute | None, scan: DataFrame) -> None:
        if name in self._schemas:
            return
        schema = self.targets.schema(name)
        if schema is None:
            if route is None or not route.create_if_missing:
                raise MissingTable(f"target table {name} does not exist")
            columns = scan.drop(FILE_PATH, ROW_ORDER)
            if self.spec.file_format == "csv":
                types = self._text_types(table)
                schema = T.StructType([T.StructField(n, types[n]) for n in columns.columns])
            else:
                schema = for_target(columns).schema
            self.targets.create(name, schema, route.key_columns)
        self._schemas[name] = schema

    def _merge(self, table: str, rows: Iterator) -> tuple[int, int]:
        """Insert or upsert; every chunk is a commit."""
        n_files = n_rows = 0
        for _, same_route in itertools.groupby(rows, key=lambda r: r["route"]):
            for chunk in _chunks(same_route, self.spec.files_per_batch):
                route = self._route(chunk[0])
                if self.spec.write_mode == "upsert" and (route is None or not route.key_columns):
                    raise SpecError(f"upsert into {table!r} needs key columns")
                f, r = self._merge_chunk(self._name(table), table, route, chunk)
                n_files, n_rows = n_files + f, n_rows + r
        return n_files, n_rows

    def _merge_chunk(self, name, table, route, chunk, delivery: str | None = None) -> tuple[int, int]:
        """Merge files into the table `name` in one commit, whatever columns they have.

        A delivery made before is left alone.
        """
        commit_id = delivery or uuid.uuid4().hex
        if delivery is not None and self.ledger.is_committed(commit_id):
            return 0, 0
        scans = [s for s in self._scans(chunk) if len(s.columns) > 2]
        done = self._record(scans, table, chunk, commit_id) if scans else {"files": 0}
        if done["files"] == 0:
            return 0, 0
        self._ensure(name, table, route, scans[0])
        batches = [self._typed(scan, name) for scan in scans]
        if self.spec.write_mode == "insert":
            plain = [b.drop(FILE_PATH, ROW_ORDER) for b in batches]
            rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), plain)
            self.targets.insert(name, rows, commit_id)
        else:
            self.targets.upsert_all(
                name, [self._ranked(b, chunk) for b in batches], route.key_columns, (FILE_RANK, ROW_ORDER),
                self.spec.on_duplicate, commit_id,
            )
        return done["files"], done["rows"]

    def merge_delivery(self, name: str, keys: tuple[str, ...], files: DataFrame, delivery: str) -> None:
        """Merge listed files of one micro-batch, as a batch run does with its batches."""
        probed = sources.with_column_sets(self.spark, files, self.spec.file_format, self.spec.input)
        chunk = sorted(probed.collect(), key=lambda r: r["file_key"])
        if chunk:
            self._merge_chunk(name, name, IngestRoute("**", name, keys), chunk, delivery)
        while self._scratch:
            sources.delete_folder(self.spark, self._scratch.pop())

    def _replace(self, table: str, rows: Iterator) -> tuple[int, int]:
        """Empty the table once and fill it from all files, in one commit.

        With ``truncate="per_file"`` only the rows of the last file stay.
        """
        name, commit_id = self._name(table), uuid.uuid4().hex
        n_files = n_rows = 0
        folders: list[str] = []
        for chunk in _chunks(rows, self.spec.files_per_batch):
            scans = [s for s in self._scans(chunk) if len(s.columns) > 2]
            done = self._record(scans, table, chunk, commit_id) if scans else {"files": 0}
            if done["files"] == 0:
                continue
            self._ensure(name, table, self._route(chunk[0]), scans[0])
            n_files, n_rows = n_files + done["files"], n_rows + done["rows"]
            if self.spec.truncate == "per_file":
                folders = []
                uris = [r["uri"] for r in chunk if r["file_key"] == done["last"]]
                scans = [s.where(F.col(FILE_PATH).isin(uris)) for s in scans]
            for scan in scans:
                batch = self._typed(scan, name).drop(FILE_PATH, ROW_ORDER)
                folders.append(self.targets.stage(name, batch))
        if n_files:
            self.targets.replace(name, folders, commit_id)
        return n_files, n_rows


def conform_keeping(df: DataFrame, schema: T.StructType, kept: Sequence[str]) -> DataFrame:
    """``conform`` with some columns passed through as they are."""
    extra = [df.schema[c] for c in kept]
    return conform(df, T.StructType([*schema.fields, *extra]))
