"""Parquet tables of which an increment opens only the files it needs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import zones
from tidemark.operators.increments import Position
from tidemark.session import configure
from tidemark.sinks.ledger import Ledger
from tidemark.specs import TableSpec


class ZonedSource:
    """Tables kept as ``<base>/<name>.parquet``, with a zone map for each in the ledger.

    Use it as the source of a sync. Calling it scans a whole table; `between` scans the
    files that can have rows of a range. Files that came or changed since the last run
    are looked into first, their key columns only.
    """

    def __init__(self, spark: SparkSession, base: str, ledger: Ledger) -> None:
        self.spark, self.base, self.ledger = configure(spark), base.rstrip("/"), ledger

    def _folder(self, spec: TableSpec) -> str:
        return f"{self.base}/{spec.name}.parquet"

    def __call__(self, spec: TableSpec) -> DataFrame:
        return self.spark.read.parquet(self._folder(spec))

    def files(self, spec: TableSpec) -> DataFrame:
        """The files a scan of the table would read, as they are now."""
        listing = self.spark.read.format("binaryFile").option("recursiveFileLookup", "true")
        return listing.load(self._folder(spec)).select(
            "path",
            F.col("_metadata.file_path").alias("uri"),
            "length",
            F.col("modificationTime").alias("modified_at"),
        )

    def scan(self, spec: TableSpec, files: DataFrame, all_files: int) -> DataFrame:
        """Rows of some files of a table, with the table's columns."""
        whole = self(spec)
        chosen = zones.paths(files)
        if len(chosen) == all_files:
            return whole
        if not chosen:
            return self.spark.createDataFrame([], whole.schema)
        reader = self.spark.read.schema(whole.schema).option("basePath", self._folder(spec))
        return reader.parquet(*chosen)

    def refresh(self, spec: TableSpec) -> int:
        """Make entries of files that have none; their number."""
        return self._refresh(spec, self.files(spec))

    def _refresh(self, spec: TableSpec, files: DataFrame) -> int:
        fresh = zones.without_entry(files, self.ledger.zones(spec))
        found = fresh.count()
        if found:
            entries = zones.zone_entries(fresh, self.scan(spec, fresh, files.count()), spec)
            self.ledger.mark_zones(spec, entries)
        return found

    def between(self, spec: TableSpec, lo: Position | None, hi: Position | None = None) -> DataFrame:
        """Rows of the files that can have rows after `lo` and up to `hi`, or NULL keys.

        Rows outside the range may be among them. The files are listed once, so what is
        opened was looked into.
        """
        files = self.files(spec)
        self._refresh(spec, files)
        wanted = zones.may_hold(self(spec).schema, spec, lo, hi)
        needed = zones.to_open(files, self.ledger.zones(spec), wanted)
        return self.scan(spec, needed, files.count())
