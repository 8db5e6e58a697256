"""What to move: table specs, ingest specs and the checks on them.

Everything here is plain Python and is checked before any Spark job starts.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

DEFAULT_SCHEMA = "public"
PARTITION_LAYOUTS = {
    "date": ("year", "month", "day"),
    "month": ("year", "month"),
    "year": ("year",),
}
FILE_FORMATS = ("parquet", "csv")
WRITE_MODES = ("insert", "upsert", "truncate_insert")
OUTPUT_FORMATS = ("parquet", "iceberg")
NULL_KEY_POLICIES = ("error", "skip")

# How a dry run names the ways to sync a table.
MODES = {
    "full": "full",
    "cursor": "incremental (cursor)",
    "unique": "incremental (unique watermark)",
    "invalid": "incremental (invalid config: missing tiebreaker)",
}


class SpecError(ValueError):
    """A spec that cannot be run as written."""


def _one_of(what: str, value: str, allowed: Iterable[str]) -> None:
    if value not in allowed:
        raise SpecError(f"{what} must be one of {', '.join(allowed)}; got {value!r}")


@dataclass(frozen=True)
class TableSpec:
    """One source table and how to extract it."""

    name: str
    schema: str | None = None
    columns: tuple[str, ...] | None = None
    incremental_column: str | None = None
    incremental_tiebreaker_column: str | None = None
    incremental_column_is_unique: bool = False
    partition_by: str | None = None

    def __post_init__(self) -> None:
        if self.columns is not None:
            object.__setattr__(self, "columns", tuple(self.columns))
        if self.partition_by is not None:
            _one_of("partition_by", self.partition_by, PARTITION_LAYOUTS)

    @property
    def full_name(self) -> str:
        return f"{self.schema}.{self.name}" if self.schema else self.name

    @property
    def lookup_schema(self) -> str:
        return self.schema or DEFAULT_SCHEMA

    @property
    def qualified_name(self) -> str:
        """Schema and name, always both: the ledger key and output folder."""
        return f"{self.lookup_schema}.{self.name}"

    @property
    def watermark(self) -> str | None:
        return self.incremental_column

    @property
    def cursor(self) -> str | None:
        """The tiebreaker counts only beside an incremental column."""
        return self.incremental_tiebreaker_column if self.incremental_column else None

    @property
    def mode(self) -> str:
        if self.watermark is None:
            return MODES["full"]
        if self.cursor is not None:
            return MODES["cursor"]
        return MODES["unique" if self.incremental_column_is_unique else "invalid"]


def check_incremental(spec: TableSpec, columns: Sequence[str]) -> None:
    """Raise unless the incremental settings fit the selected columns."""
    wm, cur, name = spec.watermark, spec.cursor, spec.full_name
    if wm is None:
        return
    if cur is None and not spec.incremental_column_is_unique:
        raise SpecError(
            f"{name}: values of {wm!r} may repeat, so the table needs a tiebreaker column "
            "or the column must be marked unique"
        )
    if cur == wm:
        raise SpecError(
            f"{name}: {cur!r} cannot be both the incremental column and its tiebreaker"
        )
    for what, column in (("incremental_column", wm), ("incremental_tiebreaker_column", cur)):
        if column is not None and column not in columns:
            raise SpecError(f"{name}: {what} {column!r} is not among the selected columns")


@dataclass(frozen=True)
class Location:
    """A folder on a local disk, or a bucket and prefix on an object store."""

    path: str | None = None
    bucket: str | None = None
    prefix: str | None = None
    region: str | None = None
    endpoint: str | None = None

    def __post_init__(self) -> None:
        if (self.path is None) == (self.bucket is None):
            raise SpecError("a location needs either a path or a bucket")

    @property
    def uri(self) -> str:
        if self.path is not None:
            return self.path.rstrip("/") or "/"
        prefix = (self.prefix or "").strip("/")
        return f"s3a://{self.bucket}/{prefix}" if prefix else f"s3a://{self.bucket}"

    def hadoop_options(self) -> dict[str, str]:
        """S3A settings, per bucket, for readers and writers alike."""
        if self.bucket is None:
            return {}
        root = f"fs.s3a.bucket.{self.bucket}."
        options = {}
        if self.region:
            options[root + "endpoint.region"] = self.region
        if self.endpoint:
            options[root + "endpoint"] = self.endpoint
            options[root + "path.style.access"] = "true"
        return options


@dataclass(frozen=True)
class SyncSpec:
    """Tables to extract, where to put them and in which form."""

    output: Location | None = None
    tables: tuple[TableSpec, ...] | None = None
    schema: str = DEFAULT_SCHEMA
    exclude: tuple[str, ...] = ()
    format: str = "parquet"
    warehouse: str | None = None
    catalog: str | None = None
    glue_database: str | None = None
    batch_size: int | None = None
    write_mode: str = "append"
    null_keys: str = "error"
    lake_fallback: str | None = None

    def __post_init__(self) -> None:
        _one_of("format", self.format, OUTPUT_FORMATS)
        _one_of("write_mode", self.write_mode, ("append", "overwrite"))
        _one_of("null_keys", self.null_keys, NULL_KEY_POLICIES)
        _one_of("lake_fallback", self.lake_fallback, (None, "parquet"))
        if self.tables is not None:
            object.__setattr__(self, "tables", tuple(self.tables))
        object.__setattr__(self, "exclude", tuple(self.exclude))
        if self.format == "iceberg" and self.warehouse is None:
            raise SpecError("a lake table output needs a warehouse")
        if self.catalog == "glue" and self.glue_database is None:
            raise SpecError("a glue catalog needs a glue_database")
        if self.format == "parquet" and self.output is None:
            raise SpecError("Parquet needs an output location")
        if self.batch_size is not None and self.batch_size < 1:
            raise SpecError("batch_size must be at least 1")


@dataclass(frozen=True)
class IngestRoute:
    """Files that match the pattern go to the target table."""

    file_pattern: str
    target_table: str
    key_columns: tuple[str, ...] = ()
    create_if_missing: bool = False

    def __post_init__(self) -> None:
        object.__setattr__(self, "key_columns", tuple(self.key_columns))


@dataclass(frozen=True)
class IngestSpec:
    """Files to load, the tables they go to and how rows are merged."""

    input: Location
    pattern: str | None = None
    file_format: str = "parquet"
    write_mode: str = "insert"
    tables: tuple[IngestRoute, ...] = field(default_factory=tuple)
    target_schema: str = DEFAULT_SCHEMA
    on_duplicate: str = "last"
    truncate: str = "once"
    track_changes: bool = False
    files_per_batch: int = 4096
    csv_line_breaks: bool = True

    def __post_init__(self) -> None:
        _one_of("file_format", self.file_format, FILE_FORMATS)
        _one_of("write_mode", self.write_mode, WRITE_MODES)
        _one_of("on_duplicate", self.on_duplicate, ("last", "error"))
        _one_of("truncate", self.truncate, ("once", "per_file"))
        object.__setattr__(self, "tables", tuple(self.tables))
        if self.pattern is None:
            object.__setattr__(self, "pattern", f"**/*.{self.file_format}")
        if self.files_per_batch < 1:
            raise SpecError("files_per_batch must be at least 1")
        if self.write_mode == "upsert":
            for route in self.tables:
                if not route.key_columns:
                    raise SpecError(f"upserts into {route.target_table!r} need key_columns")


def parse_table_ref(ref: str) -> tuple[str | None, str]:
    """Split ``schema.name``; a reference without both parts is a bare name."""
    schema, dot, name = ref.partition(".")
    return (schema, name) if dot and schema and name else (None, ref)


def select_table(ref: str, tables: Sequence[TableSpec]) -> TableSpec:
    """The configured spec a reference means, or a minimal one if unknown."""
    schema, name = parse_table_ref(ref)
    found = [
        t for t in tables if t.name == name and (schema is None or t.lookup_schema == schema)
    ]
    if schema is None and len(found) > 1:
        schemas = ", ".join(t.lookup_schema for t in found)
        raise SpecError(
            f"{name!r} is ambiguous: there is one in each of {schemas}; write schema.name"
        )
    return found[-1] if found else TableSpec(name=name, schema=schema)
