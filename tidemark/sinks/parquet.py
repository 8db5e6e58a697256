"""Parquet output: one folder per run below run-date folders."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.specs import PARTITION_LAYOUTS, TableSpec

RUN_COLUMN = "run"


def run_date_parts(run_ts: datetime, partition_by: str | None) -> dict[str, str]:
    """Folder names and zero-padded values for the time of a run, in UTC."""
    formats = {"year": "%Y", "month": "%m", "day": "%d"}
    layout = PARTITION_LAYOUTS[partition_by] if partition_by else ()
    return {name: run_ts.strftime(formats[name]) for name in layout}


def with_run_date(df: DataFrame, run_ts: datetime, partition_by: str | None) -> DataFrame:
    """Add the run-date columns as text, which keeps the zero padding."""
    parts = run_date_parts(run_ts, partition_by)
    return df.select("*", *[F.lit(v).alias(k) for k, v in parts.items()])


def table_folder(base: str, spec: TableSpec) -> str:
    return f"{base.rstrip('/')}/{spec.qualified_name}"


def run_folder(base: str, spec: TableSpec, run_ts: datetime, run_id: str) -> str:
    """The one folder a run writes; the same run always names the same folder.

    All rows of a run share its date, so the folder is spelled out and the
    write needs no dynamic partitioning and no sort.
    """
    parts = [f"{k}={v}" for k, v in run_date_parts(run_ts, spec.partition_by).items()]
    return "/".join([table_folder(base, spec), *parts, f"{RUN_COLUMN}={run_id}"])


def run_folders(base: str, spec: TableSpec) -> str:
    """Path pattern of the folders of all runs of a table."""
    depth = len(PARTITION_LAYOUTS[spec.partition_by]) if spec.partition_by else 0
    return table_folder(base, spec) + "/*" * depth + f"/{RUN_COLUMN}=*"


def write_parquet(
    df: DataFrame, path: str, mode: str = "append", rows_per_file: int | None = None
) -> int:
    """Write Snappy Parquet and return the row count of the same pass.

    Callers skip the write when there is nothing to write, so that an empty
    input leaves no file behind.
    """
    seen = Observation()
    writer = (
        df.observe(seen, F.count(F.lit(1)).alias("rows"))
        .write.mode(mode)
        .option("compression", "snappy")
    )
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    writer.parquet(path)
    return int(seen.get["rows"])


def read_output(
    spark: SparkSession, base: str, spec: TableSpec, schema: T.StructType | None = None
) -> DataFrame:
    """All rows a table's runs have written, with run-date columns as text.

    Columns that only some runs have are NULL in the rows of the others.
    """
    layout = PARTITION_LAYOUTS[spec.partition_by] if spec.partition_by else ()
    reader = spark.read
    path = table_folder(base, spec)
    if schema is None:
        schema = reader.option("mergeSchema", "true").parquet(path).schema
    hidden = {*layout, RUN_COLUMN}
    fields = [f for f in schema.fields if f.name not in hidden]
    text = [T.StructField(n, T.StringType()) for n in (*layout, RUN_COLUMN)]
    return reader.schema(T.StructType(fields + text)).parquet(path).drop(RUN_COLUMN)
