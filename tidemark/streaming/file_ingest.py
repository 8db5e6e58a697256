"""File ingest as a stream.

The stream carries the names of new files; each micro-batch of them is merged by the
code of a batch run, so types, column sets and duplicates are treated alike. The
checkpoint of the file source remembers which files are done. Files come in order of
modification time, not of key, so across micro-batches the later written file wins,
where a batch run lets the greater key win.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.paths import file_key, glob_to_regex
from tidemark.plans.ingest import Ingest
from tidemark.sinks.lake import LakeTargets
from tidemark.sources.files import apply_hadoop_options, qualify
from tidemark.sources.tables import MissingTable
from tidemark.specs import IngestSpec, SpecError

# Fixed value: what Spark's listing of whole files gives.
LISTED = "path string, modificationTime timestamp, length long, content binary"


def read_file_stream(spark: SparkSession, spec: IngestSpec, files_per_trigger: int = 1000) -> DataFrame:
    """New files of a folder as a stream of names; no content is read."""
    apply_hadoop_options(spark, spec.input)
    base = qualify(spark, spec.input.uri)
    stream = (
        spark.readStream.format("binaryFile")
        .schema(LISTED)
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", files_per_trigger)
        .option("pathGlobFilter", spec.pattern.rsplit("/", 1)[-1])
        .load(base)
    )
    key = file_key(F.col("_metadata.file_path"), base)
    return stream.select(
        key.alias("file_key"),
        "path",
        F.col("_metadata.file_path").alias("uri"),
        "length",
        F.col("modificationTime").alias("modified_at"),
    ).where(F.col("file_key").rlike(glob_to_regex(spec.pattern, spec.input.bucket is not None)))


def start_ingest(
    spark: SparkSession,
    spec: IngestSpec,
    targets: LakeTargets,
    table: str,
    checkpoint: str,
    keys: tuple[str, ...] = (),
    files_per_trigger: int = 1000,
    trigger: dict | None = None,
):
    """Start a stream that merges new files into a target table, which must exist.

    The default trigger takes what is there and stops. A micro-batch that is
    delivered again is recognised by its commit ids and skipped. The driver holds the
    names of `files_per_trigger` files. Columns that a file lacks keep their values.
    """
    if spec.write_mode == "truncate_insert":
        raise SpecError("a stream inserts or upserts; it cannot truncate")
    if spec.write_mode == "upsert" and not keys:
        raise SpecError(f"upsert into {table!r} needs key columns")
    if targets.schema(table) is None:
        raise MissingTable(f"target table {table} does not exist")
    ingest = Ingest(spark, spec, targets, targets.ledger)

    def merge_batch(files: DataFrame, batch_id: int) -> None:
        ingest.merge_delivery(table, tuple(keys), files, f"{checkpoint}#{batch_id}")

    return (
        read_file_stream(spark, spec, files_per_trigger)
        .writeStream.foreachBatch(merge_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
