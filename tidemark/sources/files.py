"""File discovery and file scans."""

from __future__ import annotations

import ast
import re
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.contracts import exactly
from tidemark.functions.conversions import from_epoch, wrap_unsigned
from tidemark.functions.paths import file_key, glob_to_regex
from tidemark.session import scratch_dir
from tidemark.sources import csv_splits
from tidemark.specs import Location, SpecError

FILE_PATH = "_file_path"
ROW_ORDER = "_row_order"

LISTING_SCHEMA = T.StructType(
    [
        T.StructField("file_key", T.StringType(), False),
        T.StructField("path", T.StringType(), False),
        T.StructField("uri", T.StringType(), False),
        T.StructField("length", T.LongType(), False),
        T.StructField("modified_at", T.TimestampType(), False),
    ]
)


def apply_hadoop_options(spark: SparkSession, location: Location) -> None:
    """Set the object store options of a location on the session."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for key, value in location.hadoop_options().items():
        conf.set(key, value)


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return jvm_path.getFileSystem(conf).exists(jvm_path)


def qualify(spark: SparkSession, path: str) -> str:
    """Absolute form of a path, with scheme, as file listings show it."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return jvm_path.getFileSystem(conf).makeQualified(jvm_path).toString()


def path_of_uri(spark: SparkSession, uri: str) -> str:
    """Path of a URI as ``_metadata`` shows it, percent escapes undone."""
    return spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(uri)).toString()


def delete_folder(spark: SparkSession, path: str) -> None:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(jvm_path, True)


def delete_except(spark: SparkSession, pattern: str, keep: str) -> None:
    """Delete the folders a path pattern names, but for one."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    fs = jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    kept = qualify(spark, keep)
    for status in fs.globStatus(jvm_path) or []:
        if status.getPath().toString() != kept:
            fs.delete(status.getPath(), True)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names right below a folder; empty if the folder is missing."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(jvm_path):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(jvm_path))


def discover_files(
    spark: SparkSession, location: Location, pattern: str, limit_to_component: bool | None = None
) -> DataFrame:
    """Files below a location that match a glob, one row each.

    Only the listing is read: the content column is pruned away. Spark lists
    large trees in parallel. Matching names that Spark hides are an error. The rows are not sorted; order by ``file_key``.
    """
    apply_hadoop_options(spark, location)
    base = qualify(spark, location.uri)
    cross_slash = location.bucket is not None
    if limit_to_component is not None:
        cross_slash = not limit_to_component
    # The last pattern component narrows the listing itself. Character classes
    # and braces mean other things to the listing filter, so those are left to
    # the regular expression.
    last = pattern.rsplit("/", 1)[-1]
    if not path_exists(spark, base):
        return spark.createDataFrame([], LISTING_SCHEMA)
    refuse_hidden(spark, base, pattern, cross_slash)
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if "**" not in last and not set(last) & set("[]{}\\"):
        reader = reader.option("pathGlobFilter", last)
    key = file_key(F.col("_metadata.file_path"), base)
    return (
        reader.load(base)
        .select(
            key.alias("file_key"),
            "path",
            F.col("_metadata.file_path").alias("uri"),
            F.col("length"),
            F.col("modificationTime").alias("modified_at"),
        )
        .where(F.col("file_key").rlike(glob_to_regex(pattern, cross_slash)))
    )


class HiddenFiles(RuntimeError):
    """Files that a pattern means but whose names Spark does not read."""


# What writers leave beside their output.
WRITERS_OWN = ("_temporary", "_SUCCESS")


def refuse_hidden(spark: SparkSession, base: str, pattern: str, cross_slash: bool) -> None:
    """Raise if the pattern matches files with `_` or `.` at the start of a name.

    Spark's listing leaves such names out. Only they are listed here, level by level.
    Unfinished output of a writer, below `_temporary`, does not count.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(base).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    wanted = re.compile(glob_to_regex(pattern, cross_slash))
    found: list[str] = []
    level = base
    while fs.globStatus(path(f"{level}/*")):
        for status in fs.globStatus(path(f"{level}/{{_,.}}*")) or []:
            if status.getPath().getName() in WRITERS_OWN:
                continue
            if status.isFile():
                found.append(status.getPath().toString())
                continue
            below = fs.listFiles(status.getPath(), True)
            while below.hasNext():
                found.append(below.next().getPath().toString())
        level += "/*"
    keys = [uri[len(base.rstrip("/")) + 1 :] for uri in found]
    matched = sorted(k for k in keys if wanted.search(k) and not set(k.split("/")) & set(WRITERS_OWN))
    if matched:
        raise HiddenFiles(f"Spark cannot read names that begin with _ or .: {', '.join(matched[:5])} below {base}")


def read_files(
    spark: SparkSession,
    paths: Sequence[str],
    file_format: str,
    schema: T.StructType | None = None,
    merge_schema: bool = False,
) -> DataFrame:
    """Scan Parquet or CSV files, local or on an object store."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    if file_format == "parquet":
        return reader.option("mergeSchema", str(merge_schema).lower()).parquet(*paths)
    if file_format == "csv":
        text = read_csv_text(spark, paths, schema.names if schema else None)
        return typed_text(text, schema or T.StructType(text_types(text)))
    raise SpecError(f"unknown file format {file_format!r}")


# How CSV is read, by RFC 4180: quotes are doubled within quotes, ragged lines fail.
CSV_OPTIONS = {"quote": '"', "escape": '"', "mode": "FAILFAST"}


def csv_header(spark: SparkSession, path: str) -> list[str]:
    """Column names of a CSV file."""
    return spark.read.options(header=True, multiLine=True, **CSV_OPTIONS).csv(path).columns


def read_csv_text(
    spark: SparkSession,
    paths: Sequence[str],
    names: Sequence[str] | None = None,
    line_breaks: bool = True,
    scratch: str | None = None,
) -> DataFrame:
    """CSV files with one header as text columns, by RFC 4180.

    Quotes are doubled within quotes, where line breaks are text. A line with more or
    fewer cells than the header fails. See ``csv_rows``.
    """
    rows = csv_rows(spark, paths, names, line_breaks, scratch)
    return rows.drop(FILE_PATH, ROW_ORDER)


def csv_rows(
    spark: SparkSession,
    paths: Sequence[str],
    names: Sequence[str] | None = None,
    line_breaks: bool = True,
    scratch: str | None = None,
    known: tuple[list[str], list[str]] | None = None,
) -> DataFrame:
    """``read_csv_text`` with the URI of each row's file and the order of rows in it.

    Large files are split, those with line breaks in quotes too, whose records are put
    together in `scratch`, a new folder by default. With ``line_breaks`` off no file is
    looked at for them, and a quoted line break ends the line. `known` saves looking, if
    ``csv_splits.by_line_breaks`` was called on these files before.
    """
    if names is None:
        names = csv_header(spark, paths[0])
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    broken, plain = [], list(paths)
    if line_breaks and names:
        with_breaks, without = known or csv_splits.by_line_breaks(spark, paths)
        if with_breaks:
            broken, plain = ([path_of_uri(spark, u) for u in uris] for uris in (with_breaks, without))
    parts = []
    if plain:
        reader = spark.read.options(header=True, **CSV_OPTIONS).schema(schema)
        parts.append(with_row_order(reader.csv(plain), "csv"))
    if broken:
        records = csv_splits.csv_records(spark, broken, scratch or scratch_dir(spark, "csv-records"))
        ddl = ", ".join(f"`{n.replace('`', '``')}` string" for n in names)
        cells = F.from_csv("record", ddl, {"multiLine": "true", **CSV_OPTIONS})
        order = F.struct("block", "row").alias(ROW_ORDER)
        parsed = records.select(cells.alias("cells"), F.col("uri").alias(FILE_PATH), order)
        parts.append(parsed.select(*(F.col(f"cells.`{n}`").alias(n) for n in names), FILE_PATH, ROW_ORDER))
    return reduce(DataFrame.unionByName, parts)


_DAY, _CLOCK = r"\d{4}-\d{2}-\d{2}", r"\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?"
# Types that text may have, the narrowest first, with the form of their values.
TEXT_FORMS: tuple[tuple[T.DataType, str], ...] = (
    (T.LongType(), r"[+-]?\d+"),
    (T.DoubleType(), r"[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?"),
    (T.BooleanType(), "(?i)true|false"),
    (T.DateType(), _DAY),
    (T.TimestampNTZType(), f"{_DAY}([ T]{_CLOCK})?"),
    (T.TimestampType(), f"{_DAY}[ T]{_CLOCK}(Z|[+-]\\d{{2}}(:?\\d{{2}})?)"),
)


def text_fits(text: DataFrame) -> dict[str, tuple[bool, ...]]:
    """For each text column whether any cell has a value, and which forms all cells have.

    One pass; facts of several batches of files combine to those of all of them.
    """
    facts = []
    for name in text.columns:
        c = F.col(f"`{name}`")
        facts.append(F.coalesce(F.bool_or(c.isNotNull()), F.lit(False)))
        for kind, form in TEXT_FORMS:
            fits = c.rlike(f"^({form})$") & c.try_cast(kind).isNotNull()
            facts.append(F.coalesce(F.bool_and(c.isNull() | fits), F.lit(True)))
    row = text.agg(*[f.alias(str(i)) for i, f in enumerate(facts)]).first()
    width = 1 + len(TEXT_FORMS)
    return {n: tuple(row[i * width : (i + 1) * width]) for i, n in enumerate(text.columns)}


def combined_fits(known: dict[str, tuple[bool, ...]], more: dict[str, tuple[bool, ...]]) -> dict:
    """Facts of two sets of files as those of both."""
    both = dict(known)
    for name, facts in more.items():
        if name in both:
            facts = (both[name][0] or facts[0], *(a and b for a, b in zip(both[name][1:], facts[1:])))
        both[name] = facts
    return both


def fitting_type(facts: tuple[bool, ...]) -> T.DataType:
    """The narrowest type that all cells of a column fit; text without any value."""
    any_value, *fits = facts
    if any_value:
        for (kind, _), fit in zip(TEXT_FORMS, fits):
            if fit:
                return kind
    return T.StringType()


def text_types(text: DataFrame) -> list[T.StructField]:
    return [T.StructField(n, fitting_type(facts)) for n, facts in text_fits(text).items()]


def typed_text(text: DataFrame, schema: T.StructType) -> DataFrame:
    """Text columns as the types of `schema`; a cell that does not fit fails."""
    return text.select(
        *(
            F.col(f"`{f.name}`")
            if isinstance(f.dataType, T.StringType)
            else exactly(F.col(f"`{f.name}`"), f.name, T.StringType(), f.dataType).alias(f.name)
            for f in schema.fields
        )
    )


def stored_values(df: DataFrame, column_set: str | None) -> DataFrame:
    """Undo what Spark makes of Parquet types it has no equal for.

    Unsigned 64-bit integers arrive as decimals and wrap to signed ones;
    nanosecond timestamps arrive as numbers and become timestamps.
    """
    for name, kind in ast.literal_eval(column_set) if column_set else ():
        if kind == "uint64":
            df = df.withColumn(name, wrap_unsigned(F.col(f"`{name}`")))
        elif kind.startswith("timestamp[ns"):
            ts = from_epoch(F.col(f"`{name}`"), "ns", zoned="tz=" in kind)
            df = df.withColumn(name, ts)
    return df


def with_row_order(df: DataFrame, file_format: str) -> DataFrame:
    """Add the file's URI and a column that orders the rows of one file.

    Must sit directly on the scan. Parquet gives a row index; CSV does not, so
    its rows are ordered by block start and a generated id.
    """
    if file_format == "parquet":
        order: Column = F.struct(
            F.col("_metadata.row_index").alias("block"), F.lit(0).cast("bigint").alias("row")
        )
    else:
        order = F.struct(
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("row"),
        )
    return df.select("*", F.col("_metadata.file_path").alias(FILE_PATH), order.alias(ROW_ORDER))


# Path schemes whose files a task can open by itself.
TASK_SCHEMES = ("file", "hdfs", "s3a")


def column_prober(file_format: str, location: Location):
    """The function that tasks run over batches of listed files.

    Everything it calls is nested in it, so it travels to the workers whole and
    they need no copy of this package.
    """
    region, endpoint = location.region, location.endpoint

    def open_path(path: str):
        from pyarrow import fs

        scheme, _, rest = path.partition(":")
        if scheme == "file":
            return fs.LocalFileSystem().open_input_file("/" + rest.lstrip("/"))
        if scheme == "s3a":
            options = {"region": region, "endpoint_override": endpoint}
            store = fs.S3FileSystem(**{k: v for k, v in options.items() if v})
            return store.open_input_file(rest.lstrip("/"))
        authority, _, key = rest.lstrip("/").partition("/")
        store, _ = fs.FileSystem.from_uri(f"{scheme}://{authority}/")
        return store.open_input_file("/" + key)

    def columns(path: str) -> str:
        import pyarrow.parquet as pq

        with open_path(path) as source:
            if file_format == "parquet":
                return repr([(f.name, str(f.type)) for f in pq.read_schema(source)])
            text = b""
            while b"\n" not in text and (more := source.read(4096)):
                text += more
            return text.split(b"\n")[0].decode("utf-8", "replace").strip()

    def probe(frames):
        for frame in frames:
            yield frame.assign(column_set=[columns(path) for path in frame["path"]])

    return probe


def with_column_sets(
    spark: SparkSession, files: DataFrame, file_format: str, location: Location
) -> DataFrame:
    """Add a text that is the same for files with the same columns.

    Tasks read one footer or header line per file. Where they cannot open the
    files the text is NULL, and ``group_by_columns`` asks Spark for each schema.
    """
    scheme = qualify(spark, location.uri).partition(":")[0]
    schema = T.StructType([*files.schema.fields, T.StructField("column_set", T.StringType())])
    if scheme not in TASK_SCHEMES:
        return files.withColumn("column_set", F.lit(None).cast("string"))
    return files.mapInPandas(column_prober(file_format, location), schema)


# How footers name the types that Spark has no equal for.
FOOTER_TYPES = {
    "INTEGER(64,false)": "uint64",
    "UINT_64": "uint64",
    "TIMESTAMP(NANOS,true)": "timestamp[ns, tz=UTC]",
    "TIMESTAMP(NANOS,false)": "timestamp[ns]",
}


def footer_columns(spark: SparkSession, path: str) -> list[tuple[str, str]]:
    """Names and types of a Parquet file, by the session's own file systems."""
    jvm = spark._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    source = jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(
        jvm.org.apache.hadoop.fs.Path(path), conf
    )
    reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(source)
    try:
        columns = []
        for field in reader.getFooter().getFileMetaData().getSchema().getFields():
            logical = field.getLogicalTypeAnnotation()
            kind = logical.toString() if logical is not None else ""
            columns.append((field.getName(), FOOTER_TYPES.get(kind, f"{field}")))
        return columns
    finally:
        reader.close()


def _columns_by_reader(spark: SparkSession, rows: Sequence, file_format: str) -> list[str]:
    def columns(row) -> str:
        if file_format == "parquet":
            return repr(footer_columns(spark, row["path"]))
        return repr(csv_header(spark, row["path"]))

    with ThreadPoolExecutor(max_workers=16) as pool:
        return list(pool.map(columns, rows))


def group_by_columns(spark: SparkSession, files: Sequence, file_format: str) -> list[list]:
    """Split one batch of files into groups of one column set, in first-seen order."""
    sets = [r["column_set"] for r in files]
    if None in sets:
        sets = _columns_by_reader(spark, files, file_format)
        files = [{**r.asDict(), "column_set": s} for r, s in zip(files, sets)]
    groups: dict[str, list] = {}
    for columns, row in zip(sets, files):
        groups.setdefault(columns, []).append(row)
    return list(groups.values())


def rows_per_file(df: DataFrame, base: str) -> DataFrame:
    """Row count of every file behind a scan; no data column is read."""
    counts = count_by_path(df.select(F.col("_metadata.file_path").alias(FILE_PATH)))
    return counts.select(file_key(F.col(FILE_PATH), base).alias("file_key"), "rows_ingested")


def count_by_path(df: DataFrame) -> DataFrame:
    """Row count per file URI; keys are made from the few results, not from every row."""
    return df.groupBy(FILE_PATH).agg(F.count(F.lit(1)).alias("rows_ingested"))
