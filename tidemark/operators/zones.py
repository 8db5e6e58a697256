"""Zone maps: what range of positions each file of a table holds.

An entry is made once for every version of a file, from its key columns alone, and kept
in the ledger. The next increment then opens only the files that can have rows in its
range, which Spark cannot tell by itself for zone-free timestamps, and for no type where
rows are compared by watermark and tiebreaker together.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.conversions import position_text
from tidemark.functions.literals import literal, parse_as
from tidemark.operators.increments import Position
from tidemark.specs import TableSpec

# What tells one version of a file from another.
VERSION = ("uri", "length", "modified_at")

ENDS = ("first", "last")


def _keys(spec: TableSpec) -> list[tuple[str, str]]:
    named = (("watermark", spec.watermark), ("cursor", spec.cursor))
    return [(part, column) for part, column in named if column is not None]


def zone_entries(files: DataFrame, rows: DataFrame, spec: TableSpec) -> DataFrame:
    """First and last position, rows and rows with a NULL key of every listed file.

    `rows` are the rows of the files, straight from their scan. A file without rows has
    an entry too, so that it is not looked at again.
    """
    schema = rows.schema
    key = F.struct(*(F.col(f"`{column}`").alias(part) for part, column in _keys(spec)))
    whole = F.lit(True)
    for _, column in _keys(spec):
        whole = whole & F.col(f"`{column}`").isNotNull()
    found = (
        rows.groupBy(F.col("_metadata.file_path").alias("uri"))
        .agg(
            F.min(F.when(whole, key)).alias("first"),
            F.max(F.when(whole, key)).alias("last"),
            F.count(F.lit(1)).alias("n_rows"),
            F.count_if(~whole).alias("null_keys"),
        )
        .select(
            "uri",
            *(
                position_text(F.col(f"{end}.{part}"), schema[column].dataType).alias(f"{end}_{part}")
                for end in ENDS
                for part, column in _keys(spec)
            ),
            "n_rows",
            "null_keys",
        )
    )
    counted = files.select(*VERSION).join(found, "uri", "left")
    return counted.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("n_rows", "null_keys")})


def _after(entry: str, schema: T.StructType, spec: TableSpec, position: Position) -> Column:
    """Whether an entry's end lies after a position; NULL where the entry cannot tell."""
    parts = dict(_keys(spec))
    saved = {"watermark": position.watermark, "cursor": position.cursor}

    def sides(part: str) -> tuple[Column, Column]:
        kind = schema[parts[part]].dataType
        return parse_as(F.col(f"{entry}_{part}"), kind), literal(saved[part], kind)

    mine, theirs = sides("watermark")
    if "cursor" not in parts or position.cursor is None:
        return mine > theirs
    my_cursor, their_cursor = sides("cursor")
    return (mine > theirs) | ((mine == theirs) & (my_cursor > their_cursor))


def may_hold(
    schema: T.StructType, spec: TableSpec, lo: Position | None, hi: Position | None
) -> Column:
    """Whether a file can have rows after `lo` and up to `hi`, or rows with a NULL key.

    Entries that cannot be compared, as after a change of type, say yes.
    """
    reach = F.lit(True)
    if lo is not None:
        reach = reach & F.coalesce(_after("last", schema, spec, lo), F.lit(True))
    if hi is not None:
        reach = reach & F.coalesce(~_after("first", schema, spec, hi), F.lit(True))
    has_position = F.col("n_rows") > F.col("null_keys")
    return (F.col("null_keys") > 0) | (has_position & reach)


def without_entry(files: DataFrame, entries: DataFrame) -> DataFrame:
    """Listed files whose present version has no entry."""
    return files.join(entries.select(*VERSION), list(VERSION), "left_anti")


def to_open(files: DataFrame, entries: DataFrame, wanted: Column) -> DataFrame:
    """Listed files that an increment has to open: those of wanted entries, or without any."""
    idle = entries.where(~wanted).select(*VERSION)
    return files.join(idle, list(VERSION), "left_anti")


def paths(files: DataFrame) -> Sequence[str]:
    """Paths of listed files, sorted. Scans keep the names of their files on the driver too."""
    return sorted(r["path"] for r in files.select("path").collect())
