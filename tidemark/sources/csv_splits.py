"""CSV files with quoted line breaks, read split by split.

A line break ends a record where the number of quotes before it in the file is even, by
RFC 4180, whose quotes are doubled within quotes. So a split need not know what comes
before it but for one bit: the parity of the quotes of all splits before it. One pass over
the lines gives each split's own parity, a running sum over the few splits of a file gives
the bit, and a second pass puts lines together to records. A record that reaches over
split borders leaves a piece in each, which are put together afterwards.

Files without a quoted line break, as most, are told by the first pass and need no second:
Spark splits them at any line.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# How a line of a split belongs to records: one by itself, or a record that goes on in
# the next split, comes from the one before and goes on, or ends here.
WHOLE, BEGINS, GOES_ON, ENDS = range(4)

PIECES = "uri string, block long, row long, piece int, record string"


class UnclosedQuote(ValueError):
    """A file ends within quotes."""


class ChangedSplits(RuntimeError):
    """A file was split otherwise in the second pass, as when it changed in between."""


def lines_of(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Lines of text files with the split each is in; a carriage return stays at the end.

    Both passes must split alike, so the number of splits is tied to the session's cores
    as they are when this is first called.
    """
    if spark.conf.get("spark.sql.files.minPartitionNum", None) is None:
        spark.conf.set("spark.sql.files.minPartitionNum", str(spark.sparkContext.defaultParallelism))
    lines = spark.read.option("lineSep", "\n").text(list(paths))
    return lines.select(
        F.col("_metadata.file_path").alias("uri"), F.col("_metadata.file_block_start").alias("block"), "value"
    )


def split_states(lines: DataFrame) -> DataFrame:
    """uri, block, inside, odd_lines: whether a split begins within quotes, and its uneven lines."""
    quotes = F.length("value") - F.length(F.replace(F.col("value"), F.lit('"')))
    splits = lines.groupBy("uri", "block").agg(
        F.pmod(F.sum(quotes), F.lit(2)).alias("parity"), F.count_if(quotes % 2 == 1).alias("odd_lines")
    )
    before = Window.partitionBy("uri").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.pmod(F.sum("parity").over(before), F.lit(2)), F.lit(0)) == 1
    return splits.select("uri", "block", inside.alias("inside"), "odd_lines")


def record_pieces(lines: DataFrame, inside: dict[str, dict[int, bool]]) -> DataFrame:
    """Lines put together to records, or to pieces of those that reach over splits.

    `inside` has the state of every split of every file, some bytes for each.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at: tuple[str, int] | None = None
        held: list[str] = []
        within = came = False
        row = 0
        out: list[tuple[str, int, int, int, str]] = []

        def leave() -> None:
            if at is not None and within:
                out.append((*at, row, GOES_ON if came else BEGINS, "\n".join(held)))

        for batch in batches:
            for uri, block, line in zip(*(c.to_pylist() for c in batch.columns)):
                if (uri, block) != at:
                    leave()
                    if block not in inside.get(uri, {}):
                        raise ChangedSplits(f"{uri} has another split at {block} than before")
                    at, held, row = (uri, block), [], 0
                    within = came = inside[uri][block]
                odd = line.count('"') % 2 == 1
                if within:
                    held.append(line)
                    if odd:
                        out.append((uri, block, row, ENDS if came else WHOLE, "\n".join(held)))
                        within, came, held, row = False, False, [], row + 1
                elif odd:
                    within, held = True, [line]
                else:
                    out.append((uri, block, row, WHOLE, line))
                    row += 1
            yield made(out)
            out = []
        leave()
        yield made(out)

    def made(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.string())
        names = ("uri", "block", "row", "piece", "record")
        return pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], names=list(names)
        )

    return lines.mapInArrow(run, PIECES)


def put_together(pieces: DataFrame) -> DataFrame:
    """uri, block, row, record of the records that reach over splits, placed where they begin.

    At most two pieces of a split are among them, so only these are shuffled.
    """
    torn = pieces.where(F.col("piece") != WHOLE)
    order = Window.partitionBy("uri").orderBy("block", "row")
    begins = F.when(F.col("piece") == BEGINS, F.struct("block", "row"))
    placed = torn.withColumn("start", F.last(begins, ignorenulls=True).over(order))
    parts = F.array_sort(F.collect_list(F.struct("block", "piece", "record")))
    records = placed.groupBy("uri", "start").agg(parts.alias("parts"))
    closed = F.element_at("parts.piece", -1) == ENDS
    text = F.concat(F.lit("a quote is not closed in "), "uri")
    record = F.when(closed, F.array_join("parts.record", "\n")).otherwise(F.raise_error(text).cast("string"))
    return records.select("uri", "start.block", "start.row", record.alias("record"))


def csv_records(spark: SparkSession, paths: Sequence[str], scratch: str) -> DataFrame:
    """uri, block, row, record: the records of files with quoted line breaks, headers left out.

    Records are written below `scratch` once, with one line break or carriage return less
    at their ends; empty ones go. Lone carriage returns end no record.
    """
    lines = lines_of(spark, paths)
    inside: dict[str, dict[int, bool]] = {}
    for split in split_states(lines).collect():
        inside.setdefault(split["uri"], {})[split["block"]] = split["inside"]
    record_pieces(lines, inside).write.parquet(scratch)
    pieces = spark.read.schema(PIECES).parquet(scratch)
    whole = pieces.where(F.col("piece") == WHOLE).select("uri", "block", "row", "record")
    records = whole.unionByName(put_together(pieces))
    header = (F.col("block") == 0) & (F.col("row") == 0)
    ended = records.where(~header).withColumn("record", F.regexp_replace("record", r"\r$", ""))
    return ended.where(F.trim("record") != "")


def by_line_breaks(spark: SparkSession, paths: Sequence[str]) -> tuple[list[str], list[str]]:
    """URIs of files with and without a line break in quotes, from a scan of the lines.

    Files without lines are in neither.
    """
    states = split_states(lines_of(spark, paths)).groupBy("uri").agg((F.sum("odd_lines") > 0).alias("broken"))
    found = sorted((r["uri"], r["broken"]) for r in states.collect())
    return [u for u, broken in found if broken], [u for u, broken in found if not broken]
