"""Helpers the text operators share."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import checkpoint_root

# Columns of a table of documents, in order.
DOCUMENT = ("doc_id", "text", "lang", "source", "n_chars")

# Rows that a task turns into Python values at a time, whatever the Arrow batch.
ROWS_AT_A_TIME = 512


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def vocabulary(name: str) -> str:
    """Place of a public tokenizer's file, the same on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def cut(df: DataFrame) -> DataFrame:
    """`df` computed once and kept in the shared folder, where every executor reads it."""
    root = checkpoint_root(df.sparkSession)
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(root)
    return df.checkpoint()


def set_aside(df: DataFrame, working: Sequence[str]) -> tuple[DataFrame, dict[str, str]]:
    """`df` with columns named as a working column under free names, and the names to give back."""
    taken = {c.lower() for c in (*df.columns, *working)}
    back = {}
    for column in df.columns:
        if column.lower() in {c.lower() for c in working}:
            free = f"_{column}"
            while free.lower() in taken:
                free = f"_{free}"
            taken.add(free.lower())
            back[free] = column
    return df.withColumnsRenamed({old: new for new, old in back.items()}), back


def remainder(column: str, divisor: int) -> Column:
    """crc32 of a column's text modulo `divisor`; -1 for NULL."""
    rest = F.crc32(F.col(column).cast("string").cast("binary")) % F.lit(divisor)
    return F.coalesce(rest, F.lit(-1))


def fields(ddl: str) -> list[T.StructField]:
    return T._parse_datatype_string(ddl).fields


def kept_by_worker(key: tuple, make: Callable):
    """What `make` returns, made once in a worker process and kept between tasks."""
    kept = sys.modules.setdefault("_tidemark_kept", types.ModuleType("_tidemark_kept")).__dict__
    if key not in kept:
        kept[key] = make()
    return kept[key]


def map_rows(
    df: DataFrame,
    inputs: Sequence[str],
    keep: Sequence[str],
    ddl: str,
    make: Callable[[], Callable[..., Iterable[Sequence]]],
) -> DataFrame:
    """One row out for each row in: the columns `keep`, then those of `ddl`.

    `make` runs once in a task. What it returns is given lists of the `inputs` and
    gives back one sequence for each column of `ddl`.
    """
    added = fields(ddl)
    names = [*keep, *(f.name for f in added)]
    schema = T.StructType([*(df.schema[c] for c in keep), *added])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        kinds = [to_arrow_type(f.dataType) for f in added]
        work = make()
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_A_TIME):
                part = batch.slice(at, ROWS_AT_A_TIME)
                results = work(*(part.column(c).to_pylist() for c in inputs))
                made = [pa.array(v, k) for v, k in zip(results, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), *made], names=names)

    needed = list(dict.fromkeys([*keep, *inputs]))
    return df.select(*needed).mapInArrow(run, schema)
