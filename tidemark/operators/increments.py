"""Reading a table from a saved position on.

A position is the text of the last watermark and, for watermarks that repeat,
of a tiebreaker key. The next increment holds the rows after the position and
up to a frozen upper one, so there is no page loop: the range is one scan.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.conversions import position_text
from tidemark.functions.literals import fits, literal
from tidemark.specs import SpecError, TableSpec


class NullKeyError(ValueError):
    """Rows whose watermark or tiebreaker is NULL would be lost."""


@dataclass(frozen=True)
class Position:
    """Saved progress of a table, as text."""

    watermark: str
    cursor: str | None = None


@dataclass(frozen=True)
class Frontier:
    """Where an increment ends, and what it will hold."""

    position: Position | None
    rows: int
    null_keys: int


def _column(name: str) -> Column:
    return F.col(f"`{name}`")


def _dtype(schema: T.StructType, name: str) -> T.DataType:
    return schema[name].dataType


def check_position(spec: TableSpec, saved: Position | None) -> None:
    """A saved watermark without a cursor cannot resume in cursor mode."""
    if saved is not None and spec.cursor is not None and saved.cursor is None:
        raise SpecError(
            f"saved progress of {spec.full_name} has watermark but no cursor; "
            "clear it to start over"
        )


def position_fits(df: DataFrame, spec: TableSpec, saved: Position) -> bool:
    """Whether the saved texts still fit the column types; one row, no scan."""
    checks = [(spec.watermark, saved.watermark)]
    if spec.cursor is not None:
        checks.append((spec.cursor, saved.cursor))
    flags = F.lit(True)
    for name, text in checks:
        field = df.schema[name] if name in df.columns else None
        flags = flags & fits(
            F.lit(text),
            field.dataType if field else None,
            field.metadata.get("src_type") if field else None,
        )
    one = df.sparkSession.range(0, 1, 1, 1).select(flags.alias("fits"))
    return bool(one.first()["fits"])


def after(schema: T.StructType, spec: TableSpec, lo: Position | None) -> Column | None:
    """Rows strictly after a position; None when nothing is saved."""
    if spec.watermark is None or lo is None:
        return None
    wm = _column(spec.watermark)
    w = literal(lo.watermark, _dtype(schema, spec.watermark))
    if spec.cursor is None or lo.cursor is None:
        return wm > w
    c = literal(lo.cursor, _dtype(schema, spec.cursor))
    return (wm > w) | ((wm == w) & (_column(spec.cursor) > c))


def up_to(schema: T.StructType, spec: TableSpec, hi: Position) -> Column:
    """Rows at or before a position."""
    wm = _column(spec.watermark)
    w = literal(hi.watermark, _dtype(schema, spec.watermark))
    if spec.cursor is None or hi.cursor is None:
        return wm <= w
    c = literal(hi.cursor, _dtype(schema, spec.cursor))
    return (wm < w) | ((wm == w) & (_column(spec.cursor) <= c))


def increment(
    df: DataFrame, spec: TableSpec, lo: Position | None = None, hi: Position | None = None
) -> DataFrame:
    """Rows after ``lo`` and up to ``hi``, either of which may be open."""
    lower = after(df.schema, spec, lo)
    if lower is not None:
        df = df.where(lower)
    if hi is not None:
        # Plain bound on the watermark first: row groups are pruned by it.
        w = literal(hi.watermark, _dtype(df.schema, spec.watermark))
        df = df.where(_column(spec.watermark) <= w).where(up_to(df.schema, spec, hi))
    return df


def in_order(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Order by watermark and tiebreaker, NULLs last; unordered for a full sync."""
    keys = [k for k in (spec.watermark, spec.cursor) if k is not None]
    return df.orderBy(*[_column(k).asc_nulls_last() for k in keys]) if keys else df


def first_rows(df: DataFrame, spec: TableSpec, lo: Position | None, limit: int) -> DataFrame:
    """The first ``limit`` rows after a position, for a capped run."""
    return in_order(increment(df, spec, lo), spec).limit(limit)


def _has_keys(spec: TableSpec) -> Column:
    keys = _column(spec.watermark).isNotNull()
    return keys & _column(spec.cursor).isNotNull() if spec.cursor else keys


def _lost(schema: T.StructType, spec: TableSpec, lo: Position | None) -> Column:
    """Rows with a NULL key that no position can reach."""
    wm = _column(spec.watermark)
    lost = wm.isNull()
    if spec.cursor is not None:
        no_cursor = _column(spec.cursor).isNull()
        if lo is not None:
            no_cursor &= wm >= literal(lo.watermark, _dtype(schema, spec.watermark))
        lost |= no_cursor
    return lost


def null_key_rows(df: DataFrame, spec: TableSpec, lo: Position | None = None) -> DataFrame:
    """Count of rows after a position whose watermark or tiebreaker is NULL."""
    counts = [F.count_if(_column(spec.watermark).isNull()).alias("null_watermarks")]
    if spec.cursor is not None:
        counts.append(F.count_if(_column(spec.cursor).isNull()).alias("null_cursors"))
    return df.where(_lost(df.schema, spec, lo)).agg(
        *counts, F.count(F.lit(1)).alias("null_key_rows")
    )


def _position_columns(schema: T.StructType, spec: TableSpec, source: Column) -> list[Column]:
    keys = {"watermark_value": spec.watermark, "cursor_value": spec.cursor}
    return [
        (
            position_text(source[name], _dtype(schema, key)) if key else F.lit(None).cast("string")
        ).alias(name)
        for name, key in keys.items()
    ]


def _last_keys(spec: TableSpec) -> Column:
    """Greatest (watermark, cursor) pair; rows with a NULL key never win."""
    fields = [_column(spec.watermark).alias("watermark_value")]
    if spec.cursor is not None:
        fields.append(_column(spec.cursor).alias("cursor_value"))
    return F.max(F.when(_has_keys(spec), F.struct(*fields)))


def high_watermark(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Position of the last row in order, as text, in one pass without a sort."""
    last = df.agg(_last_keys(spec).alias("last"))
    return last.select(*_position_columns(df.schema, spec, F.col("last")))


def frontier(df: DataFrame, spec: TableSpec, lo: Position | None) -> Frontier:
    """End of the next increment, found in one pass over the key columns.

    The same pass counts the rows that a NULL key would hide.
    """
    lost = _lost(df.schema, spec, lo)
    lower = after(df.schema, spec, lo)
    scope = df if lower is None else df.where(lower | lost)
    found = scope.agg(
        _last_keys(spec).alias("last"),
        F.count_if(_has_keys(spec)).alias("rows"),
        F.count_if(lost).alias("null_keys"),
    )
    row = found.select(
        *_position_columns(df.schema, spec, F.col("last")), "rows", "null_keys"
    ).first()
    text = row["watermark_value"]
    end = None if text is None else Position(text, row["cursor_value"])
    return Frontier(end, row["rows"], row["null_keys"])


def frontier_by_aggregates(df: DataFrame, spec: TableSpec, lo: Position | None) -> Frontier:
    """The same for a relational source: plain maxima it can compute itself."""
    lost = df.where(_lost(df.schema, spec, lo)).count()
    rows = increment(df, spec, lo)
    wm_type = _dtype(df.schema, spec.watermark)
    usable = rows.where(_has_keys(spec))
    top = usable.agg(F.max(_column(spec.watermark)).alias("m"))
    watermark = top.select(position_text(F.col("m"), wm_type).alias("t")).first()["t"]
    if watermark is None:
        return Frontier(None, 0, lost)
    cursor = None
    if spec.cursor is not None:
        same = usable.where(_column(spec.watermark) == literal(watermark, wm_type))
        last = same.agg(F.max(_column(spec.cursor)).alias("m"))
        text = position_text(F.col("m"), _dtype(df.schema, spec.cursor))
        cursor = last.select(text.alias("t")).first()["t"]
    return Frontier(Position(watermark, cursor), -1, lost)


def guard_null_keys(spec: TableSpec, null_keys: int, policy: str) -> None:
    if null_keys and policy == "error":
        raise NullKeyError(
            f"{null_keys} row(s) of table {spec.full_name} have a NULL in "
            f"{spec.watermark!r}{f' or {spec.cursor!r}' if spec.cursor else ''}"
        )
