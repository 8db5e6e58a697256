"""Value conversions, all as Spark expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Text form of positions and timestamps.
POSITION_TEXT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
PLAIN_SECONDS = "yyyy-MM-dd HH:mm:ss"
RFC3339_SECONDS = "yyyy-MM-dd'T'HH:mm:ss"
RFC3339_OFFSET = "xxx"
DATE_TEXT = "yyyy-MM-dd"

# How many of each unit make a second.
EPOCH_UNITS = {"s": 1, "ms": 10**3, "us": 10**6, "ns": 10**9}


def is_nested(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.ArrayType, T.MapType, T.StructType))


def _fraction(column: Column) -> Column:
    """Fraction of a second in no, three or six digits, whichever is exact."""
    digits = F.date_format(column, "SSSSSS")
    return (
        F.when(digits == "000000", "")
        .when(digits.endswith("000"), F.concat(F.lit("."), F.substring(digits, 1, 3)))
        .otherwise(F.concat(F.lit("."), digits))
    )


def as_text(column: Column, dtype: T.DataType) -> Column:
    """Text of a value: JSON for nested values, RFC 3339 for zoned timestamps."""
    if isinstance(dtype, T.StringType):
        return column
    if is_nested(dtype):
        return F.to_json(column, {"ignoreNullFields": "false"})
    if isinstance(dtype, T.TimestampType):
        return F.concat(
            F.date_format(column, RFC3339_SECONDS),
            _fraction(column),
            F.date_format(column, RFC3339_OFFSET),
        )
    if isinstance(dtype, T.TimestampNTZType):
        return F.concat(F.date_format(column, PLAIN_SECONDS), _fraction(column))
    return column.cast("string")


def position_text(column: Column, dtype: T.DataType) -> Column:
    """Text under which a position is saved; reads back with ``parse_as``."""
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.date_format(column, POSITION_TEXT)
    if isinstance(dtype, T.DateType):
        return F.date_format(column, DATE_TEXT)
    return column.cast("string")


def from_epoch(column: Column, unit: str, zoned: bool = False) -> Column:
    """Timestamp of an epoch number in seconds, millis, micros or nanos.

    Nanoseconds are cut to whole microseconds, the finest the lake keeps.
    """
    number = column.cast("bigint")
    if unit == "s":
        ts = F.timestamp_seconds(number)
    elif unit == "ms":
        ts = F.timestamp_millis(number)
    elif unit == "us":
        ts = F.timestamp_micros(number)
    elif unit == "ns":
        ts = F.timestamp_micros(floor_div(number, 1000))
    else:
        raise ValueError(f"unknown epoch unit {unit!r}")
    return ts if zoned else ts.cast("timestamp_ntz")


def floor_div(column: Column, by: int) -> Column:
    """Whole-number division that rounds down, exact on 64-bit values."""
    return F.call_function("div", column - F.pmod(column, F.lit(by)), F.lit(by))


def from_epoch_day(column: Column) -> Column:
    """Date of a day count since 1970-01-01."""
    return F.date_from_unix_date(column.cast("int"))


def wrap_unsigned(column: Column) -> Column:
    """Unsigned 64-bit value (read as decimal(20,0)) as a signed one, wrapped."""
    top = F.lit("18446744073709551616").cast("decimal(20,0)")
    half = F.lit("9223372036854775807").cast("decimal(20,0)")
    return F.when(column > half, column - top).otherwise(column).cast("bigint")
