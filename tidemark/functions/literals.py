"""Saved text back to typed values, and whether it still fits the column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The accepted text forms.
INTEGER_FORM = r"^[+-]?\d+$"
FLOAT_FORM = r"(?i)^[+-]?(\d+\.?\d*(e[+-]?\d+)?|\.\d+(e[+-]?\d+)?|inf|infinity|nan)$"
BOOLEAN_FORM = r"(?i)^(true|false)$"
DATE_FORM = r"^\d{4}-\d{2}-\d{2}$"
TIMESTAMP_FORM = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}(\.\d+)?$"
RFC3339_FORM = r"^\d{4}-\d{2}-\d{2}[Tt ]\d{2}:\d{2}:\d{2}(\.\d+)?([Zz]|[+-]\d{2}:\d{2})$"
UUID_FORM = (
    r"(?i)^(urn:uuid:[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}"
    r"|\{[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}\}"
    r"|[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}"
    r"|[0-9a-f]{32})$"
)


def parse_as(text: Column, dtype: T.DataType) -> Column:
    """Typed value of a text column, NULL where the text does not fit the type."""
    if isinstance(dtype, T.StringType):
        return text
    if isinstance(dtype, T.TimestampType):
        form = text.rlike(TIMESTAMP_FORM) | text.rlike(RFC3339_FORM)
    elif isinstance(dtype, T.TimestampNTZType):
        form = text.rlike(TIMESTAMP_FORM)
    elif isinstance(dtype, T.DateType):
        form = text.rlike(DATE_FORM)
    elif isinstance(dtype, T.BooleanType):
        form = text.rlike(BOOLEAN_FORM)
    elif isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        form = text.rlike(INTEGER_FORM)
    elif isinstance(dtype, (T.FloatType, T.DoubleType, T.DecimalType)):
        form = text.rlike(FLOAT_FORM)
    else:
        return text.try_cast(dtype)
    return F.when(form, text.try_cast(dtype))


def fits(text: Column, dtype: T.DataType | None, source_type: str | None = None) -> Column:
    """Whether saved text still fits the column; a missing column never does."""
    if dtype is None:
        return F.lit(False)
    kind = (source_type or "").strip().lower()
    if kind == "uuid":
        return F.coalesce(text.rlike(UUID_FORM), F.lit(False))
    if kind in ("numeric", "decimal"):
        return F.coalesce(text.rlike(FLOAT_FORM), F.lit(False))
    if isinstance(dtype, T.StringType):
        return text.isNotNull()
    return parse_as(text, dtype).isNotNull()


def literal(text: str, dtype: T.DataType) -> Column:
    """Saved text as a literal of the column's own type.

    Only the literal is cast, never the column, so that the comparison folds to
    a constant and reaches the scan.
    """
    if isinstance(dtype, T.StringType):
        return F.lit(text)
    return F.lit(text).cast(dtype)
