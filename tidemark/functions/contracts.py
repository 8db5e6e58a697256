"""Type contracts: source column type to lake type, lake type to target type."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.conversions import as_text

# Source type names and the lake type each maps to.
# Anything not listed here is stored as text.
SOURCE_TO_LAKE: dict[str, T.DataType] = {
    "boolean": T.BooleanType(),
    "bool": T.BooleanType(),
    "smallint": T.ShortType(),
    "int2": T.ShortType(),
    "integer": T.IntegerType(),
    "int": T.IntegerType(),
    "int4": T.IntegerType(),
    "serial": T.IntegerType(),
    "bigint": T.LongType(),
    "int8": T.LongType(),
    "bigserial": T.LongType(),
    "real": T.FloatType(),
    "float4": T.FloatType(),
    "double precision": T.DoubleType(),
    "float8": T.DoubleType(),
    "bytea": T.BinaryType(),
    "date": T.DateType(),
    "timestamp": T.TimestampNTZType(),
    "timestamp without time zone": T.TimestampNTZType(),
    "timestamptz": T.TimestampType(),
    "timestamp with time zone": T.TimestampType(),
}

# Lake types and the column type a target table gets.
# Anything not listed here becomes TEXT.
LAKE_TO_TARGET: dict[type[T.DataType], str] = {
    T.BooleanType: "BOOLEAN",
    T.ByteType: "SMALLINT",
    T.ShortType: "SMALLINT",
    T.IntegerType: "INTEGER",
    T.LongType: "BIGINT",
    T.FloatType: "REAL",
    T.DoubleType: "DOUBLE PRECISION",
    T.StringType: "TEXT",
    T.BinaryType: "BYTEA",
    T.DateType: "DATE",
    T.TimestampType: "TIMESTAMPTZ",
    T.TimestampNTZType: "TIMESTAMP",
    T.TimeType: "TIME",
    T.DayTimeIntervalType: "INTERVAL",
}

# Target types whose values are carried as text.
CARRIED_AS_TEXT = ("TEXT", "INTERVAL", "TIME")


def lake_type(source_type: str, decimal: T.DecimalType | None = None) -> T.DataType:
    """Lake type of a source type; numeric is text unless a decimal is asked for."""
    key = source_type.strip().lower()
    if decimal is not None and key in ("numeric", "decimal"):
        return decimal
    return SOURCE_TO_LAKE.get(key, T.StringType())


def target_type(dtype: T.DataType) -> str:
    """Column type a target table gets for a lake type."""
    return LAKE_TO_TARGET.get(type(dtype), "TEXT")


def source_type(field: T.StructField) -> str:
    """Declared source type of a field, or the target name of its Spark type."""
    return field.metadata.get("src_type") or target_type(field.dataType).lower()


def lake_schema(columns: list[tuple[str, str, bool]]) -> T.StructType:
    """Schema from (name, source type, nullable) rows in ordinal order."""
    return T.StructType(
        [T.StructField(n, lake_type(t), null, {"src_type": t}) for n, t, null in columns]
    )


def to_lake(
    df: DataFrame,
    source_types: Mapping[str, str] | None = None,
    decimals: Mapping[str, T.DecimalType] | None = None,
) -> DataFrame:
    """Cast every column to its lake type.

    Columns without a declared source type keep their Spark type if the lake
    has it and turn to text otherwise (decimals, nested values, intervals).
    """
    declared = dict(source_types or {})
    wanted = dict(decimals or {})
    known = {type(t) for t in SOURCE_TO_LAKE.values()} | {T.StringType, T.ByteType}
    columns = []
    for f in df.schema.fields:
        if f.name in declared:
            dtype = lake_type(declared[f.name], wanted.get(f.name))
        elif f.name in wanted or type(f.dataType) in known:
            dtype = wanted.get(f.name, f.dataType)
        else:
            dtype = T.StringType()
        c = F.col(f"`{f.name}`")
        if isinstance(dtype, T.StringType):
            c = as_text(c, f.dataType)
        elif dtype != f.dataType:
            c = c.cast(dtype)
        metadata = {**f.metadata, **({"src_type": declared[f.name]} if f.name in declared else {})}
        columns.append(c.alias(f.name, metadata=metadata))
    return df.select(*columns)


def target_columns(schema: T.StructType) -> list[tuple[int, str, str, bool]]:
    """(ordinal, name, target type, nullable) for each field."""
    return [
        (i, f.name, target_type(f.dataType), f.nullable)
        for i, f in enumerate(schema.fields, start=1)
    ]


def for_target(df: DataFrame, keep_decimal: bool = False) -> DataFrame:
    """Bring file columns to values a target column can hold.

    Small integers widen to 16 bits; decimals, nested values and every other
    type without a column type of its own become text, nested ones as JSON.
    """
    columns = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.ByteType):
            c = c.cast("smallint")
        elif isinstance(f.dataType, T.DecimalType) and keep_decimal:
            pass
        elif not isinstance(f.dataType, T.StringType) and target_type(f.dataType) in CARRIED_AS_TEXT:
            c = as_text(c, f.dataType)
        columns.append(c.alias(f.name, metadata=f.metadata))
    return df.select(*columns)


def exactly(column: Column, name: str, source: T.DataType, target: T.DataType) -> Column:
    """A cast that fails on a value it would change; text must read as the target type."""
    value = column.try_cast(target)
    if isinstance(source, T.StringType):
        same = value.isNotNull()
    elif isinstance(source, (T.NullType, T.BinaryType)) or isinstance(target, T.BinaryType):
        return column.cast(target)
    else:
        same = value.try_cast(source).eqNullSafe(column)
    problem = F.concat(
        F.lit(f"column {name}: "), column.cast("string"), F.lit(f" does not fit {target.simpleString()}")
    )
    return F.when(column.isNull() | same, value).otherwise(F.raise_error(problem).cast(target))


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast the columns of a batch to an existing target schema.

    Columns the batch lacks stay absent; columns the target lacks are an error, and
    so is a value that the target type cannot hold as it is.
    """
    fields = {f.name: f for f in schema.fields}
    unknown = [c for c in df.columns if c not in fields]
    if unknown:
        raise ValueError(f"columns not in the target table: {', '.join(unknown)}")
    columns = []
    for f in df.schema.fields:
        dtype, c = fields[f.name].dataType, F.col(f"`{f.name}`")
        if dtype == f.dataType:
            columns.append(c)
        elif isinstance(dtype, T.StringType):
            columns.append(as_text(c, f.dataType).alias(f.name))
        else:
            columns.append(exactly(c, f.name, f.dataType, dtype).alias(f.name))
    return df.select(*columns)
