"""Data-quality profile of an output and the severity its rules give."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.conversions import as_text, is_nested, position_text

# Severities from mild to grave.
SEVERITIES = ("info", "warning", "critical")


def _bounded(dtype: T.DataType) -> bool:
    """Whether minimum and maximum make sense for the type."""
    return not is_nested(dtype) and not isinstance(dtype, (T.BinaryType, T.VariantType))


def profile(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    distinct: str = "approx",
    exact_distinct: Sequence[str] = (),
) -> DataFrame:
    """One row per column: rows, NULLs, distinct values, minimum and maximum.

    One pass over the data. Distinct counts are approximate, but for the
    columns in ``exact_distinct``; ``distinct="none"`` leaves them out. Every
    exact one makes Spark carry another copy of the row into the shuffle, so
    ask for few.
    """
    fields = [f for f in df.schema.fields if columns is None or f.name in columns]
    aggregates = [F.count(F.lit(1)).alias("rows")]
    for i, f in enumerate(fields):
        c = F.col(f"`{f.name}`")
        aggregates.append(F.count(c).alias(f"n{i}"))
        if f.name in exact_distinct:
            aggregates.append(F.count_distinct(c).alias(f"d{i}"))
        elif distinct == "approx":
            aggregates.append(F.approx_count_distinct(c).alias(f"d{i}"))
        if _bounded(f.dataType):
            aggregates += [F.min(c).alias(f"lo{i}"), F.max(c).alias(f"hi{i}")]
    have = lambda f: f.name in exact_distinct or distinct == "approx"

    def text(name: str, dtype: T.DataType):
        if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
            return position_text(F.col(name), dtype)
        return as_text(F.col(name), dtype)

    none = F.lit(None)
    rows = [
        F.struct(
            F.lit(f.name).alias("column_name"),
            F.col("rows").alias("row_count"),
            (F.col("rows") - F.col(f"n{i}")).alias("null_count"),
            (F.col(f"d{i}") if have(f) else none).cast("bigint").alias("distinct_count"),
            (text(f"lo{i}", f.dataType) if _bounded(f.dataType) else none)
            .cast("string").alias("min_value"),
            (text(f"hi{i}", f.dataType) if _bounded(f.dataType) else none)
            .cast("string").alias("max_value"),
        )
        for i, f in enumerate(fields)
    ]
    return df.agg(*aggregates).select(F.inline(F.array(*rows)))


def severity(df: DataFrame, rules: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Check rules in one pass and grade the output.

    A rule is a name with an SQL condition every row must meet and the severity
    of breaking it. A condition that is NULL counts as broken. The result is one
    row: rows seen, worst severity and broken rows per rule as JSON.
    """
    for name, (_, grade) in rules.items():
        if grade not in SEVERITIES:
            raise ValueError(f"rule {name!r} has unknown severity {grade!r}")
    broken = {
        name: F.count_if(~F.coalesce(F.expr(condition), F.lit(False)))
        for name, (condition, _) in rules.items()
    }
    counts = df.agg(
        F.count(F.lit(1)).alias("rows"), *[c.alias(f"_{n}") for n, c in broken.items()]
    )
    worst = F.lit("ok")
    for grade in SEVERITIES:
        hit = F.lit(False)
        for name, (_, g) in rules.items():
            if g == grade:
                hit = hit | (F.col(f"`_{name}`") > 0)
        worst = F.when(hit, grade).otherwise(worst)
    metrics = F.struct(F.col("rows"), *[F.col(f"`_{n}`").alias(n) for n in rules])
    return counts.select(
        F.col("rows").alias("row_count"),
        worst.alias("severity"),
        F.to_json(metrics).alias("metrics_json"),
    )
