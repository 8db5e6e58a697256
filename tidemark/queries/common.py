"""Helpers the queries share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import configure

Query = Callable[[SparkSession, str], DataFrame]

# A query with the SQL that must give the same rows.
Check = tuple[Query, str]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def money(column: str):
    """Exact two-digit amount of a double."""
    return F.col(column).cast("decimal(18,2)")
