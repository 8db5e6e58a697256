"""Which table a file or a reference means."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.paths import InvalidGlob, file_stem, first_component, glob_to_regex
from tidemark.specs import DEFAULT_SCHEMA, IngestRoute


def _first_match(key: Column, routes: Sequence[IngestRoute]) -> Column:
    """Index of the first route whose pattern matches; -1 if none does."""
    match: Column | None = None
    for i, route in enumerate(routes):
        try:
            hit = key.rlike(glob_to_regex(route.file_pattern))
        except InvalidGlob:
            continue  # an unreadable pattern matches no file
        match = F.when(hit, i) if match is None else match.when(hit, i)
    return F.lit(-1) if match is None else match.otherwise(-1)


def inferred_table(key: Column) -> Column:
    """First folder of a file key, or the file name without its extension."""
    return F.when(F.instr(key, "/") > 0, first_component(key)).otherwise(file_stem(key))


def route_files(files: DataFrame, routes: Sequence[IngestRoute]) -> DataFrame:
    """Add the target table, the matching route and its create flag to files."""
    key = F.col("file_key")
    routed = files.withColumn("route", _first_match(key, routes))
    target = inferred_table(key)
    create = F.lit(False)
    for i, r in enumerate(routes):
        hit = F.col("route") == i
        target = F.when(hit, F.lit(r.target_table)).otherwise(target)
        if r.create_if_missing:
            create = create | hit
    return routed.withColumn("target_table", target).withColumn("create_if_missing", create)


def split_ref(ref: Column) -> tuple[Column, Column]:
    """Schema (NULL for a bare name) and name of a table reference."""
    dot = F.instr(ref, ".")
    whole = (dot > 1) & (dot < F.length(ref))
    schema = F.when(whole, F.substring_index(ref, ".", 1))
    name = F.when(whole, F.substr(ref, dot + F.lit(1))).otherwise(ref)
    return schema, name


def resolve_refs(refs: DataFrame, tables: DataFrame) -> DataFrame:
    """Resolve table references against configured tables.

    ``refs`` has ``table_ref``; ``tables`` has ``schema_name`` (may be NULL) and
    ``table_name``. The outcome is ``configured``, ``ambiguous`` (a bare name in
    several schemas) or ``minimal`` (unknown, synced whole).

    Both sides are first reduced to distinct rows and the tables to one row per
    name or per schema and name, so the joins cannot multiply rows.
    """
    ref_schema, ref_name = split_ref(F.col("table_ref"))
    wanted = refs.select("table_ref").distinct().select(
        "table_ref", ref_schema.alias("ref_schema"), ref_name.alias("ref_name")
    )
    known = tables.select(
        F.coalesce("schema_name", F.lit(DEFAULT_SCHEMA)).alias("schema_name"), "table_name"
    ).distinct()
    by_name = known.groupBy("table_name").agg(
        F.count(F.lit(1)).alias("n"), F.min("schema_name").alias("only_schema")
    )
    dotted = wanted.where("ref_schema IS NOT NULL").join(
        known.withColumn("hit", F.lit(True)),
        (F.col("ref_schema") == F.col("schema_name")) & (F.col("ref_name") == F.col("table_name")),
        "left",
    ).select(
        "table_ref",
        F.col("ref_schema").alias("schema_name"),
        F.col("ref_name").alias("table_name"),
        F.when(F.col("hit"), "configured").otherwise("minimal").alias("outcome"),
    )
    bare = wanted.where("ref_schema IS NULL").join(
        by_name, F.col("ref_name") == F.col("table_name"), "left"
    ).select(
        "table_ref",
        F.when(F.col("n") == 1, F.col("only_schema")).alias("schema_name"),
        F.col("ref_name").alias("table_name"),
        F.when(F.col("n") > 1, "ambiguous")
        .when(F.col("n") == 1, "configured")
        .otherwise("minimal")
        .alias("outcome"),
    )
    return dotted.unionByName(bare)
