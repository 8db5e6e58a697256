"""Line dedup by the spread of a line over distinct sites.

HyperLogLog sketches of the sites of each line are merged by aggregation. Where the
estimate is near the threshold, sites are counted exactly. Lines on enough sites are
removed from every document but the first that has them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cut, set_aside

SPACE_CHARACTERS = " \t\x0b\x0c\r"

# Columns that the rows have on the way.
WORKING = ("_row", "_removed", "_kept", "line", "keeper", "_often", "_meets", "_least")

# Spread lines of most occurrences, which meet their rows without a shuffle: 16 bytes each.
# Each other line has fewer occurrences than this part of all.
MOST_BROADCAST = 20_000


@dataclass(frozen=True)
class Settings:
    """A line with a word that `least_sites` or more have is removed.

    The sketches have 2 ** `precision` registers. Estimates within `margin` standard
    errors of the threshold, one site at least, are settled by exact counts.
    """

    least_sites: int = 5
    precision: int = 10
    margin: float = 5.0

    @property
    def near(self) -> float:
        error = 1.04 / (1 << self.precision) ** 0.5
        return max(1.0, self.margin * error * self.least_sites)


def trimmed(line: Column) -> Column:
    return F.trim(line, F.lit(SPACE_CHARACTERS))


def line_hash(line: Column) -> Column:
    return F.xxhash64(trimmed(line))


def occurrences(docs: DataFrame, *columns: Column | str) -> DataFrame:
    """A row for each line with a word: `columns` and the line's hash `line`."""
    split = docs.filter(F.col("text").isNotNull()).select(*columns, F.explode(F.split("text", "\n")).alias("line"))
    return split.filter(trimmed(F.col("line")) != "").withColumn("line", line_hash(F.col("line")))


def spread_lines(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Hashes of the lines on enough sites, the least doc_id that has each, occurrences: line, keeper, n.

    Sites of the lines near the threshold are few, so distinct sites are taken first and
    no line's rows meet in one task.
    """
    sites = occurrences(docs, "doc_id", F.col("source").cast("string").alias("site"))
    # Written once: few lines come near the threshold, and three uses follow.
    estimated = cut(
        sites.groupBy("line")
        .agg(F.hll_sketch_agg("site", F.lit(settings.precision)).alias("sketch"), F.min("doc_id").alias("keeper"), F.count("*").alias("n"))
        .select("line", "keeper", "n", F.hll_sketch_estimate("sketch").alias("about"))
        .filter(F.col("about") >= settings.least_sites - settings.near)
    )
    sure = F.col("about") > settings.least_sites + settings.near
    exact = (
        sites.filter(F.col("site").isNotNull())
        .select("line", "site")
        .distinct()
        .join(estimated.filter(~sure).select("line"), "line", "left_semi")
        .groupBy("line")
        .agg(F.count("*").alias("sites"))
        .filter(F.col("sites") >= settings.least_sites)
    )
    settled = estimated.filter(~sure).join(exact, "line").select("line", "keeper", "n")
    return estimated.filter(sure).select("line", "keeper", "n").union(settled)


def clean(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The rows of `docs` with their texts freed of spread lines; n_removed lines went.

    A line counts without the white space around it, a site is a value of `source`;
    NULL is no site. The document of least doc_id keeps the line. A NULL text stays
    NULL, and a text of removed lines only becomes empty. `n_chars` follows the text
    where the table has it. Repeated rows are treated alike.

    Lines without a word are never removed.

    Rows meet the lines to remove by a hash of their id and text, so only hashes and
    then each text once are shuffled; rows that share the hash by chance can only lose
    spread lines. The most frequent spread lines are sent to every task.
    """
    docs, back = set_aside(docs.drop("n_removed"), WORKING)
    row = F.xxhash64("doc_id", "text")
    spread = cut(spread_lines(docs, settings))
    often = spread.orderBy(F.desc("n"), "line").limit(MOST_BROADCAST).select("line", F.lit(True).alias("_often"), "keeper")
    known = occurrences(docs, "doc_id", row.alias("_row")).join(F.broadcast(often), "line", "left")
    # Rows that know their line's keeper are dealt by their own hash, the others by the line.
    meets = F.when(F.col("_often"), F.col("_row")).otherwise(F.col("line"))
    rest = spread.select(F.col("line").alias("_meets"), F.col("keeper").alias("_least"))
    removed = (
        known.withColumn("_meets", meets)
        .join(rest, "_meets", "left")
        .withColumn("keeper", F.when(F.col("_often"), F.col("keeper")).otherwise(F.col("_least")))
        .filter(F.col("_often") | F.col("_least").isNotNull())
        .filter(~F.col("doc_id").eqNullSafe(F.col("keeper")))
        .groupBy("_row")
        .agg(F.collect_set("line").alias("_removed"))
    )
    text_lines = F.split("text", "\n")
    kept = F.filter(text_lines, lambda line: ~F.array_contains(F.col("_removed"), line_hash(line)))
    joined = docs.withColumn("_row", row).join(removed, "_row", "left")
    touched = F.col("_removed").isNotNull()
    with_lines = joined.withColumn("_kept", F.when(touched, kept))
    text = F.when(touched, F.array_join("_kept", "\n")).otherwise(F.col("text"))
    n_removed = F.when(touched, F.size(text_lines) - F.size("_kept")).otherwise(0).cast("long")
    cleaned = with_lines.select(
        *(text.alias("text") if c == "text" else F.col(c) for c in docs.columns), n_removed.alias("n_removed")
    )
    if "n_chars" in docs.columns:
        measured = F.when(F.col("n_removed") > 0, F.length("text").cast(docs.schema["n_chars"].dataType))
        cleaned = cleaned.withColumn("n_chars", F.coalesce(measured, F.col("n_chars")))
    return cleaned.withColumnsRenamed(back)
