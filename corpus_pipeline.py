"""A corpus from raw documents to packed sequences, in five stages.

Each stage reads what the one before it wrote and returns the columns of
`documents`; the last returns the places of the packed pieces. Extra columns are
dropped at the start of a stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import language, lines, nearcopies, packing, quality
from tidemark.llm.common import DOCUMENT, vocabulary
from tidemark.session import scratch_dir

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID: documents go whose language is undetermined or uncertain."""
    docs = docs.select(*DOCUMENT)
    return language.confident(docs, language.fit(docs))


def of_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality rules: documents go that fail the base or break a rule."""
    return quality.good(docs.select(*DOCUMENT))


def without_spread_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Line dedup: lines that many sources have stay in one document each.

    Documents of which no line is left go.
    """
    docs = docs.select(*DOCUMENT)
    cleaned = lines.clean(docs)
    empty = (F.col("n_removed") > 0) & ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    return cleaned.filter(~empty).select(*DOCUMENT)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash near-dedup over five-word shingles: one document of each group stays.

    Documents are one group within op6's radius, or at a Jaccard similarity of 0.8 or more.
    """
    return nearcopies.deduplicated(docs.select(*DOCUMENT), size=5, radius=3, least=0.8)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Best-fit packing: every piece of every document, with its place in a sequence."""
    pieces = packing.pieces(docs, vocabulary("word_bpe_49k.json"), 2048)
    digests = pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return packing.pack(digests, 2048, order=("doc_id", "piece", "ids_crc32"))


STAGES: list[tuple[str, Stage]] = [
    ("language_id", identified),
    ("quality_rules", of_quality),
    ("line_dedup", without_spread_lines),
    ("simhash_near_dedup", one_of_each_group),
    ("best_fit_packing", packed),
]

# Language ID and near-duplicates are beyond SQL; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other over `documents`, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        folder = scratch_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return docs
