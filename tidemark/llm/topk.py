"""Exact top-k search by inner product with a three-phase uniform threshold.

The dimensions are cut into lists: a list's score of a row is the inner product over
its dimensions, and a row's score the sum over the lists. (1) Every list gives its k
best rows for each query; the k-th best of their whole scores is a safe cutoff. (2) It
is brought to all rows: one that reaches it reaches the cutoff's even share in at
least one list, and only such entries are collected. (3) Their scores are resolved
exactly. Rows and queries meet in blocks of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import cut

LISTS = 2
ROWS_IN_BLOCK = 4096
QUERIES_IN_BLOCK = 2048
QUERIES_AT_A_TIME = 128


def usable(vector: Column) -> Column:
    """Neither NULL nor with a NULL, NaN or infinite component."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & F.coalesce(finite, F.lit(False))


def quantized(vector: Column, scale: float) -> Column:
    """floor(scale * x) of each component, as longs."""
    return F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("long"))


def blocks(rows: DataFrame, n_blocks: int, name: str) -> DataFrame:
    """One row for each block: its number `name`, the ids and the vectors end to end."""
    dealt = rows.withColumn(name, F.pmod(F.xxhash64("id", F.lit("block")), F.lit(n_blocks)))
    return dealt.groupBy(name).agg(F.collect_list(F.struct("id", "vector")).alias("held")).select(
        name, F.col("held.id").alias("ids"), F.flatten("held.vector").alias("values")
    )


def kind_for(rows: np.ndarray, queries: np.ndarray) -> type:
    """A type in which every partial sum of the products is exact."""
    if not rows.size or not queries.size:
        return np.float64
    bound = int(np.abs(rows).max()) * int(np.abs(queries).max()) * max(1, rows.shape[1])
    return np.float32 if bound < 1 << 24 else np.float64 if bound < 1 << 53 else object


class Block:
    """Scores of a block of rows for a block of queries, by list."""

    def __init__(self, row_ids, row_values, query_ids, query_values, n_lists: int):
        self.row_ids = np.array(row_ids, np.int64)
        self.query_ids = np.array(query_ids, np.int64)
        rows = np.asarray(row_values).reshape(len(row_ids), -1)
        queries = np.asarray(query_values).reshape(len(query_ids), -1)
        kind = kind_for(rows, queries)
        cuts = [rows.shape[1] * i // n_lists for i in range(n_lists + 1)]
        self.lists = [(rows[:, i:j].astype(kind).T, queries[:, i:j].astype(kind)) for i, j in zip(cuts, cuts[1:])]

    def parts(self) -> Iterator[tuple[np.ndarray, list[np.ndarray], np.ndarray]]:
        """Places of some queries, their scores in each list, and which rows are their own."""
        for at in range(0, len(self.query_ids), QUERIES_AT_A_TIME):
            some = np.arange(at, min(at + QUERIES_AT_A_TIME, len(self.query_ids)))
            scores = [queries[some] @ rows for rows, queries in self.lists]
            yield some, scores, self.query_ids[some][:, None] == self.row_ids[None, :]

    def best(self, query: np.ndarray, row: np.ndarray, score: np.ndarray, k: int):
        """Of entries, each query's k best: query ids, row ids and scores."""
        order = np.lexsort((self.row_ids[row], -score, query))
        query, row, score = query[order], row[order], score[order]
        first = np.searchsorted(query, query, side="left")
        kept = np.arange(len(query)) - first < k
        return self.query_ids[query[kept]], self.row_ids[row[kept]], score[kept].astype(np.int64)

    def leading(self, k: int):
        """Phase 1: the k best rows of each list, with their whole scores."""
        for some, scores, own in self.parts():
            listed = np.zeros(own.shape, bool)
            for score in scores:
                lowest = np.where(own, score.min(initial=0) - 1, score)
                top = np.argpartition(lowest, -k, axis=1)[:, -k:] if k < own.shape[1] else np.arange(own.shape[1])[None, :]
                np.put_along_axis(listed, np.broadcast_to(top, (len(some), top.shape[1])), True, axis=1)
            query, row = np.nonzero(listed & ~own)
            yield self.best(some[query], row, whole(scores, query, row), k)

    def reaching(self, cutoffs: np.ndarray, k: int):
        """Phases 2 and 3: rows that reach the even share in a list, resolved exactly."""
        for some, scores, own in self.parts():
            cutoff = cutoffs[some]
            reached = np.zeros(own.shape, bool)
            for score in scores:
                reached |= score * len(scores) >= cutoff[:, None]
            query, row = np.nonzero(reached & ~own)
            score = whole(scores, query, row)
            enough = score >= cutoff[query]
            yield self.best(some[query[enough]], row[enough], score[enough], k)


def whole(scores: list[np.ndarray], query: np.ndarray, row: np.ndarray) -> np.ndarray:
    total = sum(score[query, row] for score in scores)
    return total if total.dtype == object else total.astype(np.int64)


ENTRY = "query_id long, vec_id long, score long"


def entries(found) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in found], names=["query_id", "vec_id", "score"])


def search(vectors: DataFrame, queries: DataFrame, k: int, n_lists: int = LISTS) -> DataFrame:
    """Each query's k best rows: query_id, rank, vec_id, score; ties go to smaller ids.

    Both tables have `id` and `vector`, an array of longs; shorter vectors count as
    filled up with zeros. Rows with a query's id are its own and no candidates, rows
    without an id take no part. A query with fewer than k candidates gets them all;
    empty tables give no rows. Scores are exact integers.
    """
    vectors, queries = (
        df.select(F.col("id").cast("long").alias("id"), "vector").filter(F.col("id").isNotNull()) for df in (vectors, queries)
    )
    sizes = [df.agg(F.count("*").alias("n"), F.max(F.size("vector")).alias("d")).first() for df in (vectors, queries)]
    width = max(1, *(s["d"] or 0 for s in sizes))
    filled = F.concat("vector", F.array_repeat(F.lit(0).cast("long"), F.lit(width) - F.size("vector"))).alias("vector")
    n_rows, n_queries = (max(1, -(-s["n"] // most)) for s, most in zip(sizes, (ROWS_IN_BLOCK, QUERIES_IN_BLOCK)))
    row_blocks = cut(blocks(vectors.select("id", filled), n_rows, "r"))
    query_blocks = cut(blocks(queries.select("id", filled), n_queries, "q"))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    rows_for_all = row_blocks.withColumn("q", every(n_queries))

    def paired(asking: DataFrame) -> DataFrame:
        for_all = asking.withColumn("r", every(n_rows))
        asked = for_all.withColumnRenamed("ids", "query_ids").withColumnRenamed("values", "query_values")
        return rows_for_all.join(asked, ["r", "q"])

    def block_of(batch: pa.RecordBatch, i: int) -> Block:
        values = (batch.column(c)[i].values for c in ("ids", "values", "query_ids", "query_values"))
        return Block(*(v.to_numpy(zero_copy_only=False) for v in values), n_lists)

    def lead(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                yield from map(entries, block_of(batch, i).leading(k))

    def reach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                cutoffs = batch.column("cutoffs")[i].values.to_numpy(zero_copy_only=False)
                yield from map(entries, block_of(batch, i).reaching(cutoffs, k))

    by_score = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    leading = paired(query_blocks).select("ids", "values", "query_ids", "query_values").mapInArrow(lead, ENTRY)
    cutoffs = (
        leading.withColumn("rank", F.row_number().over(by_score))
        .filter(F.col("rank") <= k)
        .groupBy("query_id")
        .agg(F.count("*").alias("n"), F.min("score").alias("score"))
        .filter(F.col("n") == k)
        .select("query_id", F.col("score").alias("cutoff"))
    )
    # Queries without a full list have no cutoff: everything reaches it.
    lowest = F.lit(-(1 << 62))
    asking = (
        query_blocks.select("q", "values", F.posexplode("ids").alias("at", "query_id"))
        .select("q", "at", "query_id")
        .join(cutoffs, "query_id", "left")
        .groupBy("q")
        .agg(F.sort_array(F.collect_list(F.struct("at", F.coalesce("cutoff", lowest).alias("cutoff")))).alias("held"))
        .select("q", F.col("held.cutoff").alias("cutoffs"))
    )
    with_cutoffs = query_blocks.join(asking, "q")
    reached = (
        paired(with_cutoffs).select("ids", "values", "query_ids", "query_values", "cutoffs").mapInArrow(reach, ENTRY)
    )
    ranked = reached.withColumn("rank", F.row_number().over(by_score)).filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
