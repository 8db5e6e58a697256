"""Connected components of a graph whose edges stay on the cluster."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cut

# Edges that a task takes at least, if there are so many, and holds at most besides a batch.
EDGES_A_TASK = 1 << 18


def forest(edges: DataFrame) -> DataFrame:
    """Edges that join what the edges of a task join: each node and the least one it reaches there."""
    held_at_most = EDGES_A_TASK

    def joined(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        whole = pa.Table.from_batches(held).combine_chunks()
        ends = pa.concat_arrays([c for name in "uv" for c in whole.column(name).chunks])
        names, number = np.unique(ends.to_numpy(zero_copy_only=False), return_inverse=True)
        root = list(range(len(names)))
        for x, y in number.reshape(2, -1).T.tolist():
            while root[x] != x:
                root[x] = x = root[root[x]]
            while root[y] != y:
                root[y] = y = root[root[y]]
            root[max(x, y)] = min(x, y)
        # Roots have lesser numbers than what hangs on them.
        for x, above in enumerate(root):
            root[x] = root[above]
        own = [x for x, top in enumerate(root) if x != top]
        columns = [pa.array(names[places], ends.type) for places in (own, [root[x] for x in own])]
        return pa.RecordBatch.from_arrays(columns, names=["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) > held_at_most:
                held = [joined(held)]
                # A forest this large is given up, so that memory stays bounded.
                if 2 * held[0].num_rows > held_at_most:
                    yield held.pop()
        if sum(b.num_rows for b in held):
            yield joined(held)

    return edges.mapInArrow(run, edges.schema)


def large_star(edges: DataFrame, n_parts: int) -> DataFrame:
    """Larger neighbours of each node are hung on its least neighbour, or on itself."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))).coalesce(n_parts)
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    hung = both.filter(F.col("v") > F.col("u")).join(least, "u")
    return hung.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def small_star(edges: DataFrame, n_parts: int) -> DataFrame:
    """Smaller neighbours of each node and the node are hung on the least of them."""
    edges = edges.coalesce(n_parts)
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    rest = edges.join(least, "u").filter(F.col("v") > F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return rest.union(least.select("u", F.col("m").alias("v"))).coalesce(n_parts).distinct()


def components(edges: DataFrame) -> DataFrame:
    """The least node reachable from each node that has an edge: node, root.

    `edges` has two columns of one orderable type; their direction, repeats and loops
    do not matter, and rows with a NULL are no edges. Star operations alternate until
    nothing changes, each round kept in the shared folder. No node's neighbours are
    gathered: minima are aggregated and joined back. Rounds never have more edges than
    the first, so tasks are as many as those need: a graph of few edges takes a few tasks
    a round, not one for each shuffle partition. Each task joins its own edges before the
    first round, which leaves an edge for a node, however dense the graph.
    """
    a, b = (F.col(c) for c in edges.columns)
    edges = cut(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter(a.isNotNull() & b.isNotNull() & (a != b)).distinct())
    state = n_parts = None
    while True:
        found = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if (found["n"], found["h"]) == state or not found["n"]:
            break
        state = (found["n"], found["h"])
        if n_parts is None:
            n_parts = -(-found["n"] // EDGES_A_TASK)
            edges = cut(forest(edges.coalesce(n_parts)))
        edges = cut(small_star(large_star(edges, n_parts), n_parts))
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.union(edges.select("v", "v").distinct())
