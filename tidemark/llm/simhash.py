"""SimHash near-duplicates by pivot distance tables.

Distinct fingerprints are blocked so that any two within the radius share a block: of
`radius + 1` bands of bits two such agree in one. Blocks that are too large are split
by the same rule on their other bits. In a block, the Hamming distances to reference
fingerprints are computed once; pairs whose distances differ by more than the radius
are discarded, and the survivors are compared. A block gives back one link for each
fingerprint that is joined to another, never its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cut, map_rows
from tidemark.llm.components import components

BITS = 64
SEED = 42

# Hashes whose bits are counted at a time.
HASHES_AT_A_TIME = 1 << 15

# Fingerprints in a block beyond which it is split, as long as bits are left.
LARGE_BLOCK = 4096
DEEPEST = 3

# Rows of whole blocks that a task compares at a time.
ROWS_TOGETHER = 1 << 17

N_PIVOTS = 24


def shingle_hashes(text: str, size: int) -> np.ndarray:
    words = text.encode().lower().split()
    joined = b" ".join(words)
    if len(words) < size:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)] if words else [], np.uint64)
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends[: len(words) - size]]
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[a : b - 1], SEED) for a, b in zip(starts, ends[size - 1 :])], np.uint64)


def fingerprint(text: str | None, size: int) -> int:
    """Bits that over half the hashes of the text's shingles have, as a signed long.

    ASCII capitals are lowered, words end at ASCII white space, shingles count as
    often as they occur. Fewer words than `size` are one shingle; none give 0.
    """
    hashes = shingle_hashes(text, size) if text else np.zeros(0, np.uint64)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), HASHES_AT_A_TIME):
        part = hashes[at : at + HASHES_AT_A_TIME].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, size: int, keep: tuple[str, ...]) -> DataFrame:
    """The columns `keep` of `docs` and `fingerprint`, a long."""

    def make():
        return lambda texts: ([fingerprint(t, size) for t in texts],)

    return map_rows(docs, ["text"], [c for c in keep if c != "fingerprint"], "fingerprint long", make)


def signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def bands(bits: list[int], radius: int) -> list[int]:
    """Masks that share `bits` out among `radius + 1` bands."""
    cuts = [len(bits) * i // (radius + 1) for i in range(radius + 2)]
    return [sum(1 << b for b in bits[i:j]) for i, j in zip(cuts, cuts[1:])]


def masks_by_level(radius: int) -> list[list[tuple[int, int]]]:
    """For each level, masks with the mask they refine."""
    levels = [[(0, mask) for mask in bands(list(range(BITS)), radius)]]
    while len(levels) < DEEPEST:
        finer = []
        for _, mask in levels[-1]:
            free = [b for b in range(BITS) if not mask >> b & 1]
            finer += [(mask, mask | band) for band in bands(free, radius)]
        levels.append(finer)
    return levels


def pivots() -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(i.to_bytes(8, "little")) for i in range(N_PIVOTS)], np.uint64)


def link_blocks(prints: np.ndarray, blocks: np.ndarray, radius: int) -> np.ndarray:
    """For each print the place of a print it is linked with in its block, maybe itself.

    `blocks` numbers the block of each print. A sweep along the first pivot's
    distance pairs each print with those after it, one step further in each round;
    the other pivots and the comparison thin out the pairs.
    """
    table = np.bitwise_count(prints[:, None] ^ pivots()).astype(np.int8)
    order = np.lexsort((table[:, 0], blocks))
    prints, blocks, table = prints[order], blocks[order], table[order]
    root = np.arange(len(prints))
    left = np.arange(len(prints))
    step = 0
    while left.size:
        step += 1
        left = left[left + step < len(prints)]
        right = left + step
        near = (blocks[left] == blocks[right]) & (table[right, 0] - table[left, 0] <= radius)
        left = left[near]
        a, b = left, left + step
        for pivot in range(1, N_PIVOTS):
            if not a.size:
                break
            close = np.abs(table[a, pivot] - table[b, pivot]) <= radius
            a, b = a[close], b[close]
        same = np.bitwise_count(prints[a] ^ prints[b]) <= radius
        a, b = a[same], b[same]
        apart = root[a] != root[b]
        if apart.any():
            root = joined(root, a[apart], b[apart])
    links = np.empty_like(order)
    links[order] = order[root]
    return links


def joined(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Roots after the sets of a[i] and b[i] are joined; the least place is the root."""
    for x, y in zip(a.tolist(), b.tolist()):
        while root[x] != x:
            x = root[x]
        while root[y] != y:
            y = root[y]
        root[max(x, y)] = min(x, y)
    while (root[root] != root).any():
        root = root[root]
    return root


def links(prints: DataFrame, radius: int) -> DataFrame:
    """Links a, b that join all of the distinct `fingerprint`s within the radius."""
    rows = prints.select("fingerprint").distinct()
    found = None
    for level, masks in enumerate(masks_by_level(radius)):
        coarser = {}
        for parent, mask in masks:
            coarser.setdefault(parent, []).append(mask)
        if level:
            finer = F.create_map(*(x for p, ms in coarser.items() for x in (F.lit(signed(p)), F.array(*(F.lit(signed(m)) for m in ms)))))
            rows = rows.select("fingerprint", F.explode(F.element_at(finer, F.col("mask"))).alias("mask"))
        else:
            rows = rows.select("fingerprint", F.explode(F.array(*(F.lit(signed(m)) for m in coarser[0]))).alias("mask"))
        rows = rows.withColumn("part", F.col("fingerprint").bitwiseAND(F.col("mask")))
        sizes = rows.groupBy("mask", "part").agg(F.count("*").alias("n")).filter(F.col("n") > 1)
        sized = cut(rows.join(sizes, ["mask", "part"]))
        last = level == DEEPEST - 1
        fitting = sized if last else sized.filter(F.col("n") <= LARGE_BLOCK)
        compared = compare(fitting, radius)
        found = compared if found is None else found.union(compared)
        rows = sized.filter(F.col("n") > LARGE_BLOCK).select("fingerprint", "mask")
        if last or rows.isEmpty():
            return found
    return found


def compare(blocks: DataFrame, radius: int) -> DataFrame:
    """Links within the blocks `mask`, `part`; whole blocks are compared, many at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def linked(held: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
            masks, parts, prints = (np.concatenate(c) for c in zip(*held))
            starts = (masks[1:] != masks[:-1]) | (parts[1:] != parts[:-1])
            numbers = np.concatenate([[0], np.cumsum(starts)])
            other = link_blocks(prints.view(np.uint64), numbers, radius)
            own = other != np.arange(len(other))
            return pa.RecordBatch.from_arrays([pa.array(prints[own]), pa.array(prints[other[own]])], names=["a", "b"])

        held: list[tuple[np.ndarray, ...]] = []
        for batch in batches:
            columns = tuple(batch.column(c).to_numpy() for c in ("mask", "part", "fingerprint"))
            if not len(columns[0]):
                continue
            held.append(columns)
            if sum(len(c[0]) for c in held) < ROWS_TOGETHER:
                continue
            masks, parts, prints = (np.concatenate(c) for c in zip(*held))
            # The last block may go on in the next batch.
            last = np.flatnonzero((masks != masks[-1]) | (parts != parts[-1]))
            whole = last[-1] + 1 if last.size else 0
            if whole:
                yield linked([(masks[:whole], parts[:whole], prints[:whole])])
            held = [(masks[whole:], parts[whole:], prints[whole:])]
        if held:
            yield linked(held)

    together = blocks.repartition("mask", "part").sortWithinPartitions("mask", "part")
    return together.select("mask", "part", "fingerprint").mapInArrow(run, "a long, b long")


def rooted(prints: DataFrame, radius: int) -> DataFrame:
    """Each distinct fingerprint with the least one that links reach, its own if none."""
    found = components(links(prints, radius)).withColumnRenamed("node", "fingerprint")
    root = F.coalesce("root", "fingerprint").alias("root")
    return prints.select("fingerprint").distinct().join(found, "fingerprint", "left").select("fingerprint", root)


def grouped(prints: DataFrame, radius: int) -> DataFrame:
    """`prints` with `component_id`, the least doc_id that links reach.

    Fingerprints link at `radius` or fewer differing bits. Equal fingerprints are one
    node, whatever their number. Rows with a NULL doc_id take part as links; where a
    component has no other rows its id is NULL.
    """
    prints = cut(prints.drop("component_id"))
    roots = rooted(prints, radius)
    least = prints.groupBy("fingerprint").agg(F.min("doc_id").alias("_least"))
    ids = least.join(roots, "fingerprint").groupBy("root").agg(F.min("_least").alias("component_id"))
    # Every fingerprint once, so a fingerprint of many rows is the only skew, and
    # adaptive execution splits it.
    known = roots.join(ids, "root").select("fingerprint", "component_id")
    return prints.join(known, "fingerprint").select(*prints.columns, "component_id")


def deduplicated(docs: DataFrame, size: int, radius: int) -> DataFrame:
    """One row of `docs` for each component: that of least doc_id, NULL last.

    Of rows that differ and share that doc_id one is taken by a hash of the row, and
    of repeated rows one is left. Rows meet their fingerprints again by that hash, so
    texts are shuffled once.
    """
    columns = docs.columns
    hashed = docs.withColumn("_row", F.xxhash64(*columns))
    prints = cut(fingerprints(hashed, size, ("doc_id", "_row")))
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_row")
    firsts = prints.groupBy("fingerprint").agg(F.min(place).alias("place"))
    kept = (
        firsts.join(rooted(prints, radius), "fingerprint")
        .groupBy("root")
        .agg(F.min("place").alias("place"))
        .select(F.col("place._row").alias("_row"))
    )
    return hashed.join(kept, "_row", "left_semi").dropDuplicates(["_row"]).select(*columns)


def as_hex(column: str) -> Column:
    return F.lpad(F.lower(F.hex(F.col(column))), 16, "0")
