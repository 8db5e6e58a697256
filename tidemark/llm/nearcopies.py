"""Near copies by the Jaccard similarity of word shingles, found by seeded SimHashes.

A radius of few bits misses most pairs that share four shingles in five: one bit in six
differs there. So a set of shingles gets several fingerprints under independent seeds,
their bits are dealt into bands, and sets that agree in a band are a block. Pairs of a
block go through the fingerprints at a wide radius, and what is left is verified by the
shingles themselves.

Bands get wider as sets get more, so that blocks of unlike sets stay as small, and more,
so that a pair of a similarity of 0.8 shares none with a chance of MISSED. Pairs that
join blocks go through two fingerprints, which travel with every band; only sets with
such a pair bring all of theirs, whose wide radius is four standard errors off and
closer by far: it lets pairs of 0.69 or more through, where that of two does of 0.47.

What those pairs come from is compared in chunks. Sets that joining pairs connect are a
cluster, and a cluster is dealt into chunks of bounded number and bytes. Blocks only name
the pairs of chunks that hold a pair of sets of two groups, so a set travels once for each
chunk it meets and not for each set; all sets of two such chunks are compared by their
shingles, and of the links as many stay as join the groups.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cut, map_rows
from tidemark.llm.components import components
from tidemark.llm.simhash import ROWS_TOGETHER, SEED, fingerprint, joined, links, shingle_hashes

N_SEEDS = 16
BITS = N_SEEDS * 64

# Bits of 1024 that differ at a similarity of 0.8: the angle between the sets over pi.
DIFFERING = math.acos(2 * 0.8 / 1.8) / math.pi

# Unlike sets of a block, on average at most, and the least width of a band.
UNLIKE = 16
LEAST_WIDTH = 14
MISSED = 0.0005

# Bits of two fingerprints and of all that near copies may differ in: 19 and 155 do at a
# similarity of 0.8, with standard errors of 4 and 11, and 64 and 512 at random.
SKETCH_RADIUS = 36
WHOLE_RADIUS = 200

LANES = np.uint64(0x0101010101010101)
# Bytes of a sum that cannot overflow.
ADDED_AT_A_TIME = 255
SETS_AT_A_TIME = 128

# A chunk of sets to compare: about so many, and so many bytes of shingle hashes.
CHUNK_SETS = 1024
CHUNK_BYTES = 8 << 20
# Cells of a matrix of sets by shingles, and pairs of chunks held before repeats go.
CELLS = 1 << 22
PAIRS_TOGETHER = 1 << 16


def mixed(hashes: np.ndarray, seed: int) -> np.ndarray:
    """Hashes of hashes: one function for each seed."""
    x = hashes ^ np.uint64(xxhash.xxh64_intdigest(seed.to_bytes(8, "little"), SEED))
    for factor in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB):
        x = (x ^ (x >> np.uint64(31))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def ones_of(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each bit, eight bits a step in the bytes of a word."""
    n = -len(hashes) % ADDED_AT_A_TIME
    rows = np.concatenate([hashes, np.zeros(n, np.uint64)]).reshape(-1, ADDED_AT_A_TIME)
    counts = np.empty((8, 8), np.int64)
    for bit in range(8):
        sums = ((rows >> np.uint64(bit)) & LANES).sum(axis=1, dtype=np.uint64)
        counts[:, bit] = sums.astype("<u8").view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
    return counts.reshape(-1)


def seeded_bits(hashes: np.ndarray) -> np.ndarray:
    """The bits of the SimHash of distinct shingle hashes under each seed, end to end."""
    return np.concatenate([2 * ones_of(mixed(hashes, seed)) > len(hashes) for seed in range(N_SEEDS)])


def missed(width: int, n_bands: int) -> float:
    """The chance that a pair of a similarity of 0.8 agrees in none of the bands.

    Bands draw from the same bits, so the chance is taken for each number of bits that
    may differ, and these by their own chances.
    """
    n = np.arange(BITS + 1)
    logs = np.cumsum(np.log(np.maximum(n, 1)))
    chances = np.exp(logs[-1] - logs - logs[::-1] + n * math.log(DIFFERING) + (BITS - n) * math.log(1 - DIFFERING))
    return float((chances * (1 - (1 - n / BITS) ** width) ** n_bands).sum())


def layout(n_sets: int) -> np.ndarray:
    """The bits of each band, for so many sets: one row of places for a band.

    The bits are dealt out in one order after another, so no two bands of an order
    share a bit.
    """
    width = max(LEAST_WIDTH, math.ceil(math.log2(max(1, n_sets) / UNLIKE)))
    n_bands = 1
    while missed(width, n_bands) > MISSED:
        n_bands += max(1, n_bands // 50)
    rng = np.random.default_rng(SEED)
    of_order = BITS // width
    orders = [rng.permutation(BITS)[: of_order * width].reshape(of_order, width) for _ in range(-(-n_bands // of_order))]
    return np.concatenate(orders)[:n_bands]


def described(text: str | None, size: int) -> tuple[int, bytes | None]:
    """The set's hash and the bits of all fingerprints; none for a set without shingles."""
    hashes = np.unique(shingle_hashes(text, size)) if text else np.zeros(0, np.uint64)
    whole = int(np.array([xxhash.xxh64_intdigest(hashes.astype("<u8").tobytes(), SEED)], np.uint64).view(np.int64)[0])
    return whole, np.packbits(seeded_bits(hashes), bitorder="little").tobytes() if len(hashes) else None


def descriptions(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, _row, fingerprint (of op6), shingles and sketch of each row."""

    def make():
        return lambda texts: zip(*((fingerprint(t, size), *described(t, size)) for t in texts))

    return map_rows(docs, ["text"], ["doc_id", "_row"], "fingerprint long, shingles long, sketch binary", make)


def sketches_of(column: pa.Array) -> np.ndarray:
    """Sketches as rows of 64-bit words, two or all."""
    words = np.frombuffer(b"".join(column.to_pylist()), "<u8")
    return words.reshape(len(column), -1)


def dealt(sets: DataFrame, bands: np.ndarray, whole: bool) -> DataFrame:
    """A row for each band of each set: `band`, shingles, root and chunk where there are, sketch.

    The sketch is the whole one or its first two fingerprints.
    """
    width = bands.shape[1]
    powers = 1 << np.arange(width, dtype=np.int64)
    first = np.arange(len(bands), dtype=np.int64) << width
    keep = [c for c in ("shingles", "root", "chunk") if c in sets.columns]
    n_words = N_SEEDS if whole else 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SETS_AT_A_TIME):
                part = batch.slice(at, SETS_AT_A_TIME)
                words = sketches_of(part.column("sketch"))
                bits = np.unpackbits(words.view(np.uint8), axis=1, bitorder="little").astype(np.int64)
                values = np.stack([first[i] + bits[:, places] @ powers for i, places in enumerate(bands)], axis=1)
                row = np.repeat(np.arange(len(words)), len(bands))
                taken = pa.array(row)
                short = pa.array([w.tobytes() for w in words[:, :n_words]], pa.binary())
                columns = [pa.array(values.reshape(-1)), *(part.column(c).take(taken) for c in keep), short.take(taken)]
                yield pa.RecordBatch.from_arrays(columns, names=["band", *keep, "sketch"])

    ddl = "".join(f", {c} long" for c in keep)
    return sets.filter("sketch IS NOT NULL").select(*keep, "sketch").mapInArrow(run, f"band long{ddl}, sketch binary")


def distinct_pairs(pairs: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Unordered pairs without repeats, the lesser first."""
    a, b = (np.concatenate(c) for c in zip(*pairs)) if pairs else (np.zeros(0, np.int64), np.zeros(0, np.int64))
    both = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0)
    return both[:, 0], both[:, 1]


def sketch_pairs(blocks: np.ndarray, sets: np.ndarray, sketches: np.ndarray, radius: int, roots: np.ndarray | None):
    """Pairs of sets of one block within the wide radius.

    Without roots, enough pairs to join all that such pairs join. With them `sets` may be
    the chunks of the sets, and pairs are those that sets of two roots are in.
    """
    order = np.lexsort((sets, blocks))
    blocks, sets, sketches = blocks[order], sets[order], sketches[order]
    roots = roots[order] if roots is not None else None
    joins = np.arange(len(sets))
    left = np.arange(len(sets))
    pairs = []
    step = held = 0
    while left.size:
        step += 1
        left = left[left + step < len(sets)]
        left = left[blocks[left] == blocks[left + step]]
        a, b = left, left + step
        other = joins[a] != joins[b] if roots is None else roots[a] != roots[b]
        a, b = a[other], b[other]
        near = np.bitwise_count(sketches[a] ^ sketches[b]).sum(axis=1, dtype=np.int16) <= radius
        a, b = a[near], b[near]
        if not a.size:
            continue
        pairs.append((sets[a], sets[b]))
        held += a.size
        if roots is None:
            joins = joined(joins, a, b)
        elif held > PAIRS_TOGETHER:
            pairs = [distinct_pairs(pairs)]
            held = 0
    return distinct_pairs(pairs)


def candidates(members: DataFrame, rooted: bool) -> DataFrame:
    """Distinct pairs a, b of shingle sets that share a `band` and pass the wide radius.

    With roots, the pairs of chunks, or chunks twice, in which such sets of two roots are,
    by their whole sketches.
    """
    names = ("band", *(("chunk", "root") if rooted else ("shingles",)))
    radius = WHOLE_RADIUS if rooted else SKETCH_RADIUS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(columns: list[np.ndarray]) -> pa.RecordBatch:
            sketches, blocks, sets, *roots = columns
            pairs = sketch_pairs(blocks, sets, sketches, radius, roots[0] if roots else None)
            return pa.RecordBatch.from_arrays([pa.array(p, pa.int64()) for p in pairs], names=["a", "b"])

        held: list[list[np.ndarray]] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append([sketches_of(batch.column("sketch")), *(batch.column(c).to_numpy() for c in names)])
            if sum(len(c[0]) for c in held) < ROWS_TOGETHER:
                continue
            columns = [np.concatenate(c) for c in zip(*held)]
            # The last block may go on in the next batch.
            last = np.flatnonzero(columns[1] != columns[1][-1])
            whole = last[-1] + 1 if last.size else 0
            if whole:
                yield found([c[:whole] for c in columns])
            held = [[c[whole:] for c in columns]]
        if held:
            yield found([np.concatenate(c) for c in zip(*held)])

    together = members.select(*names, "sketch").repartition("band").sortWithinPartitions("band")
    return together.mapInArrow(run, "a long, b long").distinct()


def shingle_sets(docs: DataFrame, sets: DataFrame, size: int) -> DataFrame:
    """Sorted distinct shingle hashes `hashes` of the rows that stand for `sets`."""

    def make():
        def many(texts: list[str | None]):
            return ([np.unique(shingle_hashes(t or "", size)).astype("<u8").tobytes() for t in texts],)

        return many

    return map_rows(docs.join(sets, "_row"), ["text"], ["shingles"], "hashes binary", make)


def verified(pairs: DataFrame, hashes: DataFrame, least: float) -> DataFrame:
    """The pairs a, b whose sets have a Jaccard similarity of `least` or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist()):
                x, y = np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8")
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(common >= least * (len(x) + len(y) - common))
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(pa.array(keep, pa.bool_())) for c in "ab"], names=["a", "b"])

    for end, of_end in (("a", "x"), ("b", "y")):
        pairs = pairs.join(hashes.select(F.col("shingles").alias(end), F.col("hashes").alias(of_end)), end)
    return pairs.select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def chunked(clusters: DataFrame, hashes: DataFrame) -> DataFrame:
    """The `chunk` of each of the `shingles`: a part of its cluster, about as large as the others."""
    sized = clusters.join(hashes.select("shingles", F.length("hashes").alias("bytes")), "shingles")
    parts = F.greatest(F.ceil(F.count("*") / CHUNK_SETS), F.ceil(F.sum("bytes") / CHUNK_BYTES))
    part = F.pmod(F.xxhash64("shingles"), F.col("parts"))
    number = sized.groupBy("cluster").agg(parts.alias("parts"))
    return sized.join(number, "cluster").select("shingles", F.xxhash64("cluster", part).alias("chunk"))


def common_shingles(hashes: list[np.ndarray]) -> np.ndarray:
    """How many hashes each two of the sets have in common, by products of 0-1 matrices.

    The diagonal counts only what some other set has too.
    """
    n = len(hashes)
    values, counts = np.unique(np.concatenate(hashes), return_counts=True)
    values = values[counts > 1]
    common = np.zeros((n, n), np.float32)
    width = max(64, CELLS // n)
    for first in range(0, len(values), width):
        some = values[first : first + width]
        cells = np.zeros((n, len(some)), np.float32)
        for row, held in enumerate(hashes):
            part = held[np.searchsorted(held, some[0]) : np.searchsorted(held, some[-1], "right")]
            at = np.searchsorted(some, part)
            cells[row, at[some[at] == part]] = 1
        common += cells @ cells.T
    return common


def chunk_links(sets: np.ndarray, roots: np.ndarray, hashes: list[np.ndarray], least: float):
    """Links that join all roots which sets of a similarity of `least` or more join."""
    common = common_shingles(hashes)
    sizes = np.array([len(h) for h in hashes], np.float64)
    group = np.unique(roots, return_inverse=True)[1]
    joins = np.arange(group.max() + 1)
    a, b = [], []
    for row in range(len(sets)):
        shared = common[row].astype(np.float64)
        others = np.flatnonzero(shared >= least * (sizes[row] + sizes - shared))
        others = others[joins[group[others]] != joins[group[row]]]
        # One set of each group that is still apart.
        others = others[np.unique(joins[group[others]], return_index=True)[1]]
        a += [sets[row]] * len(others)
        b += sets[others].tolist()
        joins = joined(joins, np.full(len(others), group[row]), group[others])
    return np.array(a, np.int64), np.array(b, np.int64)


def chunks_compared(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """Links a, b from comparing all `sets` of the two chunks of each of the pairs a, b."""

    def found(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        whole = pa.Table.from_batches(parts)
        ids, roots = (whole.column(c).to_numpy() for c in ("shingles", "root"))
        hashes = [np.frombuffer(h, "<u8") for h in whole.column("hashes").to_pylist()]
        return pa.RecordBatch.from_arrays([pa.array(x) for x in chunk_links(ids, roots, hashes, least)], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(c).to_numpy() for c in "ab"], axis=1)
            edges = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            starts = [0, *edges.tolist()]
            for at, end in zip(starts, [*starts[1:], len(keys)]):
                key = tuple(keys[at].tolist())
                if held and key != last:
                    yield found(held)
                    held = []
                last = key
                held.append(batch.slice(at, end - at))
        if held:
            yield found(held)

    sides = pairs.select("a", "b", F.explode(F.array_distinct(F.array("a", "b"))).alias("chunk"))
    rows = sides.join(sets, "chunk").select("a", "b", "shingles", "root", "hashes")
    return rows.repartition("a", "b").sortWithinPartitions("a", "b").mapInArrow(run, "a long, b long")


def copies(docs: DataFrame, described: DataFrame, size: int, least: float) -> DataFrame:
    """Links a, b that join all shingle sets found to be similar by `least` or more.

    First pairs that join the blocks are verified, so a large group of near copies
    becomes one root without all of its pairs; then chunks in which two roots may have
    another pair are compared.
    """
    sets = cut(described.groupBy("shingles").agg(F.min("_row").alias("_row"), F.min("sketch").alias("sketch")))
    bands = layout(sets.count())
    joining = cut(candidates(dealt(sets, bands, False), False))
    suspects = joining.select(F.col("a").alias("shingles")).union(joining.select("b")).distinct()
    hashes = cut(shingle_sets(docs, sets.join(suspects, "shingles").select("shingles", "_row"), size))
    found = cut(verified(joining, hashes, least))
    # Only a set with a joining pair can have another pair.
    clusters = components(joining).select(F.col("node").alias("shingles"), F.col("root").alias("cluster"))
    roots = components(found).withColumnRenamed("node", "shingles")
    placed = cut(
        chunked(clusters, hashes)
        .join(roots, "shingles", "left")
        .select("shingles", "chunk", F.coalesce("root", "shingles").alias("root"))
    )
    pairs = candidates(dealt(placed.join(sets.select("shingles", "sketch"), "shingles"), bands, True), True)
    return found.union(cut(chunks_compared(cut(pairs), placed.join(hashes, "shingles"), least)))


def deduplicated(docs: DataFrame, size: int, radius: int, least: float) -> DataFrame:
    """One row of `docs` for each group of near copies: that of least doc_id, NULL last.

    Rows are near copies where their fingerprints differ in `radius` bits at most or
    their sets of `size`-word shingles have a Jaccard similarity of `least` or more.
    Of rows that differ and share that doc_id one is taken by a hash of the row, and
    of repeated rows one is left.
    """
    columns = docs.columns
    hashed = docs.withColumn("_row", F.xxhash64(*columns))
    described = cut(descriptions(hashed, size))
    of_set = described.groupBy("shingles").agg(F.min("fingerprint").alias("least"))
    same = described.join(of_set, "shingles").select(F.col("fingerprint").alias("a"), F.col("least").alias("b")).filter("a != b")
    similar = copies(hashed, described, size, least)
    for end in "ab":
        similar = similar.join(of_set.select(F.col("shingles").alias(end), F.col("least").alias(f"{end}_print")), end)
    similar = similar.select("a_print", "b_print")
    found = components(links(described, radius).union(same).union(similar)).withColumnRenamed("node", "fingerprint")
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_row")
    kept = (
        described.groupBy("fingerprint")
        .agg(F.min(place).alias("place"))
        .join(found, "fingerprint", "left")
        .groupBy(F.coalesce("root", "fingerprint").alias("root"))
        .agg(F.min("place").alias("place"))
        .select(F.col("place._row").alias("_row"))
    )
    return hashed.join(kept, "_row", "left_semi").dropDuplicates(["_row"]).select(*columns)
