"""Prefix trie of conversations by collapse of whole sequences.

Identical conversations become one weighted sequence before any prefix is made. Only
the turns of distinct sequences are expanded into prefixes, whose weights add up to the
members of a node. Sequences that are a proper beginning of another are found by an
anti-join; the others are the leaves.

A turn's place, role and text are hashed to 120 bits; a prefix is known by the exclusive
or of its turns' hashes, which a running window gives without gathering a conversation.
Everything is joined on the key of a node or of a sequence, of which each side has one
row; the one join with a hot side, children with their parent, comes last, where Spark
splits it at run time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import cut

WORD = r"[^\x20\x09-\x0D]+"

# Conversation ids of one number above these bits are joined to a text at a time.
BLOCK_BITS = 12

KEY = ("hi", "lo")


def numbered(turns: DataFrame) -> DataFrame:
    """conv_id, n, role, text: turns by number from 1.

    They are ordered by turn, NULL first, then by role and text; NULL roles and texts are
    empty. Rows without conv_id belong to no conversation.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = turns.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), text.alias("text")
    )
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    return rows.select("conv_id", F.row_number().over(order).alias("n"), "role", "text")


def borrowed_turns(conv_id: Column) -> Column:
    """How many turns a conversation takes from the first of its twenty."""
    return F.crc32(conv_id.cast("string").cast("binary")) % 4


def rebuilt(turns: DataFrame) -> DataFrame:
    """conv_id, part, n, role, text of numbered turns with their borrowed beginnings.

    Part 0 are the first turns of conversation c - c % 20, part 1 the conversation's own
    after as many, part 2 one row without turn for each conversation. Parts and numbers
    order a conversation; numbers need not follow one another.
    """
    own = turns.filter(F.col("n") > borrowed_turns(F.col("conv_id"))).select("conv_id", F.lit(1).alias("part"), "n", "role", "text")
    ids = turns.filter(F.col("n") == 1).select("conv_id")
    first = turns.filter((F.col("conv_id") % 20 == 0) & (F.col("n") <= 3)).select(
        F.col("conv_id").alias("first_id"), "n", "role", "text"
    )
    asked = ids.select("conv_id", (F.col("conv_id") - F.col("conv_id") % 20).alias("first_id"), borrowed_turns(F.col("conv_id")).alias("h"))
    lent = asked.join(first, "first_id").filter(F.col("n") <= F.col("h")).select("conv_id", F.lit(0).alias("part"), "n", "role", "text")
    ends = ids.select("conv_id", F.lit(2).alias("part"), F.lit(0).alias("n"), F.lit("").alias("role"), F.lit("").alias("text"))
    return lent.unionByName(own).unionByName(ends)


def words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def keyed(rows: DataFrame) -> DataFrame:
    """conv_id, depth, key, parent key and words of every turn and of the end of each conversation.

    `rows` as `rebuilt` gives them. The end has the depth and key of the last turn, and
    `ends` true.
    """
    # Words and digests are taken before the window, so that no text is sorted again.
    short = rows.select(
        "conv_id",
        "part",
        "n",
        (F.col("part") == 2).alias("ends"),
        words(F.col("text")).alias("words"),
        F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"), 256).alias("turn"),
    )
    order = Window.partitionBy("conv_id").orderBy("part", "n")
    placed = short.withColumn("depth", F.row_number().over(order))
    digest = F.sha2(F.concat_ws(":", "depth", "turn").cast("binary"), 256)
    hashed = placed.withColumns(
        {
            "depth": F.when(F.col("ends"), F.col("depth") - 1).otherwise(F.col("depth")).cast("long"),
            **{
                c: F.when(F.col("ends"), F.lit(0)).otherwise(F.conv(F.substring(digest, at, 15), 16, 10).cast("long"))
                for c, at in zip(KEY, (1, 16))
            },
        }
    )
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    keys = hashed.withColumns({f"key_{c}": F.bit_xor(c).over(so_far) for c in KEY})
    return keys.select(
        "conv_id",
        "depth",
        "ends",
        "words",
        F.struct(*(F.col(f"key_{c}").alias(c) for c in KEY)).alias("key"),
        F.struct(*(F.col(f"key_{c}").bitwiseXOR(F.col(c)).alias(c) for c in KEY)).alias("parent"),
    )


def ends_digests(ends: DataFrame) -> DataFrame:
    """key, ends_sha256: digest of the ids of the conversations of one key, ascending.

    `ends` has conv_id and key. Ids become texts block by block, each of bounded size,
    which one pass in order feeds to the digest: a hot key's list is never held.
    """
    blocks = (
        ends.groupBy("key", F.shiftright("conv_id", BLOCK_BITS).alias("block"))
        .agg(F.array_join(F.array_sort(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids"))
        .repartition("key")
        .sortWithinPartitions("key", "block")
        .select(F.col("key.hi").alias("hi"), F.col("key.lo").alias("lo"), "ids")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, digest = None, None
        for batch in batches:
            done = []
            for hi, lo, ids in zip(*(c.to_pylist() for c in batch.columns)):
                if (hi, lo) == at:
                    digest.update(b",")
                else:
                    if at is not None:
                        done.append((*at, digest.hexdigest()))
                    at, digest = (hi, lo), hashlib.sha256()
                digest.update(ids.encode())
            yield made(done)
        if at is not None:
            yield made([(*at, digest.hexdigest())])

    def made(rows: list[tuple[int, int, str]]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.string())
        columns = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
        return pa.RecordBatch.from_arrays(columns, names=["hi", "lo", "ends_sha256"])

    found = blocks.mapInArrow(run, "hi long, lo long, ends_sha256 string")
    return found.select(F.struct("hi", "lo").alias("key"), "ends_sha256")


def trie(rows: DataFrame) -> DataFrame:
    """The nodes of the prefix trie over rebuilt conversations.

    `rows` as `rebuilt` gives them. One row for each distinct beginning, the root
    included: conv_id (least member), depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256. No conversation, no node.
    """
    turns = cut(keyed(rows))
    ends = turns.filter("ends").select("conv_id", "key", "depth")
    sequences = cut(ends.groupBy("key").agg(F.min("conv_id").alias("sequence"), F.count("*").alias("weight"), F.first("depth").alias("size")))

    # Beginnings of distinct sequences only, the root (depth 0) among them.
    chosen = sequences.select("sequence", "weight", "size")
    steps = turns.filter(~F.col("ends")).withColumnRenamed("conv_id", "sequence").drop("ends").join(chosen, "sequence")
    nothing = F.struct(F.lit(0).cast("long").alias("hi"), F.lit(0).cast("long").alias("lo"))
    roots = chosen.withColumns(
        {"depth": F.lit(0).cast("long"), "words": F.lit(0).cast("long"), "key": nothing, "parent": F.lit(None).cast("struct<hi:bigint,lo:bigint>")}
    )
    prefixes = cut(steps.unionByName(roots))

    inner = prefixes.filter(F.col("depth") < F.col("size")).select("key").distinct()
    leaves = sequences.join(inner, "key", "left_anti").select("sequence", F.lit(True).alias("leaf"))
    prefixes = cut(prefixes.join(leaves, "sequence", "left").withColumn("leaf", F.coalesce("leaf", F.lit(False))))

    nodes = cut(
        prefixes.groupBy("key").agg(
            F.min("sequence").alias("conv_id"),
            F.first("depth").alias("depth"),
            F.first("parent").alias("parent"),
            F.first("words").alias("words"),
            F.sum("weight").alias("n_convs"),
            F.count_if("leaf").alias("n_leaves"),
            F.min(F.when(F.col("leaf"), F.col("sequence"))).alias("owner"),
        )
    )

    # A node's saving belongs to the least leaf below it; the nodes of a leaf are the end
    # of its path. A beginning's total is the sum over its leaves of what they own from
    # there on.
    saving = (F.col("n_convs") - 1) * F.col("words")
    owned = nodes.select(F.col("owner").alias("sequence"), "depth", saving.alias("saving"), F.lit(None).cast("struct<hi:bigint,lo:bigint>").alias("key"))
    paths = prefixes.filter("leaf").select("sequence", "depth", F.lit(0).cast("long").alias("saving"), "key")
    downwards = Window.partitionBy("sequence").orderBy(F.desc("depth")).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    below = paths.unionByName(owned).select("key", F.sum("saving").over(downwards).alias("saving"))
    saved = below.filter(F.col("key").isNotNull()).groupBy("key").agg(F.sum("saving").alias("saved_tokens"))

    children = nodes.filter(F.col("depth") > 0).groupBy(F.col("parent").alias("key")).agg(F.count("*").alias("n_children"))
    empty = hashlib.sha256().hexdigest()
    full = (
        nodes.drop("words", "owner")
        .join(saved, "key", "left")
        .join(children, "key", "left")
        .join(ends_digests(ends), "key", "left")
        .withColumns({"n_children": F.coalesce("n_children", F.lit(0)), "ends_sha256": F.coalesce("ends_sha256", F.lit(empty))})
    )
    parents = nodes.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    return full.join(parents, "parent", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"
    )
