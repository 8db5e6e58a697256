"""Sharding by extendible hashing, with DataFrame functions only.

A directory indexed by the first bits of a row's hash names the shard of each row. A
bucket over the byte limit splits on one more bit, others stay as they are, until all
fit.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tidemark.llm.common import cut

# Bits of a row's hash: fifteen hexadecimal digits of an MD5 digest.
HASH_BITS = 60

# Bits that a round adds to the directory beyond those an even spread needs.
SPARE_BITS = 4

# Copies of a row that are ranked together.
RANKED_TOGETHER = 50_000


def row_hash(*columns: str) -> Column:
    """A long of HASH_BITS bits from the columns' texts, NULL as empty."""
    text = F.concat_ws("|", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")


def prefix(bits: Column, depth: Column) -> Column:
    """The first `depth` bits of a hash."""
    return F.call_function("shiftright", bits, (F.lit(HASH_BITS) - depth).cast("int"))


def directory(cells: DataFrame, base: int, depth: int, limit: int) -> DataFrame:
    """For each prefix of `depth` bits the depth of its bucket, NULL where none fits.

    `cells` has the prefixes with their bytes and the least and greatest hash. The
    sizes of all shorter prefixes from `base` on come from them; a bucket is the
    shortest that fits or holds one hash only.
    """
    at = F.explode(F.sequence(F.lit(base), F.lit(depth))).alias("depth")
    shorter = F.call_function("shiftright", F.col("cell"), (F.lit(depth) - F.col("depth")).cast("int"))
    every = cells.select("cell", "bytes", "low", "high", at).withColumn("prefix", shorter)
    sizes = every.groupBy("depth", "prefix").agg(
        F.sum("bytes").alias("bytes"), F.min("low").alias("low"), F.max("high").alias("high")
    )
    fits = sizes.filter((F.col("bytes") <= limit) | (F.col("low") == F.col("high"))).select("depth", "prefix")
    found = every.select("cell", "depth", "prefix").join(fits, ["depth", "prefix"])
    return found.groupBy("cell").agg(F.min("depth").alias("depth"))


def shard(rows: DataFrame, limit: int) -> DataFrame:
    """`rows` with their `shard` bits, `depth` and `page`; `hash` and `bytes` are given.

    Only a bucket over `limit` bytes is split. Rows of one hash cannot be told apart:
    where they exceed the limit, pages of as many of them as fit make it up. A row
    that is longer than the limit has a shard, or a page of one, to itself. An empty
    table has no shards. Columns named as an output are replaced.
    """
    rows = cut(rows.drop("shard", "depth", "page", "_cell", "_depth"))
    kept, base, done = rows.columns, 0, []
    pending = rows
    while True:
        total = pending.agg(F.sum("bytes")).first()[0]
        if base == 0:
            bits = math.ceil(math.log2(max(1, (total or 0) / limit)))
        else:
            cell = F.call_function("shiftright", F.col("hash"), F.lit(HASH_BITS - base))
            largest = pending.groupBy(cell).agg(F.sum("bytes").alias("b")).agg(F.max("b")).first()[0]
            bits = math.ceil(math.log2(max(1, (largest or 0) / limit)))
        depth = min(HASH_BITS, base + bits + SPARE_BITS)
        placed = pending.withColumn("_cell", prefix(F.col("hash"), F.lit(depth)))
        cells = placed.groupBy(F.col("_cell").alias("cell")).agg(
            F.sum("bytes").alias("bytes"), F.min("hash").alias("low"), F.max("hash").alias("high")
        )
        entries = directory(cells, base, depth, limit).select(F.col("cell").alias("_cell"), F.col("depth").alias("_depth"))
        found = cut(placed.join(entries, "_cell", "left").select(*kept, "_depth"))
        done.append(found.filter(F.col("_depth").isNotNull()))
        pending = found.filter(F.col("_depth").isNull()).select(*kept)
        base = depth
        if pending.isEmpty():
            break
    result = done[0]
    for part in done[1:]:
        result = result.union(part)
    bits = F.when(F.col("_depth") == 0, "").otherwise(F.lpad(F.bin(prefix(F.col("hash"), F.col("_depth"))), F.col("_depth"), F.lit("0")))
    named = result.select(*kept, bits.alias("shard"), F.col("_depth").cast("int").alias("depth"))
    return paged(named, limit)


def paged(rows: DataFrame, limit: int) -> DataFrame:
    """Adds `page`: 0, but where rows of one hash exceed the limit in their shard."""
    crowded = (
        rows.groupBy("shard")
        .agg(F.sum("bytes").alias("_bytes"), F.max("bytes").alias("_most"), F.count("*").alias("_n"))
        .filter((F.col("_bytes") > limit) & (F.col("_n") > 1))
        .select("shard", "_most", F.ceil(F.col("_n") / RANKED_TOGETHER).alias("_groups"))
    )
    # Rows of a crowded shard are alike, so any number does to deal them out.
    dealt = cut(
        rows.join(crowded, "shard").withColumn("_group", F.pmod(F.monotonically_increasing_id(), F.col("_groups")))
    )
    sizes = dealt.groupBy("shard", "_group").agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy("shard").orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("shard", "_group", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    ranked = dealt.withColumn("_rank", F.row_number().over(Window.partitionBy("shard", "_group").orderBy("hash")))
    each = F.greatest(F.lit(1), F.floor(F.lit(limit) / F.col("_most")))
    page = F.floor((F.col("_rank") + F.col("_before") - 1) / each).cast("long")
    split = ranked.join(before, ["shard", "_group"]).select(*rows.columns, page.alias("page"))
    rest = rows.join(crowded.select("shard"), "shard", "left_anti").select(*rows.columns, F.lit(0).cast("long").alias("page"))
    return rest.union(split)


def write(sharded: DataFrame, folder: str) -> None:
    """One folder for each shard and page, each written by one task."""
    sharded.repartition("shard", "page").write.partitionBy("shard", "page").parquet(folder)
