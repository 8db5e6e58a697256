"""Merging batches into target tables.

All merges are plain joins and aggregates, so Spark picks the join: a small
batch is broadcast once its size is known, a large one is shuffled on the keys.
Batches are reduced to one row per key before they meet the target, with
partial aggregation ahead of the shuffle, so a key that holds a large share of
the batch does not land in one task.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.specs import SpecError

_PRESENT = "_in_batch"
# Which of several batches a row is of, and the value of a column that a batch has.
_SET, _VALUE = "_column_set", "_value"


class DuplicateKeys(ValueError):
    """A batch holds one key more than once."""


def _cols(names: Sequence[str]) -> list[Column]:
    return [F.col(f"`{n}`") for n in names]


def _require_keys(keys: Sequence[str], df: DataFrame) -> None:
    if not keys:
        raise SpecError("upsert needs key columns")
    missing = [k for k in keys if k not in df.columns]
    if missing:
        raise SpecError(f"key columns not in the batch: {', '.join(missing)}")


def has_all_keys(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [c.isNotNull() for c in _cols(keys)])


def _split_null_keys(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame | None]:
    """Rows with whole keys, and the others, which never conflict with any row."""
    nullable = [k for k in keys if df.schema[k].nullable]
    if not nullable:
        return df, None
    whole = has_all_keys(nullable)
    return df.where(whole), df.where(~whole)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their counts."""
    return (
        df.groupBy(*_cols(keys)).agg(F.count(F.lit(1)).alias("occurrences")).where("occurrences > 1")
    )


def require_unique(df: DataFrame, keys: Sequence[str]) -> None:
    whole, _ = _split_null_keys(df, keys)
    if not duplicate_keys(whole, keys).isEmpty():
        raise DuplicateKeys(f"the batch holds duplicate keys on ({', '.join(keys)})")


def last_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of every key by a total order, order columns dropped.

    An aggregate rather than a window: each task first keeps one row per key.
    Without order columns the greatest values win, so the result is the same on
    every run.
    """
    values = [c for c in df.columns if c not in keys and c not in order]
    kept = [c for c in df.columns if c not in order]
    if not values:
        return df.select(*_cols(keys)).distinct().select(*_cols(kept))
    last = F.max_by(F.struct(*_cols(values)), F.struct(*_cols(order or values)))
    rows = df.groupBy(*_cols(keys)).agg(last.alias("_last"))
    return rows.select(*_cols(keys), "_last.*").select(*_cols(kept))


def one_per_key(
    batch: DataFrame, keys: Sequence[str], order: Sequence[str], on_duplicate: str = "last"
) -> DataFrame:
    """Batch with unique keys: the last row wins, or duplicates are an error.

    Rows with a NULL in a key all stay, since NULLs never conflict.
    """
    _require_keys(keys, batch)
    if on_duplicate == "error":
        require_unique(batch, keys)
        return batch.select(*_cols([c for c in batch.columns if c not in order]))
    whole, rest = _split_null_keys(batch, keys)
    rows = last_per_key(whole, keys, order)
    return rows if rest is None else rows.unionByName(rest.select(*_cols(rows.columns)))


def last_present_per_key(
    batches: Sequence[DataFrame],
    keys: Sequence[str],
    order: Sequence[str],
    on_duplicate: str = "last",
) -> DataFrame:
    """Batches of different columns as one row per key, each column with its last value.

    Only rows of batches that have a column count for it, NULLs of theirs included, so the
    result is that of merging row after row in order. A column is a struct of its value,
    or NULL where no row of the key has it. With ``on_duplicate="error"`` a key may occur
    once in each batch. Rows with a NULL key stay as they are.
    """
    for batch in batches:
        _require_keys(keys, batch)
    every = list(dict.fromkeys(c for b in batches for c in b.columns if c not in order))
    values = [c for c in every if c not in keys]
    marked = [b.withColumn(_SET, F.lit(i)) for i, b in enumerate(batches)]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), marked)
    if on_duplicate == "error":
        require_unique(rows, [*keys, _SET])
    has = {c: F.col(_SET).isin([i for i, b in enumerate(batches) if c in b.columns]) for c in values}
    whole, rest = _split_null_keys(rows, keys)
    place = F.struct(*_cols(order))
    last = [
        F.max_by(F.struct(F.col(f"`{c}`").alias(_VALUE)), F.when(has[c], place)).alias(c) for c in values
    ]
    grouped = whole.groupBy(*_cols(keys))
    found = grouped.agg(*last) if last else whole.select(*_cols(keys)).distinct()
    if rest is None:
        return found
    as_is = [F.when(has[c], F.struct(F.col(f"`{c}`").alias(_VALUE))).alias(c) for c in values]
    return found.unionByName(rest.select(*_cols(keys), *as_is))


def insert(target: DataFrame, batch: DataFrame) -> DataFrame:
    """Append; columns the batch lacks are NULL."""
    unknown = [c for c in batch.columns if c not in target.columns]
    if unknown:
        raise SpecError(f"columns not in the target: {', '.join(unknown)}")
    return target.unionByName(batch, allowMissingColumns=True)


def upsert(
    target: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    order: Sequence[str] = (),
    on_duplicate: str = "last",
) -> DataFrame:
    """Insert new keys and update known ones.

    On a known key every column of the batch replaces the target's, NULLs
    included; columns the batch lacks keep the target's value. A batch of key
    columns alone changes nothing on a known key.
    """
    _require_keys(keys, batch)
    whole, keyless = _split_null_keys(batch, keys)
    rows = one_per_key(whole, keys, order, on_duplicate)
    if keyless is not None:
        keyless = keyless.select(*_cols(rows.columns))
    return _merge(target, rows, keyless, keys)


def upsert_unique(target: DataFrame, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``upsert`` of a batch that holds every key once, NULL keys aside."""
    _require_keys(keys, rows)
    return _merge(target, *_split_null_keys(rows, keys), keys)


def upsert_present(target: DataFrame, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Merge rows of ``last_present_per_key``; a column that a key lacks keeps its value."""
    unknown = [c for c in rows.columns if c not in target.columns]
    if unknown:
        raise SpecError(f"columns not in the target: {', '.join(unknown)}")
    rows, keyless_rows = _split_null_keys(rows, keys)
    keyed, keyless = _split_null_keys(target, keys)
    values = [c for c in rows.columns if c not in keys]

    def plain(df: DataFrame) -> DataFrame:
        return df.select(*_cols(keys), *[F.col(f"`{c}`.{_VALUE}").alias(c) for c in values])

    t, b = keyed.alias("t"), rows.alias("b")
    same = [F.col(f"t.`{k}`") == F.col(f"b.`{k}`") for k in keys]
    columns = [
        F.when(F.col(f"b.`{c}`").isNotNull(), F.col(f"b.`{c}`.{_VALUE}")).otherwise(F.col(f"t.`{c}`")).alias(c)
        if c in values
        else F.col(f"t.`{c}`")
        for c in target.columns
    ]
    updated = t.join(b, same, "left").select(*columns)
    merged = insert(updated, plain(_new_rows(keyed, rows, keys)))
    if keyless is not None:
        merged = merged.unionByName(keyless)
    return merged if keyless_rows is None else insert(merged, plain(keyless_rows))


def _merge(
    target: DataFrame, rows: DataFrame, keyless_rows: DataFrame | None, keys: Sequence[str]
) -> DataFrame:
    unknown = [c for c in rows.columns if c not in target.columns]
    if unknown:
        raise SpecError(f"columns not in the target: {', '.join(unknown)}")
    # Rows with a NULL key match nothing; left in the joins they would all hash
    # to one partition, so on both sides they go around them.
    keyed, keyless = _split_null_keys(target, keys)
    updated = [c for c in rows.columns if c not in keys]
    if not updated:
        merged = insert(target, _new_rows(keyed, rows, keys))
        keyless = None
    elif set(rows.columns) == set(target.columns):
        kept = keyed.join(rows.select(*_cols(keys)), list(keys), "left_anti")
        merged = kept.select(*_cols(target.columns)).unionByName(rows)
    else:
        merged = _upsert_some_columns(keyed, rows, keys, updated)
    if keyless is not None:
        merged = merged.unionByName(keyless)
    return merged if keyless_rows is None else insert(merged, keyless_rows)


def _new_rows(target: DataFrame, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of the batch whose key the target lacks.

    Only key columns of the target are read, and a small batch is broadcast to
    them, so the target is not shuffled.
    """
    key_columns = _cols(keys)
    known = target.select(*key_columns).join(rows.select(*key_columns), list(keys), "left_semi")
    return rows.join(known, list(keys), "left_anti")


def _upsert_some_columns(
    target: DataFrame, rows: DataFrame, keys: Sequence[str], updated: Sequence[str]
) -> DataFrame:
    """Update some columns by a flag that says whether the batch has the key.

    The flag, not the value, decides, so a NULL in the batch overwrites.
    """
    t, b = target.alias("t"), rows.withColumn(_PRESENT, F.lit(True)).alias("b")
    same = [F.col(f"t.`{k}`") == F.col(f"b.`{k}`") for k in keys]
    joined = t.join(b, same, "left")
    columns = [
        (
            F.when(F.col(f"b.{_PRESENT}"), F.col(f"b.`{c}`")).otherwise(F.col(f"t.`{c}`"))
            if c in updated
            else F.col(f"t.`{c}`")
        ).alias(c)
        for c in target.columns
    ]
    return insert(joined.select(*columns), _new_rows(target, rows, keys))


def truncate_insert(
    batch: DataFrame, target_columns: Sequence[str], file_column: str | None = None
) -> DataFrame:
    """Rows of a table that was emptied and filled with the batch.

    With ``file_column`` the table is emptied before every file, which leaves
    the rows of the last file key only.
    """
    if file_column is not None:
        last = batch.agg(F.max(f"`{file_column}`").alias("_last_file"))
        # One row, so broadcasting it is always safe.
        batch = batch.join(
            F.broadcast(last), F.col(f"`{file_column}`") == F.col("_last_file"), "left_semi"
        )
    have = set(batch.columns)
    return batch.select(
        *[F.col(f"`{c}`") if c in have else F.lit(None).alias(c) for c in target_columns]
    )
