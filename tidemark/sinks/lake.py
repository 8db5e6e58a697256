"""Target tables kept as Parquet folders with a commit log and manifests.

Rows go to a new folder first; a row in the ledger then makes the folder part
of the table. It names a manifest, the list of all live files with their buckets,
rows and bytes, so a reader needs the last commit only and lists no folder.
Nothing that is being read is ever overwritten, and a run that dies half way
leaves folders that no reader looks at. Tables with keys are laid out by a hash
bucket of the keys, so an upsert reads and rewrites only the buckets its batch
touches.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.paths import file_key
from tidemark.operators import merge
from tidemark.session import configure
from tidemark.sinks.ledger import Ledger, utc_now
from tidemark.sources.files import FILE_PATH, child_names, delete_folder, qualify
from tidemark.sources.tables import MissingTable

BUCKET = "_bucket"

MANIFEST = (
    T.StructType().add("bucket", T.IntegerType()).add("path", T.StringType()).add("n_rows", T.LongType()).add("bytes", T.LongType())
)

# Turns a table and a batch of unique keys into the table after the batch.
Merge = Callable[[DataFrame, DataFrame, Sequence[str]], DataFrame]

# Bucket of the rows with a NULL in a key: they never conflict, so upserts only
# ever add to it.
KEYLESS = -1


def bucket_of(keys: Sequence[str], n_buckets: int) -> Column:
    columns = [F.col(f"`{k}`") for k in keys]
    bucket = F.pmod(F.xxhash64(*columns), F.lit(n_buckets)).cast("int")
    return F.when(merge.has_all_keys(keys), bucket).otherwise(KEYLESS)


class LakeTargets:
    def __init__(
        self, spark: SparkSession, root: str, ledger: Ledger, n_buckets: int = 256
    ) -> None:
        self.spark, self.root, self.ledger = configure(spark), root.rstrip("/"), ledger
        self.n_buckets = n_buckets

    # reading

    def exists(self, table: str) -> bool:
        return self.ledger.last_commit(table) is not None

    def _head(self, table: str):
        """The last commit of a table, which names its manifest; None without a table."""
        last = self.ledger.last_commit(table)
        if last is None or last["manifest"] is not None or last["schema_json"] is not None:
            return last
        # Written before there were manifests: only its first commit says what the table is.
        return self.ledger.commits(table)[0]

    def _state(self, table: str):
        head = self._head(table)
        if head is None:
            raise MissingTable(f"target table {table} does not exist")
        return head

    def schema(self, table: str) -> T.StructType | None:
        """Schema of a table; None if there is no such table."""
        head = self._head(table)
        return T.StructType.fromJson(_json(head["schema_json"])) if head else None

    def files(self, table: str) -> DataFrame:
        """Live files of a table: bucket, path (below the table), n_rows, bytes."""
        return self._files(self._state(table))

    def _files(self, head) -> DataFrame:
        if head["manifest"] is not None:
            return self.spark.read.schema(MANIFEST).parquet(self._path(head["table_name"], head["manifest"]))
        return self._listed_by_commits(head)

    def _no_files(self) -> DataFrame:
        nothing = self.spark.range(0, 0, 1, 1)
        return nothing.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in MANIFEST.fields])

    def _listed_by_commits(self, head) -> DataFrame:
        """Live files of a table without a manifest, from the folders of its commits."""
        live = self._no_files()
        for commit in self.ledger.commits(head["table_name"]):
            live = live.where(~_in_buckets(commit["buckets"])) if commit["kind"] == "rewrite" else live
            live = live.unionByName(self._written(head, commit["folders"]))
        return live

    def _written(self, head, folders: Sequence[str]) -> DataFrame:
        """Files of new folders; rows are counted by their footers."""
        if not folders:
            return self._no_files()
        table, schema = head["table_name"], T.StructType.fromJson(_json(head["schema_json"]))
        base = qualify(self.spark, f"{self.root}/{table}")
        paths = [self._path(table, f) for f in folders]
        scan = self.spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(*paths)
        found = scan.groupBy(
            F.col("_metadata.file_path").alias(FILE_PATH), F.col("_metadata.file_size").alias("bytes")
        ).agg(F.count(F.lit(1)).alias("n_rows"))
        key = file_key(F.col(FILE_PATH), base)
        bucket = F.regexp_extract(key, f"/{BUCKET}=(-?\\d+)/", 1)
        return found.select(
            F.when(bucket != "", bucket.cast("int")).alias("bucket"),
            key.alias("path"),
            "n_rows",
            "bytes",
        )

    def read(self, table: str, buckets: Sequence[int] | None = None) -> DataFrame:
        """Rows of the table, or of some of its buckets: one scan of live files."""
        return self._scan(self._state(table), buckets)

    def _scan(self, head, buckets: Sequence[int] | None = None) -> DataFrame:
        """Rows of a commit's files, whose names are on the driver as for any scan."""
        schema = T.StructType.fromJson(_json(head["schema_json"]))
        files = self._files(head)
        if buckets is not None and head["n_buckets"]:
            files = files.where(_in_buckets(buckets))
        paths = sorted(self._path(head["table_name"], r["path"]) for r in files.select("path").collect())
        if not paths:
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.schema(schema)
        return reader.option("recursiveFileLookup", "true").parquet(*paths)

    # writing

    def _stage(self, table: str, df: DataFrame, keys: Sequence[str], n_buckets: int) -> str:
        """Write rows to a folder no reader knows yet."""
        folder = f"data-{uuid.uuid4().hex}"
        path = self._path(table, folder)
        if n_buckets:
            # Rebalancing lets Spark split a bucket that is too large and join
            # small ones, so files stay near one size.
            df = df.withColumn(BUCKET, bucket_of(keys, n_buckets)).hint("rebalance", BUCKET)
            df.write.partitionBy(BUCKET).parquet(path)
        else:
            df.write.parquet(path)
        return folder

    def _path(self, table: str, folder: str) -> str:
        return f"{self.root}/{table}/{folder}"

    def _commit(
        self,
        head,
        kind: str,
        commit_id: str | None,
        folders: Sequence[str],
        buckets: Sequence[int] = (),
    ) -> None:
        """Make folders part of a table, by a manifest of all files that then live.

        An append adds to the files of the commit before, a rewrite takes the place of
        its buckets, a replacement of all.
        """
        table = head["table_name"]
        live = self._written(head, folders)
        if kind == "append":
            live = self._files(head).unionByName(live)
        elif kind == "rewrite":
            live = self._files(head).where(~_in_buckets(buckets)).unionByName(live)
        # A new table has no file and needs no manifest to say so.
        manifest = f"manifest-{uuid.uuid4().hex}" if kind != "create" else None
        if manifest is not None:
            live.coalesce(1).write.parquet(self._path(table, manifest))
        self.ledger.append_row(
            "commits",
            table_name=table,
            commit_id=commit_id or uuid.uuid4().hex,
            kind=kind,
            committed_at=utc_now(),
            op="set",
            folders=list(folders),
            buckets=list(buckets),
            keys=list(head["keys"]),
            n_buckets=head["n_buckets"],
            schema_json=head["schema_json"],
            manifest=manifest,
        )

    def create(self, table: str, schema: T.StructType, keys: Sequence[str] = ()) -> None:
        head = {
            "table_name": table,
            "keys": keys,
            "n_buckets": self.n_buckets if keys else 0,
            "schema_json": _nullable(schema).json(),
        }
        self._commit(head, "create", None, [])

    def insert(self, table: str, batch: DataFrame, commit_id: str | None = None) -> None:
        head = self._state(table)
        self._commit(head, "append", commit_id, [self._stage_rows(head, batch)])

    def _stage_rows(self, head, batch: DataFrame) -> str:
        schema = T.StructType.fromJson(_json(head["schema_json"]))
        rows = merge.insert(self.spark.createDataFrame([], schema), batch)
        return self._stage(head["table_name"], rows, head["keys"], head["n_buckets"])

    def stage(self, table: str, batch: DataFrame) -> str:
        """Write rows that a later ``replace`` puts in place."""
        return self._stage_rows(self._state(table), batch)

    def replace(self, table: str, folders: Sequence[str], commit_id: str | None = None) -> None:
        """Make staged folders the whole table."""
        self._commit(self._state(table), "replace", commit_id, folders)

    def compact(self, table: str) -> None:
        """Rewrite a table into one folder. No load may run beside; `vacuum` after."""
        self.replace(table, [self.stage(table, self.read(table))])

    def compact_worst(self, table: str, files_allowed: int = 8, buckets_at_once: int = 64) -> int:
        """Rewrite the buckets of most files, if these are more than allowed; their number.

        The manifest tells which, so nothing is listed, and other buckets are neither
        read nor written. A table without buckets is rewritten whole. No load may run
        beside; `vacuum` after.
        """
        head = self._state(table)
        many = self._files(head).groupBy("bucket").agg(F.count("*").alias("n")).where(F.col("n") > files_allowed)
        worst = [r["bucket"] for r in many.orderBy(F.desc("n"), "bucket").limit(buckets_at_once).collect()]
        if not worst:
            return 0
        if head["n_buckets"]:
            folder = self._stage_rows(head, self._scan(head, worst))
            self._commit(head, "rewrite", None, [folder], worst)
        else:
            self.compact(table)
        return len(worst)

    def vacuum(self, table: str) -> int:
        """Delete folders without a live file; their number. No load may run beside.

        Manifests but the last go too.
        """
        head = self._state(table)
        folder = F.split_part("path", F.lit("/"), F.lit(1))
        live = {r["folder"] for r in self._files(head).select(folder.alias("folder")).distinct().collect()}
        names = child_names(self.spark, f"{self.root}/{table}")
        dead = [n for n in names if n.startswith("data-") and n not in live]
        old = [n for n in names if n.startswith("manifest-") and head["manifest"] is not None and n != head["manifest"]]
        for name in (*dead, *old):
            delete_folder(self.spark, self._path(table, name))
        return len(dead)

    def upsert(
        self,
        table: str,
        batch: DataFrame,
        keys: Sequence[str],
        order: Sequence[str] = (),
        on_duplicate: str = "last",
        commit_id: str | None = None,
    ) -> None:
        """Merge a batch; it is reduced to one row per key and written once first.

        The merge reads the batch several times. From files it is read cheaply,
        its size is known when Spark picks the join, and its folders say which
        buckets of the target have to be read and written again.
        """
        rows = merge.one_per_key(batch, keys, order, on_duplicate)
        self._rewrite(table, rows, keys, merge.upsert_unique, commit_id)

    def upsert_all(
        self,
        table: str,
        batches: Sequence[DataFrame],
        keys: Sequence[str],
        order: Sequence[str],
        on_duplicate: str = "last",
        commit_id: str | None = None,
    ) -> None:
        """Merge batches that have different columns, in one rewrite.

        For each key and column the last value by `order` counts among the rows whose
        batch has the column; a column that none of them has keeps the table's value.
        """
        if len(batches) == 1:
            return self.upsert(table, batches[0], keys, order, on_duplicate, commit_id)
        rows = merge.last_present_per_key(batches, keys, order, on_duplicate)
        self._rewrite(table, rows, keys, merge.upsert_present, commit_id)

    def _rewrite(self, table: str, rows: DataFrame, keys: Sequence[str], merged_with: Merge, commit_id: str | None) -> None:
        """Stage rows of unique keys, then write the buckets they fall into anew."""
        head = self._state(table)
        bucketed = head["n_buckets"] and list(head["keys"]) == list(keys)
        staged = self._stage(table, rows, keys, head["n_buckets"] if bucketed else 0)
        staged_path = self._path(table, staged)
        touched = None
        if bucketed:
            touched = [b for b in _buckets_in(self.spark, staged_path) if b != KEYLESS]
        reader = self.spark.read.schema(_nullable(rows.schema))
        rows = reader.option("recursiveFileLookup", "true").parquet(staged_path)
        merged = merged_with(self._scan(head, touched), rows, keys)
        folder = self._stage(table, merged, head["keys"], head["n_buckets"])
        if bucketed:
            self._commit(head, "rewrite", commit_id, [folder], touched)
        else:
            self._commit(head, "replace", commit_id, [folder])
        delete_folder(self.spark, staged_path)


def _json(text: str) -> dict:
    import json

    return json.loads(text)


def _nullable(schema: T.StructType) -> T.StructType:
    """The schema as Parquet readers will report it."""
    return T.StructType([T.StructField(f.name, f.dataType, True, f.metadata) for f in schema])


def _in_buckets(buckets: Sequence[int]) -> Column:
    """Whether a file is in one of the buckets; files without a bucket are in none."""
    return F.coalesce(F.col("bucket").isin(list(buckets)), F.lit(False))


def _buckets_in(spark: SparkSession, path: str) -> list[int]:
    prefix = f"{BUCKET}="
    return [int(n[len(prefix):]) for n in child_names(spark, path) if n.startswith(prefix)]
