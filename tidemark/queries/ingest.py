"""File discovery, routing, ledger checks and ingest runs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.paths import file_key, first_component
from tidemark.operators import history, merge
from tidemark.operators.routing import route_files as route
from tidemark.plans.ingest import Ingest
from tidemark.plans.ingest import ingest_plan as plan_files
from tidemark.queries.common import Check, table
from tidemark.session import scratch_dir
from tidemark.sinks.lake import LakeTargets
from tidemark.sinks.ledger import Ledger
from tidemark.sources.files import discover_files as discover
from tidemark.sources.files import qualify, read_csv_text, read_files
from tidemark.sources.files import rows_per_file as count_rows
from tidemark.specs import IngestRoute, IngestSpec, Location
from tidemark.streaming.file_ingest import start_ingest

# The supplied tables.
TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

ROUTES = (
    IngestRoute("raw/*.csv", "landing", create_if_missing=True),
    IngestRoute("src1?/part-[0-4]*.parquet", "early_parts", ("doc_id",)),
    IngestRoute("**/*.fr.parquet", "french", create_if_missing=True),
)


def _file_of_document() -> F.Column:
    """File key of a document: below its source, at the top, or deep in ``raw``."""
    doc = F.col("doc_id").cast("string")
    lang = F.col("lang")
    return (
        F.when(lang == "en", F.concat("source", F.lit("/part-"), doc, F.lit(".parquet")))
        .when(lang == "fr", F.concat(F.lit("doc."), doc, F.lit(".fr.parquet")))
        .when(lang == "de", F.concat(F.lit("raw/de/"), "source", F.lit("/"), doc, F.lit(".csv")))
        .otherwise(F.concat("source", F.lit("."), doc, F.lit(".json")))
    )


def _files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", _file_of_document().alias("file_key"))


def _loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledger of loaded files: those of the documents that carry a label."""
    labels = table(spark, sf_dir, "labels").select("doc_id")
    return _files(spark, sf_dir).join(labels, "doc_id", "left_semi").select("file_key")


def route_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    routed = route(_files(spark, sf_dir), ROUTES)
    return routed.select("file_key", "target_table", "create_if_missing")


def unseen_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.unseen_files(_files(spark, sf_dir), _loaded(spark, sf_dir))


def ingest_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = IngestSpec(Location(path=sf_dir), pattern="**/*", tables=ROUTES)
    plan = plan_files(_files(spark, sf_dir), spec, _loaded(spark, sf_dir))
    return plan.select("file_key", "target_table", "create_if_missing").orderBy("file_key")


def ingest_unseen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of files not loaded yet, with the table they go to, on top of the loaded."""
    documents = table(spark, sf_dir, "documents").withColumn("file_key", _file_of_document())
    fresh = history.unseen_files(documents, _loaded(spark, sf_dir))
    rows = route(fresh, ROUTES).select("doc_id", "lang", "text", "target_table")
    before = documents.join(_loaded(spark, sf_dir), "file_key", "left_semi")
    return merge.insert(rows, before.select("doc_id", "lang", "text"))


def rows_per_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row count of every supplied table file (or folder of files)."""
    base = qualify(spark, sf_dir)
    counts = [count_rows(table(spark, sf_dir, t), base) for t in TABLES]
    every = reduce(DataFrame.unionByName, counts)
    return every.groupBy(first_component(F.col("file_key")).alias("file_key")).agg(
        F.sum("rows_ingested").alias("rows_ingested")
    )


def _write_documents(spark: SparkSession, sf_dir: str, name: str) -> str:
    """The documents as a tree of Parquet files, one folder per source and language."""
    root = scratch_dir(spark, name)
    documents = table(spark, sf_dir, "documents")
    documents.hint("rebalance", "source", "lang").write.partitionBy("source", "lang").parquet(
        f"{root}/in"
    )
    return root


def discover_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Folders of the files found below a tree of documents."""
    root = _write_documents(spark, sf_dir, "discover")
    found = discover(spark, Location(path=f"{root}/in"), "source=src1*/*/*.parquet")
    folder = F.regexp_extract("file_key", "^(.*)/[^/]*$", 1)
    return found.select(folder.alias("folder")).distinct()


def read_discovered_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file scan with keys, reduced to rows per folder."""
    root = _write_documents(spark, sf_dir, "scan")
    base = qualify(spark, f"{root}/in")
    rows = read_files(spark, [base], "parquet")
    per_file = rows.groupBy(F.col("_metadata.file_path").alias("uri")).agg(
        F.count(F.lit(1)).alias("documents"), F.sum("n_chars").alias("chars")
    )
    folder = F.regexp_extract(file_key(F.col("uri"), base), "^(.*)/[^/]*$", 1)
    return per_file.groupBy(folder.alias("folder")).agg(
        F.sum("documents").alias("documents"), F.sum("chars").alias("chars")
    )


def _run_ingest(spark: SparkSession, root: str, target: str, **spec) -> DataFrame:
    ledger = Ledger(spark, f"{root}/ledger")
    targets = LakeTargets(spark, f"{root}/lake", ledger, n_buckets=8)
    Ingest(spark, IngestSpec(Location(path=f"{root}/in"), **spec), targets, ledger).run()
    return targets.read(target)


def ingest_parquet_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_dir(spark, "ingest-parquet")
    table(spark, sf_dir, "lineitem").write.parquet(f"{root}/in/lineitem")
    routes = (IngestRoute("lineitem/*.parquet", "lines", create_if_missing=True),)
    return _run_ingest(spark, root, "public.lines", tables=routes)


def ingest_csv_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_dir(spark, "ingest-csv")
    orders = table(spark, sf_dir, "orders")
    orders.withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")).write.csv(
        f"{root}/in/orders", header=True
    )
    routes = (IngestRoute("orders/*.csv", "orders", create_if_missing=True),)
    return _run_ingest(spark, root, "public.orders", tables=routes, file_format="csv")


def ingest_csv_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts with quotes, commas and line breaks, through CSV files and back."""
    root = scratch_dir(spark, "ingest-csv-text")
    text = F.concat(F.lit('say "'), F.col("text"), F.lit('", and\n'), F.col("lang"), F.lit("\\"))
    docs = table(spark, sf_dir, "documents").select("doc_id", text.alias("text"), "n_chars")
    writer = docs.write.option("header", True).option("quote", '"').option("escape", '"')
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(f"{root}/in/docs")
    routes = (IngestRoute("docs/*.csv", "docs", create_if_missing=True),)
    return _run_ingest(spark, root, "public.docs", tables=routes, file_format="csv")


def csv_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as CSV files with line breaks, quotes and empty lines in their cells, read by splits.

    Each task writes the file of its own rows, so no task has more of the table than a split.
    """
    root = scratch_dir(spark, "csv-splits")
    text = F.concat(F.lit('"'), F.col("text"), F.lit('"\n\n,"",\r\n'), F.col("source"))
    docs = table(spark, sf_dir, "documents").select("doc_id", text.alias("text"), "lang")
    writer = docs.write.option("header", True).option("quote", '"').option("escape", '"')
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(f"{root}/in")
    read = read_csv_text(spark, [f"{root}/in"])
    return read.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang")


def ingest_upsert_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers, then a later folder of files that raises every balance."""
    root = scratch_dir(spark, "ingest-upsert")
    customers = table(spark, sf_dir, "customer")
    customers.write.parquet(f"{root}/in/customer/a")
    raised = customers.select("c_custkey", (F.col("c_acctbal") + 1).alias("c_acctbal"))
    raised.write.parquet(f"{root}/in/customer/b")
    routes = (IngestRoute("customer/*", "customer", ("c_custkey",), True),)
    return _run_ingest(spark, root, "public.customer", tables=routes, write_mode="upsert")


def ingest_mixed_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers in six files of changing columns, merged at once.

    Balances rise twice, names of some are given up in between, and new keys come with
    keys and segments only.
    """
    root = scratch_dir(spark, "ingest-mixed")
    customers = table(spark, sf_dir, "customer")
    balance, number = F.col("c_acctbal"), F.col("c_custkey")
    lots = (
        customers,
        customers.select("c_custkey", (balance + 1).alias("c_acctbal")),
        customers.where(number % 3 == 0).select("c_custkey", F.lit(None).cast("string").alias("c_name"), "c_mktsegment"),
        customers.where(number % 2 == 0).select("c_custkey", (balance + 2).alias("c_acctbal")),
        customers.where(number % 6 == 0),
        customers.select((-1 - number).alias("c_custkey"), F.upper("c_mktsegment").alias("c_mktsegment")),
    )
    for i, lot in enumerate(lots):
        lot.write.parquet(f"{root}/in/customer/{i}")
    routes = (IngestRoute("customer/*", "customer", ("c_custkey",), True),)
    return _run_ingest(spark, root, "public.customer", tables=routes, write_mode="upsert")


def compacted_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders upserted in lots that overlap, then only the buckets of most files rewritten."""
    root = scratch_dir(spark, "compacted")
    orders = table(spark, sf_dir, "orders")
    targets = LakeTargets(spark, f"{root}/lake", Ledger(spark, f"{root}/ledger"), n_buckets=8)
    targets.create("public.orders", orders.schema, ("o_orderkey",))
    number = F.col("o_orderkey")
    targets.upsert("public.orders", orders.where(number % 3 != 0), ("o_orderkey",))
    targets.insert("public.orders", orders.where(number % 3 == 0))
    targets.upsert("public.orders", orders.where(number % 5 == 0).withColumn("o_orderstatus", F.lit("X")), ("o_orderkey",))
    targets.insert("public.orders", orders.where(number < 100).withColumn("o_orderkey", F.lit(None).cast("long")))
    targets.compact_worst("public.orders", files_allowed=1, buckets_at_once=4)
    targets.vacuum("public.orders")
    return targets.read("public.orders")


def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of orders merged by a stream that stops when it has caught up."""
    root = scratch_dir(spark, "stream")
    orders = table(spark, sf_dir, "orders")
    orders.repartition(4, "o_orderkey").write.parquet(f"{root}/in")
    targets = LakeTargets(spark, f"{root}/lake", Ledger(spark, f"{root}/ledger"), n_buckets=8)
    targets.create("public.orders", orders.schema, ("o_orderkey",))
    spec = IngestSpec(Location(path=f"{root}/in"), write_mode="upsert")
    query = start_ingest(
        spark, spec, targets, "public.orders", f"{root}/checkpoint", ("o_orderkey",),
        files_per_trigger=2,
    )
    query.awaitTermination()
    return targets.read("public.orders")


def stream_upsert_some_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers by stream, then a later file of keys and balances only."""
    root = scratch_dir(spark, "stream-columns")
    customers = table(spark, sf_dir, "customer")
    targets = LakeTargets(spark, f"{root}/lake", Ledger(spark, f"{root}/ledger"), n_buckets=8)
    targets.create("public.customer", customers.schema, ("c_custkey",))
    spec = IngestSpec(Location(path=f"{root}/in"), write_mode="upsert")
    raised = customers.select("c_custkey", (F.col("c_acctbal") + 1).alias("c_acctbal"))
    for name, rows in (("a", customers), ("b", raised)):
        rows.write.parquet(f"{root}/in/{name}")
        start_ingest(
            spark, spec, targets, "public.customer", f"{root}/checkpoint", ("c_custkey",)
        ).awaitTermination()
    return targets.read("public.customer")


_FILES = """
    SELECT doc_id, CASE lang
        WHEN 'en' THEN source || '/part-' || doc_id || '.parquet'
        WHEN 'fr' THEN 'doc.' || doc_id || '.fr.parquet'
        WHEN 'de' THEN 'raw/de/' || source || '/' || doc_id || '.csv'
        ELSE source || '.' || doc_id || '.json' END AS file_key, lang, text
    FROM documents
"""
_ROUTED = r"""
    SELECT *, CASE
        WHEN regexp_matches(file_key, '^raw/.*\.csv$') THEN 'landing'
        WHEN regexp_matches(file_key, '^src1./part-[0-4].*\.parquet$') THEN 'early_parts'
        WHEN regexp_matches(file_key, '^(.*/)?[^/]*\.fr\.parquet$') THEN 'french'
        WHEN instr(file_key, '/') > 0 THEN split_part(file_key, '/', 1)
        ELSE regexp_replace(file_key, '\.[^.]*$', '') END AS target_table
    FROM files
"""
_CREATE = "target_table IN ('landing', 'french') AS create_if_missing"
_UNSEEN = """
    SELECT * FROM files f WHERE NOT EXISTS (
        SELECT 1 FROM files g JOIN labels l ON g.doc_id = l.doc_id WHERE g.file_key = f.file_key)
"""

CHECKS: dict[str, Check] = {
    "route_files": (
        route_files,
        f"WITH files AS ({_FILES}), routed AS ({_ROUTED}) "
        f"SELECT file_key, target_table, {_CREATE} FROM routed",
    ),
    "unseen_files": (
        unseen_files,
        f"WITH files AS ({_FILES}), fresh AS ({_UNSEEN}) SELECT file_key, doc_id FROM fresh",
    ),
    "ingest_plan": (
        ingest_plan,
        f"WITH files AS ({_FILES}), routed AS ({_ROUTED}), fresh AS ("
        + _UNSEEN.replace("FROM files f", "FROM routed f")
        + f") SELECT file_key, target_table, {_CREATE} FROM fresh",
    ),
    "ingest_unseen": (
        ingest_unseen,
        f"WITH files AS ({_FILES}), routed AS ({_ROUTED}) "
        "SELECT doc_id, lang, text, CASE WHEN doc_id NOT IN (SELECT doc_id FROM labels) "
        "THEN target_table END AS target_table FROM routed",
    ),
    "rows_per_file": (
        rows_per_file,
        " UNION ALL ".join(
            f"SELECT '{t}.parquet' AS file_key, count(*) AS rows_ingested FROM {t}" for t in TABLES
        ),
    ),
    "discover_files": (
        discover_files,
        "SELECT DISTINCT 'source=' || source || '/lang=' || lang AS folder "
        "FROM documents WHERE source LIKE 'src1%'",
    ),
    "read_discovered_files": (
        read_discovered_files,
        "SELECT 'source=' || source || '/lang=' || lang AS folder, count(*) AS documents, "
        "CAST(sum(n_chars) AS BIGINT) AS chars FROM documents GROUP BY 1",
    ),
    "ingest_parquet_rows": (ingest_parquet_rows, "SELECT * FROM lineitem"),
    "ingest_csv_rows": (ingest_csv_rows, "SELECT * FROM orders"),
    "ingest_csv_documents": (
        ingest_csv_documents,
        "SELECT doc_id, 'say \"' || text || '\", and' || chr(10) || lang || '\\' AS text, n_chars FROM documents",
    ),
    "csv_splits": (
        csv_splits,
        "SELECT doc_id, '\"' || text || '\"' || chr(10) || chr(10) || ',\"\",' || chr(13) || chr(10) || source AS text, lang FROM documents",
    ),
    "ingest_upsert_rows": (
        ingest_upsert_rows,
        "SELECT c_custkey, c_name, c_nationkey, c_acctbal + 1 AS c_acctbal, c_mktsegment "
        "FROM customer",
    ),
    "ingest_mixed_columns": (
        ingest_mixed_columns,
        """
        SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 AND c_custkey % 6 <> 0 THEN NULL ELSE c_name END AS c_name,
               c_nationkey,
               c_acctbal + CASE WHEN c_custkey % 6 = 0 THEN 0 WHEN c_custkey % 2 = 0 THEN 2 ELSE 1 END AS c_acctbal,
               c_mktsegment
        FROM customer
        UNION ALL
        SELECT -1 - c_custkey, NULL, NULL, NULL, upper(c_mktsegment) FROM customer
        """,
    ),
    "compacted_table": (
        compacted_table,
        """
        SELECT o.* REPLACE (CASE WHEN o_orderkey % 5 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus) FROM orders o
        UNION ALL
        SELECT o.* REPLACE (CAST(NULL AS BIGINT) AS o_orderkey) FROM orders o WHERE o_orderkey < 100
        """,
    ),
    "stream_ingest": (stream_ingest, "SELECT * FROM orders"),
    "stream_upsert_some_columns": (
        stream_upsert_some_columns,
        "SELECT c_custkey, c_name, c_nationkey, c_acctbal + 1 AS c_acctbal, c_mktsegment "
        "FROM customer",
    ),
}
