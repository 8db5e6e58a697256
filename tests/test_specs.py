import pytest

from tidemark.specs import (
    IngestRoute, IngestSpec, Location, SpecError, SyncSpec, TableSpec, check_incremental,
    parse_table_ref, select_table,
)

HERE = Location(path="/data")


def test_names():
    assert TableSpec("users").full_name == "users"
    assert TableSpec("users").qualified_name == "public.users"
    assert TableSpec("users", schema="sales").full_name == "sales.users"


def test_defaults():
    sync = SyncSpec(output=HERE)
    assert (sync.schema, sync.format, sync.exclude, sync.tables) == ("public", "parquet", (), None)
    ingest = IngestSpec(HERE)
    assert (ingest.file_format, ingest.write_mode, ingest.target_schema) == (
        "parquet", "insert", "public",
    )
    assert ingest.pattern == "**/*.parquet"
    assert IngestSpec(HERE, file_format="csv").pattern == "**/*.csv"


def test_locations():
    s3 = Location(bucket="lake", prefix="/raw/", region="eu-west-1", endpoint="http://store:9000")
    assert s3.uri == "s3a://lake/raw"
    assert s3.hadoop_options() == {
        "fs.s3a.bucket.lake.endpoint.region": "eu-west-1",
        "fs.s3a.bucket.lake.endpoint": "http://store:9000",
        "fs.s3a.bucket.lake.path.style.access": "true",
    }
    assert Location(bucket="lake").uri == "s3a://lake"
    assert HERE.hadoop_options() == {}
    with pytest.raises(SpecError):
        Location()
    with pytest.raises(SpecError):
        Location(path="/a", bucket="b")


@pytest.mark.parametrize(
    "kwargs, message",
    [
        (dict(format="iceberg"), "warehouse"),
        (dict(output=HERE, catalog="glue"), "glue_database"),
        (dict(), "output"),
        (dict(output=HERE, format="orc"), "format"),
        (dict(output=HERE, batch_size=0), "batch_size"),
    ],
)
def test_sync_spec_checks(kwargs, message):
    with pytest.raises(SpecError, match=message):
        SyncSpec(**kwargs)


def test_upsert_needs_keys():
    with pytest.raises(SpecError, match="key_columns"):
        IngestSpec(HERE, write_mode="upsert", tables=(IngestRoute("*.parquet", "users"),))
    IngestSpec(HERE, write_mode="upsert", tables=(IngestRoute("*.parquet", "users", ("id",)),))


def test_modes():
    assert TableSpec("t").mode == "full"
    assert TableSpec("t", incremental_column="id", incremental_column_is_unique=True).mode == (
        "incremental (unique watermark)"
    )
    cursor = TableSpec("t", incremental_column="u", incremental_tiebreaker_column="id")
    assert cursor.mode == "incremental (cursor)"
    assert "missing tiebreaker" in TableSpec("t", incremental_column="u").mode


@pytest.mark.parametrize(
    "spec, message",
    [
        (TableSpec("t", incremental_column="u"), "needs a tiebreaker"),
        (TableSpec("t", incremental_column="u", incremental_tiebreaker_column="u"), "cannot be both"),
        (TableSpec("t", incremental_column="x", incremental_tiebreaker_column="id"), "'x' is not among"),
        (TableSpec("t", incremental_column="u", incremental_tiebreaker_column="x"), "'x' is not among"),
    ],
)
def test_incremental_checks(spec, message):
    with pytest.raises(SpecError, match=message):
        check_incremental(spec, ["id", "u"])


def test_incremental_checks_pass():
    check_incremental(TableSpec("t"), [])
    check_incremental(
        TableSpec("t", incremental_column="id", incremental_column_is_unique=True), ["id"]
    )


@pytest.mark.parametrize(
    "ref, parts",
    [
        ("analytics.users", ("analytics", "users")),
        ("users", (None, "users")),
        (".users", (None, ".users")),
        ("users.", (None, "users.")),
        ("a.b.c", ("a", "b.c")),
    ],
)
def test_parse_table_ref(ref, parts):
    assert parse_table_ref(ref) == parts


def test_select_table():
    tables = [TableSpec("users", "a"), TableSpec("users", "b"), TableSpec("orders")]
    assert select_table("a.users", tables) is tables[0]
    assert select_table("orders", tables) is tables[2]
    assert select_table("public.orders", tables) is tables[2]
    assert select_table("new.thing", tables) == TableSpec("thing", "new")
    with pytest.raises(SpecError, match="ambiguous"):
        select_table("users", tables)
