from datetime import datetime, timezone

import pytest

from tidemark.operators.increments import NullKeyError, Position
from tidemark.plans.sync import Sync, SyncFailed, sync_plan
from tidemark.sinks import parquet
from tidemark.sinks.ledger import Ledger
from tidemark.sources.tables import MissingTable, catalog_listing, catalog_source, parquet_source
from tidemark.specs import Location, SpecError, SyncSpec, TableSpec

RUN_TS = datetime(2026, 2, 3, 4, 5, 6, tzinfo=timezone.utc)
T0, T1 = datetime(2026, 1, 1), datetime(2026, 1, 1, 0, 1)
USERS = TableSpec("users", incremental_column="updated_at", incremental_tiebreaker_column="id")
ROWS = [(1, T0, "a"), (2, T0, "b"), (3, T0, "c"), (4, T1, "d")]
SCHEMA = "id int, updated_at timestamp, payload string"


class Place:
    """A source of frames by name, a ledger and an output folder."""

    def __init__(self, spark, root):
        self.spark, self.base = spark, f"{root}/out"
        self.ledger = Ledger(spark, f"{root}/ledger")
        self.frames = {"users": spark.createDataFrame(ROWS, SCHEMA)}

    def source(self, spec):
        if spec.name not in self.frames:
            raise MissingTable(f"table {spec.full_name} has no visible columns")
        return self.frames[spec.name]

    def sync(self, *tables, **kwargs):
        options = {k: kwargs.pop(k) for k in ("rules", "source_types") if k in kwargs}
        spec = SyncSpec(output=Location(path=self.base), tables=tables or (USERS,), **kwargs)
        return Sync(self.spark, spec, self.source, self.ledger, **options)

    def ids(self, spec=USERS):
        return sorted(r["id"] for r in parquet.read_output(self.spark, self.base, spec).collect())


@pytest.fixture
def place(spark, tmp_path):
    return Place(spark, str(tmp_path))


def test_resume_writes_only_later_rows(place):
    place.ledger.set_progress("public.users", Position("2026-01-01 00:00:00.000000", "2"))
    (done,) = place.sync().run()
    assert place.ids() == [3, 4] and done.rows == 2
    assert place.ledger.get_progress("public.users") == Position("2026-01-01 00:01:00.000000", "4")
    (again,) = place.sync().run()
    assert again.rows == 0 and place.ids() == [3, 4]


def test_watermark_without_cursor_fails(place):
    place.ledger.set_progress("public.users", Position("2026-01-01 00:00:00.000000"))
    with pytest.raises(SyncFailed, match="watermark but no cursor"):
        place.sync().run()


def test_position_from_a_second_source(place):
    spec = SyncSpec(output=Location(path=place.base), tables=(USERS,))
    early = place.frames["users"].where("id < 4")
    sync = Sync(place.spark, spec, place.source, place.ledger, relational=lambda _: early)
    sync.run()
    assert place.ids() == [1, 2, 3]
    assert place.ledger.get_progress("public.users").cursor == "3"


def test_unique_watermark(place):
    spec = TableSpec("users", incremental_column="id", incremental_column_is_unique=True)
    place.sync(spec).run()
    assert place.ledger.get_progress("public.users") == Position("4", None)
    assert place.ids() == [1, 2, 3, 4]


def test_stale_progress_is_cleared_and_resynced(place):
    place.ledger.set_progress("public.users", Position("2026-01-01 00:00:00.000000", "two"))
    place.sync().run()
    assert place.ids() == [1, 2, 3, 4]


def test_failures_do_not_stop_other_tables(place):
    with pytest.raises(SyncFailed, match="1 table.*missing.*no visible columns") as caught:
        place.sync(TableSpec("missing"), USERS).run()
    assert [name for name, _ in caught.value.failures] == ["missing"]
    assert place.ids() == [1, 2, 3, 4]
    by_table = {r["table_name"]: r for r in place.ledger.runs().collect()}
    assert by_table["public.missing"]["status"] == "failed"
    assert "no visible columns" in by_table["public.missing"]["error"]
    assert (by_table["public.users"]["status"], by_table["public.users"]["rows"]) == ("succeeded", 4)


def test_bad_spec_fails(place):
    with pytest.raises(SyncFailed, match="needs a tiebreaker"):
        place.sync(TableSpec("users", incremental_column="id")).run()
    with pytest.raises(SpecError, match="not among the selected"):
        place.sync().sync_table(
            TableSpec("users", columns=("id",), incremental_column="updated_at",
                      incremental_tiebreaker_column="id")
        )


@pytest.mark.parametrize("crash", ["write", "finish"])
def test_a_crashed_run_is_replayed_once(place, monkeypatch, crash):
    """Rows that arrive between the crash and the retry come with the next run."""
    def fail(*_, **__):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        if crash == "write":
            patch.setattr(parquet, "write_parquet", fail)
        else:
            patch.setattr(place.ledger, "finish", fail)
        with pytest.raises(SyncFailed, match="lost"):
            place.sync().run()
    place.frames["users"] = place.spark.createDataFrame([*ROWS, (5, T1, "e")], SCHEMA)
    (replay,) = place.sync().run()
    assert replay.position.cursor == "4" and place.ids() == [1, 2, 3, 4]
    place.sync().run()
    assert place.ids() == [1, 2, 3, 4, 5]


def test_null_keys(place):
    place.frames["users"] = place.spark.createDataFrame([*ROWS, (9, None, "n")], SCHEMA)
    with pytest.raises(SyncFailed) as caught:
        place.sync().run()
    assert isinstance(caught.value.failures[0][1], NullKeyError)
    place.sync(null_keys="skip").run()
    assert place.ids() == [1, 2, 3, 4]


@pytest.mark.parametrize(
    "partition_by, folder",
    [
        ("date", "year=2026/month=02/day=03"), ("month", "year=2026/month=02"),
        ("year", "year=2026"), (None, ""),
    ],
)
def test_run_date_folders(place, partition_by, folder):
    spec = TableSpec("users", schema="sales", partition_by=partition_by)
    (done,) = place.sync(spec).run(run_ts=RUN_TS)
    assert f"/out/sales.users/{folder + '/' if folder else ''}run=" in done.path
    back = parquet.read_output(place.spark, place.base, spec)
    assert back.columns == ["id", "updated_at", "payload", *[p.split("=")[0] for p in folder.split("/") if p]]
    if partition_by == "date":
        assert back.first()["month"] == "02"


def test_full_copies(place):
    spec = TableSpec("users", partition_by="year", columns=("payload", "id", "nope"))
    for _ in range(2):
        place.sync(spec).run(run_ts=RUN_TS)
    assert place.ids(spec) == [1, 1, 2, 2, 3, 3, 4, 4]
    place.sync(spec, write_mode="overwrite").run(run_ts=RUN_TS)
    assert place.ids(spec) == [1, 2, 3, 4]
    assert parquet.read_output(place.spark, place.base, spec).columns == ["id", "payload", "year"]


def test_nothing_is_written_for_an_empty_table(place, tmp_path):
    place.frames["users"] = place.spark.createDataFrame([], SCHEMA)
    outcomes = place.sync(USERS, TableSpec("users", schema="other")).run()
    assert [(o.rows, o.path) for o in outcomes] == [(0, None), (0, None)]
    assert not (tmp_path / "out").exists()


def test_rows_per_file(place):
    (done,) = place.sync(TableSpec("users"), batch_size=1).run()
    files = place.spark.read.parquet(done.path).inputFiles()
    assert len(files) == 4


def test_quality_is_kept_with_the_run(place):
    rules = {"public.users": {"payload_known": ("payload <> 'a'", "warning")}}
    place.sync(rules=rules).run()
    row = place.ledger.runs().first()
    assert (row["severity"], row["metrics_json"]) == ("warning", '{"rows":4,"payload_known":1}')


def test_source_types(place):
    types = {"public.users": {"id": "bigint", "updated_at": "timestamp"}}
    (done,) = place.sync(source_types=types).run()
    assert dict(place.spark.read.parquet(done.path).dtypes)["id"] == "bigint"
    assert dict(place.spark.read.parquet(done.path).dtypes)["updated_at"] == "timestamp_ntz"


def test_discovered_tables(place):
    listing = place.spark.createDataFrame(
        [("public", "users"), ("public", "gone"), ("public", "skipme"), ("other", "x")],
        "schema_name string, table_name string",
    )
    spec = SyncSpec(output=Location(path=place.base), exclude=("skipme",))
    sync = Sync(place.spark, spec, place.source, place.ledger)
    assert [t.full_name for t in sync.tables(listing)] == ["public.gone", "public.users"]
    outcomes = {o.table: o for o in sync.run(listing)}
    assert outcomes["public.gone"].skipped and outcomes["public.users"].rows == 4
    with pytest.raises(MissingTable):
        sync.run()


def test_catalog_tables_and_lake_table(spark, place):
    spark.sql("CREATE SCHEMA IF NOT EXISTS shop")
    place.frames["users"].write.mode("overwrite").saveAsTable("shop.clients")
    listing = catalog_listing(spark)
    assert ("shop", "clients") in {tuple(r) for r in listing.collect()}
    source = catalog_source(spark)
    assert source(TableSpec("clients", "shop")).count() == 4
    with pytest.raises(MissingTable, match="no visible columns"):
        source(TableSpec("nobody", "shop"))
    refused = SyncSpec(format="iceberg", warehouse="/w", tables=(TableSpec("users", "lake"),))
    with pytest.raises(SyncFailed, match="iceberg is not on the classpath"):
        Sync(spark, refused, place.source, place.ledger).run()
    spec = SyncSpec(
        format="iceberg", warehouse="/w", lake_fallback="parquet",
        tables=(TableSpec("clients", "shop", incremental_column="id", incremental_column_is_unique=True),),
    )
    lake = Sync(spark, spec, lambda s: source(s).withColumnRenamed("payload", "note"), place.ledger)
    with pytest.raises(SyncFailed):
        lake.run()  # the name is taken by a table of other columns
    spec2 = SyncSpec(format="iceberg", warehouse="/w", lake_fallback="parquet", tables=(TableSpec("users", "lake"),))
    for want in (4, 8):
        (done,) = Sync(spark, spec2, place.source, place.ledger).run()
        assert done.rows == 4 and spark.table("lake.users").count() == want


def test_plan(spark, tmp_path):
    spark.createDataFrame(ROWS, SCHEMA).write.parquet(str(tmp_path / "users.parquet"))
    source = parquet_source(spark, str(tmp_path))
    plan = sync_plan(spark, source, [USERS, TableSpec("users", columns=("id",), partition_by="date")])
    assert [tuple(r) for r in plan.collect()] == [
        ("users", "incremental (cursor)", None, 3, "id, updated_at, payload", "updated_at", "id"),
        ("users", "full", "date", 1, "id", None, None),
    ]
    counted = sync_plan(spark, source, [USERS], count_rows=True).first()
    assert counted["source_rows"] == 4
